"""Global order on a cluster: ordinals, ranks, running totals and previous rows.

A window without ``partitionBy`` sends the whole table to one task, and a window
over a hot key sends that key's rows to one task. Everything here works on a
table that is range-partitioned by the full sort key instead, so a hot group is
spread over several partitions; one small row per (partition, group) carries a count,
a sum or a last row from one partition to the next.

The sort key must identify a row (end it with a unique id), otherwise equal rows
could swap places between runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxframe.session import materialize

PART = "_part"
POS = "_pos"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _column(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


def spread_sorted(df: DataFrame, *keys: str | Column, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``keys``; add ``_part`` and ``_pos`` and write once."""
    order = [_column(k) for k in keys]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    row_id = F.monotonically_increasing_id()
    numbered = (
        ranged.sortWithinPartitions(*order)
        .withColumn("_row_id", row_id)
        .withColumn(PART, F.shiftright("_row_id", _ROW_BITS).cast("int"))
        .withColumn(POS, F.col("_row_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_row_id")
    )
    return materialize(numbered, "sorted")


def _prefix(summary: DataFrame, value: str, within: Sequence[str]) -> DataFrame:
    """Sum of ``value`` over the earlier partitions of each group, as ``_carry``.

    One row per (partition, group) comes in. Without groups that is one row per range
    partition, so the window without ``partitionBy`` stays small.
    """
    window = Window.partitionBy(*within).orderBy(PART) if within else Window.orderBy(PART)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return summary.withColumn("_carry", F.coalesce(F.sum(value).over(before), F.lit(0)))


def ordinals_of(frame: DataFrame, out: str = "ordinal") -> DataFrame:
    """0-based global ordinal of a table made by :func:`spread_sorted`."""
    sizes = frame.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    # One row per range partition, a number fixed by the partition count: safe to broadcast.
    offsets = F.broadcast(_prefix(sizes, "_n", ()).drop("_n"))
    return frame.join(offsets, PART).withColumn(out, F.col(POS) + F.col("_carry")).drop("_carry")


def with_ordinal(df: DataFrame, *keys: str | Column, out: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """Stable 0-based ordinal of every row in the order of ``keys``."""
    return ordinals_of(spread_sorted(df, *keys, partitions=partitions), out).drop(PART, POS)


def running_total(frame: DataFrame, value: str, out: str, within: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sum of ``value`` in sorted order, per group when ``within`` is given.

    What a group brings along from earlier partitions enters as one extra row before the
    group's first row of the partition; only groups that cross a boundary have one.
    """
    summary = frame.groupBy(PART, *within).agg(F.sum(value).alias("_n"))
    carried = _prefix(summary, "_n", within).where(F.col("_carry") != 0)
    extra = carried.select(PART, *within, F.lit(-1).cast("bigint").alias(POS), F.col("_carry").alias("_term"))
    rows = frame.withColumn("_term", F.col(value)).unionByName(extra, allowMissingColumns=True)
    upto = Window.partitionBy(PART, *within).orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(out, F.sum("_term").over(upto)).where(F.col(POS) >= 0).drop("_term")


def ranks_of(frame: DataFrame, within: Sequence[str], out: str = "rank") -> DataFrame:
    """0-based position inside each group of a table sorted by (within, order)."""
    counted = running_total(frame.withColumn("_one", F.lit(1)), "_one", out, within)
    return counted.withColumn(out, F.col(out) - 1).drop("_one")


def with_rank(
    df: DataFrame, within: Sequence[str], *keys: str | Column, out: str = "rank", partitions: int | None = None
) -> DataFrame:
    """0-based position of each row inside its group, also for groups too big for one task."""
    frame = spread_sorted(df, *within, *keys, partitions=partitions)
    return ranks_of(frame, within, out).drop(PART, POS)


def previous_row(frame: DataFrame, columns: Sequence[str], out: str, within: Sequence[str] = ()) -> DataFrame:
    """Struct of ``columns`` of the preceding row in sorted order; null for a group's first row.

    The last row of a group's earlier partition enters as one extra row, as in
    :func:`running_total`.
    """
    packed = frame.withColumn("_packed", F.struct(*columns))
    last = packed.groupBy(PART, *within).agg(F.max_by("_packed", POS).alias("_last"))
    order = Window.partitionBy(*within).orderBy(PART) if within else Window.orderBy(PART)
    carried = last.withColumn("_packed", F.lag("_last").over(order)).where(F.col("_packed").isNotNull())
    extra = carried.select(PART, *within, F.lit(-1).cast("bigint").alias(POS), "_packed")
    rows = packed.unionByName(extra, allowMissingColumns=True)
    before = F.lag("_packed").over(Window.partitionBy(PART, *within).orderBy(POS))
    return rows.withColumn(out, before).where(F.col(POS) >= 0).drop("_packed")


def contiguous_slice(ordinal: Column, total: Column | int, parts: Column | int) -> Column:
    """Slice number of an ordinal when ``total`` rows are cut into ``parts`` nearly equal runs.

    The first ``total mod parts`` slices hold one row more; never more slices than rows.
    """
    n = F.lit(total) if isinstance(total, int) else total
    k = F.least(F.lit(parts) if isinstance(parts, int) else parts, n)
    small = F.floor(n / k)
    extra = n % k
    cut = extra * (small + 1)
    return F.when(ordinal < cut, F.floor(ordinal / (small + 1))).otherwise(extra + F.floor((ordinal - cut) / small)).cast("int")


def order_breaks(frame: DataFrame, column: str) -> DataFrame:
    """Count steps up and down of ``column`` along the sorted table; monotone means one of them is 0."""
    stepped = previous_row(frame, [column], "_prev")
    before = F.col(f"_prev.{column}")
    return stepped.agg(
        F.count_if(F.col(column) > before).alias("steps_up"),
        F.count_if(F.col(column) < before).alias("steps_down"),
    ).withColumn("monotone", (F.col("steps_up") == 0) | (F.col("steps_down") == 0))
