"""Epoch order, rank slices, length blocks and batches.

The order of an epoch is a stable hash order numbered across the cluster. Batches are
closed one after the other, but only inside a window of a few hundred rows, so the
windows are packed in parallel and no window grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxframe.functions.arrays import each_with, pad_right
from voxframe.functions.hashing import stable_key
from voxframe.operators.ordering import contiguous_slice, running_total, spread_sorted, with_ordinal

# ---- fixed values -----------------------------------------------------------
RANKS = 8
LENGTH_WINDOW = 512
SORT_BLOCK = 500
# -----------------------------------------------------------------------------


def epoch_order(df: DataFrame, key: str, seed: int, epoch: int = 0, out: str = "ordinal") -> DataFrame:
    """Seeded permutation of the rows as a 0-based ordinal; another epoch gives another one."""
    return with_ordinal(df.withColumn("_key", stable_key(seed, epoch, F.col(key))), "_key", key, out=out).drop("_key")


def rank_slices(df: DataFrame, ordinal: str, rows: int, ranks: int) -> DataFrame:
    """Rank ``ordinal mod ranks``; with fewer rows than ranks, rows repeat until each rank has one."""
    if rows >= ranks or rows == 0:
        return df.withColumn("rank", F.pmod(F.col(ordinal), F.lit(ranks)).cast("int"))
    copies = F.sequence(F.col(ordinal).cast("int"), F.lit(ranks - 1), F.lit(rows))
    return df.withColumn("rank", F.explode(copies))


def contiguous_split(df: DataFrame, keys: Sequence[str], parts: int, exact: bool = False) -> DataFrame:
    """Contiguous, nearly equal slices in key order; ``exact`` demands equal ones."""
    numbered = with_ordinal(df, *keys)
    rows = numbered.count()
    if exact and rows % parts:
        raise ValueError(f"{rows} rows cannot be split into {parts} equal parts")
    return numbered.withColumn("part", contiguous_slice(F.col("ordinal"), rows, parts))


def length_sorted_blocks(df: DataFrame, ordinal: str, length: str, key: str, block: int = SORT_BLOCK) -> DataFrame:
    """Consecutive blocks of the order, each sorted by length; adds ``block`` and ``place``."""
    blocked = df.withColumn("block", F.floor(F.col(ordinal) / block))
    window = Window.partitionBy("block").orderBy(length, ordinal, key)
    return blocked.withColumn("place", F.row_number().over(window) - 1)


def static_batches(df: DataFrame, ordinal: str, columns: Sequence[str], size: int) -> DataFrame:
    """Lists of ``size`` consecutive rows; the remainder forms the last one."""
    rows = F.sort_array(F.collect_list(F.struct(ordinal, *columns)))
    return df.groupBy(F.floor(F.col(ordinal) / size).alias("batch")).agg(rows.alias("rows"))


def batch_starts(lengths: Sequence[Column], budget: int) -> Column:
    """Places, from 0, at which batches start in parallel length arrays.

    A batch is closed when its padded size with the next row, rows times the sum of the
    longest of each length, would exceed the budget. The fold carries the open batch; only
    a closed one adds to the list.
    """
    names = [f"l{i}" for i in range(len(lengths))]
    rows = F.arrays_zip(*[c.cast("array<bigint>").alias(n) for n, c in zip(names, lengths)])
    zero = F.lit(0).cast("bigint")
    start = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("at"), F.lit(0).alias("held"), *[zero.alias(n) for n in names])

    def place(state: Column, row: Column) -> Column:
        padded = sum((F.greatest(state[n], row[n]) for n in names), zero)
        fits = (state["held"] > 0) & ((state["held"] + 1) * padded <= budget)
        return F.struct(
            F.when(fits, state["starts"]).otherwise(F.concat(state["starts"], F.array(state["at"]))).alias("starts"),
            (state["at"] + 1).alias("at"),
            F.when(fits, state["held"] + 1).otherwise(1).alias("held"),
            *[F.when(fits, F.greatest(state[n], row[n])).otherwise(row[n]).alias(n) for n in names],
        )

    return F.aggregate(rows, start, place, lambda state: state["starts"])


def budget_batches(
    df: DataFrame, ordinal: str, key: str, lengths: Sequence[str], budget: int, window: int = LENGTH_WINDOW
) -> DataFrame:
    """One row per batch: ``window``, ``batch``, its rows in order and its padded size.

    Windows of the order are sorted by total length; inside one, a batch closes before
    ``rows * (sum of the longest of each length)`` would exceed the budget, and at the
    window's end. A first row beyond the budget gets a batch of its own. A window is
    shuffled once; its batches are slices of it.
    """
    total = sum((F.col(c) for c in lengths), F.lit(0))
    fields = F.struct(total.alias("_total"), F.col(ordinal).alias("_ordinal"), F.col(key), *lengths)
    windows = df.groupBy(F.floor(F.col(ordinal) / window).alias("window")).agg(F.sort_array(F.collect_list(fields)).alias("_rows"))
    windows = windows.withColumn("_starts", batch_starts([F.col(f"_rows.{c}") for c in lengths], budget))
    opened = windows.select("window", "_rows", "_starts", F.posexplode("_starts").alias("batch", "_from"))
    upto = F.coalesce(F.get("_starts", F.col("batch") + 1), F.size("_rows"))
    cut = opened.select("window", "batch", "_from", F.slice("_rows", F.col("_from") + 1, upto - F.col("_from")).alias("_rows"))
    members = F.transform("_rows", lambda r, i: F.struct((F.col("_from") + i).alias("place"), *[r[c].alias(c) for c in (key, *lengths)]))
    longest = sum((F.array_max(F.col(f"_rows.{c}")) for c in lengths), F.lit(0))
    n = F.size("_rows").cast("bigint")
    return cut.select("window", "batch", n.alias("n"), (longest * n).alias("padded_size"), members.alias("rows"))


def assign_ranks(batches: DataFrame, ranks: int = RANKS, equal_steps: bool = False) -> DataFrame:
    """Global batch ordinal, its rank ``ordinal mod ranks`` and step; optionally empty batches for equal steps."""
    numbered = with_ordinal(batches, "window", "batch", out="batch_ordinal")
    placed = numbered.withColumns(
        {
            "rank": F.pmod("batch_ordinal", F.lit(ranks)).cast("int"),
            "step": F.floor(F.col("batch_ordinal") / ranks),
        }
    )
    if not equal_steps:
        return placed
    total = placed.count()
    missing = -total % ranks
    spark = batches.sparkSession
    filler = spark.range(total, total + missing, 1, 1).select(
        F.col("id").alias("batch_ordinal"),
        F.pmod("id", F.lit(ranks)).cast("int").alias("rank"),
        F.floor(F.col("id") / ranks).alias("step"),
        F.lit(0).cast("bigint").alias("n"),
    )
    return placed.unionByName(filler, allowMissingColumns=True)


def fraction_boundaries(df: DataFrame, order: Sequence[str], samples: str, eligible: int, parts: int = 8) -> DataFrame:
    """First row of the order at which the running sample sum reaches each ``ceil(eligible * k / parts)``."""
    if eligible < 1:
        raise ValueError("eligible must be positive")
    summed = running_total(spread_sorted(df, *order), samples, "reached")
    before = F.col("reached") - F.col(samples)
    targets = F.array(
        *[F.struct(F.lit(k).alias("boundary"), F.lit(-(-eligible * k // parts)).alias("target")) for k in range(1, parts + 1)]
    )
    # A row answers for the targets between the sum before it and the sum with it.
    hit = F.filter(targets, lambda t: (t["target"] > before) & (t["target"] <= F.col("reached")))
    return summed.withColumn("_t", F.explode(hit)).select(
        F.col("_t.boundary").alias("boundary"), F.col("_t.target").alias("target"), *order, "reached"
    )


def padded(rows: Column, field: str, fill: int | float = 0) -> Column:
    """The field's arrays of a batch padded to the longest, or null when a row lacks it."""
    arrays = F.transform(rows, lambda r: r[field])
    longest = F.array_max(F.transform(arrays, lambda a: F.size(a)))
    complete = F.forall(arrays, lambda a: a.isNotNull())
    return F.when(complete, each_with(longest, arrays, lambda n, a: pad_right(a, n, fill)))


def field_lengths(rows: Column, field: str) -> Column:
    """Array sizes of a field of a batch, or null when a row lacks it."""
    arrays = F.transform(rows, lambda r: r[field])
    return F.when(F.forall(arrays, lambda a: a.isNotNull()), F.transform(arrays, lambda a: F.size(a)))
