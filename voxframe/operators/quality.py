"""Checks that report or stop: constraints, coverage, limits, audits, reuse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxframe.operators.aggregates import dataset_digest

# ---- fixed values -----------------------------------------------------------
MOST_ROWS_PER_SHARD = 8000
# -----------------------------------------------------------------------------


def finite_or_null(value: Column) -> Column:
    """Null or a finite number; a null and a NaN are different things."""
    infinite = F.abs(value) == float("inf")
    return value.isNull() | ~(F.isnan(value) | infinite)


def filled(value: Column) -> Column:
    """Non-empty string."""
    return F.coalesce(value != "", F.lit(False))


def optional_string(value: Column) -> Column:
    """Null or a non-empty string."""
    return value.isNull() | (value != "")


def non_negative(value: Column) -> Column:
    """Present and at least zero."""
    return F.coalesce(value >= 0, F.lit(False))


def one_of(value: Column, allowed: Sequence, nullable: bool = False) -> Column:
    """One of the allowed values."""
    return F.coalesce(value.isin(*allowed), F.lit(nullable))


def violation_counts(df: DataFrame, constraints: Mapping[str, Column]) -> DataFrame:
    """Rows breaking each constraint, all counted in one pass; a null verdict counts as broken."""
    counted = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in constraints.items()])
    return counted.unpivot([], list(constraints), "constraint", "violations")


def require_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The table itself, if its names and types are exactly the expected ones."""
    expected = [(f.name, f.dataType) for f in schema]
    actual = [(f.name, f.dataType) for f in df.schema]
    if len({n for n, _ in actual}) != len(actual):
        raise ValueError("duplicate column names")
    if sorted(expected, key=lambda p: p[0]) != sorted(actual, key=lambda p: p[0]):
        raise ValueError(f"unexpected columns: {df.schema.simpleString()}")
    return df


def id_coverage(df: DataFrame, key: str, first: int, last: int | None = None, categories: tuple[str, int] | None = None) -> DataFrame:
    """Facts about ids that should run from ``first`` without gap or repeat, and whether they do."""
    facts = [
        F.min(key).alias("first_id"),
        F.max(key).alias("last_id"),
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("distinct_ids"),
    ]
    if categories:
        facts.append(F.count_distinct(categories[0]).alias("categories"))
    out = df.agg(*facts)
    end = F.col("last_id") if last is None else F.lit(last)
    ok = (
        (F.col("first_id") == first)
        & (F.col("last_id") == end)
        & (F.col("distinct_ids") == end - first + 1)
        & (F.col("rows") == F.col("distinct_ids"))
    )
    if categories:
        ok = ok & (F.col("categories") == categories[1])
    return out.withColumn("covered", ok)


def oversized_groups(df: DataFrame, group: Column | str, most: int = MOST_ROWS_PER_SHARD) -> DataFrame:
    """Groups with more rows than allowed."""
    column = F.col(group) if isinstance(group, str) else group
    return df.groupBy(column.alias("group")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > most)


def audit_differences(manifest: DataFrame, recomputed: DataFrame, keys: Sequence[str], facts: Sequence[str]) -> DataFrame:
    """Long table of facts that differ between a manifest and what the data says, either side possibly missing."""
    left = manifest.select(*keys, *[F.col(f).cast("string").alias(f"_m_{f}") for f in facts], F.lit(True).alias("_in_m"))
    right = recomputed.select(*keys, *[F.col(f).cast("string").alias(f"_r_{f}") for f in facts], F.lit(True).alias("_in_r"))
    joined = left.join(right, list(keys), "full_outer")
    entries = F.array(
        *[
            F.struct(F.lit(f).alias("fact"), F.col(f"_m_{f}").alias("declared"), F.col(f"_r_{f}").alias("found"))
            for f in facts
        ]
    )
    wrong = F.filter(entries, lambda e: ~e["declared"].eqNullSafe(e["found"]))
    return joined.select(*keys, F.explode(wrong).alias("e")).select(*keys, "e.fact", "e.declared", "e.found")


def table_differences(published: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Rows only in the published or only in the recomputed table, copies counted.

    Both tables are read once: equal rows cancel in one grouped sum.
    """
    columns = published.columns
    sides = published.withColumn("_n", F.lit(1)).union(recomputed.select(*columns).withColumn("_n", F.lit(-1)))
    left = sides.groupBy(*columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    side = F.when(F.col("_n") > 0, "published").otherwise("recomputed")
    copies = F.array_repeat(side, F.abs("_n").cast("int"))
    return left.select(*columns, F.explode(copies).alias("only_in"))


def fingerprint(df: DataFrame, columns: Sequence[str], seed: int, schema_version: int) -> str:
    """Identity of an input table together with the settings that shape the result."""
    row = dataset_digest(df, columns).first()
    digest, rows = (row["digest"], row["rows"]) if row else ("", 0)
    return f"{schema_version}:{seed}:{rows}:{digest}"
