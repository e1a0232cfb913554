"""Seeded samples, best-of and extreme rows. No random numbers: order comes from stable keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxframe.functions.hashing import stable_key
from voxframe.operators.ordering import with_ordinal
from voxframe.session import materialize

# ---- fixed values -----------------------------------------------------------
SEED = 1986
RESERVED_PROMPTS = 20
PILOT_ROWS = 33
ROWS_PER_PHASE = 32
# -----------------------------------------------------------------------------


def lowest_scores(df: DataFrame, key: str, count: int, seed: int = SEED, score: str = "score") -> DataFrame:
    """The ``count`` rows with the lowest (stable key, id); independent of input order."""
    return df.withColumn(score, stable_key(seed, key)).orderBy(score, key).limit(count)


def reserved_prompts(eligible: DataFrame, key: str, count: int = RESERVED_PROMPTS, seed: int = SEED, strict: bool = True) -> DataFrame:
    """``(key, reservation_score)`` of the reserved rows; with ``strict`` too few eligible rows are an error."""
    chosen = lowest_scores(eligible.select(key), key, count, seed, "reservation_score")
    if strict and chosen.count() < count:
        raise ValueError(f"fewer than {count} rows can be reserved")
    return chosen


def lowest_per_group(df: DataFrame, group: str, key: str, count: int, seed: int = SEED) -> DataFrame:
    """The ``count`` lowest-scored rows of every group.

    Spark limits each group to ``count`` rows per task before the shuffle, so a hot
    group never travels whole.
    """
    window = Window.partitionBy(group).orderBy("score", key)
    scored = df.withColumn("score", stable_key(seed, key))
    return scored.withColumn("place", F.row_number().over(window)).where(F.col("place") <= count)


def extreme_rows(df: DataFrame, phase: str, key: str, length: str, seed: int = SEED) -> DataFrame:
    """Shortest and longest row of each phase; ties go to the lower stable key of (seed, phase, id)."""
    scored = df.select(phase, key, length, stable_key(seed, phase, key).alias("score"))
    kept = [F.col(key), F.col(length)]
    picked = scored.groupBy(phase).agg(
        F.min(F.struct(F.col(length).alias("_l"), "score", *[c.alias(f"_v{i}") for i, c in enumerate(kept)])).alias("short"),
        F.min(F.struct((-F.col(length)).alias("_l"), "score", *[c.alias(f"_v{i}") for i, c in enumerate(kept)])).alias("long"),
    )
    sides = F.array(
        F.struct(F.lit("short").alias("extreme"), F.col("short._v0").alias(key), F.col("short._v1").alias(length)),
        F.struct(F.lit("long").alias("extreme"), F.col("long._v0").alias(key), F.col("long._v1").alias(length)),
    )
    distinct = F.col("short._v1") != F.col("long._v1")
    return picked.select(phase, F.explode(sides).alias("s"), distinct.alias("lengths_differ")).select(
        phase, "s.extreme", f"s.{key}", f"s.{length}", "lengths_differ"
    )


def require_extremes(extremes: DataFrame, key: str, rows: int = 4) -> DataFrame:
    """Check a selection of extremes: lengths differ in every phase and all ids are distinct."""
    kept = materialize(extremes, "extremes")
    facts = kept.agg(
        F.bool_and("lengths_differ").alias("differ"), F.count_distinct(key).alias("ids"), F.count(F.lit(1)).alias("rows")
    ).first()
    if not facts["differ"]:
        raise ValueError("a phase lacks distinct short and long rows")
    if facts["ids"] != rows or facts["rows"] != rows:
        raise ValueError(f"the selection needs {rows} distinct rows")
    return kept


def worst_rows(df: DataFrame, utterance: str, number: str, key: str, count: int = 20) -> DataFrame:
    """Rows with most utterance errors, then most number errors, then the lowest id."""
    return df.orderBy(F.desc(utterance), F.desc(number), F.asc(key)).limit(count)


def best_by_loss(df: DataFrame, loss: str, key: str, count: int) -> DataFrame:
    """The ``count`` rows of lowest loss."""
    return df.orderBy(F.asc(loss), F.asc(key)).limit(count)


def retained(df: DataFrame, index: str, key: str, current: object, count: int) -> DataFrame:
    """The newest ``count`` rows by index, plus the current one."""
    newest = df.orderBy(F.desc(index), F.desc(key)).limit(count)
    return newest.unionByName(df.where(F.col(key) == current)).distinct()


def stratified_by_length(df: DataFrame, length: str, key: str) -> DataFrame:
    """First, middle and last row in the order of (length, id)."""
    ranked = with_ordinal(df, length, key)
    count = ranked.count()
    return ranked.where(F.col("ordinal").isin(sorted({0, count // 2, count - 1})))


def longest_first(items: Column, length: str) -> Column:
    """Array of structs in descending order of a length field, ties in their given order."""
    indexed = F.transform(items, lambda x, i: F.struct((-x[length]).alias("l"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(indexed), lambda s: s["x"])


def first_per_group(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """First row of each group in the given order."""
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).where(F.col("_place") == 1).drop("_place")
