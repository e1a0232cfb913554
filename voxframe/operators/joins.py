"""Joins that check keys and counts while they join.

Hints are left out on purpose: the planner broadcasts a side whose size it knows to
be below the threshold and splits skewed partitions of a shuffled join at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.functions.hashing import hash_index, stable_key
from voxframe.operators.ordering import with_ordinal


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row per key of either side: copies on each side and the ``issue``, or null.

    Only the keys travel. Copies are counted on the map side, so a key with many copies
    is one row before anything is shuffled.
    """

    def copies(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(f"n_{side}"))

    joined = copies(left, "left").join(copies(right, "right"), key, "full_outer")
    issue = (
        F.when(F.col("n_left").isNull(), "missing_left")
        .when(F.col("n_right").isNull(), "missing_right")
        .when(F.col("n_left") > 1, "duplicate_left")
        .when(F.col("n_right") > 1, "duplicate_right")
    )
    return joined.select(
        key,
        F.coalesce("n_left", F.lit(0)).alias("n_left"),
        F.coalesce("n_right", F.lit(0)).alias("n_right"),
        issue.alias("issue"),
    )


def issue_counts(reconciled: DataFrame) -> DataFrame:
    """Number of keys per issue."""
    return reconciled.where(F.col("issue").isNotNull()).groupBy("issue").agg(F.count(F.lit(1)).alias("keys"))


def fail_on_issue(df: DataFrame, what: str, issue: str = "issue", key: str | None = None) -> DataFrame:
    """Pass rows through; the first row with an issue stops the job."""
    detail = [F.lit(": "), F.coalesce(F.col(key).cast("string"), F.lit("null"))] if key else []
    message = F.concat(F.lit(f"{what}: "), F.col(issue), *detail)
    return df.where(F.when(F.col(issue).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).drop(issue)


def strict_join(
    left: DataFrame, right: DataFrame, key: str, left_columns: Sequence[str], right_columns: Sequence[str]
) -> DataFrame:
    """1:1 join; a duplicate or unmatched key on either side stops the job.

    Both tables empty is no error; one empty side is, as every key of the other is unmatched.
    """
    paired = fail_on_issue(_paired(left, right, key, left_columns, right_columns), "strict join", key=key)
    return paired.select(key, *[F.col("_l")[c].alias(c) for c in left_columns], *[F.col("_r")[c].alias(c) for c in right_columns])


def _paired(left: DataFrame, right: DataFrame, key: str, left_columns: Sequence[str], right_columns: Sequence[str]) -> DataFrame:
    """One row per key of either side with one record of each, ``_l`` and ``_r``, and the ``issue`` of the key.

    Each input is read once. Copies of a key are combined on the map side, and the checks lie
    on the rows of one full outer join, so an empty side cannot make the planner skip them.
    """

    def one(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
        record = F.struct(*[F.col(c) for c in columns]) if columns else F.struct(F.lit(True).alias("_there"))
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(f"_n{side}"), F.first(record).alias(f"_{side}"))

    issue = (
        F.when(F.col("_nl").isNull(), "missing_left")
        .when(F.col("_nr").isNull(), "missing_right")
        .when(F.col("_nl") > 1, "duplicate_left")
        .when(F.col("_nr") > 1, "duplicate_right")
    )
    return one(left, left_columns, "l").join(one(right, right_columns, "r"), key, "full_outer").withColumn("issue", issue)


def enrich(df: DataFrame, lookup: DataFrame, key: str, mandatory: Sequence[str]) -> DataFrame:
    """Left join with columns that must be found; a missing value stops the job."""
    joined = df.join(lookup, key, "left")
    found = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in mandatory))
    message = F.concat(
        F.lit(f"no {', '.join(mandatory)} for key "), F.coalesce(F.col(key).cast("string"), F.lit("null"))
    )
    return joined.where(F.when(found, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def two_hop(df: DataFrame, owners: DataFrame, vectors: DataFrame, key: str, owner: str) -> DataFrame:
    """Key to owner to the owner's record."""
    return df.join(owners, key, "left").join(vectors, owner, "left")


def optional(df: DataFrame, lookup: DataFrame | None, key: str, column: str, kind: str) -> DataFrame:
    """Left join of an optional column; without the lookup the column is null."""
    if lookup is None:
        return df.withColumn(column, F.lit(None).cast(kind))
    return df.join(lookup.select(key, column), key, "left")


def _compared(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], added: Sequence[str] = ()) -> DataFrame:
    """Left rows joined to the right ones, with ``issue`` naming the first listed column that differs."""
    renamed = right.select(key, *[F.col(c).alias(f"_r_{c}") for c in columns], *added)
    differs = [F.when(~F.col(c).eqNullSafe(F.col(f"_r_{c}")), F.lit(f"{c} differs")) for c in columns]
    joined = left.join(renamed, key).withColumn("issue", F.coalesce(*differs))
    return joined.drop(*[f"_r_{c}" for c in columns])


def mismatches(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys whose copies, presence or listed columns differ between two tables, with the reason."""
    audit = reconcile(left, right, key)
    sound = audit.where(F.col("issue").isNull()).select(key)
    differing = _compared(left.join(sound, key), right, key, columns)
    found = audit.select(key, "issue").unionByName(differing.select(key, "issue"))
    return found.where(F.col("issue").isNotNull())


def reconciled_rows(cache: DataFrame, plan: DataFrame, key: str, equal: Sequence[str], added: Sequence[str]) -> DataFrame:
    """Cache rows with plan columns added; key sets and the ``equal`` columns must agree, else the job stops."""
    kept = [c for c in cache.columns if c != key]
    paired = _paired(cache, plan, key, kept, [*dict.fromkeys([*equal, *added])])
    differs = [F.when(~F.col("_l")[c].eqNullSafe(F.col("_r")[c]), F.lit(f"{c} differs")) for c in equal]
    checked = fail_on_issue(paired.withColumn("issue", F.coalesce("issue", *differs)), "cache and plan disagree", key=key)
    columns = [F.col(key) if c == key else F.col("_l")[c].alias(c) for c in cache.columns]
    return checked.select(*columns, *[F.col("_r")[c].alias(c) for c in added])


def matched_and_unmatched(hypotheses: DataFrame, labels: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Hypotheses joined to their labels, and those without one."""
    return hypotheses.join(labels, key), hypotheses.join(labels, key, "left_anti")


def membership(df: DataFrame, ids: DataFrame, key: str, out: str) -> DataFrame:
    """Boolean column: is the key among ``ids``?"""
    marked = ids.select(key).distinct().withColumn(out, F.lit(True))
    return df.join(marked, key, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def round_robin(items: DataFrame, partners: DataFrame, item_key: str, partner_key: str) -> DataFrame:
    """Item i of the item order gets partner ``i mod n`` of the partner order."""
    count = partners.count()
    if count == 0:
        raise ValueError("round robin needs at least one partner")
    placed = with_ordinal(partners, partner_key, out="_slot")
    numbered = with_ordinal(items, item_key, out="item_ordinal")
    return numbered.withColumn("_slot", F.pmod("item_ordinal", F.lit(count))).join(placed, "_slot").drop("_slot")


def random_partner(items: DataFrame, partners: DataFrame, item_key: str, partner_key: str, seed: int) -> DataFrame:
    """One uniformly drawn partner per item, the same in every run with the same seed."""
    count = partners.count()
    if count == 0:
        raise ValueError("no partner to draw from")
    placed = with_ordinal(partners, partner_key, out="_slot")
    drawn = items.withColumn("_slot", hash_index(stable_key(seed, item_key), count))
    return drawn.join(placed, "_slot").drop("_slot")


def pending(expected: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Expected work not done yet."""
    return expected.join(done, key, "left_anti")


def unexpected(expected: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Done work nobody expected."""
    return done.join(expected, key, "left_anti")


def counter_difference(after: DataFrame, before: DataFrame, keys: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """Counters after minus before; keys missing before keep their value."""
    base = before.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in counters])
    joined = after.join(base, list(keys), "left")
    return joined.select(*keys, *[(F.col(c) - F.coalesce(f"_b_{c}", F.lit(0))).alias(c) for c in counters])


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str, column: str) -> DataFrame:
    """Chosen and rejected value per key."""
    return chosen.select(key, F.col(column).alias(f"chosen_{column}")).join(
        rejected.select(key, F.col(column).alias(f"rejected_{column}")), key
    )


