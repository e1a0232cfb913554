"""Set operations over keys and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables; a column a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def labelled_union(tables: Mapping[str, DataFrame], label: str = "split") -> DataFrame:
    """Union with the table's name in a label column."""
    return union_all([df.withColumn(label, F.lit(name)) for name, df in tables.items()])


def set_difference(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys missing from ``actual`` and keys unexpected in it; empty when the sets are equal."""
    left = expected.select(key).distinct().withColumn("_e", F.lit(True))
    right = actual.select(key).distinct().withColumn("_a", F.lit(True))
    joined = left.join(right, key, "full_outer").where(F.col("_e").isNull() | F.col("_a").isNull())
    return joined.select(key, F.when(F.col("_a").isNull(), "missing").otherwise("unexpected").alias("difference"))


def unexpected_keys(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``actual`` that are not expected."""
    return actual.select(key).subtract(expected.select(key))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def without_duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once; every copy of a repeated key is discarded.

    The repeated keys are counted first and removed by an anti-join, so the copies of
    a hot key are never brought together.
    """
    return df.join(duplicate_keys(df, keys).select(*keys), list(keys), "left_anti")


def latest_per_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """Newest record per key; versions are unique within a key."""
    others = [c for c in df.columns if c != key]
    newest = df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(version)).alias("_row"))
    return newest.select(key, *[F.col(f"_row.{c}").alias(c) for c in others])


def upsert(registry: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """Registry with the changes applied; the higher version replaces."""
    return latest_per_key(registry.unionByName(changes), key, version)
