"""Set operations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.base import query, table
from voxframe.operators.sets import (
    duplicate_keys,
    labelled_union,
    latest_per_key,
    set_difference,
    union_all,
    unexpected_keys,
    upsert,
    without_duplicated,
)


@query("united_tables", "SET-01", sql="SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark")
def united_tables(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return union_all([docs, table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")])


@query(
    "labelled_splits",
    "SET-02",
    sql="SELECT doc_id AS id, 'train' AS split FROM documents UNION ALL SELECT item_id, 'test' FROM benchmark",
)
def labelled_splits(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    return labelled_union({"train": docs, "test": table(spark, folder, "benchmark").select(F.col("item_id").alias("id"))})


@query(
    "key_set_difference",
    "SET-03",
    sql="""WITH e AS (SELECT DISTINCT o_custkey AS key FROM orders), a AS (SELECT c_custkey AS key FROM customer WHERE c_acctbal > 0)
SELECT key, 'missing' AS difference FROM (SELECT * FROM e EXCEPT SELECT * FROM a) UNION ALL SELECT key, 'unexpected' FROM (SELECT * FROM a EXCEPT SELECT * FROM e)""",
)
def key_set_difference(spark, folder):
    expected = table(spark, folder, "orders").select(F.col("o_custkey").alias("key"))
    return set_difference(expected, table(spark, folder, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key")), "key")


@query(
    "unexpected_key_set",
    "SET-04",
    sql="SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 250000",
)
def unexpected_key_set(spark, folder):
    expected = table(spark, folder, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("key"))
    return unexpected_keys(expected, table(spark, folder, "customer").select(F.col("c_custkey").alias("key")), "key")


@query(
    "duplicated_keys",
    "SET-05",
    sql="SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicated_keys(spark, folder):
    return duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "rows_without_duplicated_keys",
    "SET-05",
    sql="""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE (l_orderkey, l_linenumber) NOT IN (
SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def rows_without_duplicated_keys(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return without_duplicated(lines, ["l_orderkey", "l_linenumber"])


@query(
    "mixed_column_union",
    "SET-06",
    sql="SELECT c_custkey, c_mktsegment, NULL::BIGINT AS s_suppkey FROM customer UNION ALL SELECT NULL, NULL, s_suppkey FROM supplier",
)
def mixed_column_union(spark, folder):
    return union_all([table(spark, folder, "customer").select("c_custkey", "c_mktsegment"), table(spark, folder, "supplier").select("s_suppkey")])


@query(
    "registry_upsert",
    "SET-07",
    sql="""WITH c AS (SELECT user_id, event_id AS version, event_type, value FROM events)
SELECT user_id, version, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY version DESC) AS n FROM c) WHERE n = 1""",
)
def registry_upsert(spark, folder):
    """A registry of the latest view per user, upserted with all other events."""
    events = table(spark, folder, "events").select("user_id", F.col("event_id").alias("version"), "event_type", "value")
    registry = latest_per_key(events.where("event_type = 'view'"), "user_id", "version")
    return upsert(registry, events.where("event_type <> 'view'"), "user_id", "version")


@query("registered_speakers", "SET-07", sql="SELECT DISTINCT user_id FROM events")
def registered_speakers(spark, folder):
    return table(spark, folder, "events").select("user_id").distinct()
