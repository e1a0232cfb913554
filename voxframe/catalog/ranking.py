"""Top rows, extremes and orders inside a row."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.aggregating import DISTANCE_SQL
from voxframe.catalog.base import query, table, turn_pairs
from voxframe.catalog.writing import CACHE_SQL, token_cache
from voxframe.functions.edit import token_distance
from voxframe.operators.sampling import (
    best_by_loss,
    extreme_rows,
    longest_first,
    retained,
    stratified_by_length,
    worst_rows,
)


@query(
    "phase_extremes",
    "TOP-04",
    sql=f"""WITH {CACHE_SQL}, s AS (SELECT phase, source_relative_path, len(speech_token)::INTEGER AS speech_token_len,
sha256('1986' || chr(0) || phase || chr(0) || source_relative_path) AS k FROM cache),
r AS (SELECT *, row_number() OVER (PARTITION BY phase ORDER BY speech_token_len, k) AS a, row_number() OVER (PARTITION BY phase ORDER BY speech_token_len DESC, k) AS b,
min(speech_token_len) OVER (PARTITION BY phase) <> max(speech_token_len) OVER (PARTITION BY phase) AS lengths_differ FROM s)
SELECT phase, 'short' AS extreme, source_relative_path, speech_token_len, lengths_differ FROM r WHERE a = 1
UNION ALL SELECT phase, 'long', source_relative_path, speech_token_len, lengths_differ FROM r WHERE b = 1""",
)
def phase_extremes(spark, folder):
    return extreme_rows(token_cache(spark, folder), "phase", "source_relative_path", "speech_token_len")


@query(
    "worst_transcripts",
    "TOP-05",
    sql=f"WITH RECURSIVE {DISTANCE_SQL} SELECT conv_id, turn, errors::INTEGER AS errors, units::INTEGER AS units FROM distances ORDER BY errors DESC, units DESC, conv_id * 100 + turn LIMIT 20",
)
def worst_transcripts(spark, folder):
    pairs = turn_pairs(spark, folder).withColumn("id", F.col("conv_id") * 100 + F.col("turn"))
    scored = pairs.select("id", "conv_id", "turn", token_distance(F.col("ref"), F.col("hyp")).alias("errors"), F.size("ref").alias("units"))
    return worst_rows(scored, "errors", "units", "id").drop("id")


@query(
    "lowest_losses",
    "TOP-06",
    sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5",
)
def lowest_losses(spark, folder):
    return best_by_loss(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 5)


@query(
    "retained_checkpoints",
    "TOP-06",
    sql="""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)
UNION SELECT o_orderkey, o_custkey FROM (SELECT * FROM orders ORDER BY o_custkey DESC, o_orderkey DESC LIMIT 3)""",
)
def retained_checkpoints(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    current = orders.agg(F.min("o_orderkey")).first()[0]
    return retained(orders, "o_custkey", "o_orderkey", current, 3)


@query(
    "length_strata",
    "TOP-07",
    sql="""WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS ordinal, count(*) OVER () AS n FROM documents)
SELECT doc_id, n_chars, ordinal FROM r WHERE ordinal IN (0, n // 2, n - 1)""",
)
def length_strata(spark, folder):
    return stratified_by_length(table(spark, folder, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id")


@query(
    "longest_first_lines",
    "TOP-08",
    sql="""SELECT l_orderkey, string_agg(n || ':' || q, ' ' ORDER BY q DESC, n, p) AS lines FROM (
SELECT l_orderkey, l_linenumber AS n, l_quantity::INTEGER AS q, l_partkey AS p FROM lineitem) GROUP BY 1""",
)
def longest_first_lines(spark, folder):
    """Lines of an order, largest quantity first; an order has a handful of lines."""
    rows = F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_quantity").cast("int").alias("q"))))
    grouped = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(rows.alias("rows"))
    shown = F.transform(longest_first(F.col("rows"), "q"), lambda r: F.concat_ws(":", r["n"], r["q"]))
    return grouped.select("l_orderkey", F.array_join(shown, " ").alias("lines"))
