"""Ordinals, slices, blocks, batches, streaks and levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.base import query, table
from voxframe.operators.ordering import order_breaks, spread_sorted, with_ordinal
from voxframe.operators.greedy import greedy_batches
from voxframe.operators.packing import (
    assign_ranks,
    budget_batches,
    contiguous_split,
    epoch_order,
    fraction_boundaries,
    length_sorted_blocks,
    rank_slices,
    static_batches,
)
from voxframe.operators.sampling import first_per_group, lowest_scores
from voxframe.operators.sequences import active_levels, chunk_latencies, gaps, longest_streaks
from voxframe.plans.batches import packed_epoch


@query(
    "global_ordinals",
    "WIN-01",
    sql="SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS ordinal FROM lineitem",
)
def global_ordinals(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")
    keys = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return with_ordinal(lines, *keys).select("l_orderkey", "l_linenumber", "l_extendedprice", "ordinal")


@query(
    "contiguous_slices",
    "WIN-02",
    sql="SELECT o_orderkey, (ntile(7) OVER (ORDER BY o_orderkey) - 1)::INTEGER AS part FROM orders",
)
def contiguous_slices(spark, folder):
    return contiguous_split(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 7).select("o_orderkey", "part")


@query(
    "epoch_rank_slices",
    "WIN-03",
    sql="""SELECT o_orderkey, i AS ordinal, (i % 8)::INTEGER AS rank FROM (
SELECT o_orderkey, row_number() OVER (ORDER BY sha256('1986' || chr(0) || '2' || chr(0) || o_orderkey), o_orderkey) - 1 AS i FROM orders)""",
)
def epoch_rank_slices(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    ordered = epoch_order(orders, "o_orderkey", 1986, 2)
    return rank_slices(ordered, "ordinal", ordered.count(), 8)


@query(
    "repeated_rank_slices",
    "WIN-03",
    sql="""WITH r AS (SELECT r_name, row_number() OVER (ORDER BY r_name) - 1 AS i, count(*) OVER () AS n FROM region)
SELECT r_name, k::INTEGER AS rank FROM r, range(0, 8) t(k) WHERE k % n = i""",
)
def repeated_rank_slices(spark, folder):
    """Five regions over eight ranks: the list repeats until every rank has one."""
    regions = with_ordinal(table(spark, folder, "region").select("r_name"), "r_name")
    return rank_slices(regions, "ordinal", regions.count(), 8).select("r_name", "rank")


@query(
    "exact_rank_split",
    "WIN-04",
    sql="SELECT o_orderkey, (ntile(4) OVER (ORDER BY o_orderkey) - 1)::INTEGER AS part FROM orders",
)
def exact_rank_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    return contiguous_split(orders, ["o_orderkey"], 4, exact=True).select("o_orderkey", "part")


@query(
    "seeded_permutation",
    "WIN-05",
    sql="""SELECT doc_id, row_number() OVER (ORDER BY sha256('11' || chr(0) || '0' || chr(0) || doc_id), doc_id) - 1 AS ordinal FROM documents""",
)
def seeded_permutation(spark, folder):
    return epoch_order(table(spark, folder, "documents").select("doc_id"), "doc_id", 11)


@query(
    "length_sorted_blocks",
    "WIN-06",
    sql="""SELECT o_orderkey, i // 500 AS block, (row_number() OVER (PARTITION BY i // 500 ORDER BY o_custkey, i) - 1)::INTEGER AS place FROM (
SELECT *, row_number() OVER (ORDER BY sha256('1986' || chr(0) || '0' || chr(0) || o_orderkey), o_orderkey) - 1 AS i FROM orders)""",
)
def length_sorted_block_places(spark, folder):
    ordered = epoch_order(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 1986)
    return length_sorted_blocks(ordered, "ordinal", "o_custkey", "o_orderkey").select("o_orderkey", "block", "place")


@query(
    "static_batch_lists",
    "WIN-07",
    sql="""SELECT i // 16 AS batch, string_agg(doc_id::VARCHAR, ',' ORDER BY i) AS docs FROM (
SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) GROUP BY 1""",
)
def static_batch_lists(spark, folder):
    batches = static_batches(with_ordinal(table(spark, folder, "documents").select("doc_id"), "doc_id"), "ordinal", ["doc_id"], 16)
    return batches.select("batch", F.array_join(F.transform("rows", lambda r: r["doc_id"].cast("string")), ",").alias("docs"))


def _greedy_sql(ordered: str, cost: str, budget: int, window: int) -> str:
    """Packing as a recursive query that walks all windows at once."""
    close = f"(held + 1) * ({cost}) > {budget}"
    return f"""o AS (SELECT *, i // {window} AS win, row_number() OVER (PARTITION BY i // {window} ORDER BY a + b, i) - 1 AS place FROM ({ordered})),
p AS (SELECT win, place, key, 0 AS batch, 1 AS held, a AS ma, b AS mb FROM o WHERE place = 0
 UNION ALL SELECT o.win, o.place, o.key, CASE WHEN {close} THEN batch + 1 ELSE batch END, CASE WHEN {close} THEN 1 ELSE held + 1 END,
 CASE WHEN {close} THEN a ELSE greatest(ma, a) END, CASE WHEN {close} THEN b ELSE greatest(mb, b) END
 FROM p JOIN o ON o.win = p.win AND o.place = p.place + 1)"""


@query(
    "dynamic_frame_batches",
    "WIN-08",
    sql="WITH RECURSIVE "
    + _greedy_sql(
        "SELECT doc_id AS key, n_chars AS a, 0 AS b, row_number() OVER (ORDER BY sha256('1986' || chr(0) || '0' || chr(0) || doc_id), doc_id) - 1 AS i FROM documents",
        "greatest(ma, a)",
        30000,
        500,
    )
    + " SELECT win AS \"window\", batch::INTEGER AS batch, count(*) AS n, max(ma) * count(*) AS padded_size, string_agg(key::VARCHAR, ',' ORDER BY place) AS docs FROM p GROUP BY 1, 2",
)
def dynamic_frame_batches(spark, folder):
    docs = epoch_order(table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id", 1986)
    batches = budget_batches(docs, "ordinal", "doc_id", ["n_chars"], 30000, 500)
    docs_list = F.array_join(F.transform("rows", lambda r: r["doc_id"].cast("string")), ",")
    return batches.select("window", "batch", "n", "padded_size", docs_list.alias("docs"))


@query(
    "whole_order_batches",
    "WIN-08",
    sql="""WITH RECURSIVE o AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY sha256('1986' || chr(0) || '0' || chr(0) || doc_id), doc_id) - 1 AS i FROM documents),
p AS (SELECT i, doc_id, n_chars, 0 AS batch, 1 AS held, n_chars AS longest FROM o WHERE i = 0
    UNION ALL SELECT o.i, o.doc_id, o.n_chars, CASE WHEN greatest(longest, o.n_chars) * (held + 1) > 12000 THEN batch + 1 ELSE batch END,
        CASE WHEN greatest(longest, o.n_chars) * (held + 1) > 12000 THEN 1 ELSE held + 1 END,
        CASE WHEN greatest(longest, o.n_chars) * (held + 1) > 12000 THEN o.n_chars ELSE greatest(longest, o.n_chars) END
    FROM p JOIN o ON o.i = p.i + 1)
SELECT batch::BIGINT AS batch, count(*) AS n, max(n_chars) * count(*) AS padded_size, string_agg(doc_id::VARCHAR, ',' ORDER BY i) AS docs FROM p GROUP BY 1""",
)
def whole_order_batches(spark, folder):
    """One greedy packing over the whole seeded order, on blocks of a few hundred rows at once."""
    docs = epoch_order(table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id", 1986)
    batches = greedy_batches(docs, "ordinal", "doc_id", ["n_chars"], 12000, 512)
    docs_list = F.array_join(F.transform("rows", lambda r: r["doc_id"].cast("string")), ",")
    return batches.select("batch", "n", "padded_size", docs_list.alias("docs"))


_PACKED = "WITH RECURSIVE " + _greedy_sql(
    "SELECT o_orderkey AS key, o_orderkey % 97 + 1 AS a, o_custkey % 211 + 1 AS b, row_number() OVER (ORDER BY sha256('1986' || chr(0) || '0' || chr(0) || o_orderkey), o_orderkey) - 1 AS i FROM orders",
    "greatest(ma, a) + greatest(mb, b)",
    4000,
    512,
)


def _lengths(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        (F.col("o_orderkey") % 97 + 1).alias("text_token_len"),
        (F.col("o_custkey") % 211 + 1).alias("speech_token_len"),
    )


@query(
    "token_budget_batches",
    "WIN-09",
    "WIN-10",
    sql=_PACKED
    + """, g AS (SELECT win, batch, count(*) AS n, (max(ma) + max(mb)) * count(*) AS padded_size, string_agg(key::VARCHAR, ',' ORDER BY place) AS keys FROM p GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (ORDER BY win, batch) - 1 AS batch_ordinal FROM g)
SELECT batch_ordinal, (batch_ordinal % 8)::INTEGER AS rank, batch_ordinal // 8 AS step, n, padded_size, keys FROM r""",
)
def token_budget_batches(spark, folder):
    batches = packed_epoch(_lengths(spark, folder), "o_orderkey", ["text_token_len", "speech_token_len"], 4000, 1986)
    keys = F.array_join(F.transform("rows", lambda r: r["o_orderkey"].cast("string")), ",")
    return batches.select("batch_ordinal", "rank", "step", "n", "padded_size", keys.alias("keys"))


@query(
    "equal_rank_steps",
    "WIN-10",
    sql=_PACKED
    + """, g AS (SELECT win, batch, count(*) AS n FROM p GROUP BY 1, 2),
r AS (SELECT n, row_number() OVER (ORDER BY win, batch) - 1 AS batch_ordinal, count(*) OVER () AS total FROM g),
a AS (SELECT batch_ordinal, n FROM r UNION ALL SELECT k, 0 FROM range(0, 100000) t(k), (SELECT DISTINCT total FROM r) WHERE k >= total AND k < ceil(total / 8.0) * 8)
SELECT (batch_ordinal % 8)::INTEGER AS rank, count(*) AS steps, count(*) FILTER (n = 0) AS empty_steps FROM a GROUP BY 1""",
)
def equal_rank_steps(spark, folder):
    ordered = epoch_order(_lengths(spark, folder), "o_orderkey", 1986)
    batches = budget_batches(ordered, "ordinal", "o_orderkey", ["text_token_len", "speech_token_len"], 4000)
    placed = assign_ranks(batches, equal_steps=True)
    return placed.groupBy("rank").agg(F.count(F.lit(1)).alias("steps"), F.count_if(F.col("n") == 0).alias("empty_steps"))


@query(
    "first_item_per_group",
    "WIN-11",
    sql="SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1",
)
def first_item_per_group(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return first_per_group(orders, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "passing_streaks",
    "WIN-12",
    sql="""WITH f AS (SELECT user_id, event_type NOT IN ('error', 'signup') AS ok, sum(CASE WHEN event_type IN ('error', 'signup') THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
r AS (SELECT user_id, island, count(*) FILTER (ok) AS run FROM f GROUP BY 1, 2)
SELECT user_id, max(run) AS longest, max(run) >= 3 AS reached FROM r GROUP BY 1""",
)
def passing_streaks(spark, folder):
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", (~F.col("event_type").isin("error", "signup")).alias("ok"))
    return longest_streaks(events, ["user_id"], ["ts", "event_id"], "ok")


@query(
    "fraction_boundary_rows",
    "WIN-13",
    sql="""WITH s AS (SELECT o_orderkey, o_custkey % 7 + 1 AS n FROM orders), c AS (SELECT o_orderkey, sum(n) OVER (ORDER BY o_orderkey)::BIGINT AS reached FROM s),
t AS (SELECT k, ceil(sum(n) * k / 8.0)::BIGINT AS target FROM s, range(1, 9) r(k) GROUP BY k)
SELECT k::INTEGER AS boundary, target, min(o_orderkey) AS o_orderkey, min(reached) AS reached FROM t JOIN c ON reached >= target GROUP BY 1, 2""",
)
def fraction_boundary_rows(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", (F.col("o_custkey") % 7 + 1).alias("n"))
    total = rows.agg(F.sum("n")).first()[0]
    marks = fraction_boundaries(rows, ["o_orderkey"], "n", total)
    return marks.select("boundary", F.col("target").cast("bigint").alias("target"), "o_orderkey", "reached")


@query(
    "chunk_latency_per_user",
    "WIN-14",
    sql="""WITH n AS (SELECT user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
SELECT user_id, (max(t) FILTER (n = 2) - max(t) FILTER (n = 1)) / 1e6 AS first_chunk_seconds, (max(t) FILTER (n = 3) - max(t) FILTER (n = 2)) / 1e6 AS second_chunk_seconds FROM n GROUP BY 1""",
)
def chunk_latency_per_user(spark, folder):
    return chunk_latencies(table(spark, folder, "events"), "user_id", "ts", "event_id")


@query(
    "event_gaps",
    "WIN-14",
    sql="SELECT event_id, user_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6 AS gap_seconds FROM events",
)
def event_gaps(spark, folder):
    return gaps(table(spark, folder, "events").select("event_id", "user_id", "ts"), "user_id", "ts", "event_id").drop("ts")


@query(
    "shard_order_check",
    "WIN-15",
    sql="""WITH s AS (SELECT o_custkey AS c, lag(o_custkey) OVER (ORDER BY o_orderdate, o_orderkey) AS p FROM orders)
SELECT count(*) FILTER (c > p) AS steps_up, count(*) FILTER (c < p) AS steps_down, count(*) FILTER (c > p) = 0 OR count(*) FILTER (c < p) = 0 AS monotone FROM s""",
)
def shard_order_check(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_custkey")
    return order_breaks(spread_sorted(orders, "o_orderdate", "o_orderkey"), "o_custkey")


@query(
    "active_request_levels",
    "WIN-17",
    sql="""SELECT event_id, sum(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN -1 ELSE 0 END) OVER (ORDER BY ts, event_id)::BIGINT AS active FROM events""",
)
def active_request_levels(spark, folder):
    delta = F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", -1).otherwise(0)
    events = table(spark, folder, "events").select("event_id", "ts", delta.alias("delta"))
    return active_levels(events, "delta", "ts", "event_id").select("event_id", "active")


@query(
    "reserved_indexes",
    "WIN-18",
    sql="""SELECT o_orderkey, row_number() OVER (ORDER BY sha256('1986' || chr(0) || o_orderkey), o_orderkey) - 1 AS prompt_index FROM orders
ORDER BY 2 LIMIT 20""",
)
def reserved_indexes(spark, folder):
    chosen = lowest_scores(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 20)
    return with_ordinal(chosen, "score", "o_orderkey", out="prompt_index").select("o_orderkey", "prompt_index")
