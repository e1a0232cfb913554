"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxframe.catalog.base import TURNS_SQL, query, table, turn_pairs
from voxframe.catalog.writing import CACHE_SQL, token_cache
from voxframe.functions.edit import token_distance
from voxframe.functions.injected import whitespace_tokens
from voxframe.functions.signal import preference_loss
from voxframe.operators.aggregates import (
    COMPLETE_MS_EDGES,
    all_exact,
    batch_statistics,
    dataset_digest,
    distinct_check,
    error_summary,
    grouped_lists,
    histogram,
    latency_summary,
    masked_matches,
    mean_vectors,
    micro_rate,
    preference_metrics,
    real_time_factor,
    rolled_up,
    stage_totals,
    token_audit,
    value_counts,
    weighted_mean,
)
from voxframe.operators.sampling import best_by_loss
from voxframe.sources.sinks import cache_manifest


def rounded_vector(column: str, digits: int = 5) -> Column:
    """Vector as text with rounded numbers, for comparison."""
    return F.array_join(F.transform(column, lambda v: F.format_string(f"%.{digits}f", v.cast("double") + 0.0)), " ")


@query(
    "mean_vector_per_label",
    "AGG-01",
    "UDA-01",
    sql="""WITH m AS (SELECT label, i, avg(x::DOUBLE) AS x FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2)
SELECT label, string_agg(printf('%.5f', x + 0.0), ' ' ORDER BY i) AS mean_vector FROM m GROUP BY label""",
)
def mean_vector_per_label(spark, folder):
    means = mean_vectors(table(spark, folder, "embeddings"), ["label"], "embedding")
    return means.select("label", rounded_vector("mean_vector").alias("mean_vector"))


@query(
    "utterances_per_speaker",
    "AGG-02",
    sql="""SELECT source, (i // 20)::INTEGER AS part, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS docs
FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM documents) GROUP BY 1, 2""",
)
def utterances_per_speaker(spark, folder):
    lists = grouped_lists(table(spark, folder, "documents"), "source", "doc_id", 20, "docs")
    return lists.select("source", "part", F.array_join(F.transform("docs", lambda d: d.cast("string")), ",").alias("docs"))


@query("category_counts", "AGG-06", sql="SELECT p_type, count(*) AS rows FROM part GROUP BY 1 ORDER BY 1")
def category_counts(spark, folder):
    return value_counts(table(spark, folder, "part"), "p_type")


@query(
    "shard_token_audit",
    "AGG-07",
    sql=f"""WITH {CACHE_SQL} SELECT phase, shard, count(*) AS row_count, min(list_min(speech_token)) AS token_min, max(list_max(speech_token)) AS token_max FROM cache GROUP BY 1, 2""",
)
def shard_token_audit(spark, folder):
    return cache_manifest(token_cache(spark, folder))


@query(
    "phase_roll_up",
    "AGG-08",
    sql=f"""WITH {CACHE_SQL}, a AS (SELECT phase, shard, count(*) AS n, min(list_min(speech_token)) AS lo, max(list_max(speech_token)) AS hi FROM cache GROUP BY 1, 2)
SELECT phase, count(*) AS shards, sum(n)::BIGINT AS row_count, min(lo) AS token_min, max(hi) AS token_max FROM a GROUP BY 1""",
)
def phase_roll_up(spark, folder):
    return rolled_up(token_audit(token_cache(spark, folder), ["phase", "shard"], "speech_token"), ["phase"])


# Word distance in SQL: the table row by row, each row a list built from left to right.
DISTANCE_SQL = f"""{TURNS_SQL},
dp AS (
  SELECT conv_id, turn, category, r, h, 0 AS i, range(0, len(h) + 1) AS costs FROM turns
  UNION ALL
  SELECT conv_id, turn, category, r, h, i + 1,
    list_reduce(range(1, len(h) + 1), lambda acc, j: list_append(acc,
      least(acc[-1] + 1, costs[j + 1] + 1, costs[j] + CASE WHEN r[i + 1] = h[j] THEN 0 ELSE 1 END)), [costs[1] + 1])
  FROM dp WHERE i < len(r)),
distances AS (SELECT conv_id, turn, category, costs[-1] AS errors, len(r) AS units FROM dp WHERE i = len(r))"""


def _distances(spark, folder):
    pairs = turn_pairs(spark, folder)
    errors = token_distance(F.col("ref"), F.col("hyp"))
    return pairs.select("conv_id", "turn", "category", errors.alias("errors"), F.size("ref").alias("units"))


@query(
    "micro_error_rate",
    "AGG-09",
    "UDA-01",
    sql=f"WITH RECURSIVE {DISTANCE_SQL} SELECT category, round(sum(errors) / sum(units), 9) AS rate FROM distances GROUP BY 1",
)
def micro_error_rate(spark, folder):
    rate = F.round(micro_rate(F.col("errors"), F.col("units")), 9)
    return _distances(spark, folder).groupBy("category").agg(rate.alias("rate"))


@query(
    "error_rate_summary",
    "AGG-10",
    "AGG-11",
    sql=f"""WITH RECURSIVE {DISTANCE_SQL}, g AS (SELECT category, grouping(category) AS g, round(sum(errors) / sum(units), 9) AS wer,
round(avg(errors / units), 9) AS macro, count(*) FILTER (units = 0)::DOUBLE AS empty FROM distances GROUP BY GROUPING SETS ((category), ()))
SELECT CASE g WHEN 1 THEN 'overall' ELSE 'category' END AS level, category, m.metric, CASE m.metric WHEN 'wer' THEN wer WHEN 'macro-wer' THEN macro ELSE empty END AS value
FROM g, (SELECT unnest(['wer', 'macro-wer', 'empty-reference-rows']) AS metric) m""",
)
def error_rate_summary(spark, folder):
    summary = error_summary(_distances(spark, folder), {"wer": ("errors", "units")}, "category")
    return summary.withColumn("value", F.round("value", 9))


def _latencies(spark, folder):
    return table(spark, folder, "events").select("event_type", (F.col("value") / 1000).alias("seconds"))


@query(
    "latency_summary_by_type",
    "AGG-15",
    sql="""SELECT event_type, count(*) AS requests, round(avg(value), 6) AS mean_ms, round(var_pop(value / 1000) * 1000, 6) AS variance_x1000, round(var_pop(value), 3) AS variance_ms2,
round(quantile_cont(value, 0.5), 6) AS p50_ms, round(quantile_cont(value, 0.9), 6) AS p90_ms, round(quantile_cont(value, 0.95), 6) AS p95_ms, round(quantile_cont(value, 0.99), 6) AS p99_ms
FROM events GROUP BY 1""",
)
def latency_summary_by_type(spark, folder):
    return _rounded_latency(latency_summary(_latencies(spark, folder), "seconds", ["event_type"]))


@query(
    "latency_summary_overall",
    "AGG-15",
    sql="""SELECT count(*) AS requests, round(avg(value), 6) AS mean_ms, round(var_pop(value / 1000) * 1000, 6) AS variance_x1000, round(var_pop(value), 3) AS variance_ms2,
round(quantile_cont(value, 0.5), 6) AS p50_ms, round(quantile_cont(value, 0.9), 6) AS p90_ms, round(quantile_cont(value, 0.95), 6) AS p95_ms, round(quantile_cont(value, 0.99), 6) AS p99_ms
FROM events""",
)
def latency_summary_overall(spark, folder):
    return _rounded_latency(latency_summary(_latencies(spark, folder), "seconds"))


def _rounded_latency(summary):
    digits = {"variance_ms2": 3}
    return summary.select(
        *[c if c in ("event_type", "requests") else F.round(c, digits.get(c, 6)).alias(c) for c in summary.columns]
    )


@query(
    "real_time_factors",
    "AGG-16",
    sql="""SELECT user_id, CASE WHEN sum(n) = 0 THEN 'Infinity'::DOUBLE ELSE round(sum(v) / sum(n), 6) END AS rtf FROM (
SELECT user_id, round(value * 100)::BIGINT AS v, CASE WHEN user_id % 5 = 0 THEN 0 ELSE CAST(props->>'k' AS BIGINT) END AS n FROM events) GROUP BY 1""",
)
def real_time_factors(spark, folder):
    audio = F.when(F.col("user_id") % 5 == 0, F.lit(0).cast("bigint")).otherwise(F.get_json_object("props", "$.k").cast("bigint"))
    events = table(spark, folder, "events").select("user_id", F.round(F.col("value") * 100).cast("bigint").alias("v"), audio.alias("n"))
    rtf = real_time_factor(F.sum("v"), F.sum("n"))
    return events.groupBy("user_id").agg(F.round(rtf, 6).alias("rtf"))


@query(
    "stage_time_totals",
    "AGG-17",
    sql="""SELECT user_id, """ + ", ".join(
        f"sum(CASE WHEN event_type = '{s}' THEN round(value * 100)::BIGINT END)::BIGINT AS {s}" for s in ["click", "error", "purchase", "signup", "view"]
    ) + " FROM events GROUP BY 1",
)
def stage_time_totals(spark, folder):
    events = table(spark, folder, "events").withColumn("hundredths", F.round(F.col("value") * 100).cast("bigint"))
    return stage_totals(events, ["user_id"], "event_type", ["click", "error", "purchase", "signup", "view"], "hundredths")


@query(
    "weighted_batch_means",
    "AGG-18",
    sql="""SELECT l_returnflag, l_linestatus, round(sum(d * q)::DOUBLE / sum(q)::DOUBLE, 9) AS loss FROM (
SELECT l_returnflag, l_linestatus, round(l_discount * 100)::BIGINT AS d, l_quantity::BIGINT AS q FROM lineitem) GROUP BY 1, 2""",
)
def weighted_batch_means(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", F.round(F.col("l_discount") * 100).cast("bigint").alias("d"), F.col("l_quantity").cast("bigint").alias("q")
    )
    return lines.groupBy("l_returnflag", "l_linestatus").agg(F.round(weighted_mean(F.col("d"), F.col("q")), 9).alias("loss"))


@query(
    "latency_histogram",
    "AGG-19",
    sql=f"""WITH e AS (SELECT unnest({[float(x) for x in COMPLETE_MS_EDGES]}::DOUBLE[] || ['Infinity'::DOUBLE]) AS le)
SELECT event_type, le, count(*) FILTER (value <= le) AS bucket, round(sum(value::DECIMAL(18,2)), 2)::DOUBLE AS sum, count(*) AS count FROM events, e GROUP BY 1, 2""",
)
def latency_histogram(spark, folder):
    rows = histogram(table(spark, folder, "events").withColumn("value", F.col("value").cast("decimal(18,2)")), ["event_type"], "value", COMPLETE_MS_EDGES)
    return rows.withColumn("sum", F.col("sum").cast("double"))


@query(
    "batch_size_statistics",
    "AGG-20",
    sql="""SELECT l_returnflag, l_linenumber, sum(l_quantity::BIGINT)::BIGINT AS executions, round(sum(l_partkey)::DOUBLE / 1e6, 6) AS total_ms,
round(sum(l_partkey)::DOUBLE / 1e6 / sum(l_quantity::BIGINT)::DOUBLE, 9) AS mean_ms, round(sum(l_partkey)::DOUBLE / 1e6 / sum(l_quantity::BIGINT)::DOUBLE / l_linenumber, 9) AS mean_ms_per_sample
FROM lineitem GROUP BY 1, 2 HAVING sum(l_quantity::BIGINT) > 0""",
)
def batch_size_statistics(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("q", F.col("l_quantity").cast("bigint"))
    stats = batch_statistics(lines, "l_returnflag", "l_linenumber", "q", "l_partkey")
    return stats.select(
        "l_returnflag",
        "l_linenumber",
        "executions",
        F.round("total_ms", 6).alias("total_ms"),
        F.round("mean_ms", 9).alias("mean_ms"),
        F.round("mean_ms_per_sample", 9).alias("mean_ms_per_sample"),
    )


@query(
    "masked_token_accuracy",
    "AGG-21",
    sql=rf"""WITH t AS (SELECT a.role, list_transform(list_filter(string_split_regex(a.text, '\s+'), lambda w: w <> ''), lambda w: length(w)) AS p,
list_transform(list_filter(string_split_regex(b.text, '\s+'), lambda w: w <> ''), lambda w: CASE WHEN length(w) > 8 THEN -1 ELSE length(w) END) AS t
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
u AS (SELECT role, unnest(list_zip(p[1:least(len(p), len(t))], t[1:least(len(p), len(t))])) AS z FROM t)
SELECT role, round(count(*) FILTER (z[1] = z[2])::DOUBLE / count(*), 9) AS accuracy FROM u WHERE z[2] <> -1 GROUP BY 1""",
)
def masked_token_accuracy(spark, folder):
    """Word lengths of a turn against the next turn's, as far as both reach; long words are ignored."""
    turns = table(spark, folder, "conversations")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), whitespace_tokens(F.col("text")).alias("t"))
    pairs = turns.select("conv_id", "turn", "role", whitespace_tokens(F.col("text")).alias("p")).join(following, ["conv_id", "turn"])
    n = F.least(F.size("p"), F.size("t"))
    target = F.transform(F.slice("t", F.lit(1), n), lambda x: F.when(x > 8, -1).otherwise(x))
    counts = pairs.select("role", masked_matches(F.slice("p", F.lit(1), n), target).alias("m"))
    return counts.groupBy("role").agg(F.round(F.try_divide(F.sum("m.matches"), F.sum("m.units")), 9).alias("accuracy"))


@query(
    "all_samples_exact",
    "AGG-22",
    sql="SELECT l_orderkey, bool_and(l_returnflag = l_linestatus OR l_linenumber < 3) AS all_exact, count(*) AS samples FROM lineitem GROUP BY 1",
)
def all_samples_exact(spark, folder):
    lines = table(spark, folder, "lineitem")
    correct = F.when(F.col("l_linenumber") < 3, F.col("l_linestatus")).otherwise(F.col("l_returnflag"))
    return all_exact(lines.withColumn("correct", correct), ["l_orderkey"], "correct", "l_linestatus")


@query(
    "mean_latencies",
    "AGG-23",
    sql="SELECT round(avg(value), 6) AS generation, round(avg(CAST(props->>'k' AS DOUBLE)), 6) AS asr, count(*) AS rows FROM events",
)
def mean_latencies(spark, folder):
    return table(spark, folder, "events").agg(
        F.round(F.avg("value"), 6).alias("generation"),
        F.round(F.avg(F.get_json_object("props", "$.k").cast("double")), 6).alias("asr"),
        F.count(F.lit(1)).alias("rows"),
    )


@query(
    "table_digest",
    "AGG-24",
    "JSN-01",
    sql="""WITH h AS (SELECT sha256('{"o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority || '"}') AS h FROM orders),
leaf AS (SELECT h, count(*) AS n FROM h GROUP BY 1),
l8 AS (SELECT h[1:8] AS h, sum(n) AS n, sha256(string_agg(h || ':' || n, ',' ORDER BY h || ':' || n)) AS d FROM leaf GROUP BY 1),
l6 AS (SELECT h[1:6] AS h, sum(n) AS n, sha256(string_agg(h || ':' || d, ',' ORDER BY h || ':' || d)) AS d FROM l8 GROUP BY 1),
l4 AS (SELECT h[1:4] AS h, sum(n) AS n, sha256(string_agg(h || ':' || d, ',' ORDER BY h || ':' || d)) AS d FROM l6 GROUP BY 1),
l2 AS (SELECT h[1:2] AS h, sum(n) AS n, sha256(string_agg(h || ':' || d, ',' ORDER BY h || ':' || d)) AS d FROM l4 GROUP BY 1)
SELECT sha256(string_agg(h || ':' || d, ',' ORDER BY h || ':' || d)) AS digest, sum(n)::BIGINT AS rows FROM l2""",
)
def table_digest(spark, folder):
    return dataset_digest(table(spark, folder, "orders"), ["o_orderpriority", "o_custkey"])


@query(
    "mean_of_best_checkpoints",
    "AGG-25",
    "TOP-06",
    sql="""WITH best AS (SELECT vec_id, label, embedding FROM embeddings ORDER BY round(embedding[1], 6), vec_id LIMIT 40),
m AS (SELECT label, i, avg(x::DOUBLE) AS x FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM best) GROUP BY 1, 2)
SELECT label, string_agg(printf('%.5f', x + 0.0), ' ' ORDER BY i) AS mean_vector FROM m GROUP BY label""",
)
def mean_of_best_checkpoints(spark, folder):
    vectors = table(spark, folder, "embeddings").withColumn("loss", F.round(F.get("embedding", F.lit(0)), 6))
    best = best_by_loss(vectors, "loss", "vec_id", 40)
    return mean_vectors(best, ["label"], "embedding").select("label", rounded_vector("mean_vector").alias("mean_vector"))


@query(
    "preference_pair_metrics",
    "AGG-26",
    "MTH-06",
    sql="""WITH z AS (SELECT l_quantity AS pc, l_discount * 100 AS pr, l_tax * 100 AS bc, l_linenumber::DOUBLE AS br FROM lineitem),
m AS (SELECT 0.1 * ((pc - pr) - (bc - br)) AS b, (pc - bc) * 0.1 AS rc, (pr - br) * 0.1 AS rr FROM z)
SELECT round(avg(rc), 6) AS chosen_reward, round(avg(rr), 6) AS rejected_reward, round(avg((rc > rr)::INTEGER::DOUBLE), 6) AS accuracy,
round(avg(-ln(1 / (1 + exp(-b))) * 0.9 - ln(1 / (1 + exp(b))) * 0.1), 6) AS loss FROM m""",
)
def preference_pair_metrics(spark, folder):
    logs = (F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100, F.col("l_linenumber").cast("double"))
    loss, chosen, rejected = preference_loss(*logs, beta=0.1, smoothing=0.1)
    pairs = table(spark, folder, "lineitem").select(loss.alias("loss"), chosen.alias("c"), rejected.alias("r"))
    metrics = preference_metrics(pairs, "c", "r", "loss")
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


@query(
    "distinct_id_check",
    "AGG-27",
    sql="SELECT count(l_orderkey) AS rows, count(DISTINCT l_orderkey) AS distinct_values, count(l_orderkey) = count(DISTINCT l_orderkey) AS all_distinct FROM lineitem",
)
def distinct_id_check(spark, folder):
    return distinct_check(table(spark, folder, "lineitem"), "l_orderkey")
