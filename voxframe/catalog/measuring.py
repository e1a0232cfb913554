"""Signal, reward and bound arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.base import WORDS_SQL, query, table
from voxframe.functions.signal import (
    audio_metrics,
    duration_seconds,
    frame_count,
    pcm16_samples,
    preference_loss,
    samples_from_shorts,
    token_bounds,
    token_rate,
    transcript_reward,
)
from voxframe.functions.text import whitespace_token_count


@query(
    "audio_metric_rows",
    "MTH-01",
    sql="""WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS e FROM embeddings),
l AS (SELECT vec_id, e, list_filter(range(1, 65), lambda i: abs(e[i]) > 0.1::DOUBLE) AS loud FROM e)
SELECT vec_id, 64 / 16.0::DOUBLE AS duration_sec, (64 - len(loud)) / 64.0::DOUBLE AS silence_ratio, coalesce(loud[1] - 1, 64) / 16.0::DOUBLE AS leading_silence_sec,
coalesce(64 - loud[-1], 64) / 16.0::DOUBLE AS trailing_silence_sec, round(20 * log10(sqrt(list_dot_product(e, e) / 64)), 6) AS rms_dbfs, round(20 * log10(list_max(list_transform(e, lambda v: abs(v)))), 6) AS peak_dbfs FROM l""",
)
def audio_metric_rows(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", audio_metrics(F.col("embedding"), F.lit(16), -20.0).alias("m"))
    return rows.select(
        "vec_id",
        "m.duration_sec",
        "m.silence_ratio",
        "m.leading_silence_sec",
        "m.trailing_silence_sec",
        F.round("m.rms_dbfs", 6).alias("rms_dbfs"),
        F.round("m.peak_dbfs", 6).alias("peak_dbfs"),
    )


@query(
    "pcm_sample_values",
    "MTH-02",
    sql="""SELECT o_orderkey, v / 32768.0::DOUBLE AS first, v / 32768.0::DOUBLE AS short, 2::INTEGER AS n FROM (
SELECT o_orderkey, CASE WHEN o_orderkey % 65536 < 32768 THEN o_orderkey % 65536 ELSE o_orderkey % 65536 - 65536 END AS v FROM orders)""",
)
def pcm_sample_values(spark, folder):
    """Order keys as 16-bit little-endian samples, written twice."""
    v = F.col("o_orderkey") % 65536
    byte = lambda c: F.lpad(F.hex(c), 2, "0")
    pair = F.concat(byte(v % 256), byte(F.floor(v / 256)))
    orders = table(spark, folder, "orders").select("o_orderkey", F.unhex(F.concat(pair, pair)).alias("pcm"), v.alias("v"))
    samples = pcm16_samples(F.col("pcm"))
    short = F.when(F.col("v") < 32768, F.col("v")).otherwise(F.col("v") - 65536).cast("short")
    return orders.select(
        "o_orderkey",
        F.get(samples, F.lit(1)).cast("double").alias("first"),
        F.get(samples_from_shorts(F.array(short)), F.lit(0)).cast("double").alias("short"),
        F.size(samples).alias("n"),
    )


@query(
    "frame_counts",
    "MTH-03",
    sql=f"SELECT doc_id, n_chars / 16000.0::DOUBLE * 100 AS frames, n_chars / 100.0::DOUBLE AS seconds, len({WORDS_SQL}) / (n_chars / 100.0::DOUBLE) AS rate FROM documents",
)
def frame_counts(spark, folder):
    seconds = duration_seconds(F.col("n_chars"), F.lit(100.0))
    return table(spark, folder, "documents").select(
        "doc_id",
        frame_count(F.col("n_chars"), F.lit(16000.0)).alias("frames"),
        seconds.alias("seconds"),
        token_rate(whitespace_token_count(F.col("text")), seconds).alias("rate"),
    )


@query(
    "transcript_rewards",
    "MTH-04",
    sql="SELECT event_id, round(least(greatest(1 - (exp(2 * 3 * x) - 1) / (exp(2 * 3 * x) + 1), 0), 1), 6) AS reward FROM (SELECT event_id, value / 100 AS x FROM events)",
)
def transcript_rewards(spark, folder):
    return table(spark, folder, "events").select("event_id", F.round(transcript_reward(F.col("value") / 100), 6).alias("reward"))


@query(
    "generated_token_bounds",
    "MTH-05",
    sql=f"SELECT doc_id, (greatest(n, 1) * 2)::INTEGER AS low, least(2048, greatest(greatest(n, 1) * 2, greatest(n, 1) * 20))::INTEGER AS high FROM (SELECT doc_id, len({WORDS_SQL}) AS n FROM documents)",
)
def generated_token_bounds(spark, folder):
    low, high = token_bounds(whitespace_token_count(F.col("text")))
    return table(spark, folder, "documents").select("doc_id", low.alias("low"), high.alias("high"))


@query(
    "preference_losses",
    "MTH-06",
    sql="""WITH z AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_discount * 100 - l_tax * 100) - (l_linenumber - l_quantity / 10) AS m FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(-ln(1 / (1 + exp(-0.1 * m))), 6) AS loss, round((m - 1 / (2 * 0.1::DOUBLE)) * (m - 1 / (2 * 0.1::DOUBLE)), 6) AS squared FROM z""",
)
def preference_losses(spark, folder):
    logs = (F.col("l_discount") * 100, F.col("l_tax") * 100, F.col("l_linenumber"), F.col("l_quantity") / 10)
    plain = preference_loss(*logs, beta=0.1)[0]
    squared = preference_loss(*logs, beta=0.1, squared=True)[0]
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(plain, 6).alias("loss"), F.round(squared, 6).alias("squared")
    )
