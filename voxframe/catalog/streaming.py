"""Streams run to the end over the given tables; SQL says what the batch result must be."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxframe.catalog.base import WORDS_SQL, query, table
from voxframe.catalog.reading import log_line
from voxframe.functions.injected import whitespace_tokens
from voxframe.operators.sequences import sessions
from voxframe.session import scratch_path
from voxframe.sources.logs import request_events
from voxframe.sources.sinks import sharded
from voxframe.streaming.journal import usable_records, with_record_hash
from voxframe.streaming.requests import active_level, request_lifecycle, user_sessions, windowed_counts, windowed_histogram
from voxframe.streaming.run import drain, new_files, table_stream
from voxframe.streaming.tokens import rebatched, rebatched_table

EDGES = [10, 25, 50, 100, 200]


# Arbitrary state needs the RocksDB store.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}
# Sessions of a busy user are merged in each task before the shuffle.
LOCAL_SESSIONS = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


@contextmanager
def _settings(spark, wanted):
    """Session settings for the time of a run; the session's own are put back."""
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _events(spark, folder):
    stream = table_stream(spark, folder, "events")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _at(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


@query(
    "request_counts_by_hour",
    "STM-01",
    sql="SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS requests FROM events GROUP BY 1, 2",
)
def request_counts_by_hour(spark, folder):
    counts = drain(windowed_counts(_events(spark, folder), ["event_type"]), "update", ["window_start", "event_type"])
    return counts.withColumn("window_start", _at("window_start"))


_BUCKETS = ", ".join(f"count(*) FILTER (value <= {e}) AS le_{i}" for i, e in enumerate(EDGES))


@query(
    "latency_histogram_by_day",
    "STM-02",
    sql=f"SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, {_BUCKETS}, round(sum(value), 2) AS total, count(*) AS observations FROM events GROUP BY 1, 2",
)
def latency_histogram_by_day(spark, folder):
    stream = windowed_histogram(_events(spark, folder), ["event_type"], "value", EDGES)
    rows = drain(stream, "update", ["window_start", "event_type"])
    return rows.withColumn("window_start", _at("window_start")).withColumn("total", F.round("total", 2))


@query(
    "sliding_latency_histogram",
    "STM-02",
    sql=f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, {_BUCKETS}, round(sum(value), 2) AS total, count(*) AS observations FROM (
SELECT value, date_trunc('day', ts) - to_days(d::INTEGER) AS w FROM events, range(0, 2) r(d)) GROUP BY 1""",
)
def sliding_latency_histogram(spark, folder):
    """Two-day windows moving by one day."""
    stream = windowed_histogram(_events(spark, folder), [], "value", EDGES, width="2 days", slide="1 day")
    rows = drain(stream, "update", ["window_start"])
    return rows.withColumn("window_start", _at("window_start")).withColumn("total", F.round("total", 2))


_KINDS = "CASE event_type WHEN 'view' THEN 'stream_start' WHEN 'click' THEN 'chunk' WHEN 'purchase' THEN 'stream_done' WHEN 'error' THEN 'error' ELSE 'other' END"


def _sessions_sql(gap: str) -> str:
    return f"""o AS (SELECT *, epoch_us(ts) AS us, CASE WHEN ts - lag(ts) OVER w < INTERVAL '{gap}' THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM o)"""


@query(
    "request_lifecycles",
    "STM-03",
    sql=f"""WITH {_sessions_sql('12 hours')}, k AS (SELECT *, {_KINDS} AS kind FROM s),
g AS (SELECT user_id AS request_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS opened, count(*) FILTER (kind = 'chunk') AS chunks, coalesce(sum(event_id) FILTER (kind = 'chunk'), 0)::BIGINT AS bytes,
min(us) FILTER (kind = 'stream_start') AS a, min(us) FILTER (kind = 'chunk') AS b, max(us) FILTER (kind IN ('stream_done', 'error')) AS c, bool_or(kind = 'error') AS failed FROM k GROUP BY user_id, session)
SELECT request_id, opened, chunks, bytes, (b - a) / 1e6 AS first_chunk_seconds, (c - a) / 1e6 AS total_seconds,
round(CASE WHEN bytes > 0 THEN ((c - a) / 1e6) / (bytes / 2.0 / 24000) WHEN c - a IS NOT NULL THEN 0.0 END, 6) AS rtf,
CASE WHEN failed THEN 'error' WHEN c IS NULL THEN 'unfinished' ELSE 'ok' END AS status FROM g""",
)
def request_lifecycles(spark, folder):
    """Users as requests that close after twelve silent hours; event ids as chunk sizes."""
    kind = F.col("event_type")
    named = F.when(kind == "view", "stream_start").when(kind == "click", "chunk").when(kind == "purchase", "stream_done")
    events = _events(spark, folder).select(
        F.col("user_id").alias("request_id"), "ts", named.when(kind == "error", "error").otherwise("other").alias("kind"), F.col("event_id").alias("bytes")
    )
    with _settings(spark, LOCAL_SESSIONS):
        rows = drain(request_lifecycle(events, timeout="12 hours"), "complete")
    return rows.withColumn("opened", _at("opened")).withColumn("rtf", F.round("rtf", 6))


@query(
    "active_gauge",
    "STM-04",
    sql="SELECT event_type, user_id, sum(CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END)::BIGINT AS active FROM events GROUP BY 1, 2",
)
def active_gauge(spark, folder):
    delta = F.when(F.col("event_id") % 3 == 0, -1).otherwise(1)
    stream = active_level(_events(spark, folder).withColumn("delta", delta), ["event_type", "user_id"], "delta")
    return drain(stream, "update", ["event_type", "user_id"])


_SESSION_ROWS = f"WITH {_sessions_sql('6 hours')} SELECT user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts)) AS last_request, count(*) AS requests FROM s GROUP BY user_id, session"


@query("streamed_user_sessions", "STM-05", sql=_SESSION_ROWS)
def streamed_user_sessions(spark, folder):
    with _settings(spark, LOCAL_SESSIONS):
        rows = drain(user_sessions(_events(spark, folder), "user_id", gap="6 hours"), "complete")
    return rows.withColumns({"session_start": F.unix_micros("session_start"), "last_request": F.unix_micros("last_request")})


@query("batch_user_sessions", "STM-05", sql=_SESSION_ROWS)
def batch_user_sessions(spark, folder):
    """The same sessions from the finished table, without bringing a user's rows together."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = sessions(events, "user_id", "ts", "event_id", 6 * 3600).drop("session")
    return rows.withColumns({"session_start": F.unix_micros("session_start"), "last_request": F.unix_micros("last_request")})


_BLOCKS = f"""WITH t AS (SELECT conv_id, turn, {WORDS_SQL} AS w FROM conversations), f AS (SELECT conv_id, flatten(list(list_transform(w, lambda x: length(x)) ORDER BY turn)) AS t FROM t GROUP BY 1)
SELECT conv_id, b AS block, array_to_string(t[5 * b + 1 : 5 * b + 5], ',') AS tokens FROM f, range(0, 2000) r(b) WHERE 5 * b < len(t)"""


def _shown_blocks(rows):
    return rows.withColumn("tokens", F.array_join(F.transform("tokens", lambda t: t.cast("string")), ","))


@query("rebatched_token_stream", "STM-06", sql=_BLOCKS)
def rebatched_token_stream(spark, folder):
    """Turns arrive as token lists per conversation; the last turn flushes the remainder."""
    ends = table(spark, folder, "conversations").groupBy("conv_id").agg(F.max("turn").alias("last"))
    turns = table_stream(spark, folder, "conversations").join(ends, "conv_id")
    rows = turns.select("conv_id", F.col("turn").alias("position"), whitespace_tokens(F.col("text")).alias("tokens"), (F.col("turn") == F.col("last")).alias("final"))
    with _settings(spark, ROCKSDB):
        blocks = drain(rebatched(rows, "conv_id"), "append")
    return _shown_blocks(blocks)


@query("disordered_token_stream", "STM-06", sql=_BLOCKS)
def disordered_token_stream(spark, folder):
    """The same turns, arriving in three waves of files, the end before the beginning.

    Each wave is one run of the stream from the checkpoint of the one before, so the number of micro-batches does not
    grow with the number of files.
    """
    dealt, incoming, target = (scratch_path(spark, n) for n in ("dealt-turns", "turns", "stream"))
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    ends = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    rows = turns.join(ends, "conv_id").select("conv_id", F.col("turn").alias("position"), whitespace_tokens(F.col("text")).alias("tokens"), (F.col("turn") == F.col("last")).alias("final"))
    wave = F.pmod(-F.col("position") - F.xxhash64("conv_id") % 2, F.lit(3)).cast("int")
    rows.withColumn("part", wave).write.partitionBy("part").parquet(dealt)
    waves = spark.read.schema(T.StructType([*rows.schema, T.StructField("part", T.IntegerType())])).parquet(dealt)
    for part in range(3):
        waves.where(F.col("part") == part).drop("part").write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(rows.schema).parquet(incoming)
        with _settings(spark, ROCKSDB):
            blocks = drain(rebatched(stream, "conv_id"), "append", checkpoint=f"{target}-checkpoint", target=target)
    return _shown_blocks(blocks)


@query("rebatched_token_table", "STM-06", sql=_BLOCKS)
def rebatched_token_table(spark, folder):
    turns = table(spark, folder, "conversations")
    rows = turns.select("conv_id", F.col("turn").alias("position"), whitespace_tokens(F.col("text")).alias("tokens"))
    return _shown_blocks(rebatched_table(rows, "conv_id"))


@query(
    "incremental_shards",
    "STM-07",
    sql="""SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice < 250000 THEN 1 ELSE 2 END::INTEGER AS phase, i // 1000 AS shard
FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)""",
)
def incremental_shards(spark, folder):
    """Half of the shard files are there on the first run, all on the second; each is processed once."""
    incoming, target, checkpoint = (scratch_path(spark, n) for n in ("incoming", "phases", "progress"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    numbered = sharded(orders, ["o_orderkey"], 1000)
    schema = numbered.schema
    half = numbered.where(F.col("shard") % 2 == 0), numbered.where(F.col("shard") % 2 == 1)
    phase = F.when(F.col("o_totalprice") < 250000, 1).otherwise(2)
    for part in half:
        part.repartition("shard").write.mode("append").parquet(incoming)
        new_files(spark, incoming, schema, lambda rows: rows.withColumn("phase", phase).drop("o_totalprice"), target, checkpoint, ["phase", "shard"], 3)
    return spark.read.parquet(target).withColumn("shard", F.col("shard").cast("bigint"))


_IDENTITY = "identity-1"


@query(
    "idempotent_journal",
    "STM-08",
    sql="SELECT doc_id AS benchmark_id, source AS hypothesis, n_chars / 100.0::DOUBLE AS generation_latency_seconds FROM documents WHERE lang = 'en'",
)
def idempotent_journal(spark, folder):
    """German records arrive twice, French ones under another identity, Spanish ones with a wrong hash: English ones stay."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    identity = F.when(F.col("lang") == "fr", "identity-0").otherwise(_IDENTITY)
    records = with_record_hash(
        docs.select(
            F.col("doc_id").alias("benchmark_id"),
            identity.alias("evaluation_identity_sha256"),
            F.sha2(F.col("doc_id").cast("string"), 256).alias("item_sha256"),
            F.col("source").alias("hypothesis"),
            F.concat(F.col("doc_id"), F.lit(".wav")).alias("audio_path"),
            F.sha2(F.col("source"), 256).alias("audio_sha256"),
            (F.col("n_chars") / 100.0).alias("generation_latency_seconds"),
            F.lit(0.5).alias("asr_latency_seconds"),
            "lang",
        )
    ).withColumn("record_sha256", F.when(F.col("lang") == "es", "bad").otherwise(F.col("record_sha256")))
    incoming = scratch_path(spark, "journal")
    records.write.parquet(incoming)
    records.where("lang = 'de'").write.mode("append").parquet(incoming)
    journal = drain(spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 2).parquet(incoming), "append")
    expected = docs.select(F.col("doc_id").alias("benchmark_id"), F.sha2(F.col("doc_id").cast("string"), 256).alias("expected_item_sha256"), F.concat(F.col("doc_id"), F.lit(".wav")).alias("expected_audio_path"))
    kept = usable_records(journal, expected, _IDENTITY)
    return kept.select("benchmark_id", "hypothesis", "generation_latency_seconds")


@query(
    "streamed_log_counts",
    "STM-09",
    "SRC-16",
    sql="""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, CASE event_type WHEN 'view' THEN 'stream_start' WHEN 'click' THEN 'first_chunk' ELSE 'stream_done' END AS event, count(*) AS requests
FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2""",
)
def streamed_log_counts(spark, folder):
    path = scratch_path(spark, "log")
    table(spark, folder, "events").select(log_line()).write.text(path)
    parsed = request_events(spark.readStream.text(path))
    counts = drain(windowed_counts(parsed, ["event"], width="1 day"), "update", ["window_start", "event"])
    return counts.withColumn("window_start", _at("window_start"))
