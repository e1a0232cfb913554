"""Readers, run over files that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxframe.catalog.base import TIDY_SQL, query, table, tidy
from voxframe.catalog.derived import write_archives, write_paired_files, write_sidecar_archives
from voxframe.operators.ordering import with_ordinal
from voxframe.operators.sampling import lowest_scores
from voxframe.session import scratch_path
from voxframe.sources.archives import selected_members, sidecar_lines, tar_pairs
from voxframe.sources.ranges import footer_index, member_index, members_by_range, pairs_by_range, rows_at
from voxframe.sources.logs import request_events
from voxframe.sources.manifests import (
    key_values,
    merged_json_indexes,
    one_shard,
    paired_texts,
    parquet_files,
    parquet_list,
    pipe_manifest,
    request_rows,
    row_at,
    sidecar,
    snapshot,
    tab_separated,
    valid_sidecar,
    with_optional_manifest,
)
from voxframe.sources.sinks import sharded, write_shards


def _ordered_lines(df, path, *keys):
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).select("value").write.text(path)


@query(
    "key_value_manifest",
    "SRC-01",
    sql="SELECT source AS utt, '/audio/' || max(doc_id) || '.wav' AS value FROM documents GROUP BY source",
)
def key_value_manifest(spark, folder):
    """Every source appears once per document; the last line of the manifest wins."""
    path = scratch_path(spark, "wav-scp")
    docs = table(spark, folder, "documents")
    lines = docs.select("doc_id", F.format_string("%s  /audio/%d.wav ignored", "source", "doc_id").alias("value"))
    _ordered_lines(lines, path, "doc_id")
    return key_values(spark, path)


@query(
    "free_text_manifest",
    "SRC-01",
    sql=f"SELECT 'utt' || doc_id AS utt, md5({TIDY_SQL}) AS text_md5 FROM documents",
)
def free_text_manifest(spark, folder):
    path = scratch_path(spark, "text")
    docs = table(spark, folder, "documents")
    _ordered_lines(docs.select("doc_id", F.concat(F.lit("utt"), "doc_id", F.lit("\t"), tidy(F.col("text"))).alias("value")), path, "doc_id")
    return key_values(spark, path, free_text=True).select("utt", F.md5("value").alias("text_md5"))


@query(
    "optional_manifest_absent",
    "SRC-02",
    sql="SELECT 'utt' || doc_id AS utt, CAST(NULL AS VARCHAR) AS instruct FROM documents",
)
def optional_manifest_absent(spark, folder):
    docs = table(spark, folder, "documents").select(F.concat(F.lit("utt"), "doc_id").alias("utt"))
    return with_optional_manifest(docs, scratch_path(spark, "absent"), "instruct").select("utt", "instruct")


@query(
    "optional_manifest_present",
    "SRC-02",
    sql="""SELECT 'utt' || d.doc_id AS utt, CASE WHEN l.doc_id IS NOT NULL THEN 'quality ' || l.quality END AS instruct
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def optional_manifest_present(spark, folder):
    path = scratch_path(spark, "instruct")
    labels = table(spark, folder, "labels")
    _ordered_lines(labels.select("doc_id", F.format_string("utt%d quality %d", "doc_id", "quality").alias("value")), path, "doc_id")
    docs = table(spark, folder, "documents").select(F.concat(F.lit("utt"), "doc_id").alias("utt"))
    return with_optional_manifest(docs, path, "instruct").select("utt", "instruct")


_PAIRED_SQL = """SELECT 'page' || page_id AS utt, url AS text FROM pages WHERE url NOT LIKE '%?%'"""


@query("audio_text_pairs", "SRC-03", sql=_PAIRED_SQL)
def audio_text_pairs(spark, folder):
    """Pages as audio files; those whose address has a query get no text sibling."""
    root = write_paired_files(table(spark, folder, "pages"))
    return paired_texts(spark, root)[0].select("utt", "text")


@query(
    "audio_without_text",
    "SRC-03",
    sql="SELECT 'page' || page_id || '.wav' AS file FROM pages WHERE url LIKE '%?%'",
)
def audio_without_text(spark, folder):
    root = write_paired_files(table(spark, folder, "pages"))
    return paired_texts(spark, root)[1].select(F.substring_index("path", "/", -1).alias("file"))


@query(
    "tab_separated_table",
    "SRC-04",
    sql=f"SELECT doc_id, lang, source, md5({TIDY_SQL}) AS text_md5 FROM documents",
)
def tab_separated_table(spark, folder):
    path = scratch_path(spark, "tsv")
    docs = table(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit(" "), "lang").alias("lang"), "source", F.concat(tidy(F.col("text")), F.lit(" ")).alias("text")
    )
    docs.write.option("quote", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(
        path, sep="\t", header=True
    )
    fields = [T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("lang", "source", "text")]]
    schema = T.StructType(fields)
    return tab_separated(spark, path, schema).select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


@query(
    "pipe_separated_manifest",
    "SRC-05",
    sql="""SELECT 'page' || page_id AS utt, replace(url, '|', '') AS prompt_text,
CASE WHEN page_id % 2 = 0 THEN '/abs/' ELSE '/data/set/' END || page_id || '.wav' AS prompt_wav, 'size ' || length(html) AS text FROM pages""",
)
def pipe_separated_manifest(spark, folder):
    path = scratch_path(spark, "pipe")
    pages = table(spark, folder, "pages")
    wav = F.concat(F.when(F.col("page_id") % 2 == 0, "/abs/").otherwise(""), "page_id", F.lit(".wav"))
    size = F.concat(F.lit("size "), F.char_length("html"))
    clean = F.replace("url", F.lit("|"), F.lit(""))
    pages.select(F.concat_ws("|", F.concat(F.lit("clips/page"), "page_id", F.lit(".flac")), clean, wav, size).alias("value")).write.text(path)
    return pipe_manifest(spark, path, "/data/set")


_EVENT = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StructType([T.StructField("k", T.IntegerType())])),
    ]
)


def _event_sidecar(spark, folder):
    path = scratch_path(spark, "sidecar")
    version = F.when(F.col("event_type") == "error", 2).otherwise(1)
    good = F.to_json(F.struct(version.alias("schema_version"), "event_id", "value", F.from_json("props", "k int").alias("props")))
    line = F.when(F.col("event_type") == "signup", F.concat(F.lit("["), F.col("event_id"), F.lit("]"))).otherwise(good)
    table(spark, folder, "events").select(line.alias("value")).write.text(path)
    return path


@query(
    "sidecar_issue_counts",
    "SRC-06",
    sql="""SELECT CASE event_type WHEN 'signup' THEN 'malformed' WHEN 'error' THEN 'schema_version' END AS issue, count(*) AS lines
FROM events GROUP BY 1""",
)
def sidecar_issue_counts(spark, folder):
    rows = sidecar(spark, _event_sidecar(spark, folder), _EVENT)
    return rows.groupBy("issue").agg(F.count(F.lit(1)).alias("lines"))


@query("typed_sidecar", "SRC-06", sql="SELECT 1 AS schema_version, event_id, value, CAST(props->>'k' AS INTEGER) AS k FROM events")
def typed_sidecar(spark, folder):
    path = scratch_path(spark, "sidecar")
    events = table(spark, folder, "events")
    events.select(
        F.to_json(F.struct(F.lit(1).alias("schema_version"), "event_id", "value", F.from_json("props", "k int").alias("props"))).alias("value")
    ).write.text(path)
    return valid_sidecar(spark, path, _EVENT).select("schema_version", "event_id", "value", F.col("props.k").alias("k"))


@query("compressed_sidecar_lines", "SRC-07", sql="SELECT doc_id, lang, md5(text) AS text_md5 FROM documents")
def compressed_sidecar_lines(spark, folder):
    """Archives in tar.zst by task and language, each with JSON-lines members."""
    paths = write_sidecar_archives(table(spark, folder, "documents"))
    parsed = sidecar_lines(spark, paths).select(F.from_json("line", "doc_id bigint, lang string, text string").alias("j"))
    return parsed.select("j.doc_id", "j.lang", F.md5("j.text").alias("text_md5"))


def _archived_documents(spark, folder):
    docs = table(spark, folder, "documents")
    rows = docs.select(
        F.pmod("doc_id", F.lit(16)).cast("int").alias("shard"),
        F.col("doc_id").cast("string").alias("key"),
        F.to_json(F.struct(F.format_string("%06d/%d.mp3", F.pmod("doc_id", F.lit(16)), "doc_id").alias("source_relative_path"))).alias("text"),
        F.encode("text", "UTF-8").alias("payload"),
    )
    target = scratch_path(spark, "archives")
    return write_archives(rows, target, "shard", "key", "text", "payload"), target


_ARCHIVED_PATH = "lpad((doc_id % 16)::VARCHAR, 6, '0') || '/' || doc_id || '.mp3'"


@query(
    "archive_pairs",
    "SRC-08",
    sql=f"SELECT {_ARCHIVED_PATH} AS source_relative_path, md5(text) AS payload_md5 FROM documents",
)
def archive_pairs(spark, folder):
    written, target = _archived_documents(spark, folder)
    written.count()
    return tar_pairs(spark, target).select("source_relative_path", F.md5("payload").alias("payload_md5"))


@query(
    "selected_archive_members",
    "SRC-09",
    sql=f"""SELECT {_ARCHIVED_PATH} AS source_relative_path, md5(text) AS payload_md5 FROM documents
ORDER BY sha256('1986' || chr(0) || {_ARCHIVED_PATH}), 1 LIMIT 33""",
)
def selected_archive_members(spark, folder):
    written, target = _archived_documents(spark, folder)
    written.count()
    paths = table(spark, folder, "documents").select(
        F.format_string("%06d/%d.mp3", F.pmod("doc_id", F.lit(16)), "doc_id").alias("source_relative_path")
    )
    wanted = lowest_scores(paths, "source_relative_path", 33).select(
        F.concat(F.lit(f"{target}/shard_"), F.split_part("source_relative_path", F.lit("/"), F.lit(1)), F.lit(".tar")).alias("archive"),
        F.split_part("source_relative_path", F.lit("/"), F.lit(2)).alias("member"),
    )
    found = selected_members(wanted)
    shard = F.regexp_extract("archive", r"shard_(\d{6})\.tar$", 1)
    return found.select(F.concat_ws("/", shard, "member").alias("source_relative_path"), F.md5("payload").alias("payload_md5"))


def _listed_archives(spark, written, target):
    return written.select(F.concat(F.lit(f"{target}/"), F.format_string("shard_%06d.tar", "shard")).alias("archive"))


@query(
    "archive_member_index",
    "SRC-08",
    sql="""SELECT lpad((doc_id % 16)::VARCHAR, 6, '0') AS shard, count(*) * 2 AS members,
sum(octet_length(encode(text)))::BIGINT AS audio_bytes FROM documents GROUP BY 1""",
)
def archive_member_index(spark, folder):
    """Members and audio bytes of every archive, from headers alone."""
    written, target = _archived_documents(spark, folder)
    index = member_index(_listed_archives(spark, written, target))
    audio = F.sum(F.when(F.endswith("member", F.lit(".mp3")), F.col("size")))
    shard = F.regexp_extract("archive", r"shard_(\d{6})\.tar$", 1).alias("shard")
    return index.groupBy(shard).agg(F.count(F.lit(1)).cast("long").alias("members"), audio.alias("audio_bytes"))


@query(
    "archive_pairs_by_range",
    "SRC-08",
    sql=f"SELECT {_ARCHIVED_PATH} AS source_relative_path, md5(text) AS payload_md5 FROM documents",
)
def archive_pairs_by_range(spark, folder):
    """As ``archive_pairs``, with several tasks for one archive."""
    written, target = _archived_documents(spark, folder)
    index = member_index(_listed_archives(spark, written, target))
    return pairs_by_range(index).select("source_relative_path", F.md5("payload").alias("payload_md5"))


@query(
    "selected_members_by_range",
    "SRC-09",
    sql=f"SELECT {_ARCHIVED_PATH} AS source_relative_path, md5(text) AS payload_md5 FROM documents JOIN labels USING (doc_id)",
)
def selected_members_by_range(spark, folder):
    """The archived texts of all labelled documents."""
    written, target = _archived_documents(spark, folder)
    index = member_index(_listed_archives(spark, written, target))
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    wanted = docs.select(
        F.concat(F.lit(f"{target}/"), F.format_string("shard_%06d.tar", F.pmod("doc_id", F.lit(16)))).alias("archive"),
        F.format_string("%d.mp3", "doc_id").alias("member"),
    )
    shard = F.regexp_extract("archive", r"shard_(\d{6})\.tar$", 1)
    found = members_by_range(wanted, index)
    return found.select(F.concat_ws("/", shard, "member").alias("source_relative_path"), F.md5("payload").alias("payload_md5"))


@query(
    "parquet_path_list",
    "SRC-10",
    sql="SELECT o_orderstatus, count(*) AS rows, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def parquet_path_list(spark, folder):
    """Orders beside an unreadable file, which is skipped."""
    broken = scratch_path(spark, "broken")
    table(spark, folder, "orders").select(F.lit("not parquet").alias("value")).write.text(broken)
    rows = parquet_files(spark, [f"{folder}/orders.parquet", broken], table(spark, folder, "orders").schema)
    return rows.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 2).cast("double").alias("total")
    )


@query(
    "parquet_file_list",
    "SRC-11",
    sql="SELECT o_orderpriority, count(*) AS rows, max(o_orderkey) AS last_key FROM orders GROUP BY 1",
)
def parquet_file_list(spark, folder):
    """A list file naming one Parquet folder per priority."""
    root = scratch_path(spark, "listed")
    orders = table(spark, folder, "orders")
    orders.withColumn("p", F.col("o_orderpriority").substr(1, 1)).repartition("p").write.partitionBy("p").parquet(root)
    names = orders.select(F.concat(F.lit(f"{root}/p="), F.col("o_orderpriority").substr(1, 1)).alias("value")).distinct()
    names.write.text(f"{root}-list")
    rows = parquet_list(spark, f"{root}-list")
    return rows.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"), F.max("o_orderkey").alias("last_key"))


@query(
    "merged_index_files",
    "SRC-12",
    sql="""SELECT 'utt' || doc_id AS key, CASE WHEN lang = 'en' THEN 'second/' ELSE 'first/' END || source AS value FROM documents""",
)
def merged_index_files(spark, folder):
    """Two generations of JSON indexes, one object per source; the second generation remaps English."""
    docs = table(spark, folder, "documents")
    paths = []
    for name, rows in (("first", docs), ("second", docs.where(F.col("lang") == "en"))):
        path = scratch_path(spark, f"index-{name}")
        entry = F.struct(F.concat(F.lit("utt"), "doc_id"), F.concat(F.lit(f"{name}/"), "source"))
        part = rows.groupBy("source", F.floor(F.col("doc_id") / 5000).alias("run"))
        objects = part.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).drop("run")
        # One object per file, as an index file is.
        objects.write.option("maxRecordsPerFile", 1).partitionBy("source").text(path)
        paths += sorted(spark.read.text(path).inputFiles())
    return merged_json_indexes(spark, paths)


_BENCHMARK = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


@query("benchmark_snapshot", "SRC-13", sql="SELECT item_id, text FROM benchmark")
def benchmark_snapshot(spark, folder):
    return snapshot(spark, f"{folder}/benchmark.parquet", _BENCHMARK)


@query(
    "row_by_ordinal",
    "SRC-14",
    sql="""SELECT o_orderkey, o_totalprice, n - 1 AS ordinal FROM (
SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n, count(*) OVER () AS total FROM orders) WHERE n - 1 = total // 2""",
)
def row_by_ordinal(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    numbered = with_ordinal(orders, "o_totalprice", "o_orderkey")
    return row_at(numbered, "ordinal", numbered.count() // 2)


@query(
    "rows_by_footer",
    "SRC-14",
    sql="""SELECT n - 1 AS ordinal, o_orderkey, o_totalprice FROM (
SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n FROM orders)
WHERE n - 1 IN (SELECT doc_id FROM labels)""",
)
def rows_by_footer(spark, folder):
    """Orders by price at the ordinals that labels name, read from their row groups alone."""
    target = scratch_path(spark, "by-price")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")
    orders.write.option("parquet.block.size", 1 << 16).parquet(target)
    index = footer_index(spark, [target])
    rows = index.agg(F.sum("rows")).first()[0] or 0
    wanted = table(spark, folder, "labels").select(F.col("doc_id").alias("ordinal")).where(F.col("ordinal") < rows)
    return rows_at(index, wanted, ["o_orderkey", "o_totalprice"])



@query(
    "one_plan_shard",
    "SRC-15",
    sql="""SELECT o_orderkey, o_totalprice, 3::BIGINT AS shard FROM (
SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) WHERE i // 1000 = 3""",
)
def one_plan_shard(spark, folder):
    path = scratch_path(spark, "plan-shards")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    write_shards(sharded(orders, ["o_orderkey"], 1000), path)
    return one_shard(spark, path, 3).withColumn("shard", F.col("shard").cast("bigint"))


def log_line():
    """Events as server log lines; two of five kinds are lines of another form."""
    kind = F.col("event_type")
    start = F.concat(F.lit("stream_start | mode=zero_shot | lang=ru | speaker=None | chars="), "event_id")
    first = F.concat(F.lit("first_chunk | bytes=3840 | audio_ms=80 | latency_ms="), "value", F.lit(" | rtf=1.5"))
    done = F.concat(F.lit("stream_done | chunks=1 | bytes="), "event_id", F.lit(" | total_ms="), "value", F.lit(" | rtf=2.0"))
    return F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.lit(" | INFO     | [req-"),
        "user_id",
        F.lit("] "),
        F.when(kind == "view", start).when(kind == "click", first).when(kind == "purchase", done).otherwise("other line"),
    ).alias("value")


@query(
    "parsed_server_log",
    "SRC-16",
    sql="""SELECT 'req-' || user_id AS request_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at,
CASE event_type WHEN 'view' THEN 'stream_start' WHEN 'click' THEN 'first_chunk' ELSE 'stream_done' END AS event,
CASE WHEN event_type = 'view' THEN 'zero_shot' END AS mode,
CASE WHEN event_type = 'view' THEN event_id::INTEGER END AS chars,
CASE event_type WHEN 'click' THEN 3840 WHEN 'purchase' THEN event_id END AS bytes,
CASE WHEN event_type = 'click' THEN value END AS latency_ms, CASE WHEN event_type = 'purchase' THEN value END AS total_ms
FROM events WHERE event_type IN ('view', 'click', 'purchase')""",
)
def parsed_server_log(spark, folder):
    path = scratch_path(spark, "log")
    table(spark, folder, "events").select(log_line()).write.text(path)
    parsed = request_events(spark.read.text(path))
    return parsed.select(
        "request_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "event", "mode", "chars", "bytes", "latency_ms", "total_ms"
    )


@query(
    "request_texts",
    "SRC-17",
    sql="""SELECT 'conv' || conv_id AS utt, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS position, text
FROM conversations""",
)
def request_texts(spark, folder):
    """One request document per conversation, its turns as texts."""
    path = scratch_path(spark, "requests")
    turns = table(spark, folder, "conversations")
    texts = F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"])
    grouped = turns.groupBy("conv_id").agg(texts.alias("texts"))
    document = F.to_json(F.create_map(F.concat(F.lit("conv"), "conv_id"), "texts"))
    grouped.select(document.alias("value")).write.text(path)
    return request_rows(spark.read.text(path))
