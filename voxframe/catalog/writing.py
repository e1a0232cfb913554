"""Writers: what was written is read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.base import PLAN_SQL, TURNS_SQL, query, table, turn_pairs, utterance_rows
from voxframe.functions.injected import whitespace_tokens
from voxframe.operators.columns import shard_of
from voxframe.operators.sets import union_all
from voxframe.plans.corpus import build_shards, with_tokens, with_vectors
from voxframe.plans.split import split_plan
from voxframe.session import scratch_path
from voxframe.sources.manifests import key_members
from voxframe.sources.sinks import (
    PHASE_ROWS,
    cache_manifest,
    check_schema,
    check_tokens,
    grouped_manifest_lines,
    json_cells,
    manifest_lines,
    phase_rows,
    plan_lines,
    publish,
    read_published,
    result_lines,
    roll_up_manifest,
    sharded,
    transcript_lines,
    write_lines,
    write_phase_tables,
    write_plan_lines,
    write_shards,
)


@query("written_manifest", "SNK-01", sql="SELECT doc_id || ' ' || source AS value FROM documents")
def written_manifest(spark, folder):
    path = scratch_path(spark, "utt2spk")
    write_lines(manifest_lines(table(spark, folder, "documents"), "doc_id", "source"), path)
    return spark.read.text(path)


@query(
    "speaker_manifest",
    "SNK-01",
    "AGG-02",
    sql="""SELECT 'user' || user_id || ' ' || string_agg(utt, ' ' ORDER BY utt) AS value
FROM (SELECT user_id, 'e' || event_id AS utt FROM events) GROUP BY user_id""",
)
def speaker_manifest(spark, folder):
    """All of a speaker's utterances on one line."""
    path = scratch_path(spark, "spk2utt")
    write_lines(grouped_manifest_lines(_spoken(spark, folder), "spk", "utt"), path)
    return spark.read.text(path)


def _spoken(spark, folder):
    return table(spark, folder, "events").select(
        F.concat(F.lit("user"), "user_id").alias("spk"), F.concat(F.lit("e"), "event_id").alias("utt")
    )


@query(
    "speaker_manifest_parts",
    "SNK-01",
    "AGG-02",
    sql="SELECT 'user' || user_id AS spk, 'e' || event_id AS utt FROM events",
)
def speaker_manifest_parts(spark, folder):
    """Written in parts far smaller than a speaker's list, every member is read back."""
    path = scratch_path(spark, "spk2utt-parts")
    write_lines(grouped_manifest_lines(_spoken(spark, folder), "spk", "utt", 7), path)
    return key_members(spark, path, parts=True).toDF("spk", "utt")


@query(
    "fixed_size_shards",
    "SNK-02",
    sql="""SELECT (i // 1000)::INTEGER AS shard, count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) GROUP BY 1""",
)
def fixed_size_shards(spark, folder):
    path = scratch_path(spark, "shards")
    write_shards(sharded(table(spark, folder, "orders"), ["o_orderkey"], 1000), path)
    return (
        spark.read.parquet(path)
        .groupBy("shard")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
    )


def _shards(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("utt"), F.col("source").alias("spk"), "text")
    return build_shards(docs, scratch_path(spark, "corpus"), 100)


_NUMBERED = "(SELECT doc_id AS utt, source AS spk, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS i FROM documents)"


@query(
    "utterances_with_vectors",
    "AGG-01",
    "JOIN-03",
    "JOIN-04",
    sql="""WITH m AS (SELECT source, i, avg(x::DOUBLE) AS x FROM (SELECT source, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM documents JOIN embeddings ON vec_id = doc_id) GROUP BY 1, 2),
s AS (SELECT source, string_agg(printf('%.5f', x + 0.0), ' ' ORDER BY i) AS spk_embedding FROM m GROUP BY 1)
SELECT doc_id AS utt, source AS spk, array_to_string(list_transform(embedding, lambda v: printf('%.5f', v::DOUBLE + 0.0)), ' ') AS utt_embedding, spk_embedding,
CASE WHEN l.doc_id IS NOT NULL THEN l.quality || ',' || l.toxic END AS speech_token, NULL::VARCHAR AS reject_speech_token
FROM documents d LEFT JOIN embeddings ON vec_id = doc_id LEFT JOIN s USING (source) LEFT JOIN labels l USING (doc_id)""",
)
def utterances_with_vectors(spark, folder):
    """Own vector, mean vector of the speaker, tokens where there are some, and no rejected tokens at all."""
    rows = table(spark, folder, "documents").select(F.col("doc_id").alias("utt"), F.col("source").alias("spk"))
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("utt"), F.col("embedding").alias("vector"))
    tokens = table(spark, folder, "labels").select(F.col("doc_id").alias("utt"), F.array("quality", "toxic").alias("speech_token"))
    full = with_tokens(with_vectors(rows, vectors), tokens, None)
    shown = lambda c: F.array_join(F.transform(c, lambda v: F.format_string("%.5f", v.cast("double") + 0.0)), " ")
    joined = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",").alias(c)
    return full.select(
        "utt",
        "spk",
        shown("utt_embedding").alias("utt_embedding"),
        shown("spk_embedding").alias("spk_embedding"),
        joined("speech_token"),
        joined("reject_speech_token"),
    )


@query("utterance_shard_index", "SNK-03", sql=f"SELECT utt, i::INTEGER AS shard FROM {_NUMBERED}")
def utterance_shard_index(spark, folder):
    return _shards(spark, folder)["utterances"]


@query("speaker_shard_index", "SNK-03", sql=f"SELECT DISTINCT spk, i::INTEGER AS shard FROM {_NUMBERED}")
def speaker_shard_index(spark, folder):
    return _shards(spark, folder)["speakers"]


@query("shard_file_list", "SNK-03", sql=f"SELECT DISTINCT i::INTEGER AS shard, 'shard=' || i AS file FROM {_NUMBERED}")
def shard_file_list(spark, folder):
    files = _shards(spark, folder)["shards"]
    return files.select("shard", F.substring_index("file", "/", -1).alias("file"))


def token_cache(spark, folder):
    """Plan rows with tokens: the word lengths of the text stand in for speech tokens."""
    plan = split_plan(utterance_rows(spark, folder), reserve=5, strict=False)
    tokens = whitespace_tokens(F.col("text"))
    with_tokens = plan.withColumn("speech_token", tokens).withColumn("speech_token_len", F.size(tokens))
    return phase_rows(with_tokens.withColumn("shard", shard_of(F.col("source_relative_path")) % 16))


CACHE_SQL = (
    PLAN_SQL
    + r""",
cache AS (
  SELECT source_relative_path, text, instruct, agreement, phase::INTEGER AS phase, ((doc_id % 519) % 16)::INTEGER AS shard,
         list_transform(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''), lambda w: length(w)::INTEGER) AS speech_token
  FROM plan WHERE phase IN (1, 2))"""
)


@query(
    "phase_tables",
    "SNK-04",
    "PRJ-01",
    sql=f"""WITH {CACHE_SQL}
SELECT source_relative_path, phase, shard, md5(text) AS text_md5, instruct, agreement, len(speech_token)::INTEGER AS speech_token_len,
       list_sum(speech_token)::BIGINT AS token_sum FROM cache""",
)
def phase_tables(spark, folder):
    path = scratch_path(spark, "phases")
    write_phase_tables(token_cache(spark, folder), path)
    total = F.aggregate("speech_token", F.lit(0).cast("bigint"), lambda a, t: a + t)
    return spark.read.parquet(path).select(
        "source_relative_path", "phase", "shard", F.md5("text").alias("text_md5"), "instruct", "agreement", "speech_token_len", total.alias("token_sum")
    )


_PLAN_COLUMNS = ["agreement", "phase", "reserved", "source_relative_path", "text_token_count"]


@query(
    "split_plan_lines",
    "SNK-05",
    sql=f"""WITH {PLAN_SQL}
SELECT source_relative_path, reserved, phase::INTEGER AS phase, text_token_count::INTEGER AS text_token_count, agreement,
       ((doc_id % 519) % 16)::INTEGER AS shard, 'agreement,phase,reserved,source_relative_path,text_token_count' AS keys FROM plan""",
)
def split_plan_lines(spark, folder):
    """JSON lines by shard, read back and parsed; the keys come in sorted order."""
    plan = split_plan(utterance_rows(spark, folder), reserve=5, strict=False)
    path = scratch_path(spark, "plan-lines")
    write_plan_lines(plan_lines(plan.withColumn("shard", shard_of(F.col("source_relative_path")) % 16), _PLAN_COLUMNS), path)
    schema = "agreement double, phase int, reserved boolean, source_relative_path string, text_token_count int"
    read = spark.read.text(path).withColumn("j", F.from_json("value", schema))
    keys = F.array_join(F.json_object_keys("value"), ",")
    return read.select("j.*", "shard", keys.alias("keys"))


@query(
    "canonical_result_lines",
    "SNK-06",
    "JSN-01",
    sql="""SELECT o_orderkey, value, sha256(value) AS record_sha256 FROM (SELECT o_orderkey,
'{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS value FROM orders)""",
)
def canonical_result_lines(spark, folder):
    return result_lines(table(spark, folder, "orders"), "o_orderkey", ["o_orderpriority", "o_orderkey", "o_custkey"])


@query(
    "verified_publication",
    "SNK-07",
    sql=f"""WITH {CACHE_SQL}
SELECT phase, count(*) AS rows, sum(len(speech_token))::BIGINT AS tokens FROM cache GROUP BY phase""",
)
def verified_publication(spark, folder):
    """Publish, let a second publication fail its checks, and read what is still current."""
    root = scratch_path(spark, "published")
    cache = token_cache(spark, folder).where(F.size("speech_token") > 0)
    names = [f.name for f in PHASE_ROWS]
    full = cache.select(*names, "phase")
    publish(full, root, [check_schema(full.schema), check_tokens("speech_token", "speech_token_len")])
    spoiled = full.withColumn("speech_token_len", F.col("speech_token_len") + 1)
    try:
        publish(spoiled, root, [check_tokens("speech_token", "speech_token_len")])
    except ValueError:
        pass
    current = read_published(spark, root)
    return current.groupBy("phase").agg(F.count(F.lit(1)).alias("rows"), F.sum("speech_token_len").alias("tokens"))


@query(
    "cache_roll_up",
    "SNK-08",
    "AGG-08",
    sql=f"""WITH {CACHE_SQL}
SELECT count(*) FILTER (phase = 1) AS phase1_rows, count(*) FILTER (phase = 2) AS phase2_rows, count(*) AS row_count FROM cache""",
)
def cache_roll_up(spark, folder):
    manifest = roll_up_manifest(cache_manifest(token_cache(spark, folder)))
    rows = lambda phase: F.coalesce(F.try_element_at("phase_rows", F.lit(phase)), F.lit(0).cast("bigint"))
    return manifest.select(rows(1).alias("phase1_rows"), rows(2).alias("phase2_rows"), "row_count")


_SHOWN = "'[''' || array_to_string({0}, ''', ''') || ''']'"


@query(
    "transcript_pair_lines",
    "SNK-09",
    sql=f"""WITH {TURNS_SQL}
SELECT line::INTEGER AS line, md5(conv_id || '-' || turn || ':' || chr(9) || CASE line WHEN 0 THEN 'ref=' || {_SHOWN.format('r')} ELSE 'hyp=' || {_SHOWN.format('h')} END) AS value_md5
FROM turns, (SELECT unnest([0, 1]) AS line)""",
)
def transcript_pair_lines(spark, folder):
    pairs = turn_pairs(spark, folder).withColumn("key", F.concat_ws("-", "conv_id", "turn"))
    return transcript_lines(pairs, "key", "ref", "hyp").select("line", F.md5("value").alias("value_md5"))


@query(
    "character_transcript_lines",
    "SNK-09",
    "STR-17",
    sql=f"""WITH {TURNS_SQL}
SELECT line::INTEGER AS line, md5(conv_id || '-' || turn || ':' || chr(9) || CASE line
  WHEN 0 THEN 'ref=' || {_SHOWN.format("string_split(array_to_string(r, ''), '')")}
  ELSE 'hyp=' || {_SHOWN.format("string_split(array_to_string(h, ''), '')")} END) AS value_md5
FROM turns, (SELECT unnest([0, 1]) AS line)""",
)
def character_transcript_lines(spark, folder):
    pairs = turn_pairs(spark, folder).withColumn("key", F.concat_ws("-", "conv_id", "turn"))
    return transcript_lines(pairs, "key", "ref", "hyp", by_character=True).select("line", F.md5("value").alias("value_md5"))


@query(
    "json_cell_table",
    "SNK-10",
    "SET-06",
    sql="""SELECT c_custkey::VARCHAR AS c_custkey, '"' || c_mktsegment || '"' AS c_mktsegment, 'null' AS s_name, 'null' AS s_suppkey FROM customer
UNION ALL SELECT 'null', 'null', '"' || s_name || '"', s_suppkey::VARCHAR FROM supplier""",
)
def json_cell_table(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return json_cells(union_all([customers, suppliers]))
