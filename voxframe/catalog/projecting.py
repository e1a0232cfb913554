"""Column derivation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.base import TIDY_SQL, UTTERANCES_SQL, query, table, tidy, utterance_rows
from voxframe.functions.text import log_text, slug
from voxframe.operators.columns import (
    chat_turns,
    file_stem,
    mode_fields,
    outcome_records,
    prompt_record,
    shard_of,
    speaker_of,
    strict_shard_of,
    training_columns,
    with_instruct,
    with_item_identity,
)
from voxframe.operators.ordering import with_ordinal
from voxframe.operators.sets import labelled_union

PREFIX = "You are a helpful assistant.<|endofprompt|>"


@query("pruned_columns", "PRJ-01", sql="SELECT o_orderkey, o_totalprice FROM orders")
def pruned_columns(spark, folder):
    return training_columns(table(spark, folder, "orders"), ["o_orderkey", "o_totalprice"])


@query(
    "url_stems_and_hosts",
    "PRJ-02",
    sql=r"""SELECT page_id, regexp_extract(url, '([^/]+?)(\.[^./]*)?$', 1) AS stem, split_part('spk' || page_id % 7 || '_' || page_id, '_', 1) AS speaker FROM pages""",
)
def url_stems_and_hosts(spark, folder):
    pages = table(spark, folder, "pages")
    utterance = F.concat(F.lit("spk"), F.col("page_id") % 7, F.lit("_"), "page_id")
    return pages.select("page_id", file_stem(F.col("url")).alias("stem"), speaker_of(utterance).alias("speaker"))


@query(
    "shard_numbers",
    "PRJ-03",
    sql=f"""WITH {UTTERANCES_SQL}, paths AS (SELECT doc_id, source_relative_path AS path FROM utterances
UNION ALL SELECT doc_id, '9' || source_relative_path FROM utterances UNION ALL SELECT doc_id, lpad((doc_id + 400)::VARCHAR, 6, '0') || '/x.mp3' FROM utterances)
SELECT doc_id, path, CASE WHEN regexp_full_match(path, '[0-9]{{6}}/[^/]+\\.mp3') AND path[1:6]::INTEGER < 519 THEN path[1:6]::INTEGER END AS shard FROM paths""".replace(
        "\\\\", "\\"
    ),
)
def shard_numbers(spark, folder):
    rows = utterance_rows(spark, folder).select("doc_id", F.col("source_relative_path").alias("path"))
    bad = rows.withColumn("path", F.concat(F.lit("9"), "path"))
    high = rows.withColumn("path", F.format_string("%06d/x.mp3", F.col("doc_id") + 400))
    return rows.unionByName(bad).unionByName(high).withColumn("shard", shard_of(F.col("path")))


@query("strict_shard_numbers", "PRJ-03", sql="SELECT doc_id, (doc_id % 519)::INTEGER AS shard FROM documents")
def strict_shard_numbers(spark, folder):
    rows = utterance_rows(spark, folder)
    return rows.select("doc_id", strict_shard_of(F.col("source_relative_path")).alias("shard"))


@query("constant_instruct", "PRJ-04", sql="SELECT doc_id, 'Speak slowly.' AS instruct FROM documents")
def constant_instruct(spark, folder):
    return with_instruct(table(spark, folder, "documents").select("doc_id"), "Speak slowly.")


@query(
    "prompt_records",
    "PRJ-07",
    "SET-02",
    sql="""WITH split AS (
SELECT text, doc_id, CASE WHEN lang = 'en' THEN 'train' ELSE 'test' END AS split FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS i FROM split)
SELECT split, i AS index, 'user' AS first_role, md5(text) AS content_md5, 'assistant' AS second_role, '' AS second_content,
'rule' AS style, md5(text) AS truth_md5, 'text-to-speech' AS ability, 'train.json_test.json' AS data_source FROM numbered""",
)
def prompt_records(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    parts = {
        "train": with_ordinal(docs.where(F.col("lang") == "en"), "doc_id"),
        "test": with_ordinal(docs.where(F.col("lang") != "en"), "doc_id"),
    }
    rows = labelled_union(parts)
    record = prompt_record(F.col("text"), F.col("split"), F.col("ordinal"), "train.json_test.json")
    r = rows.select(record.alias("r"))
    return r.select(
        F.col("r.extra_info.split").alias("split"),
        F.col("r.extra_info.index").alias("index"),
        F.get("r.prompt", F.lit(0))["role"].alias("first_role"),
        F.md5(F.get("r.prompt", F.lit(0))["content"]).alias("content_md5"),
        F.get("r.prompt", F.lit(1))["role"].alias("second_role"),
        F.get("r.prompt", F.lit(1))["content"].alias("second_content"),
        F.col("r.reward_model.style").alias("style"),
        F.md5("r.reward_model.ground_truth").alias("truth_md5"),
        F.col("r.ability").alias("ability"),
        F.col("r.data_source").alias("data_source"),
    )


_MODE = "CASE doc_id % 4 WHEN 0 THEN 'sft' WHEN 1 THEN 'zero_shot' WHEN 2 THEN 'cross_lingual' ELSE 'instruct2' END"


def _mode():
    n = F.col("doc_id") % 4
    return F.when(n == 0, "sft").when(n == 1, "zero_shot").when(n == 2, "cross_lingual").otherwise("instruct2")


@query(
    "chat_messages",
    "PRJ-08",
    "STR-12",
    "STR-13",
    sql=f"""WITH m AS (SELECT doc_id, {_MODE} AS mode, {TIDY_SQL} AS t, lang, source FROM documents),
c AS (SELECT *, CASE mode WHEN 'zero_shot' THEN lang || t WHEN 'instruct2' THEN source || t ELSE t END AS body FROM m)
SELECT doc_id, mode, CASE WHEN mode IN ('zero_shot', 'cross_lingual') THEN 2 ELSE 1 END::INTEGER AS turns,
md5('{PREFIX}' || body) AS user_md5,
CASE WHEN mode IN ('zero_shot', 'cross_lingual') THEN '<|s_' || doc_id || '|><|s_7|>' END AS reply FROM c""",
)
def chat_messages(spark, folder):
    docs = table(spark, folder, "documents").withColumn("mode", _mode()).withColumn("t", tidy(F.col("text")))
    prompt = F.when(F.col("mode") == "zero_shot", F.col("lang"))
    tokens = F.array(F.col("doc_id").cast("int"), F.lit(7))
    chat = docs.select("doc_id", "mode", chat_turns(F.col("mode"), F.col("t"), prompt, F.col("source"), tokens).alias("chat"))
    return chat.select(
        "doc_id",
        "mode",
        F.size("chat").alias("turns"),
        F.md5(F.get("chat", F.lit(0))["content"]).alias("user_md5"),
        F.get("chat", F.lit(1))["content"].alias("reply"),
    )


@query(
    "fields_by_mode",
    "PRJ-09",
    sql=f"""WITH m AS (SELECT doc_id, {_MODE} AS mode, lang, source FROM documents)
SELECT doc_id, mode, CASE WHEN mode NOT IN ('sft', 'cross_lingual') THEN lang END AS prompt_text,
CASE WHEN mode <> 'instruct2' THEN source END AS llm_embedding FROM m""",
)
def fields_by_mode(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", _mode().alias("mode"), F.col("lang").alias("prompt_text"), F.col("source").alias("llm_embedding")
    )
    return mode_fields(docs)


@query(
    "item_identities",
    "PRJ-10",
    sql="""SELECT p_partkey, item_json, sha256(item_json) AS item_sha256 FROM (SELECT p_partkey,
'{"p_brand":"' || p_brand || '","p_partkey":' || p_partkey || ',"p_size":' || p_size || '}' AS item_json FROM part)""",
)
def item_identities(spark, folder):
    parts = with_item_identity(table(spark, folder, "part"), ["p_partkey", "p_size", "p_brand"])
    return parts.select("p_partkey", "item_json", "item_sha256")


@query(
    "log_safe_texts",
    "PRJ-11",
    sql=r"""WITH t AS (SELECT doc_id, regexp_replace(replace(text, chr(10), ' '), '^\s+|\s+$', '', 'g') AS line,
rtrim(trim(regexp_replace(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '[^0-9a-zA-Zа-яА-ЯёЁ]+', '_', 'g'), '_')[1:48], '_') AS slug FROM documents)
SELECT doc_id, CASE WHEN length(line) > 300 THEN line[1:300] || '... [truncated]' ELSE line END AS log_text,
CASE WHEN slug = '' THEN 'empty' ELSE slug END AS slug FROM t""",
)
def log_safe_texts(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select("doc_id", log_text(text).alias("log_text"), slug(text).alias("slug"))


@query(
    "request_outcomes",
    "PRJ-12",
    sql="""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'error' ELSE 'ok' END AS status, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def request_outcomes(spark, folder):
    results = table(spark, folder, "labels").select("doc_id", "quality", F.lit("ok").alias("status"))
    return outcome_records(table(spark, folder, "documents").select("doc_id"), results, "doc_id")
