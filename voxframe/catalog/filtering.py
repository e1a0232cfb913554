"""Predicates over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.base import PLAN_SQL, WORDS_SQL, query, table, texts, utterance_rows
from voxframe.functions.text import has_cjk, has_markup, has_stress_marks, language_code, language_name, only_punctuation, whitespace_token_count
from voxframe.operators.filters import (
    capped,
    length_drop_reason,
    pcm_issue,
    rate_acceptable,
    rejection_sampling_usable,
    reservable,
    route_issue,
    shorter_than_prompt,
    tokens_unless_long,
    training_row_issue,
)
from voxframe.plans.split import split_plan, with_text_limits

_REASON = f"""CASE WHEN n_chars < 100 THEN 'frames<min' WHEN n_chars > 10240 THEN 'frames>max'
 WHEN tokens < 1 THEN 'tokens<min' WHEN tokens > 1000 THEN 'tokens>max' WHEN quality = 0 THEN 'no speech tokens'
 WHEN n_chars <> 0 AND tokens / n_chars::DOUBLE < 0.12 THEN 'ratio<min' WHEN n_chars <> 0 AND tokens / n_chars::DOUBLE > 0.17 THEN 'ratio>max' END"""
_COUNTED = f"""counted AS (SELECT d.doc_id, d.n_chars, len({WORDS_SQL}) AS tokens, coalesce(l.quality, 1) AS quality
 FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def _reasons(spark, folder):
    docs = texts(spark, folder).join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "left")
    reason = length_drop_reason(
        F.col("n_chars"),
        whitespace_token_count(F.col("text")),
        F.coalesce("quality", F.lit(1)),
        most_frames=10240,
        least_frames=100,
        most_tokens=1000,
        least_ratio=0.12,
        most_ratio=0.17,
    )
    return docs.select("doc_id", reason.alias("reason"))


@query("length_drop_reasons", "FLT-01", sql=f"WITH {_COUNTED} SELECT doc_id, {_REASON} AS reason FROM counted")
def length_drop_reasons(spark, folder):
    return _reasons(spark, folder)


@query("length_filtered_rows", "FLT-01", sql=f"WITH {_COUNTED} SELECT doc_id FROM counted WHERE {_REASON} IS NULL")
def length_filtered_rows(spark, folder):
    return _reasons(spark, folder).where(F.col("reason").isNull()).select("doc_id")


@query(
    "sample_rate_filter",
    "FLT-02",
    sql="SELECT p_partkey, p_size * 1000 AS rate FROM part WHERE p_size * 1000 = 8000 OR p_size * 1000 >= 16000",
)
def sample_rate_filter(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", (F.col("p_size") * 1000).alias("rate"))
    return parts.where(rate_acceptable(F.col("rate"), 8000))


@query(
    "long_audio_tokens",
    "FLT-03",
    sql=f"""SELECT doc_id, CASE WHEN n_chars / 100.0 > 30 THEN 0 ELSE len({WORDS_SQL}) END::INTEGER AS tokens, n_chars / 100.0 < 30 AS usable FROM documents""",
)
def long_audio_tokens(spark, folder):
    from voxframe.functions.injected import whitespace_tokens

    seconds = F.col("n_chars") / 100.0
    kept = tokens_unless_long(whitespace_tokens(F.col("text")), seconds)
    return texts(spark, folder).select(
        "doc_id", F.size(kept).alias("tokens"), rejection_sampling_usable(seconds).alias("usable")
    )


@query(
    "reservable_rows",
    "FLT-04",
    sql=f"WITH {PLAN_SQL} SELECT source_relative_path FROM limited WHERE agreement >= 0.95 AND model_limit_exclusion IS NULL",
)
def reservable_rows(spark, folder):
    rows = with_text_limits(utterance_rows(spark, folder))
    return rows.where(reservable(F.col("agreement"), F.col("model_limit_exclusion"))).select("source_relative_path")


@query(
    "training_rows",
    "FLT-05",
    sql=f"""WITH {PLAN_SQL}, spoiled AS (SELECT *, CASE WHEN n_chars % 11 = 0 THEN 3 - phase ELSE phase END AS given FROM plan)
SELECT source_relative_path, given::INTEGER AS phase,
CASE WHEN given IN (1, 2) THEN CASE WHEN text_token_count < 1 THEN 'text_token_count' WHEN given = 1 AND NOT agreement < 0.95 THEN 'agreement for phase 1'
WHEN given = 2 AND NOT agreement >= 0.95 THEN 'agreement for phase 2' END END AS issue FROM spoiled""",
)
def training_rows(spark, folder):
    plan = split_plan(utterance_rows(spark, folder), reserve=5, strict=False)
    spoiled = plan.withColumn("phase", F.when(F.col("n_chars") % 11 == 0, 3 - F.col("phase")).otherwise(F.col("phase")))
    return spoiled.select("source_relative_path", "phase", training_row_issue(spoiled).alias("issue"))


@query(
    "punctuation_only_tokens",
    "FLT-06",
    sql=rf"""WITH t AS (SELECT unnest({WORDS_SQL}) AS w FROM documents)
SELECT w AS token, count(*) AS rows FROM t WHERE regexp_full_match(w, '[\p{{P}}\p{{S}}]*') GROUP BY 1""",
)
def punctuation_only_tokens(spark, folder):
    from voxframe.functions.text import words

    tokens = texts(spark, folder).select(F.explode(words(F.col("text"))).alias("token"))
    return tokens.where(only_punctuation(F.col("token"))).groupBy("token").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "cjk_texts",
    "FLT-07",
    sql="SELECT doc_id, regexp_matches(CASE WHEN lang = 'de' THEN text || '语' ELSE text END, '[一-鿿]') AS cjk FROM documents",
)
def cjk_texts(spark, folder):
    text = F.when(F.col("lang") == "de", F.concat("text", F.lit("语"))).otherwise(F.col("text"))
    return texts(spark, folder).select("doc_id", has_cjk(text).alias("cjk"))


@query(
    "supported_languages",
    "FLT-08",
    sql="""SELECT doc_id, code, CASE code WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' WHEN 'es' THEN 'Spanish' WHEN 'auto' THEN 'Auto' END AS name
FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN lower(trim(' ' || upper(lang) || ' ')) WHEN 1 THEN 'auto' ELSE 'x' || lang END AS code FROM documents)""",
)
def supported_languages(spark, folder):
    n = F.col("doc_id") % 3
    lang = F.when(n == 0, F.concat(F.lit(" "), F.upper("lang"), F.lit(" "))).when(n == 1, F.lit("")).otherwise(F.concat(F.lit("x"), "lang"))
    code = language_code(lang)
    return texts(spark, folder).select("doc_id", code.alias("code"), language_name(code).alias("name"))


@query(
    "short_pcm_outputs",
    "FLT-09",
    sql="""SELECT o_orderkey, CASE WHEN (o_custkey * 100 + o_orderkey) % 2 <> 0 THEN 'odd byte count'
WHEN o_custkey * 100 + o_orderkey < trunc(greatest(0.05, (o_orderkey % 90) / 25.0::DOUBLE * 0.5) * 24000 * 2) THEN 'too little audio' END AS issue FROM orders""",
)
def short_pcm_outputs(spark, folder):
    issue = pcm_issue(F.col("o_custkey") * 100 + F.col("o_orderkey"), F.col("o_orderkey") % 90, 24000)
    return table(spark, folder, "orders").select("o_orderkey", issue.alias("issue"))


@query(
    "texts_shorter_than_prompt",
    "FLT-10",
    sql="SELECT conv_id, turn, length(text) < 0.5 * length(prev) AS short FROM (SELECT a.conv_id, a.turn, a.text, b.text AS prev FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1)",
)
def texts_shorter_than_prompt(spark, folder):
    turns = texts(spark, folder, "conversations", "conv_id").select("conv_id", "turn", "text")
    prompts = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt"))
    return turns.join(prompts, ["conv_id", "turn"]).select(
        "conv_id", "turn", shorter_than_prompt(F.col("text"), F.col("prompt")).alias("short")
    )


@query(
    "stress_and_markup",
    "FLT-11",
    sql="""SELECT doc_id, contains(t, chr(769)) OR regexp_matches(t, '\\+[АЕЁИОУЫЭЮЯаеёиоуыэюя]') AS stressed, contains(t, '<|') AND contains(t, '|>') AS markup
FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text || '+о' WHEN 1 THEN text || chr(769) WHEN 2 THEN '<|x|>' || text ELSE text || '+o' END AS t FROM documents)""".replace("\\\\", "\\"),
)
def stress_and_markup(spark, folder):
    n = F.col("doc_id") % 4
    text = (
        F.when(n == 0, F.concat("text", F.lit("+о")))
        .when(n == 1, F.concat("text", F.lit("́")))
        .when(n == 2, F.concat(F.lit("<|x|>"), "text"))
        .otherwise(F.concat("text", F.lit("+o")))
    )
    return texts(spark, folder).select(
        "doc_id", has_stress_marks(text).alias("stressed"), has_markup(text).alias("markup")
    )


@query(
    "route_issues",
    "FLT-12",
    sql=f"""WITH {PLAN_SQL}, spoiled AS (SELECT source_relative_path, agreement, reserved,
 CASE n_chars % 5 WHEN 0 THEN 1 WHEN 1 THEN 7 ELSE phase END AS phase FROM plan)
SELECT source_relative_path, CASE WHEN reserved AND phase IS NOT NULL THEN 'reserved row has a phase'
WHEN phase NOT IN (1, 2) THEN 'unknown phase' WHEN phase IS NOT NULL AND agreement IS NULL THEN 'phase without agreement' END AS issue FROM spoiled""",
)
def route_issues(spark, folder):
    plan = split_plan(utterance_rows(spark, folder), reserve=5, strict=False)
    n = F.col("n_chars") % 5
    phase = F.when(n == 0, 1).when(n == 1, 7).otherwise(F.col("phase"))
    return plan.select("source_relative_path", route_issue(phase, F.col("reserved"), F.col("agreement")).alias("issue"))


@query("capped_rows", "FLT-13", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def capped_rows(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return capped(orders, 50, F.desc("o_totalprice"), F.asc("o_orderkey"))
