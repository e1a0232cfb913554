"""Text normalisation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.base import WORDS_SQL, query, table, texts
from voxframe.functions.text import (
    ASCII_PUNCTUATION,
    PROMPT_MARKER,
    PROMPT_PREFIX,
    WIDE_PUNCTUATION,
    NormalizerRegistry,
    asr_normal_form,
    ensure_prompt_prefix,
    frontend_sentences,
    joined_characters,
    meeting_normal_form,
    redact_json,
    redact_map,
    remove_brackets,
    remove_loose_blanks,
    remove_punctuation,
    replace_corner_marks,
    restore_yo,
    rewrite_digit_runs,
    split_sentences,
    strip_markers,
    strip_prompt_prefix,
    strip_prompt_quotes,
    token_ids,
    token_string,
    words,
)

DIGIT_NAMES = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]


def spell_digits(run: str) -> str:
    """Digit by digit, the simplest speller a caller could supply."""
    return "-".join(DIGIT_NAMES[int(d)] for d in run)


@query(
    "asr_normal_forms",
    "STR-01",
    sql=rf"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(replace(lower(nfc_normalize(text)), 'ё', 'е'), '[\p{{P}}_]', ' ', 'g'), '\s+', ' ', 'g'))) AS normal_md5 FROM documents""",
)
def asr_normal_forms(spark, folder):
    return texts(spark, folder).select("doc_id", F.md5(asr_normal_form(F.col("text"))).alias("normal_md5"))


_PUNCTUATION = (WIDE_PUNCTUATION + ASCII_PUNCTUATION).replace("'", "")


def _drop(column: str) -> str:
    return f"translate({column}, '{_PUNCTUATION}', '')"


_TAGGED = "CASE WHEN lang = 'de' THEN '<sil>' || text || '<%>Ａｂ、' ELSE text END"
_UNTAGGED = "replace(translate(replace(t, '<sil>', ''), ' ' || chr(160), ''), '<%>', '')"


@query(
    "meeting_normal_forms",
    "STR-02",
    sql=f"""WITH t AS (SELECT doc_id, {_TAGGED} AS t FROM documents), u AS (SELECT doc_id, translate({_UNTAGGED}, '`&,', '') AS t FROM t),
v AS (SELECT doc_id, translate(CASE WHEN regexp_matches(t, '[a-zA-Z]') THEN upper(replace(t, 'ß', 'SS')) ELSE t END, 'Ａａｂｃｋｔ', 'AABCKT') AS t FROM u)
SELECT doc_id, md5({_drop("t")}) AS normal_md5 FROM v""",
)
def meeting_normal_forms(spark, folder):
    text = F.when(F.col("lang") == "de", F.concat(F.lit("<sil>"), "text", F.lit("<%>Ａｂ、"))).otherwise(F.col("text"))
    return texts(spark, folder).select("doc_id", F.md5(meeting_normal_form(text)).alias("normal_md5"))


@query("texts_without_punctuation", "STR-03", sql=f"SELECT doc_id, md5({_drop('text')}) AS text_md5 FROM documents")
def texts_without_punctuation(spark, folder):
    return texts(spark, folder).select("doc_id", F.md5(remove_punctuation(F.col("text"))).alias("text_md5"))


@query(
    "symbols_replaced",
    "STR-04",
    sql="""SELECT doc_id, md5(replace(translate(replace(replace(t, '²', '平方'), '³', '立方'), '（）【】`', ''), '——', ' ')) AS text_md5
FROM (SELECT doc_id, 'm²（' || text || '）——【x】³`' AS t FROM documents)""",
)
def symbols_replaced(spark, folder):
    text = F.concat(F.lit("m²（"), "text", F.lit("）——【x】³`"))
    return texts(spark, folder).select("doc_id", F.md5(remove_brackets(replace_corner_marks(text))).alias("text_md5"))


_KEEP = r"'([\x00-\x1f\x21-\x7f]) ([\x00-\x1f\x21-\x7f])'"


@query(
    "loose_blanks_removed",
    "STR-05",
    sql=rf"""SELECT doc_id, md5(replace(replace(regexp_replace(regexp_replace(text, {_KEEP}, '\1' || chr(57344) || '\2', 'g'), {_KEEP}, '\1' || chr(57344) || '\2', 'g'), ' ', ''), chr(57344), ' ')) AS text_md5 FROM documents""",
)
def loose_blanks_removed(spark, folder):
    return texts(spark, folder).select("doc_id", F.md5(remove_loose_blanks(F.col("text"))).alias("text_md5"))


def _spelled_sql(column: str) -> str:
    out = rf"regexp_replace(regexp_replace({column}, '([0-9])([0-9])', '\1-\2', 'g'), '([0-9])([0-9])', '\1-\2', 'g')"
    for digit, name in enumerate(DIGIT_NAMES):
        out = f"replace({out}, '{digit}', '{name}')"
    return out


@query("digit_runs_spelled", "STR-06", sql=f"SELECT doc_id, md5({_spelled_sql('text')}) AS text_md5 FROM documents")
def digit_runs_spelled(spark, folder):
    return texts(spark, folder).select("doc_id", F.md5(rewrite_digit_runs(F.col("text"), spell_digits)).alias("text_md5"))


@query(
    "markers_stripped",
    "STR-07",
    sql="SELECT doc_id, md5(replace(replace(text, 'the', ''), 'que', '')) AS text_md5, replace(replace('[FIL]' || source || '[SPK]', '[FIL]', ''), '[SPK]', '') AS source FROM documents",
)
def markers_stripped(spark, folder):
    marked = F.concat(F.lit("[FIL]"), "source", F.lit("[SPK]"))
    return texts(spark, folder).select(
        "doc_id", F.md5(strip_markers(F.col("text"), ["the", "que"])).alias("text_md5"), strip_markers(marked).alias("source")
    )


@query(
    "prompt_quotes_stripped",
    "STR-08",
    sql="SELECT page_id, md5(translate(html, '\"()“”‘（）''', '')) AS html_md5 FROM pages",
)
def prompt_quotes_stripped(spark, folder):
    return table(spark, folder, "pages").select("page_id", F.md5(strip_prompt_quotes(F.col("html"))).alias("html_md5"))


@query(
    "yo_restored",
    "STR-09",
    sql="""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Счёт по счёту, ' || source WHEN 1 THEN 'РЕБЁНОК счета: ребёнок ' || source
WHEN 2 THEN 'счёт-счёт ' || source ELSE 'пересчет ' || source END AS text FROM documents""",
)
def yo_restored(spark, folder):
    n = F.col("doc_id") % 4
    text = (
        F.when(n == 0, F.lit("Счет по счету, "))
        .when(n == 1, F.lit("РЕБЕНОК счета: ребенок "))
        .when(n == 2, F.lit("счет-сЧет "))
        .otherwise(F.lit("пересчет "))
    )
    return texts(spark, folder).select("doc_id", restore_yo(F.concat(text, "source")).alias("text"))


def _count_sql(text: str) -> str:
    return rf"len(list_filter(string_split_regex({text}, '\s+'), lambda w: w <> ''))"


_FLUSH = f"{_count_sql('cur || ps[k + 1]')} > 80 AND {_count_sql('cur')} > 60"
# Sentences in SQL: pieces end at a stop, and a recursive walk joins them greedily.
SENTENCES_SQL = rf"""t AS (SELECT doc_id, {_spelled_sql(r"regexp_replace(text, '^\s+|\s+$', '', 'g')")} AS t FROM documents),
c AS (SELECT doc_id, CASE WHEN right(t, 1) IN ('.', '?', '!', ';', ':') THEN t ELSE t || '.' END AS t FROM t),
p AS (SELECT doc_id, regexp_extract_all(t, '[^.?!;:]+[.?!;:]["”]?') AS ps FROM c),
g AS (SELECT doc_id, ps, 1 AS k, ps[1] AS cur, NULL::VARCHAR AS done FROM p
 UNION ALL SELECT doc_id, ps, k + 1, CASE WHEN {_FLUSH} THEN ps[k + 1] ELSE cur || ps[k + 1] END, CASE WHEN {_FLUSH} THEN cur END FROM g WHERE k < len(ps)),
d AS (SELECT doc_id, list(done ORDER BY k) FILTER (done IS NOT NULL) AS ds FROM g GROUP BY 1),
s AS (SELECT doc_id, CASE WHEN ds IS NULL THEN [cur] WHEN {_count_sql('cur')} < 20 THEN ds[:-2] || [ds[-1] || cur] ELSE ds || [cur] END AS ss
 FROM g JOIN d USING (doc_id) WHERE k = len(ps)),
kept AS (SELECT doc_id, list_filter(ss, lambda x: NOT regexp_full_match(x, '[\p{{P}}\p{{S}}]*')) AS ss FROM s)"""


@query(
    "frontend_sentence_rows",
    "STR-10",
    "UDT-01",
    sql=f"""WITH RECURSIVE {SENTENCES_SQL} SELECT doc_id, (i - 1)::INTEGER AS position, md5(ss[i]) AS sentence_md5
FROM (SELECT doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM kept)""",
)
def frontend_sentence_rows(spark, folder):
    docs = texts(spark, folder)
    pieces = docs.select("doc_id", F.posexplode(frontend_sentences(F.col("text"), spell_digits)).alias("position", "sentence"))
    return pieces.select("doc_id", "position", F.md5("sentence").alias("sentence_md5"))


@query(
    "sentence_concatenation",
    "UDT-01",
    sql=r"""WITH c AS (SELECT doc_id, CASE WHEN right(text, 1) IN ('.', '?', '!', ';', ':') THEN text ELSE text || '.' END AS t FROM documents)
SELECT doc_id, md5(regexp_replace(t, '[.?!;: ]|["”]', '', 'g')) AS joined_md5 FROM c""",
)
def sentence_concatenation(spark, folder):
    """Joined again, the sentences give the text back, except for stops without words before them."""
    docs = texts(spark, folder)
    joined = F.array_join(split_sentences(F.col("text"), F.lit(False)), "")
    return docs.select("doc_id", F.md5(F.regexp_replace(joined, '[.?!;: ]|["”]', "")).alias("joined_md5"))


@query(
    "routed_normal_forms",
    "STR-11",
    sql=f"""SELECT doc_id, md5(CASE lang WHEN 'de' THEN {_drop("replace(text, 'ß', 'ss')")} WHEN 'en' THEN lower(text) ELSE text END) AS text_md5 FROM documents""",
)
def routed_normal_forms(spark, folder):
    registry = (
        NormalizerRegistry()
        .register("de", lambda c: F.replace(c, F.lit("ß"), F.lit("ss")))
        .register("de", remove_punctuation)
        .register("en", F.lower)
    )
    return texts(spark, folder).select("doc_id", F.md5(registry.apply(F.col("text"), F.col("lang"))).alias("text_md5"))


_P, _M = PROMPT_PREFIX, PROMPT_MARKER
_PREFIXED = f"CASE doc_id % 4 WHEN 0 THEN '{_P}' || source WHEN 1 THEN source || '{_P}' || lang WHEN 2 THEN source || '{_M}' || lang ELSE source END"


@query(
    "prompt_prefixes",
    "STR-12",
    sql=f"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '{_P}' || source WHEN 1 THEN '{_P}' || source || lang WHEN 2 THEN source || '{_M}' || lang ELSE '{_P}' || source END AS ensured,
CASE doc_id % 4 WHEN 0 THEN source WHEN 1 THEN lang WHEN 2 THEN lang ELSE source END AS stripped FROM documents""",
)
def prompt_prefixes(spark, folder):
    n = F.col("doc_id") % 4
    text = (
        F.when(n == 0, F.concat(F.lit(_P), "source"))
        .when(n == 1, F.concat("source", F.lit(_P), "lang"))
        .when(n == 2, F.concat("source", F.lit(_M), "lang"))
        .otherwise(F.col("source"))
    )
    return texts(spark, folder).select(
        "doc_id", ensure_prompt_prefix(text).alias("ensured"), strip_prompt_prefix(text).alias("stripped")
    )


@query(
    "speech_token_strings",
    "STR-13",
    sql=f"""SELECT conv_id, turn, md5(array_to_string(list_transform({WORDS_SQL}, lambda w: '<|s_' || length(w) || '|>'), '')) AS tokens_md5 FROM conversations""",
)
def speech_token_strings(spark, folder):
    tokens = F.transform(words(F.col("text")), lambda w: F.char_length(w))
    return texts(spark, folder, "conversations", "conv_id").select("conv_id", "turn", F.md5(token_string(tokens)).alias("tokens_md5"))


@query(
    "speech_token_ids",
    "STR-14",
    sql=r"""WITH n AS (SELECT conv_id, turn, list_transform(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''), lambda w: length(w) * 500) AS ids FROM conversations),
c AS (SELECT *, CASE WHEN list_position(ids, 6500) IS NULL OR list_position(ids, 6500) = 0 THEN ids ELSE ids[1:list_position(ids, 6500) - 1] END AS head FROM n)
SELECT conv_id, turn, array_to_string(list_filter(head, lambda i: i < 6000), ',') AS ids FROM c""",
)
def speech_token_ids(spark, folder):
    """Token strings with an end id (13-letter words) and ids beyond the vocabulary (12 letters and up)."""
    tokens = F.transform(words(F.col("text")), lambda w: F.char_length(w) * 500)
    text = F.concat(token_string(tokens), F.lit("<|eos1|><|s_1|>"))
    ids = token_ids(text, 6000, 6500)
    return texts(spark, folder, "conversations", "conv_id").select(
        "conv_id", "turn", F.array_join(F.transform(ids, lambda i: i.cast("string")), ",").alias("ids")
    )


@query(
    "redacted_documents",
    "STR-16",
    sql="""SELECT event_id, '{"userId":' || user_id || ',"apiKey":"[REDACTED]","nested":{"access_token":"[REDACTED]","k":' || CAST(props->>'k' AS INTEGER) || ',"keys":["[x]"]},"keyCount":' || user_id || '}' AS redacted,
'[REDACTED]' AS map_key, event_type AS map_other FROM events""",
)
def redacted_documents(spark, folder):
    """Events as nested documents with secret-looking keys; numbers and plural keys stay."""
    nested = F.struct(
        F.array(F.col("event_type")).alias("access_token"), F.get_json_object("props", "$.k").cast("int").alias("k"), F.array(F.lit("[x]")).alias("keys")
    )
    document = F.to_json(F.struct(F.col("user_id").alias("userId"), F.col("event_type").alias("apiKey"), nested.alias("nested"), F.col("user_id").alias("keyCount")))
    flat = redact_map(F.create_map(F.lit("apiKey"), F.col("event_type"), F.lit("monkey"), F.col("event_type")))
    return table(spark, folder, "events").select(
        "event_id", redact_json(document).alias("redacted"), flat["apiKey"].alias("map_key"), flat["monkey"].alias("map_other")
    )


@query(
    "character_tokens",
    "STR-17",
    sql=f"SELECT conv_id, turn, length(array_to_string({WORDS_SQL}, ''))::INTEGER AS n, md5(array_to_string(string_split(array_to_string({WORDS_SQL}, ''), ''), ' ')) AS characters_md5 FROM conversations",
)
def character_tokens(spark, folder):
    characters = joined_characters(words(F.col("text")))
    return texts(spark, folder, "conversations", "conv_id").select(
        "conv_id", "turn", F.size(characters).alias("n"), F.md5(F.array_join(characters, " ")).alias("characters_md5")
    )
