"""Edit-distance, alignment and number-span queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.aggregating import DISTANCE_SQL
from voxframe.catalog.base import TURNS_SQL, WORDS_SQL, query, texts, turn_pairs
from voxframe.functions.edit import distance, text_distance, token_distance
from voxframe.functions.spans import number_span
from voxframe.functions.text import words
from voxframe.operators.aggregates import confusion_counts, corpus_error_line, per_word_stats
from voxframe.plans.evaluation import (
    aligned_rows,
    error_segments,
    flattened_metrics,
    metric_summary,
    with_edit_counts,
    with_row_scores,
)

# The preferred path in SQL: every cell of the table keeps its cost and its operations.
PATHS_SQL = f"""{TURNS_SQL},
dp AS (
  SELECT conv_id, turn, category, r, h, 0 AS i, list_transform(range(0, len(h) + 1), lambda j: {{'c': j, 'o': repeat('I', j)}}) AS cells FROM turns
  UNION ALL
  SELECT conv_id, turn, category, r, h, i + 1,
    list_reduce(range(1, len(h) + 1), lambda acc, j: list_append(acc,
      CASE WHEN r[i + 1] = h[j] THEN {{'c': cells[j].c, 'o': cells[j].o || 'E'}}
           WHEN acc[-1].c <= least(cells[j + 1].c, cells[j].c) THEN {{'c': acc[-1].c + 1, 'o': acc[-1].o || 'I'}}
           WHEN cells[j + 1].c <= cells[j].c THEN {{'c': cells[j + 1].c + 1, 'o': cells[j + 1].o || 'D'}}
           ELSE {{'c': cells[j].c + 1, 'o': cells[j].o || 'S'}} END), [{{'c': cells[1].c + 1, 'o': cells[1].o || 'D'}}])
  FROM dp WHERE i < len(r)),
paths AS (SELECT conv_id, turn, category, r, h, cells[-1].o AS ops FROM dp WHERE i = len(r)),
steps AS (SELECT *, unnest(range(0, length(ops))) AS pos FROM paths),
aligned AS (
  SELECT conv_id, turn, category, pos, CASE ops[pos + 1] WHEN 'E' THEN 'equal' WHEN 'I' THEN 'insertion' WHEN 'D' THEN 'deletion' ELSE 'substitution' END AS op,
    CASE WHEN ops[pos + 1] <> 'I' THEN r[pos + 1 - (length(ops[1:pos]) - length(replace(ops[1:pos], 'I', '')))] END AS ref,
    CASE WHEN ops[pos + 1] <> 'D' THEN h[pos + 1 - (length(ops[1:pos]) - length(replace(ops[1:pos], 'D', '')))] END AS hyp
  FROM steps)"""


# The same path's counts only: cost, substitutions, deletions and insertions packed into one number per cell.
COUNTS_SQL = f"""{TURNS_SQL},
dp AS (
  SELECT conv_id, turn, r, h, 0 AS i, list_transform(range(0, len(h) + 1), lambda j: (j << 30) + j) AS cells FROM turns
  UNION ALL
  SELECT conv_id, turn, r, h, i + 1,
    list_reduce(range(1, len(h) + 1), lambda acc, j: list_append(acc,
      CASE WHEN r[i + 1] = h[j] THEN cells[j]
           WHEN acc[-1] >> 30 <= least(cells[j + 1] >> 30, cells[j] >> 30) THEN acc[-1] + (1 << 30) + 1
           WHEN cells[j + 1] >> 30 <= cells[j] >> 30 THEN cells[j + 1] + (1 << 30) + 1024
           ELSE cells[j] + (1 << 30) + 1048576 END), [cells[1] + (1 << 30) + 1024])
  FROM dp WHERE i < len(r)),
counts AS (
  SELECT conv_id, turn, ((cells[-1] >> 20) & 1023)::INTEGER AS substitutions, ((cells[-1] >> 10) & 1023)::INTEGER AS deletions,
    (cells[-1] & 1023)::INTEGER AS insertions, len(r)::INTEGER AS reference_units
  FROM dp WHERE i = len(r))"""


@query("word_edit_counts", "EDT-01", sql=f"WITH RECURSIVE {COUNTS_SQL} SELECT * FROM counts")
def word_edit_counts(spark, folder):
    return with_edit_counts(turn_pairs(spark, folder), "ref", "hyp").drop("category", "ref", "hyp")


def _coded(side: str) -> str:
    """Characters as single bytes numbered within the pair, so that the byte distance is the character distance."""
    characters = f"string_split(array_to_string({side}, ''), '')"
    return f"coalesce(array_to_string(list_transform({characters}, lambda c: chr((list_position(v, c) + 32)::INTEGER)), ''), '')"


_CODED = """coded AS (SELECT *, list_distinct(string_split(array_to_string(r, '') || array_to_string(h, ''), '')) AS v FROM turns)"""


@query(
    "character_distances",
    "EDT-01",
    sql=f"""WITH {TURNS_SQL}, {_CODED} SELECT conv_id, turn, levenshtein({_coded('r')}, {_coded('h')})::INTEGER AS distance FROM coded""",
)
def character_distances(spark, folder):
    pairs = turn_pairs(spark, folder)
    joined = lambda c: F.array_join(c, "")
    return pairs.select("conv_id", "turn", text_distance(joined("ref"), joined("hyp")).alias("distance"))


@query(
    "word_distances",
    "EDT-01",
    sql=f"WITH RECURSIVE {DISTANCE_SQL} SELECT conv_id, turn, errors::INTEGER AS distance FROM distances",
)
def word_distances(spark, folder):
    pairs = turn_pairs(spark, folder)
    return pairs.select("conv_id", "turn", token_distance(F.col("ref"), F.col("hyp")).alias("distance"))


def _aligned(spark, folder):
    return aligned_rows(turn_pairs(spark, folder), ["conv_id", "turn"], "ref", "hyp")


@query(
    "alignment_rows",
    "EDT-02",
    "UDT-02",
    sql=f"WITH RECURSIVE {PATHS_SQL} SELECT conv_id, turn, pos::INTEGER AS pos, op, ref, hyp FROM aligned",
)
def alignment_rows(spark, folder):
    return _aligned(spark, folder)


@query(
    "corpus_error_totals",
    "AGG-12",
    sql=f"""WITH RECURSIVE {COUNTS_SQL}, c AS (SELECT sum(insertions)::BIGINT AS insertions, sum(deletions)::BIGINT AS deletions, sum(substitutions)::BIGINT AS substitutions,
sum(reference_units)::BIGINT AS reference_units, sum(reference_units - deletions - substitutions)::BIGINT AS correct FROM counts)
SELECT *, round(100.0 * (insertions + deletions + substitutions) / reference_units, 2) AS rate_percent FROM c""",
)
def corpus_error_totals(spark, folder):
    return corpus_error_line(with_edit_counts(turn_pairs(spark, folder), "ref", "hyp"))


@query(
    "confusion_tables",
    "AGG-13",
    sql=f"WITH RECURSIVE {PATHS_SQL} SELECT op, ref, hyp, count(*) AS count FROM aligned WHERE op <> 'equal' GROUP BY 1, 2, 3",
)
def confusion_tables(spark, folder):
    return confusion_counts(_aligned(spark, folder))


@query(
    "word_statistics",
    "AGG-14",
    sql=f"""WITH RECURSIVE {PATHS_SQL}, w AS (SELECT ref AS word, 'r' AS side, op FROM aligned WHERE ref IS NOT NULL UNION ALL SELECT hyp, 'h', op FROM aligned WHERE hyp IS NOT NULL)
SELECT word, count(*) FILTER (side = 'r' AND op = 'equal') AS correct, count(*) FILTER (op <> 'equal') AS errors, count(*) FILTER (side = 'r') AS ref_count, count(*) FILTER (side = 'h') AS hyp_count FROM w GROUP BY 1""",
)
def word_statistics(spark, folder):
    return per_word_stats(_aligned(spark, folder))


@query(
    "merged_error_segments",
    "WIN-16",
    sql=f"""WITH RECURSIVE {PATHS_SQL}, o AS (SELECT *, CASE WHEN op = 'equal' OR coalesce(lag(op) OVER w, 'equal') = 'equal' THEN 1 ELSE 0 END AS opens FROM aligned WINDOW w AS (PARTITION BY conv_id, turn ORDER BY pos)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY conv_id, turn ORDER BY pos) AS segment FROM o),
g AS (SELECT conv_id, turn, segment::BIGINT AS segment, bool_or(op <> 'equal') AS is_error, coalesce(string_agg(ref, ' ' ORDER BY pos), '*') AS ref, coalesce(string_agg(hyp, ' ' ORDER BY pos), '*') AS hyp FROM s GROUP BY 1, 2, 3)
SELECT *, CASE WHEN is_error THEN '(' || ref || '->' || hyp || ')' ELSE ref END AS shown FROM g""",
)
def merged_error_segments(spark, folder):
    return error_segments(turn_pairs(spark, folder), ["conv_id", "turn"], "ref", "hyp")


_NORMAL = r"trim(regexp_replace(regexp_replace(replace(lower({0}), 'ё', 'е'), '[\p{{P}}_]', ' ', 'g'), '\s+', ' ', 'g'))"


def _normal_sql(column: str) -> str:
    return _NORMAL.format(column)


_PLACED = f"(SELECT conv_id, turn, {WORDS_SQL} AS w, len({WORDS_SQL}) // 2 AS k FROM conversations)"


def _numbered_sentences(spark, folder):
    """Each turn with a number written in its middle, and with the same number spoken."""
    turns = texts(spark, folder, "conversations", "conv_id").select("conv_id", "turn", words(F.col("text")).alias("w"))
    k = F.floor(F.size("w") / 2).cast("int")
    head, tail = F.slice("w", F.lit(1), k), F.slice("w", k + 1, F.size("w"))
    with_middle = lambda middle: F.array_join(F.concat(head, F.split(F.lit(middle), " "), tail), " ")
    return turns.select("conv_id", "turn", with_middle("90817,263").alias("text"), with_middle("число сто один").alias("gold"))


@query(
    "number_spans",
    "EDT-03",
    sql=f"""WITH p AS (SELECT conv_id, turn, {_normal_sql("array_to_string(w[1:k], ' ')")} AS head FROM {_PLACED})
SELECT conv_id, turn, n::INTEGER AS span_start, (n + 3)::INTEGER AS span_end, NULL::VARCHAR AS error FROM (
SELECT conv_id, turn, CASE WHEN head = '' THEN 0 ELSE len(string_split(head, ' ')) END AS n FROM p)""",
)
def number_spans(spark, folder):
    rows = _numbered_sentences(spark, folder)
    span = rows.select("conv_id", "turn", number_span(F.col("text"), F.lit("90817,263"), F.col("gold")).alias("s"))
    return span.select("conv_id", "turn", F.col("s.start").alias("span_start"), F.col("s.end").alias("span_end"), F.col("s.error").alias("error"))


def _spanned_pairs(spark, folder):
    """Turn pairs with the words after the first third as the span."""
    pairs = turn_pairs(spark, folder).where(F.size("ref") > 0)
    start = F.floor(F.size("ref") / 3).cast("int")
    return pairs.withColumn("start", start).withColumn("end", F.least(start + 3, F.size("ref")))


# First and last hypothesis word aligned to the span, then the words and distances of that region.
_SPAN_SQL = f"""{PATHS_SQL},
spans AS (SELECT conv_id, turn, category, r, h, ops, len(r) // 3 AS a, least(len(r) // 3 + 3, len(r)) AS b FROM paths),
touched AS (
  SELECT conv_id, turn, min(hj) AS first, max(hj) AS last FROM (
    SELECT s.conv_id, s.turn, s.a, s.b, op,
      count(ref) OVER w - 1 AS ri, count(hyp) OVER w - 1 AS hj
    FROM spans s JOIN aligned x ON x.conv_id = s.conv_id AND x.turn = s.turn
    WINDOW w AS (PARTITION BY s.conv_id, s.turn ORDER BY x.pos))
  WHERE op IN ('equal', 'substitution') AND ri >= a AND ri < b GROUP BY 1, 2),
regions AS (
  SELECT s.*, r[a + 1 : b] AS nr, CASE WHEN t.first IS NULL THEN [] ELSE h[t.first + 1 : t.last + 1] END AS nh
  FROM spans s LEFT JOIN touched t USING (conv_id, turn)),
coded AS (SELECT *, list_distinct(string_split(array_to_string(r, '') || array_to_string(h, ''), '')) AS v FROM regions),
number_words AS (
  SELECT conv_id, turn, nr, nh, 0 AS i, range(0, len(nh) + 1) AS costs FROM regions
  UNION ALL
  SELECT conv_id, turn, nr, nh, i + 1, list_reduce(range(1, len(nh) + 1), lambda acc, j: list_append(acc,
    least(acc[-1] + 1, costs[j + 1] + 1, costs[j] + CASE WHEN nr[i + 1] = nh[j] THEN 0 ELSE 1 END)), [costs[1] + 1])
  FROM number_words WHERE i < len(nr)),
scored AS (
  SELECT c.conv_id, c.turn, c.category, length(replace(ops, 'E', '')) AS utt_word, len(r) AS utt_word_units,
    levenshtein({_coded('r')}, {_coded('h')}) AS utt_char, length(array_to_string(r, '')) AS utt_char_units,
    n.costs[-1] AS num_word, len(c.nr) AS num_word_units,
    levenshtein({_coded('c.nr')}, {_coded('c.nh')}) AS num_char, length(array_to_string(c.nr, '')) AS num_char_units
  FROM coded c JOIN number_words n ON n.conv_id = c.conv_id AND n.turn = c.turn AND n.i = len(n.nr))"""


@query(
    "row_score_distances",
    "EDT-04",
    "EDT-05",
    sql=f"""WITH RECURSIVE {_SPAN_SQL} SELECT conv_id, turn, utt_word::INTEGER AS utt_word, utt_char::INTEGER AS utt_char, num_word::INTEGER AS num_word, num_char::INTEGER AS num_char,
num_char_units::INTEGER AS num_char_units FROM scored""",
)
def row_score_distances(spark, folder):
    scored = with_row_scores(_spanned_pairs(spark, folder), "ref", "hyp")
    return scored.select(
        "conv_id",
        "turn",
        distance(F.col("scores.utterance.word")).alias("utt_word"),
        distance(F.col("scores.utterance.character")).alias("utt_char"),
        distance(F.col("scores.number.word")).alias("num_word"),
        distance(F.col("scores.number.character")).alias("num_char"),
        F.col("scores.number.character.reference_units").alias("num_char_units"),
    )


_METRICS = {"utt-wer": "utt_word", "utt-cer": "utt_char", "num-wer": "num_word", "num-cer": "num_char"}
_RATES = ", ".join(
    f"round(sum({c}) / sum({c}_units), 9) AS \"{n}\", round(avg({c} / {c}_units), 9) AS \"macro-{n}\"" for n, c in _METRICS.items()
)
_NAMES = [p + n for n in _METRICS for p in ("", "macro-")]
_PICK = " ".join(f"WHEN '{n}' THEN \"{n}\"" for n in _NAMES)


@query(
    "flattened_score_summary",
    "AGG-09",
    "AGG-10",
    "AGG-11",
    "JSN-02",
    sql=f"""WITH RECURSIVE {_SPAN_SQL}, g AS (SELECT category, grouping(category) AS g, {_RATES} FROM scored GROUP BY GROUPING SETS ((category), ()))
SELECT CASE g WHEN 1 THEN m.name ELSE 'category/' || category || '/' || m.name END AS name, CASE m.name {_PICK} ELSE 0.0 END AS value
FROM g, (SELECT unnest({_NAMES + ['empty-reference-rows']}) AS name) m""",
)
def flattened_score_summary(spark, folder):
    scored = with_row_scores(_spanned_pairs(spark, folder), "ref", "hyp")
    return flattened_metrics(metric_summary(scored)).withColumn("value", F.round("value", 9))


@query(
    "phonetic_token_distances",
    "EDT-06",
    sql="WITH RECURSIVE "
    + DISTANCE_SQL.replace(
        "b.turn = a.turn + 1)",
        "b.turn = a.turn + 1), sounded AS (SELECT conv_id, turn, category, list_transform(r, lambda w: lower(w[1])) AS r, list_transform(h, lambda w: lower(w[1])) AS h FROM turns)",
    ).replace("AS costs FROM turns", "AS costs FROM sounded")
    + " SELECT conv_id, turn, errors::INTEGER AS distance FROM distances",
)
def phonetic_token_distances(spark, folder):
    """Compared on a token column of the caller's: here the first letter of each word."""
    pairs = turn_pairs(spark, folder)
    sound = lambda c: F.transform(c, lambda w: F.lower(F.substring(w, 1, 1)))
    return pairs.select("conv_id", "turn", token_distance(sound("ref"), sound("hyp")).alias("distance"))
