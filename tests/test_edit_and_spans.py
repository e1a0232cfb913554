import random

import pytest
from pyspark.sql import functions as F

from voxframe.functions import edit
from voxframe.functions.spans import number_span
from voxframe.functions.text import asr_normal_form, words
from voxframe.plans.evaluation import flattened_metrics, metric_summary, with_row_scores


def table_path(ref, hyp):
    """Whole cost table and the walk back, as the definition says."""
    cost = [[i + j if not (i and j) else 0 for j in range(len(hyp) + 1)] for i in range(len(ref) + 1)]
    for i in range(1, len(ref) + 1):
        for j in range(1, len(hyp) + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (ref[i - 1] != hyp[j - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    i, j, ops = len(ref), len(hyp), []
    while i or j:
        if i and j and ref[i - 1] == hyp[j - 1]:
            i, j = i - 1, j - 1
            ops.append(("equal", i, j))
        elif j and cost[i][j] == cost[i][j - 1] + 1:
            j -= 1
            ops.append(("insertion", None, j))
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            ops.append(("deletion", i, None))
        else:
            i, j = i - 1, j - 1
            ops.append(("substitution", i, j))
    return ops[::-1]


@pytest.mark.parametrize("bits", [1 << 28, 9])
def test_path_equals_brute_force(bits, monkeypatch):
    monkeypatch.setattr(edit, "_WHOLE_TABLE_BITS", bits)
    rng = random.Random(5)
    for _ in range(1500):
        ref = [rng.choice("abc") for _ in range(rng.randint(0, 12))]
        hyp = [rng.choice("abc") for _ in range(rng.randint(0, 12))]
        assert list(zip(*edit._path(ref, hyp))) == table_path(ref, hyp)


def test_token_distance_has_no_vocabulary_limit(spark):
    ref = [f"w{i}" for i in range(700)]
    hyp = ref[:300] + ["x"] + ref[350:] + ["y", "z"]
    row = spark.createDataFrame([(ref, hyp)], "r array<string>, h array<string>")
    got = row.select(edit.token_distance(F.col("r"), F.col("h")).alias("d"), edit.edit_counts("r", "h").alias("c")).first()
    assert got["d"] == 52 == sum(got["c"][k] for k in ("substitutions", "deletions", "insertions"))


SPANS = [
    ("Ставка 12,5 процента", "12,5", "ставка двенадцать целых пять десятых процента", (1, 5), None),
    ("Нужно 3-5 дней", "3-5", "нужно от трех до пяти дней", (1, 5), None),
    ("Код 1111 принят", "1111", "код один один один один принят", (1, 5), None),
    ("Это 21-е место", "21-е", "это двадцать первое место", (1, 3), None),
    ("25 рублей", "25", "двадцать пять рублей", (0, 2), None),
    ("Цена 25", "25", "цена двадцать пять", (1, 3), None),
    ("да 25 да", "25", "да двадцать пять да да", None, "ambiguous number span"),
    ("нет числа", "25", "нет двадцать пять числа", None, "hard number is absent from raw text"),
    ("слово 25", "много", "слово двадцать пять", None, "hard number contains no digit groups"),
    (None, "25", "двадцать пять", None, "missing required string: text"),
    ("а 25 б", "25", "в двадцать пять г", (0, 4), None),
    ("а х 25 б", "25", "а у двадцать пять б", (1, 4), None),
    ("раз 25 два 25 три", "25", "раз двадцать пять два двадцать пять три", (1, 6), None),
    ("а 25 б", "25", "а б", None, "unanchorable number span"),
]


def test_number_spans(spark):
    rows = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(SPANS)], "i int, t string, n string, g string")
    found = rows.select("i", number_span(F.col("t"), F.col("n"), F.col("g")).alias("s")).orderBy("i").collect()
    for row, (_, _, _, span, error) in zip(found, SPANS):
        got = row["s"]
        assert got["error"] == error, row
        assert (got["start"], got["end"]) == (span or (None, None)), row


def scored(spark, rows):
    df = spark.createDataFrame(rows, "category string, r string, h string, start int, end int")
    tokens = lambda c: words(asr_normal_form(F.col(c)))
    return with_row_scores(df.withColumn("ref", tokens("r")).withColumn("hyp", tokens("h")), "ref", "hyp")


def test_row_score_example(spark):
    row = scored(spark, [("c", "сумма двадцать пять рублей", "Сумма тридцать рублей сегодня", 1, 3)]).first()["scores"]
    assert sum(row["utterance"]["word"][k] for k in ("substitutions", "deletions", "insertions")) == 3
    number = row["number"]["word"]
    assert (number["substitutions"], number["deletions"], number["insertions"]) == (1, 1, 0)


def test_micro_and_macro(spark):
    rows = [("a", "x два пять y", "x два пять y", 1, 3), ("b", "x пять y", "x шесть y", 1, 2)]
    values = {r["name"]: r["value"] for r in flattened_metrics(metric_summary(scored(spark, rows))).collect()}
    assert values["num-wer"] == pytest.approx(1 / 3) and values["macro-num-wer"] == 0.5
    assert values["category/b/num-wer"] == 1.0 and values["category/a/utt-cer"] == 0.0


def test_span_outside_reference_stops(spark):
    with pytest.raises(Exception, match="number span is outside"):
        scored(spark, [("c", "a b", "a", 1, 3)]).select("scores").collect()


def test_alignment_makes_few_rows_at_a_time(monkeypatch):
    import pyarrow as pa

    random.seed(3)
    pairs = [[[random.choice("abc") for _ in range(random.randint(0, 9))] for _ in range(2)] for _ in range(40)] + [[[], []]]
    monkeypatch.setattr(edit, "_TOKENS_AT_ONCE", 10)
    columns = [pa.array(side, pa.list_(pa.string())) for side in zip(*pairs)]
    found = edit._rows(columns, edit._path, edit.ALIGNMENT).to_pylist()
    assert [(r["op"], r["ref_at"], r["hyp_at"]) for r in found] == [edit._path(r, h) for r, h in pairs]
    assert len(edit._rows([c.slice(0, 0) for c in columns], edit._counts, edit.COUNTS)) == 0
