import pytest
from pyspark.sql import functions as F

from voxframe.catalog.wording import spell_digits
from voxframe.functions import text as T


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "t string").select(make(F.col("t")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("Ёлка, и_ЕЩЁ  ёж!", "елка и еще еж"),
        ("ｆｕｌｌ ﬁne", "full fine"),
        ("ёж", "еж"),
        ("  ", ""),
        ("a b c", "a b c"),
    ],
)
def test_asr_normal_form(spark, given, wanted):
    assert one(spark, given, T.asr_normal_form) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [("а b c", "а b c".replace("а ", "а")), ("你 好 a b", "你好a b"), (" x ", "x"), ("a  b", "ab")],
)
def test_loose_blanks(spark, given, wanted):
    assert one(spark, given, T.remove_loose_blanks) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [("Ребенок", "Ребёнок"), ("СЧЕТ", "СЧЁТ"), ("по счету", "по счёту"), ("пересчет счета", "пересчет счета")],
)
def test_yo(spark, given, wanted):
    assert one(spark, given, T.restore_yo) == wanted


def test_prompt_prefix_is_single(spark):
    p = T.PROMPT_PREFIX
    for given, wanted in [("x", p + "x"), (p + "x", p + "x"), ("a" + p + "b", p + "ab"), ("a<|endofprompt|>b", "a<|endofprompt|>b")]:
        assert one(spark, given, T.ensure_prompt_prefix) == wanted
    for given, wanted in [(p + "x", "x"), ("a<|endofprompt|>b<|endofprompt|>c", "c"), ("x", "x")]:
        assert one(spark, given, T.strip_prompt_prefix) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("<|s_7|><|s_8|><|s_9|>", [7, 8, 9]),
        ("<|s_7|> <|s_8|> <|s_9|>", [7, 8, 9]),
        ("<|s_7|><|s_8|><|eos1|><|s_99|>", [7, 8]),
        ("<|s_7|><|s_6562|><|s_8|>", [7]),
        ("<|s_7|><|s_6561|><|s_8|>", [7, 8]),
        ("", []),
    ],
)
def test_token_ids(spark, given, wanted):
    assert one(spark, given, T.token_ids) == wanted


def test_redaction(spark):
    given = '{"apiKey":"x","hf_token":{"a":1},"key":5,"monkey":"ok","deep":[{"clientSecret":["y"]}],"tokens":"ok"}'
    wanted = '{"apiKey":"[REDACTED]","hf_token":"[REDACTED]","key":5,"monkey":"ok","deep":[{"clientSecret":"[REDACTED]"}],"tokens":"ok"}'
    assert one(spark, given, T.redact_json) == wanted


def sentences(spark, text, cjk=False, counter=None):
    return one(spark, text, lambda c: T.split_sentences(c, F.lit(cjk), counter))


@pytest.mark.parametrize("counter", [None, lambda s: len(s.split())])
def test_sentences_join_and_merge(spark, counter):
    length = lambda s: len(s.split())
    piece = " ".join(["w"] * 30) + ". "
    text = (piece * 5).strip()
    made = sentences(spark, text, counter=counter)
    assert [length(s) for s in made] == [90, 60] and "".join(made) == text
    assert [length(s) for s in sentences(spark, text + " " + "x " * 10 + ".", counter=counter)] == [90, 71]
    assert sentences(spark, "a b", counter=counter) == ["a b."]
    assert sentences(spark, "", counter=counter) == [] and sentences(spark, "?!", counter=counter) == []
    assert sentences(spark, '."a. b.."c', counter=counter) == ['a. b."c.']
    assert sentences(spark, 'He said "go." Then left', counter=counter) == ['He said "go." Then left.']
    assert sentences(spark, "你好。“好！”再见", True, counter) == ["你好。“好！”再见。"]
    long = "一二三四五六七八九十" * 7 + "。"
    assert sentences(spark, long + long + "短。", True, counter) == [long, long + "短。"]


def test_frontend_routes(spark):
    sentences = lambda c: T.frontend_sentences(c, spell_digits)
    assert one(spark, "You have 12 left", sentences) == ["You have one-two left."]
    assert one(spark, "面积 3 m²， ", sentences) == ["面积3 m平方。"]
    assert one(spark, "<|x|> 12", sentences) == ["<|x|> 12"]
    assert one(spark, "...", sentences) == []


def test_log_text_and_slug(spark):
    assert one(spark, " a\nb ", T.log_text) == "a b"
    assert one(spark, "x" * 301, T.log_text) == "x" * 300 + "... [truncated]"
    assert one(spark, "?!", T.slug) == "empty"
    assert one(spark, "  Привет, Мир_42!", T.slug) == "привет_мир_42"


def test_only_punctuation(spark):
    assert one(spark, "", T.only_punctuation) and one(spark, "…+", T.only_punctuation)
    assert not one(spark, ".\n", T.only_punctuation) and not one(spark, ".a", T.only_punctuation)


def test_long_runs_of_blanks_take_no_time(spark):
    import time

    text = "x" + " " * 300_000 + "y"
    begun = time.time()
    assert one(spark, text, T.log_text) == "x" + " " * 299 + "... [truncated]" and one(spark, text, T.slug) == "x_y"
    assert one(spark, f" {text}.", lambda c: T.frontend_sentences(c, spell_digits)) == [f"{text}."]
    assert time.time() - begun < 20


@pytest.mark.parametrize("tail", ["", " ", " \n", "z", " z"])
@pytest.mark.parametrize("size", [299, 300, 301])
def test_only_what_is_cut_is_marked(spark, size, tail):
    line = ("\n " + "a" * size + tail).replace("\n", " ").strip()
    assert one(spark, "\n " + "a" * size + tail, T.log_text) == (line if len(line) <= 300 else line[:300] + "... [truncated]")


def test_slug_takes_the_first_letters(spark):
    assert one(spark, "--" + "a!" * 60 + "tail", T.slug) == "_".join("a" * 24) and one(spark, "\u212a9 \u0130x", T.slug) == "k9_i_x"


def test_sentences_count_words_that_meet_once(spark):
    text = "".join(f"{'w ' * 9}v." for _ in range(30))  # a word ends a piece and begins the next
    count = lambda s: len(s.split())
    wanted = one(spark, text, lambda c: T.split_sentences(c, F.lit(False), count))
    assert one(spark, text, lambda c: T.split_sentences(c, F.lit(False))) == wanted and "".join(wanted) == text
