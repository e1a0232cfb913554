"""Text normalisation and token-string helpers (Column in, Column out)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxframe.functions.arrays import once

# ---- fixed values -----------------------------------------------------------
PROMPT_PREFIX = "You are a helpful assistant.<|endofprompt|>"
PROMPT_MARKER = "<|endofprompt|>"
LANGUAGES = {
    "zh": "Chinese",
    "en": "English",
    "ja": "Japanese",
    "ko": "Korean",
    "ru": "Russian",
    "es": "Spanish",
    "fr": "French",
    "de": "German",
    "it": "Italian",
    "pt": "Portuguese",
    "auto": "Auto",
}
MEETING_TAGS = ["<sil>", "<%>", "<->", "<$>", "<#>", "<_>", "<space>"]
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WIDE_PUNCTUATION = (
    "＂＃＄％＆＇（）＊＋，－／：；＜＝＞＠［＼］＾＿｀｛｜｝～｟｠｢｣､　、〃〈〉《》「」『』【】〔〕〖〗〘〙〚〛〜〝〞〟"
    "〰〾〿–—‘’‛“”„‟…‧﹏﹑﹔·！？｡。"
)
PROMPT_QUOTES = "\"()“”‘（）'"
YO_WORDS = {"ребенок": "ребёнок", "счет": "счёт", "счету": "счёту"}
RUSSIAN_VOWELS = "АЕЁИОУЫЭЮЯаеёиоуыэюя"
CJK_STOPS = ["。", "？", "！", "；", "：", "、", ".", "?", "!", ";"]
LATIN_STOPS = [".", "?", "!", ";", ":"]
COMMAS = ["，", ","]
CLOSING_QUOTES = ['"', "”"]
SECRET_WORDS = ["TOKEN", "KEY", "SECRET"]
# -----------------------------------------------------------------------------

# Decimal digits, and the superscript, subscript and circled ones that count as digits as well.
_DIGIT = r"\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒" + (
    r"\x{1369}-\x{1371}\x{19DA}\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)

# Characters that NFKC leaves alone and never composes; other text goes to Python.
_NFKC_STABLE = r"[\x00-\x7F¡«»¿À-ÿЀ-џ–—‘’“”一-鿿]*"


def words(text: Column) -> Column:
    """Whitespace tokens of a text, Unicode blanks included; empty array for blank text."""
    return F.filter(F.split(text, r"(?U)[\s\x1C-\x1F]+"), lambda w: w != "")


def whitespace_token_count(text: Column) -> Column:
    """Number of whitespace tokens."""
    return F.size(words(text))


def characters(text: Column) -> Column:
    """Array of the text's characters."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def joined_characters(tokens: Column) -> Column:
    """Character form of a token array: tokens joined without blanks, then split."""
    return characters(F.array_join(tokens, ""))


@F.pandas_udf(T.StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore")


def nfkc(text: Column) -> Column:
    """NFKC form; only rows with characters NFKC may change travel to Python."""
    return F.coalesce(_nfkc(F.when(~text.rlike(f"^{_NFKC_STABLE}$"), text)), text)


def asr_normal_form(text: Column, compose: bool = True) -> Column:
    """Lower case, ё as е, punctuation and underscore as blanks, single blanks, trimmed.

    ``compose=False`` skips NFKC for text known to be composed already.
    """
    base = nfkc(text) if compose else text
    folded = F.translate(F.lower(base), "ё", "е")
    spaced = F.regexp_replace(folded, r"[\p{P}_]", " ")
    return F.regexp_replace(F.regexp_replace(spaced, r"(?U)\s+", " "), r"^ | $", "")


def remove_punctuation(text: Column) -> Column:
    """Drop ASCII and full-width punctuation, keeping the apostrophe."""
    listed = "".join(c for c in WIDE_PUNCTUATION + ASCII_PUNCTUATION if c != "'")
    return F.translate(text, listed, "")


def meeting_normal_form(text: Column) -> Column:
    """Meeting-transcript form: no blanks, tags or punctuation; upper case once a Latin letter occurs."""
    out = F.translate(text, "  ", "")
    for tag in MEETING_TAGS:
        out = F.replace(out, F.lit(tag), F.lit(""))
    out = F.translate(out, "`&,", "")
    out = F.when(out.rlike("[a-zA-Z]"), F.upper(out)).otherwise(out)
    out = F.translate(out, "Ａａｂｃｋｔ", "AABCKT")
    return remove_punctuation(F.translate(out, "，丶。、？", ""))


def replace_corner_marks(text: Column) -> Column:
    """Spell the squared and cubed signs."""
    return F.replace(F.replace(text, F.lit("²"), F.lit("平方")), F.lit("³"), F.lit("立方"))


def remove_brackets(text: Column) -> Column:
    """Drop full-width brackets and backticks; a double dash becomes a blank."""
    return F.replace(F.translate(text, "（）【】`", ""), F.lit("——"), F.lit(" "))


def remove_loose_blanks(text: Column) -> Column:
    """Keep a blank only between two ASCII non-blank characters."""
    solid = r"[\x00-\x1F\x21-\x7F]"
    return F.regexp_replace(text, f"(?<!{solid}) | (?!{solid})", "")


def rewrite_digit_runs(text: Column, spell: Callable[[str], str]) -> Column:
    """Replace every maximal run of digits by ``spell(run)``; the speller is supplied by the caller.

    Only the distinct runs of a text travel to the speller; the text is put together in the JVM.
    """

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def spelled(runs: pd.Series) -> pd.Series:
        return runs.map(lambda found: [spell(run) for run in found], na_action="ignore")

    def rewritten(row: Column) -> Column:
        said = F.map_from_arrays(row["runs"], row["spelled"])
        return F.array_join(F.transform(row["pieces"], lambda piece: F.coalesce(said[piece], piece)), "")

    pieces = F.regexp_extract_all(text, F.lit(f"[{_DIGIT}]+|[^{_DIGIT}]+"), F.lit(0))
    runs = F.array_distinct(F.regexp_extract_all(text, F.lit(f"[{_DIGIT}]+"), F.lit(0)))
    row = F.struct(pieces.alias("pieces"), runs.alias("runs"), spelled(F.when(text.rlike(f"[{_DIGIT}]"), runs)).alias("spelled"))
    return F.when(text.rlike(f"[{_DIGIT}]"), F.get(F.transform(F.array(row), rewritten), F.lit(0))).otherwise(text)


def strip_markers(text: Column, markers: Sequence[str] = ("[FIL]", "[SPK]")) -> Column:
    """Remove literal corpus markers."""
    for marker in markers:
        text = F.replace(text, F.lit(marker), F.lit(""))
    return text


def strip_prompt_quotes(text: Column) -> Column:
    """Remove quote and bracket characters that upset prompting."""
    return F.translate(text, PROMPT_QUOTES, "")


def restore_yo(text: Column, entries: Mapping[str, str] = YO_WORDS) -> Column:
    """Put ё back into whole Cyrillic words, keeping upper, title or lower case."""
    for plain, restored in entries.items():
        forms = [(plain.upper(), restored.upper()), (plain.capitalize(), restored.capitalize())]
        # Any other casing takes the lower-case replacement.
        forms.append((f"(?iu:{plain})", restored))
        for pattern, value in forms:
            text = F.regexp_replace(text, f"(?<![А-Яа-яЁё]){pattern}(?![А-Яа-яЁё])", value)
    return text


def has_stress_marks(text: Column) -> Column:
    """A combining acute accent, or a plus sign before a Russian vowel."""
    return text.contains("́") | text.rlike(rf"\+[{RUSSIAN_VOWELS}]")


def has_markup(text: Column) -> Column:
    """Control tokens of the form ``<|...|>``."""
    return text.contains("<|") & text.contains("|>")


def has_cjk(text: Column) -> Column:
    """Any character of the CJK unified block."""
    return text.rlike("[一-鿿]")


def only_punctuation(text: Column) -> Column:
    """Nothing but punctuation and symbols; the empty text counts."""
    return text.rlike(r"^[\p{P}\p{S}]*\z")


def language_code(lang: Column, default: str = "auto") -> Column:
    """Trimmed lower-case code; missing or empty takes the default."""
    filled = F.when(lang.isNull() | (lang == ""), F.lit(default)).otherwise(lang)
    return F.lower(F.trim(filled))


def language_name(code: Column) -> Column:
    """Display name of a supported code, null otherwise."""
    pairs = [F.lit(v) for item in LANGUAGES.items() for v in item]
    return F.element_at(F.create_map(*pairs), code)


def ensure_prompt_prefix(text: Column) -> Column:
    """Exactly one leading prompt prefix; text with only the bare marker is kept as it is."""
    at = F.instr(text, PROMPT_PREFIX)
    without = F.concat(
        F.substring(text, F.lit(1), at - 1), F.substring(text, at + len(PROMPT_PREFIX), F.char_length(text))
    )
    return (
        F.when(at == 1, text)
        .when(at > 1, F.concat(F.lit(PROMPT_PREFIX), without))
        .when(text.contains(PROMPT_MARKER), text)
        .otherwise(F.concat(F.lit(PROMPT_PREFIX), text))
    )


def strip_prompt_prefix(text: Column) -> Column:
    """Text after the leading prefix, else after the last marker, else unchanged."""
    rest = F.substring(text, F.lit(len(PROMPT_PREFIX) + 1), F.char_length(text))
    return F.when(text.startswith(PROMPT_PREFIX), rest).otherwise(F.substring_index(text, PROMPT_MARKER, -1))


def token_string(tokens: Column) -> Column:
    """``<|s_1|><|s_2|>...`` for an integer array."""
    return F.array_join(F.transform(tokens, lambda t: F.concat(F.lit("<|s_"), t.cast("string"), F.lit("|>"))), "")


def token_ids(text: Column, vocabulary: int = 6561, end_id: int | None = None) -> Column:
    """Ids of a token string up to the first end mark or end id; ids outside the vocabulary are dropped."""
    end = vocabulary + 1 if end_id is None else end_id
    head = F.split(text, r"<\|eos\d*\|>", 2)[0]
    found = F.regexp_extract_all(head, F.lit(r"<\|s_(\d+)\|>"), F.lit(1))
    ids = F.transform(found, lambda t: t.cast("int"))
    stop = F.array_position(ids, end)
    upto = F.when(stop > 0, F.slice(ids, F.lit(1), (stop - 1).cast("int"))).otherwise(ids)
    return F.filter(upto, lambda t: t < vocabulary)


def log_text(text: Column, limit: int = 300) -> Column:
    """One line, trimmed, cut with a marker when longer than ``limit``.

    Only the beginning is rewritten; of the rest it matters whether anything but blanks is left.
    """
    head = F.regexp_extract(text, rf"(?Us)^\s*+(.{{0,{limit}}})", 1)
    longer = text.rlike(rf"(?Us)^\s*+.{{{limit}}}\s*+\S")
    line = F.replace(head, F.lit("\n"), F.lit(" "))
    return F.when(longer, F.concat(line, F.lit("... [truncated]"))).otherwise(F.regexp_replace(line, r"(?U)\s+$", ""))


def slug(text: Column, limit: int = 48) -> Column:
    """Lower-case file-name slug; ``empty`` when nothing is left.

    Only as much of the text is rewritten as has ``limit`` letters and digits.
    """
    kept = "[0-9a-zA-Zа-яА-ЯёЁ\u0130\u212a]"  # and the two signs whose lower case begins with a Latin letter
    other = kept.replace("[", "[^", 1)
    head = F.regexp_extract(text, f"^{other}*+((?:{kept}{other}*+){{0,{limit}}})", 1)
    joined = F.regexp_replace(F.lower(head), "[^0-9a-zA-Zа-яА-ЯёЁ]+", "_")
    cut = F.rtrim(F.substring(F.trim(joined, F.lit("_")), 1, limit), F.lit("_"))
    return F.when(cut == "", F.lit("empty")).otherwise(cut)


class NormalizerRegistry:
    """Per-language chains of Column functions, applied in the order of registration."""

    def __init__(self) -> None:
        self._chains: dict[str, list[Callable[[Column], Column]]] = {}

    def register(self, lang: str, step: Callable[[Column], Column]) -> NormalizerRegistry:
        self._chains.setdefault(lang, []).append(step)
        return self

    def apply(self, text: Column, lang: Column) -> Column:
        """Normalised text; languages without a chain keep their text."""
        out = text
        for code, steps in self._chains.items():
            changed = text
            for step in steps:
                changed = step(changed)
            out = F.when(lang == code, changed).otherwise(out)
        return out


def _class(characters: Sequence[str]) -> str:
    return "[" + "".join("\\" + c for c in characters) + "]"


def sentence_pieces(text: Column, cjk: Column, split_commas: bool = False) -> Column:
    """Pieces of a paragraph, each closed by a stop and the quotes behind it.

    The paragraph is closed with a stop of its own if it has none. Stops without text before
    them are no pieces; a quote behind such a stop belongs to the piece before.
    """
    quote = _class(CLOSING_QUOTES)

    def cut(stops: Sequence[str], full_stop: str) -> Column:
        stop = _class(stops)
        closed = F.when(F.right(text, F.lit(1)).isin(*stops), text).otherwise(F.concat(text, F.lit(full_stop)))
        begun = F.regexp_replace(closed, f"^(?:{stop}{quote}?)+", "")
        body = stop.replace("[", "[^", 1)
        found = F.regexp_extract_all(begun, F.lit(f"{body}++{stop}{quote}?(?:{stop}{quote}?)*+"), F.lit(0))
        # only the first stop stays
        return F.transform(found, lambda p: F.regexp_replace(p, f"(?<={stop}|{stop}{quote}){stop}", ""))

    more = COMMAS if split_commas else []
    return F.when(cjk, cut(CJK_STOPS + more, "。")).otherwise(cut(LATIN_STOPS + more, "."))


def _joined(pieces: Column, length: Callable[[Column], Column], runs_on: Callable[[Column], tuple[Column, Column]], most: int, least: int, merge: int) -> Column:
    """Pieces joined while they stay within ``most``, but to more than ``least``; a short tail joins what is before it.

    Every piece is measured once. ``runs_on`` tells whether a piece begins, and whether it ends, inside a unit of length:
    two such pieces share one unit where they meet.
    """
    start = F.struct(F.array(F.lit(0)).alias("starts"), F.lit(0).alias("n"), F.lit(False).alias("ends"), F.lit(0).alias("at"))

    def add(state: Column, piece: Column) -> Column:
        grown = state["n"] + piece["n"] - (state["ends"] & piece["begins"]).cast("int")
        full = (grown > most) & (state["n"] > least)
        return F.struct(
            F.when(full, F.concat(state["starts"], F.array(state["at"]))).otherwise(state["starts"]).alias("starts"),
            F.when(full, piece["n"]).otherwise(grown).alias("n"),
            piece["ends"].alias("ends"),
            (state["at"] + 1).alias("at"),
        )

    def close(state: Column) -> Column:
        starts = state["starts"]
        return F.when((F.size(starts) > 1) & (state["n"] < merge), F.slice(starts, F.lit(1), F.size(starts) - 1)).otherwise(starts)

    def cut(starts: Column) -> Column:
        until = lambda k: F.coalesce(F.get(starts, k + 1), F.size(pieces))
        return F.transform(starts, lambda at, k: F.array_join(F.slice(pieces, at + 1, until(k) - at), ""))

    def measured(piece: Column) -> Column:
        begins, ends = runs_on(piece)
        return F.struct(length(piece).alias("n"), begins.alias("begins"), ends.alias("ends"))

    sentences = once(F.aggregate(F.transform(pieces, measured), start, add, close), cut)
    return F.when(pieces.isNull(), F.lit(None).cast("array<string>")).when(F.size(pieces) == 0, F.array().cast("array<string>")).otherwise(sentences)


def _joined_by_characters(pieces: Column, *limits: int) -> Column:
    return _joined(pieces, F.char_length, lambda p: (F.lit(False), F.lit(False)), *limits)


def _joined_by_words(pieces: Column, *limits: int) -> Column:
    solid = r"[^\s\x1C-\x1F]"
    return _joined(pieces, whitespace_token_count, lambda p: (p.rlike(f"(?U)^{solid}"), F.right(p, F.lit(1)).rlike(f"(?U){solid}")), *limits)


def split_sentences(
    text: Column,
    cjk: Column,
    count_tokens: Callable[[str], int] | None = None,
    most: int = 80,
    least: int = 60,
    merge: int = 20,
    split_commas: bool = False,
) -> Column:
    """Array of sentences; CJK text is measured in characters, other text in words or by ``count_tokens``.

    An empty text has no sentence. Only an injected counter leaves the JVM.
    """
    limits = (most, least, merge)

    def found(text: Column, cjk: Column) -> Column:
        return F.when(text == "", F.array().cast("array<string>")).otherwise(sentence_pieces(text, cjk, split_commas))

    if count_tokens is None:
        joined = lambda cjk: lambda p: F.when(cjk, _joined_by_characters(p, *limits)).otherwise(_joined_by_words(p, *limits))
        row = F.struct(text.alias("text"), cjk.alias("cjk"))
        return once(row, lambda r: once(found(r["text"], r["cjk"]), joined(r["cjk"])))
    pieces = found(text, cjk)
    by_length = once(pieces, lambda p: _joined_by_characters(p, *limits))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def counted(rows: pd.Series) -> pd.Series:
        def join(parts: Sequence[str]) -> list[str]:
            sentences = [""]
            for part in parts:
                if count_tokens(sentences[-1] + part) > most and count_tokens(sentences[-1]) > least:
                    sentences.append("")
                sentences[-1] += part
            if len(sentences) > 1 and count_tokens(sentences[-1]) < merge:
                sentences[-2:] = ["".join(sentences[-2:])]
            return [s for s in sentences if s]

        return rows.map(join, na_action="ignore")

    return F.when(cjk, by_length).otherwise(counted(F.when(~cjk, pieces)))


def frontend_sentences(
    text: Column,
    spell: Callable[[str], str],
    count_tokens: Callable[[str], int] | None = None,
) -> Column:
    """Language-routed clean-up, sentence split and removal of punctuation-only pieces.

    Text with control tokens, and empty text, passes through as one piece.
    """
    trimmed = F.regexp_extract(text, r"(?Us)^\s*+(.*\S)?", 1)
    chinese = replace_corner_marks(remove_loose_blanks(F.replace(trimmed, F.lit("\n"), F.lit(""))))
    chinese = F.replace(F.replace(chinese, F.lit("."), F.lit("。")), F.lit(" - "), F.lit("，"))
    chinese = F.regexp_replace(remove_brackets(chinese), "[，,、]+$", "。")
    cjk = has_cjk(trimmed)
    cleaned = F.when(cjk, chinese).otherwise(rewrite_digit_runs(F.when(~cjk, trimmed), spell))
    sentences = F.filter(split_sentences(cleaned, cjk, count_tokens), lambda s: ~only_punctuation(s))
    return F.when(has_markup(text) | (text == ""), F.array(text)).otherwise(sentences)


def _is_secret_key(key: str) -> bool:
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", key).upper()
    return any(part in SECRET_WORDS for part in re.split(r"[^A-Z0-9]+", spaced))


def _redacted(value: object, key: str = "") -> object:
    if isinstance(value, (str, dict, list)) and _is_secret_key(key):
        return "[REDACTED]"
    if isinstance(value, dict):
        return {name: _redacted(item, name) for name, item in value.items()}
    if isinstance(value, list):
        return [_redacted(item) for item in value]
    return value


@F.pandas_udf(T.StringType())
def redact_json(document: pd.Series) -> pd.Series:
    """JSON text with string, object and array values under secret-looking keys replaced."""
    import json

    return document.map(
        lambda s: json.dumps(_redacted(json.loads(s)), ensure_ascii=False, separators=(",", ":")), na_action="ignore"
    )


def redact_map(entries: Column) -> Column:
    """The same rule for a flat map of strings, without leaving the JVM."""
    spaced = lambda k: F.concat(F.lit("_"), F.upper(F.regexp_replace(k, "(?<=[a-z0-9])(?=[A-Z])", "_")), F.lit("_"))
    secret = "[^A-Z0-9](" + "|".join(SECRET_WORDS) + ")[^A-Z0-9]"
    return F.transform_values(entries, lambda k, v: F.when(spaced(k).rlike(secret), F.lit("[REDACTED]")).otherwise(v))
