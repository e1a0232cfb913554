"""Spelling variants of words over a variable-length gram index.

Frequent grams of two to ``LONGEST - 1`` code points form a dictionary. A gram of a word grows from two code points for as
long as it is frequent, up to a limit of its place, so what ends it lies inside the gram: a word is decomposed into two
grams read forward from its start and two read backward from its end. One edit leaves a gram as it is unless it falls
inside the gram or, seen from the end the gram is read from, before it. The limits keep every word's bound: wherever the
edit is, it affects at most two of the four grams, and the two that remain are the first two, the last two, or the outer
ones. So the lists to merge for a word are those three combinations, and what meets there is verified by edit distance.
Words of one length or of neighbouring lengths can be near; they meet in the class of the shorter length, whose limits
hold for both.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxframe.session import materialize

# ---- fixed values -----------------------------------------------------------
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DELETED = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_RATIO = 10
# -----------------------------------------------------------------------------

SHORTEST, LONGEST = 2, 6
#: A gram is frequent above this count, and above a 65,536th of all letters: no more grams of one length can be.
FREQUENT = 64
_SHARE = 1 << 16
_HELD = 500_000  # gram counts a task holds before it hands them on
_ROWS = 20_000
_BRIEF = 48  # code points up to which the built-in distance, whose work is the square, is the faster test


def spelled_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the runs of letters of all whole texts, some with a letter deleted as the contract of the query says.

    A null text has no words, a null key reads as an empty one; repeated rows count each for itself.
    """
    lowered = F.translate(F.col(text).cast("string"), UPPER, LOWER)
    runs = F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}+"), F.lit(0))
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = docs.select(name.alias("name"), F.explode(runs).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("name", F.lit(":"), "run"))).withColumn("size", F.length("run"))
    at = (F.col("h") % F.col("size")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    words = rows.select(F.when(F.col("h") % DELETED == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def frequent_grams(words: DataFrame, word: str = "word") -> frozenset[str]:
    """The dictionary: grams above the frequency bound, which keeps it under a quarter of a million however many words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"gram": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return batch

        for batch in batches:
            for value in batch.column(0).to_pylist():
                for size in range(SHORTEST, LONGEST):
                    held.update(value[at : at + size] for at in range(len(value) - size + 1))
                if len(held) >= _HELD:
                    yield handed()
        if held:
            yield handed()

    grams = words.select(word).mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    letters = words.agg(F.sum(F.length(word))).first()[0] or 0
    return frozenset(r["gram"] for r in grams.where(F.col("n") > max(FREQUENT, letters // _SHARE)).select("gram").toLocalIterator())


def limits(size: int) -> tuple[int, int]:
    """Longest first and second gram, from either end, of the class of words from ``size`` code points.

    Two grams from one end and the first from the other never overlap: twice the first and the second make ``size``.
    """
    first = (size + 1) // 3
    return first, size - 2 * first


def _ends(word: str, longest: tuple[int, int], frequent: frozenset[str], step: int) -> tuple[int, int]:
    """Lengths of the first gram and of the first two, read forward (``step`` 1) or backward (-1)."""
    at, out = 0, []
    for most in longest:
        size = min(SHORTEST, most)
        while size < most:
            gram = word[at : at + size] if step > 0 else word[len(word) - at - size : len(word) - at]
            if gram not in frequent:
                break
            size += 1
        at += size
        out.append(at)
    return out[0], out[1]


def merge_keys(word: str, size: int, frequent: frozenset[str]) -> list[str]:
    """The three lists of a word in the class of ``size``: two grams that one edit leaves as they are."""
    front, back = _ends(word, limits(size), frequent, 1), _ends(word, limits(size), frequent, -1)
    end = len(word)
    return [f"{size}<{word[: front[1]]}", f"{size}>{word[end - back[1] :]}", f"{size}-{word[: front[0]]}-{word[end - back[0] :]}"]


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: all pairs of words that one edit tells apart, each pair once, from distinct ``word, n``.

    Words of at least ``LEAST_LENGTH`` code points; shorter ones are not searched.
    """
    shared = words.sparkSession.sparkContext.broadcast(frequent_grams(words))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            out: list[tuple[str, bool, str, int]] = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out += [(key, False, word, n) for key in merge_keys(word, len(word), frequent)]
                if len(word) > LEAST_LENGTH:
                    out += [(key, True, word, n) for key in merge_keys(word, len(word) - 1, frequent)]
                if len(out) >= _ROWS:
                    yield _table(out)
                    out = []
            if out:
                yield _table(out)

    made = words.where(F.length("word") >= LEAST_LENGTH).select("word", "n").mapInArrow(keys, "key string, longer boolean, word string, n long")
    made = materialize(made.withColumn("key", F.xxhash64("key")), "spelling-keys")
    short = made.where("NOT longer").select("key", "word", "n")
    met = short.join(made.select("key", "longer", F.col("word").alias("other"), F.col("n").alias("other_n")), "key")
    met = met.where(F.col("longer") | (F.col("word") < F.col("other")))
    return met.where(_one_edit(F.col("word"), F.col("other"))).select("word", "n", "other", "other_n").distinct()


def _one_edit(word: Column, other: Column) -> Column:
    """True where ``other``, as long as ``word`` or one longer, differs by one edit. Long words are compared from their first difference."""
    differs = F.zip_with(F.split(word, ""), F.split(other, ""), lambda a, b: ~a.eqNullSafe(b))
    first = F.array_position(differs, True).cast("int")
    size = F.length(other)
    rest = F.substring(word, first + (F.length(word) == size).cast("int"), size)
    return F.when(size <= _BRIEF, F.levenshtein(word, other, 1) == 1).otherwise((first > 0) & (rest == F.substring(other, first + 1, size)))


def _table(rows: list[tuple[str, bool, str, int]]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.bool_(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", "longer", "word", "n"])


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """Last word of each chain of ``word, form``, by doubling. A form is ten times as frequent, so ``most`` bounds the chains."""
    known, hops = materialize(forms.select("word", F.col("form").alias("root")), "spelling-forms"), 1
    longest = 0
    while LEAST_COUNT * FORM_RATIO ** (longest + 1) <= most:
        longest += 1
    while hops < longest:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        known = materialize(known.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
        hops *= 2
    return known


def variant_groups(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words with their counts.

    The form is the near word of the largest count, the smallest of equals, if it is ``FORM_RATIO`` times as frequent.
    """
    pairs = materialize(near_words(words), "spelling-pairs")
    turned = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    found = pairs.unionByName(turned).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    known = words.join(found, "word", "left").withColumn("form_n", -F.col("best.less"))
    is_form: Column = F.col("form_n") >= FORM_RATIO * F.col("n")
    known = known.withColumn("form", F.when(is_form, F.col("best.other"))).withColumn("form_n", F.when(is_form, F.col("form_n")))
    known = materialize(known.select("word", "form", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"), "spelling-words")
    most = known.agg(F.max("n")).first()[0] or 0
    roots = _roots(known.where(F.col("form").isNotNull()), most)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Variant groups of the words of all whole texts; an empty table has none. Other columns are not read."""
    return variant_groups(materialize(spelled_words(docs, key, text), "spelling-counts"))
