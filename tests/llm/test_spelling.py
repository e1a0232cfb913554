"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voxframe.llm import spelling
from voxframe.llm.queries import QUERIES

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(rows):
    """Counts of the words of ``(key, text)`` rows, run by run."""
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near_of(words):
    """Near words of every word, by trying all deletions."""
    by = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by[i, w[:i] + w[i + 1 :]].add(w)
    near = {w: set() for w in words}
    for (i, rest), group in by.items():
        for w in group:
            near[w] |= group - {w}
        if rest in words:  # a letter more
            near[rest] |= group
            for w in group:
                near[w].add(rest)
    return near


def expected(words):
    near, out, forms = near_of(words), {}, {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), words.get(forms[w]))
    return out


def found(frame):
    rows = [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    result = found(QUERIES["op13_spelling_variants"](spark, small))
    assert result == expected(words_of([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert any(r[0] for r in result.values())


@pytest.mark.parametrize("frequent", [0, 3, 10**9])
def test_any_dictionary_gives_the_same_pairs(spark, small, frequent, monkeypatch):
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert found(spelling.spelling_variants(docs)) == expected(words_of([tuple(r) for r in docs.select("doc_id", "text").collect()]))


_word = st.text("abé", min_size=7, max_size=14)


@settings(max_examples=300, deadline=None)
@given(_word, st.integers(0, 20), st.sampled_from("abéx"), st.integers(0, 2), st.sets(st.text("abé", min_size=2, max_size=5)))
def test_one_edit_leaves_a_list_in_common(word, at, letter, kind, frequent):
    at %= len(word)
    other = [word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]][kind]
    size = min(len(word), len(other))
    if size >= spelling.LEAST_LENGTH:
        assert set(spelling.merge_keys(word, size, frozenset(frequent))) & set(spelling.merge_keys(other, size, frozenset(frequent)))


def test_chains_are_followed_to_their_end(spark):
    words = {"aaaaaaaa" + "b" * i: 2 * 10**i for i in range(6)} | {"zzzzzzzz": 3, "zzzzzzzy": 29, "zzzzzzyz": 30}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(spelling.variant_groups(frame)) == expected(words)


def test_odd_rows(spark):
    long, longer = "abcdefgh" * 300, "q" * 300_000
    rows = [(1, "Lettering lettering, leterring LETTERING", "x", 1), (1, "Lettering lettering, leterring LETTERING", "x", 1), (None, "letterings letterings", "x", 1)]
    rows += [(2, None, "x", 1), (3, "", "x", 1), (4, "short Été 中文", None, 1), *[(i, f"{long} {long}x {longer} {longer}q", "x", 1) for i in range(5, 9)]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    words = words_of([(r[0], r[1]) for r in rows])
    got = found(spelling.spelling_variants(frame))
    assert {w: r[2] for w, r in got.items()} == words and got[longer][3] == 1
    assert {w: r for w, r in got.items() if len(w) < 9_999} == expected({w: n for w, n in words.items() if len(w) < 9_999})
    assert found(spelling.spelling_variants(frame.limit(0))) == {}
