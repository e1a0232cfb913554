"""Operators on documents against brute force, and on the odd inputs that each of them defines."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.oracle import compare
from voxframe.llm import graphs, queries
from voxframe.llm.decontaminate import contamination
from voxframe.llm.graphs import components
from voxframe.llm.jaccard import near_duplicate_classes
from voxframe.llm.languages import SAMPLE_CHARS, fit_languages, identified, identify, text_bits, training_sample
from voxframe.llm.privacy import personal_data_digests, sanitised
from voxframe.llm.suffix_array import LENGTH, _runs, parted_suffixes, repeat_digests, suffix_order, without_repeats
from voxframe.llm.suffix_tree import repeated_suffixes, repeated_word_digests, without_repeated_words
from voxframe.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
ODD = "doc_id long, text string, key string, chunk int, bucket int, lang string, n long"


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, clashing columns."""
    random.seed(11)
    words = ["".join(random.choice("abcdefgh") for _ in range(random.randint(2, 8))) for _ in range(400)]
    base = " ".join(random.choice(words) for _ in range(80))
    long_text = " ".join(random.choice(words) for _ in range(30_000))
    texts = [(1, base), (2, base), (2, base), (3, base.replace(" ", "  ", 1)), (4, base + " tail"), (5, None), (6, ""), (7, " \n\t"), (8, "one"), (9, "one"), (10, "ONE two")]
    texts += [(11, base.upper()), (12, "a " * 5000), (13, "a " * 40), (14, long_text), (15, base[:300]), (16, "é" * 60), (17, "é" * 60), (None, base), (None, None)]
    return [(k, t, "x", 1, 2, "en", 3) for k, t in texts]


@pytest.fixture(scope="module")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def pairs_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# ---- reference versions -------------------------------------------------------------


def shingles(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def classes(rows, threshold=75):
    sets = [(k, shingles(t)) for k, t in rows]
    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, s) in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= threshold * (len(s) + len(sets[j][1]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, len(s), least.get(find(i), k)) for i, (k, s) in enumerate(sets)), key=repr)


def bytes_left(rows, length=50):
    first = {}
    for k, t in rows:
        data = (t or "").encode()
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            key = float("inf") if k is None else k
            first[w] = min(first.get(w, key), key)
    out = []
    for k, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < (float("inf") if k is None else k):
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((k, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def words_left(rows, window=20):
    first = {}
    for k, t in rows:
        words = re.findall(WORD, t or "")
        for i in range(len(words) - window + 1):
            w, at = tuple(words[i : i + window]), (float("inf") if k is None else k, i)
            first[w] = min(first.get(w, at), at)
    out = []
    for k, t in rows:
        words = re.findall(WORD, t or "")
        gone = bytearray(len(words))
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (float("inf") if k is None else k, i):
                gone[i : i + window] = b"\1" * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((k, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def base_spans(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def fine(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    spans = [(m.start(), i, m.end(), kind) for i, (kind, p) in enumerate(kinds.items()) for m in re.finditer(p, text or "") if fine(kind, m[0])]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))


# ---- whole tables ---------------------------------------------------------------------


def test_near_copies_of_the_table(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert pairs_of(near_duplicate_classes(documents)) == classes(rows)
    assert pairs_of(near_duplicate_classes(documents, rare=2)) == classes(rows)


def test_bytes_and_words_of_the_table(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert pairs_of(repeat_digests(documents)) == bytes_left(rows)
    assert pairs_of(repeated_word_digests(documents)) == words_left(rows)


def test_personal_data_of_the_table(documents):
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    found = personal_data_digests(documents).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["base_sha256"] == hashlib.sha256(base_spans(rows[r["doc_id"]]).encode()).hexdigest()


def test_languages_of_the_table(spark, small):
    docs = spark.read.parquet(f"{small.replace('0.001', '0.01')}/documents.parquet")
    found = identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, rows = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right / rows > 0.97


def test_contamination_equals_sql(spark, duck, small):
    class Item:
        run = queries.QUERIES["op2_benchmark_decontamination"]
        sql = queries.SQL["op2_benchmark_decontamination"]

    assert compare(spark, duck, Item, small) == ""


# ---- odd rows ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


def test_near_copies_of_odd_rows(odd, none):
    assert pairs_of(near_duplicate_classes(odd)) == classes([r[:2] for r in odd_rows()])
    assert near_duplicate_classes(none).collect() == []


@pytest.mark.parametrize("rare", [1, 3, 64])
def test_many_near_copies(spark, rare):
    """Copies of one text, each with its own changes, so that most pairs fall short but all hang together."""
    random.seed(rare)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(random.randint(0, 7)):
            words[random.randrange(len(words))] = f"x{random.randrange(10**6)}"
        rows.append((k, " ".join(words[: random.randint(90, 120)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert pairs_of(near_duplicate_classes(docs, rare=rare)) == classes(rows)


def test_bytes_of_odd_rows(odd, none):
    assert pairs_of(repeat_digests(odd)) == bytes_left([r[:2] for r in odd_rows()])
    assert repeat_digests(none).collect() == []
    row = without_repeats(odd).where("doc_id = 17").first()
    assert row["kept"] == b"" and [tuple(s) for s in row["removed"]] == [(0, 120)]


def test_words_of_odd_rows(odd, none):
    assert pairs_of(repeated_word_digests(odd)) == words_left([r[:2] for r in odd_rows()])
    assert repeated_word_digests(none).collect() == []
    assert without_repeated_words(odd).where("doc_id = 13").first()["kept"] == ""


def test_contamination_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([("i1", odd_rows()[0][1]), ("i2", "One"), ("i2", "one"), ("i3", None), ("i4", "two three"), (None, "tail")], "item_id string, text string")
    found = {r["doc_id"]: r for r in contamination(odd, items).collect() if r["doc_id"] is not None}
    assert found[1]["n_hit"] == found[1]["n_words"] == 80 and found[1]["n_items"] == 1
    assert found[4]["n_hit"] == 81 and found[4]["items_sha256"] == hashlib.sha256(b"i1").hexdigest()
    assert found[8]["n_hit"] == 1 and found[8]["items_sha256"] == hashlib.sha256(b"i2").hexdigest()
    assert (found[10]["n_words"], found[10]["n_hit"]) == (2, 1)
    assert found[5]["n_words"] == 0 and not found[5]["contaminated"] and not found[14]["contaminated"]
    assert contamination(odd, items).count() == len(odd_rows())
    assert not any(r["contaminated"] for r in contamination(odd, items.limit(0)).collect())
    assert contamination(none, items).collect() == []


def test_languages_of_odd_rows(spark, odd, none):
    found = {r["doc_id"]: r for r in identified(odd).collect() if r["doc_id"] is not None}
    assert found[5]["lang_pred"] == found[6]["lang_pred"] == found[7]["lang_pred"] == "und" and found[5]["score"] == 0.0
    assert found[1]["lang_pred"] == "en" and found[1]["score"] == 1.0
    assert identified(none).collect() == []
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in identified(unlabelled).collect()} == {"und"}
    assert identified(odd).count() == len(odd_rows())


def test_code_lengths_are_sums_over_bytes():
    model = fit_languages([("a", "abracadabra " * 30), ("b", "bananas and cabanas " * 30)])
    text = "cadabra bananas ☃".encode()
    whole = text_bits(model, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    other = np.frombuffer(b"zz" + text + text, np.uint8)
    assert np.allclose(text_bits(model, other, np.array([0, 2, 2 + len(text), 2 + 2 * len(text)]))[1:], whole)
    # for every context the probabilities of all symbols it may be followed by sum to at most one
    chance = np.exp2(-model.bits.reshape(-1, model.symbols, 2)).sum(1)
    assert chance.max() < 1.0 + 1e-4


def test_language_ties_go_to_the_first_name(spark):
    model = fit_languages([("x", "same words"), ("w", "same words")])
    row = identify(spark.createDataFrame([(1, "same words")], "doc_id long, text string"), model).first()
    assert row["lang_pred"] == "w" and row["score"] == pytest.approx(0.5)


def test_training_sample_is_bounded_and_whole(spark):
    """A key that many rows share, repeated rows and long texts stay within the bounds; a language of long texts is learnt."""
    rows = [(1, f"text number {i}", "en") for i in range(50)] + [(1, "same", "en")] * 30 + [(1, "x" * (SAMPLE_CHARS + 5), "en"), (1, "mot", "fr")]
    rows += [(i, "zyx wvu " * 4000 + str(i), "zz") for i in range(2, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = training_sample(docs, rows=10).collect()
    assert Counter(r["label"] for r in found) == {"en": 10, "fr": 1, "zz": 3}
    assert all(len(r["sample"]) <= SAMPLE_CHARS for r in found) and {len(r["sample"]) for r in found if r["label"] == "zz"} == {SAMPLE_CHARS}
    assert sum(r["sample"] == "same" for r in training_sample(docs).collect()) == 1
    assert {r["lang_pred"] for r in identified(docs, folds=10**6).where("doc_id > 1").collect()} == {"zz"}


def test_personal_data_of_odd_rows(spark, odd, none):
    assert all(r["spans"] == "" for r in personal_data_digests(odd).collect())
    assert personal_data_digests(none).collect() == [] and sanitised(odd).count() == len(odd_rows())
    assert sanitised(odd).columns == odd.columns and sanitised(odd).where("text IS NULL").count() == 2
    texts = ["a@b.com_x@y.org", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.4", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (555) 123-4567. +12 3", "x" * 30_000 + "@" + "9" * 30_000, "é+49 30 1234567 a.b@c.d.e."]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in personal_data_digests(rows).collect():
        assert r["spans"] == base_spans(texts[r["doc_id"]]), texts[r["doc_id"]][:60]
    assert sanitised(rows).where("doc_id = 5").first()["text"] == "é[PHONE] [EMAIL]."


def test_terms_that_disclose(spark):
    """A name seen only beside one address is generalised with it; a word that is everywhere is not, nor is a copied text."""
    random.seed(4)
    filler = lambda n: " ".join("".join(random.choice("klmnopqrst") for _ in range(7)) for _ in range(n))
    rows = [(i, f"{filler(8)} Zorblax writes jo@ex.org {filler(8)}") for i in range(6)]
    rows += [(i, f"{filler(8)} writes {filler(8)}") for i in range(6, 60)]
    copied = f"{filler(8)} Quixley near 1.2.3.4 {filler(8)}"
    rows += [(i, copied + " " * (i % 3)) for i in range(60, 66)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in personal_data_digests(docs).collect():
        text = dict(rows)[r["doc_id"]]
        terms = [text[int(a) : int(b)] for kind, a, b in (s.split(":") for s in r["spans"].split(",") if s) if kind == "term"]
        assert terms == (["Zorblax"] if r["doc_id"] < 6 else []), text
    assert "[TERM] writes [EMAIL]" in sanitised(docs).where("doc_id = 0").first()["text"]


def test_terms_far_from_the_entity_and_without_it(spark):
    """A disclosing term goes wherever it stands; co-occurrence is counted in documents, and short names are terms."""
    random.seed(9)
    filler = lambda n: " ".join("".join(random.choice("klmnopqrst") for _ in range(7)) for _ in range(n))
    rows = [(i, f"Ann {filler(40)} ann@ex.org {filler(40)} 李明 {filler(3)} Ann.") for i in range(4)]
    rows += [(4, f"{filler(6)} ann {filler(6)}"), (5, f"{filler(60)} 李明"), (None, f"ANN {filler(5)}"), (6, "org ex")]
    rows += [(i, filler(20)) for i in range(7, 200)]
    rows += [(300 + i, f"{filler(3)} ex {filler(3)} org") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in personal_data_digests(docs).collect():
        text = dict(rows)[r["doc_id"]]
        terms = [text[int(a) : int(b)] for kind, a, b in (s.split(":") for s in r["spans"].split(",") if s) if kind == "term"]
        assert terms == re.findall(r"(?i)\bann\b(?!@)|李明", text), text


# ---- parts --------------------------------------------------------------------------------


def test_transform_parts_suffixes():
    random.seed(2)
    for trial in range(40):
        symbols = np.array([random.randrange(3) for _ in range(random.randint(1, 300))])
        symbols = np.concatenate([symbols, symbols[: len(symbols) // 2]]) if trial % 2 else symbols
        length = random.randint(1, 12)
        order, parted = parted_suffixes(symbols, length)
        heads = [tuple(symbols[i : i + length]) for i in order]
        assert heads == sorted(heads) and parted[0]
        assert all(parted[i] == (heads[i] != heads[i - 1]) for i in range(1, len(heads)) if len(heads[i]) == len(heads[i - 1]) == length)


def test_suffixes_of_long_repeats_are_in_order():
    random.seed(5)
    part = [random.randrange(510) for _ in range(120)]
    symbols = np.array(part * 4 + part[:61] + [0] * 130)
    for depth in (1, 7, 8, 21, 50, 127, 400):
        order = suffix_order(symbols, depth)
        heads = [tuple(symbols[i : i + depth]) for i in order]
        assert heads == sorted(heads) and sorted(order.tolist()) == list(range(len(symbols)))


def test_anchors_are_spread_over_buckets():
    random.seed(7)
    texts = ["".join(random.choices("abcdefghij ", k=997)) for _ in range(90)]  # longer than a block
    data, offsets, anchor, first, last = _runs(pa.table({"text": texts}))
    whole = [i for a, b in zip(offsets[:-1], offsets[1:]) for i in range(a, b - LENGTH + 1)]
    assert [i for a, b in zip(first, last) for i in range(a, b + 1)] == whole
    shares = np.bincount((anchor >> np.uint64(61)).astype(int), minlength=8) / len(anchor)
    assert shares.max() < 0.2  # an eighth; more than half came to the first before
    _, _, again, begin, end = _runs(pa.table({"text": ["x" * 40000 + texts[3]]}))
    known = dict(zip(anchor[(first >= 3 * 997) & (last < 4 * 997)].tolist(), range(10**6)))
    assert set(known) == set(again[begin >= 40000].tolist()) | (set(known) & set(again.tolist()))


def test_suffix_nodes():
    symbols = np.array([[1, 2], [1, 2], [1, 3], [1, 2]], np.uint32)
    assert repeated_suffixes(symbols, np.array([5, 4, 4, 4]), np.array([0, 2, 3, 1])).tolist() == [True, True, False, False]


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(500, i) for i in range(501, 540)] + [(7, 7), (None, 3)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    label = {x: x for e in edges if None not in e for x in e}
    for _ in label:
        for a, b in edges:
            if None not in (a, b):
                label[a] = label[b] = min(label[a], label[b])
    assert found == {k: v for k, v in label.items() if any(k in e and e[0] != e[1] and None not in e for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_write_few_files_and_end_with_stars(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graphs, "materialize", lambda df, label: written.append(materialize(df, label)) or written[-1])
    stars = [(1, i) for i in range(2, 40)] + [(50, i) for i in range(60, 70)]
    assert len(components(spark.createDataFrame(stars, "a long, b long")).collect()) == 50 and len(written) == 1
    written.clear()
    cores = spark.sparkContext.defaultParallelism
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 9 * cores)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        chains = [(i, i + 1) for i in range(400) if i % 20]
        found = dict(map(tuple, components(spark.createDataFrame(chains, "a long, b long")).collect()))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert found == {i: (i - 1) // 20 * 20 + 1 for i in range(1, 401)}
    assert len(written) > 1 and max(len(w.inputFiles()) for w in written[1:]) <= cores
