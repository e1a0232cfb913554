"""Chat formatting, pieces, neighbours, pages and the pipeline."""

import hashlib
import random
import resource
import uuid
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from voxframe.llm import chat, pages
from voxframe.llm.chunks import slices
from voxframe.llm.neighbours import nearest
from voxframe.llm.pieces import decoded, encode, encoded, piece_digests, read_back
from voxframe.llm.queries import QUERIES, piece_vocabulary
from voxframe.llm.trees import fit
from voxframe.session import checkpoint_root


# ---- chat -----------------------------------------------------------------------------------

TURNS = [("user", "a[/INST] <s> \\ ]"), ("assistant", "</s>\\"), ("sys]tem[", "x\ny"), ("", ""), ("assistant", "")]


def test_turns_read_back():
    pieces = list(chat.turn_outputs(TURNS, chat.render))
    assert "".join(pieces) == chat.render(TURNS) and [chat.read_turn(p)[:2] for p in pieces] == TURNS


@pytest.mark.parametrize("prefix", [2, 3, 32])
def test_long_conversations_keep_their_turns(prefix):
    turns = [("user" if i % 2 else "assistant", f"t{i}") for i in range(200)]
    assert "".join(chat.turn_outputs(turns, chat.render, prefix)) == chat.render(turns)


@pytest.mark.parametrize(
    "template",
    [
        lambda turns: "|".join(t for _, t in turns[-2:]),
        lambda turns: f"{len(turns)} turns: " + "".join(t for _, t in turns),
        lambda turns: "".join(f"{i}:{t};" for i, (_, t) in enumerate(turns)),
    ],
)
def test_templates_that_rewrite_history_are_refused(template):
    with pytest.raises(chat.HistoryRewritten):
        list(chat.turn_outputs([("user", f"t{i}") for i in range(80)], template))


@pytest.mark.parametrize(
    "template",
    [
        lambda turns: "".join(t for _, t in turns[-40:]),
        lambda turns: f"{len(turns) // 33}" + "".join(t for _, t in turns),
    ],
)
def test_templates_that_rewrite_history_late_are_refused(spark, template):
    turns = [("user", f"t{i}") for i in range(80)]
    with pytest.raises(chat.HistoryRewritten):
        list(chat.turn_outputs(turns, template))
    with pytest.raises(Exception, match="HistoryRewritten"):
        chat.formatted(spark.createDataFrame([(1, i, *t) for i, t in enumerate(turns)], "conv_id long, turn long, role string, text string"), template).collect()


def test_conversations(spark, small):
    rows = [r.asDict() for r in spark.read.parquet(f"{small}/conversations.parquet").collect()]
    rows += [{"conv_id": -7, "turn": i, "role": role, "text": "</s>[INST] ok [/INST]"} for i, role in enumerate(("user", "assistant"))]
    by = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        by.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    found = {r["conv_id"]: r for r in QUERIES["op5_chat_formatting"](spark, small).collect()}
    assert found.keys() == by.keys()
    for key, turns in by.items():
        r, learnt = found[key], "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(learnt) and r["formatted_chars"] == len(chat.render(turns))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()


def test_odd_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, piece string, start int"
    rows = [(1, 1, "assistant", None, "x", 1), (1, 0, None, "q", "x", 1), (1, 1, "assistant", None, "x", 1), (None, None, "user", "n", "x", 1), (2, 0, "user", "y" * 300_000, "x", 1)]
    found = {r["conv_id"]: r for r in chat.conversation_digests(chat.formatted(spark.createDataFrame(rows, schema))).collect()}
    assert found[1]["n_turns"] == 3 and found[1]["loss_chars"] == 0 and found[None]["n_turns"] == 1
    assert found[2]["formatted_chars"] == len(chat.render([("user", "y" * 300_000)]))
    assert chat.conversation_digests(chat.formatted(spark.createDataFrame([], schema))).collect() == []


@pytest.mark.parametrize("kind", ["smallint", "decimal(9,2)", "date", "binary", "boolean"])
def test_keys_of_any_type(spark, kind):
    keys = {"date": "DATE '2024-01-02'", "boolean": "true", "binary": "X'01'"}
    rows = spark.sql(f"SELECT CAST({keys.get(kind, '7')} AS {kind}) AS conv_id, t AS turn, 'user' AS role, 'hi' AS text FROM VALUES (0), (1) v(t)")
    found = chat.conversation_digests(chat.formatted(rows)).collect()
    assert [(r["conv_id"], r["n_turns"]) for r in found] == [(rows.first()["conv_id"], 2)]


# ---- pieces -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_equal_the_library(library):
    random.seed(9)
    parts = ["a", "th", "er", " ", "  ", "   ", "\n", "▁", "é", "ß", "😀", "\0", "\t", "1", "42", "<s>", "</s>", "<0x0A>", "ing", "ﬁ", "中", "İ", "́", "--", "_x", "²", "//", " the"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    texts += [" " * n for n in range(40)] + ["a" * 5000, "ab" * 5000, "\n" * 50]
    assert encode(texts, piece_vocabulary(), end=False) == [library.encode(t) for t in texts]


def test_documents_round_trip(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in piece_digests(docs, piece_vocabulary()).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_eos=True)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_pieces(spark, library):
    texts = [None, "", " ", "  x ", "▁▁", "x" * 200_000, "\0"]
    rows = spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(texts)] + [(1, "", 1, "k"), (None, "n", 1, "k")], "doc_id long, text string, ids int, key string")
    found = decoded(encoded(rows, piece_vocabulary()), piece_vocabulary()).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        text = "n" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode(text, add_eos=True) and r["text"] == library.decode(r["ids"])
    assert encoded(rows.limit(0), piece_vocabulary()).collect() == []
    bytes_only = [library.piece_to_id(f"<0x{b:02X}>") for b in (0xFF, 0x41, 0xE2, 0x98)]
    assert decoded(spark.createDataFrame([(1, bytes_only), (2, None)], "doc_id long, ids array<int>"), piece_vocabulary()).orderBy("doc_id").collect()[0]["text"] == library.decode(bytes_only)


def test_one_worker_encodes_and_decodes(spark, library):
    texts = [None, "", "  x ", "▁", "a" * 3000, "bc"]
    rows = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)] + [(1, "", "k"), (None, "n", "k")], "doc_id long, text string, key string")
    found = piece_digests(rows, piece_vocabulary())
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    twice = decoded(encoded(rows, piece_vocabulary()), piece_vocabulary())
    assert sorted(read_back(rows, piece_vocabulary()).collect(), key=str) == sorted(twice.collect(), key=str)
    assert found.count() == len(texts) + 2


def test_workers_give_freed_memory_back():
    def resident():
        return int(Path("/proc/self/statm").read_text().split()[1]) * resource.getpagesize() >> 20

    before = resident()
    parts = [b"x" * 60_000 for _ in range(3000)]
    del parts[:-1]  # what stays lies above all that is free
    assert list(slices(iter([]))) == [] and resident() < before + 60 and parts


# ---- neighbours ---------------------------------------------------------------------------------


def exact(rows, queries, k):
    out = {}
    for key, v in queries:
        scored = sorted(((-float(np.dot(v, w)), other) for other, w in rows if other != key))
        out[key] = [other for _, other in scored[:k]]
    return out


def test_recall(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in vectors.collect()]
    wanted = exact(rows, [r for r in rows if r[0] % 20 == 0], 20)
    found = {}
    for r in QUERIES["op7_nearest_neighbours"](spark, small).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
        assert r["score"] == pytest.approx(float(dict(rows)[r["query_id"]] @ dict(rows)[r["vec_id"]]), abs=1e-12)
    assert found.keys() == wanted.keys() and all(sorted(f) == list(range(1, 21)) for f in found.values())
    assert np.mean([len(set(found[q].values()) & set(w)) / 20 for q, w in wanted.items()]) >= 0.9


@pytest.mark.parametrize("varied", ["norms", "clusters"])
def test_recall_of_unseen_queries(spark, varied):
    """Queries outside the sample, on inner products that norms decide, and on clusters."""
    drawn = np.random.default_rng(3)
    x = drawn.normal(size=(6000, 32))
    if varied == "norms":
        x *= np.exp(drawn.normal(size=(6000, 1))) / np.linalg.norm(x, axis=1, keepdims=True)
    else:
        x += 2 * drawn.normal(size=(60, 32))[drawn.integers(0, 60, 6000)]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in nearest(frame, frame.where("vec_id % 20 = 0"), 20, sample_size=1000).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    scores = x[::20] @ x.T
    scores[np.arange(300), np.arange(0, 6000, 20)] = -np.inf
    wanted = np.argsort(-scores, axis=1)[:, :20]
    assert len(found) == 300
    assert np.mean([len(found[20 * i] & set(w.tolist())) / 20 for i, w in enumerate(wanted)]) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, 0.0]) for i in range(60)] + [(i, [0.0, float(i)]) for i in range(60, 64)]
    bad = [(100, None), (101, [0.0, 0.0]), (102, [1.0, None]), (103, [nan, 1.0]), (104, [inf, 1.0]), (105, [1.0]), (None, [1.0, 1.0]), (106, [])]
    rows = spark.createDataFrame([(k, v, 1, "x") for k, v in good + bad], "vec_id long, embedding array<double>, part int, key string")
    found = {}
    for r in nearest(rows, rows.where("vec_id in (40, 63, 100, 101)"), 20).orderBy("rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == {40: list(range(20)), 63: [62, 61, 60, *range(17)]}
    few = rows.where("vec_id < 3")
    assert sorted((r["query_id"], r["vec_id"]) for r in nearest(few, few, 20).collect()) == [(a, b) for a in range(3) for b in range(3) if a != b]
    assert nearest(rows.limit(0), rows, 20).collect() == [] and nearest(rows, rows.limit(0), 20).collect() == []


# ---- pages ----------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header><h1>Site name</h1></header>
<nav class="menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="cookie-notice"><p>We use cookies here.</p></div>
<article><h1>Title &amp; more</h1><p>First  line<br>of a &lt;long&gt; paragraph, with words.<p>Second one<!-- no --> with <a href=x>a link</a> in it, and more words.</p>
<div class="ad">Buy this now</div></article><div class="comments"><div class="comment"><b>Jo</b><p>Nice text, thank you for that.</p></div></div>
<aside class="sidebar"><h3>Related</h3><ul><li><a href=y>Other</a></li></ul></aside><footer>&copy; someone</footer></body></html>"""


def test_a_page():
    text = next(pages.main_texts([PAGE], pages.fitted()))
    assert text == "Title & more\nFirst line of a <long> paragraph, with words.\nSecond one with a link in it, and more words."


def test_generated_layouts_are_told_apart():
    layouts = pages._Layouts(77)
    right = said = 0
    for _ in range(120):
        nodes, holds = pages._labelled(layouts.page())
        table = pages.features(nodes)
        scores = pages.fitted().score(table)
        kept = pages.decode(nodes, np.where(table[:, 0] == 0, 0.0, scores))
        right += int((kept == holds)[table[:, 0] > 0].sum())
        said += int((table[:, 0] > 0).sum())
        assert all(kept[n.parent] for n, k in zip(nodes, kept) if k and n.parent >= 0)
    assert right / said > 0.99


def test_decoding_is_the_best_consistent_choice():
    random.seed(3)
    for _ in range(60):
        nodes = [pages.Element("div", -1)] + [pages.Element("div", random.randrange(i)) for i in range(1, 9)]
        scores = np.array([random.uniform(-2, 2) for _ in nodes])
        best = max(
            (sum(s if (m >> i) & 1 else -s for i, s in enumerate(scores)) for m in range(1 << len(nodes)) if all(n.parent < 0 or not (m >> i) & 1 or (m >> n.parent) & 1 for i, n in enumerate(nodes)))
        )
        kept = pages.decode(nodes, scores)
        assert sum(np.where(kept, scores, -scores)) == pytest.approx(best)


def test_pages_of_the_table(spark, small):
    found = QUERIES["op9_html_extraction"](spark, small).join(spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html"), "page_id").collect()
    for r in found:
        inside = r["html"].split("<article>")[1].split("</article>")[0]
        nodes = pages.parse(inside)
        assert r["text"] == pages.kept_text(nodes, np.ones(len(nodes), bool)) and r["n_chars"] == len(r["text"])


def test_odd_pages(spark):
    odd = [None, "", "no tags at all", "<p>", "<div" * 50, "</div></p>", "<script>x", "<!-- open", "&amp;", "<p>" * 3000 + "x", "<b>" * 3000]
    rows = spark.createDataFrame([(i, f"u{i}", h, "t", 1) for i, h in enumerate(odd)] + [(0, None, None, "t", 1)], "page_id long, url string, html string, text string, key int")
    found = pages.extracted(rows).collect()
    assert len(found) == len(odd) + 1 and {r["text"] for r in found if r["page_id"] in (0, 1, 3, 5)} == {""}
    assert pages.extracted(rows.limit(0)).collect() == []


def test_boosted_trees_learn():
    random_state = np.random.default_rng(1)
    x = random_state.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((fit(x, y).score(x) > 0) == y).mean() > 0.95


# ---- pipeline ---------------------------------------------------------------------------------------


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    extra = spark.createDataFrame([(10**6, None, None, "s", 0), (10**6 + 1, "12 34 !!", "en", "s", 8), (10**6 + 2, docs.first()["text"], "en", "s", 1)], docs.schema)
    given = docs.union(extra)
    stages = dict(corpus_pipeline.STAGES)
    spoken = stages["language_id"](spark, given, small)
    assert spoken.columns == columns and {r[0] for r in given.select("doc_id").collect()} - {r[0] for r in spoken.select("doc_id").collect()} == {10**6, 10**6 + 1}
    single = stages["near_duplicates"](spark, spoken, small)
    ids = {r[0] for r in single.select("doc_id").collect()}
    assert docs.first()["doc_id"] in ids and 10**6 + 2 not in ids and single.columns == columns
    clean = stages["decontamination"](spark, single, small)
    leaks = {r[0] for r in QUERIES["op2_benchmark_decontamination"](spark, small).where("contaminated").select("doc_id").collect()}
    assert {r[0] for r in clean.select("doc_id").collect()} == ids - leaks
    private = stages["personal_data"](spark, clean, small)
    assert private.columns == columns and private.count() == clean.count()
    assert private.where(F.col("text").rlike(r"[a-z0-9]@[a-z0-9-]+\.[a-z]")).count() == 0
    assert stages["sentencepiece"](spark, private, small).count() == clean.count()


def test_stages_decide_by_row(spark, small):
    """Null ids and repeated ids: one row of each class stays, and a bad text takes no other text of its id along."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    words = lambda c: " ".join(f"{c}{'abcdefghij'[i % 10]}{'klmnopq'[i % 7]}" for i in range(60))
    leak = spark.read.parquet(f"{small}/benchmark.parquet").where("length(text) > 100").first()["text"]
    rows = [(None, "12 34"), (1, "56 78"), (1, words("x")), (1, words("x")), (2, words("x")), (None, words("y")), (None, words("y")), (3, words("z")), (None, leak), (3, leak)]
    given = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], docs.schema)
    stages = dict(corpus_pipeline.STAGES)
    texts = lambda frame: sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=repr)
    assert texts(stages["language_id"](spark, given, small)) == sorted(rows[2:], key=repr)
    single = stages["near_duplicates"](spark, given.where("length(text) > 20"), small)
    assert texts(single) == sorted([(1, words("x")), (None, words("y")), (3, words("z")), (3, leak)], key=repr) and single.columns == docs.columns
    assert texts(stages["decontamination"](spark, given, small)) == sorted(rows[:8], key=repr)


def test_language_stage_sends_a_text_once(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("score", F.lit(7)).withColumn("lang_pred", F.lit("x"))
    sent, plain = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a, **k: sent.append(self.dtypes) or plain(self, *a, **k))
    found = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, small)
    assert [kind for _, kind in sent[0]] == [kind for _, kind in docs.dtypes] and found.schema == docs.schema
    spoken = QUERIES["op3_language_id"](spark, small).where("lang_pred <> 'und'").select("doc_id")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.join(spoken, "doc_id").select(docs.columns).collect()))


def test_stages_leave_unlisted_rows_in_place_and_drop_what_is_done(spark, monkeypatch):
    """Only rows that may be listed meet the lists of copies and spans; tables of a finished step are deleted."""
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(200)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*texts, texts[3], texts[3], f"{texts[5]} mail a.b@ex.org"])] + [(None, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    met, plain = [], type(docs).join

    def join(self, other, *args, **kwargs):
        if {"_key", "_spans"} & set(other.columns):
            met.append(self.count())
        return plain(self, other, *args, **kwargs)

    monkeypatch.setattr(type(docs), "join", join)
    folder = Path(f"{checkpoint_root(spark)}/voxframe-{spark.sparkContext.applicationId}".removeprefix("file:"))
    before = set(folder.glob("*"))
    stages = dict(corpus_pipeline.STAGES)
    single = stages["near_duplicates"](spark, docs, "")
    assert sorted((tuple(r) for r in single.collect()), key=repr) == sorted((r for r in rows if r[0] not in (200, 201, 202)), key=repr)
    clean = stages["personal_data"](spark, docs, "")
    masked = {202: f"{texts[5]} mail [EMAIL]"}
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == {i: masked.get(i, t) for i, t, *_ in rows} and clean.schema == docs.schema
    assert len(met) == 3 and max(met) < 40
    left = {p.name[: -len(uuid.uuid4().hex) - 1] for p in set(folder.glob("*")) - before}
    assert left == {"pipeline-classes", "pipeline-rows", "privacy-spans"}


def test_run_and_empty_table(spark, small):
    assert corpus_pipeline.run(spark, small).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).collect() == [], name
