"""Exact near-duplicate classes by an n-gram Jaccard join over token-combination prefixes.

A document is its set of word shingles. Two sets of similarity ``threshold`` differ by at most ``e = n - ceil(threshold *
n)`` members of either, so under one global order of shingles (seen once, rare, frequent; by hash within) it is enough to
index a prefix that survives the loss of any ``e`` members:

* a shingle seen once in all documents links nothing, takes up a place of the prefix and is not indexed;
* a rare shingle is indexed alone;
* frequent shingles fall into hash classes and are indexed as pairs within a class. A class with ``c`` of them survives
  the loss of ``c - 2``, so the prefix is extended by one for every class it touches. The number of classes grows with the
  set, which keeps the pairs of a set linear in its size; sets of neighbouring size levels share one numbering.

What two sets must share follows from their sizes, and what their prefixes may lose from that; a key beyond either prefix
makes no pair. So sets of one size meet in much shorter prefixes than the index has to hold for smaller partners.

Sets with equal members are one node from the start. Nodes that share an index key are first compared with a few leaders
of the key; keys whose nodes are connected after that are done, the others are compared across the components only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.llm.chunks import chunked, each_chunk, give_back, gram_hashes, kinds_of, mixed, pack_sorted, text_buffers, unpack_sorted, with_answers, word_bounds, word_hashes
from voxframe.llm.graphs import components
from voxframe.session import in_few_tasks, materialize, passing

SHINGLE_WORDS = 5
#: Share, in hundredths, of the union that must be common.
THRESHOLD = 75
#: A shingle in more documents than this is frequent.
RARE = 64
#: Rounds of comparing with leaders, and leaders of a key in each; they save comparisons and change no result.
_ROUNDS = 2
_LEADERS = 4
#: Postings for each task that compares members; it has no more than a few pairs for each of them.
_TASK_POSTINGS = 100_000
_SMALLEST_LEVEL = 32  # smaller sets index frequent shingles alone


def _levels(threshold: int) -> np.ndarray:
    """First set size of each level: similar sets are of the same or of neighbouring levels."""
    first = [_SMALLEST_LEVEL]
    while first[-1] < 1 << 40:
        first.append(first[-1] * 100 // threshold + 1)
    return np.array(first)


def shingle_sets(documents: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all documents end to end, and the offsets of the documents."""
    data, offsets = text_buffers(documents.column("text"))
    upper = (data >= 65) & (data <= 90)
    data = data + (upper.astype(np.uint8) << 5)
    starts, ends, owner = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    n = len(offsets) - 1
    count = np.bincount(owner, minlength=n)
    first = np.cumsum(count) - count
    grams = gram_hashes(hashes, words)
    whole = owner[: len(grams)] == owner[words - 1 :] if len(grams) else np.zeros(0, bool)
    values, owners = [grams[whole]], [owner[: len(grams)][whole]]
    short = np.flatnonzero((count > 0) & (count < words))
    for size in np.unique(count[short]):
        at = first[short[count[short] == size]]
        value = np.zeros(len(at), np.uint64)
        for i in range(size):
            value = gram_hashes(np.stack([value, hashes[at + i]], 1).ravel(), 2)[::2]
        values.append(mixed(value + np.uint64(size)))
        owners.append(owner[at])
    value, own = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, own))
    value, own = value[order], own[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
    value, own = value[keep], own[keep]
    return value, np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n))])


def _set_id(value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One number for each set, from two sums over its members; 0 for the empty set."""
    if not len(value):
        return np.zeros(len(offsets) - 1, np.int64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(value), dtype=np.uint64)])
    other = np.concatenate([[np.uint64(0)], np.cumsum(mixed(value ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    size = np.diff(offsets)
    a, b = np.diff(total[offsets]), np.diff(other[offsets])
    return np.where(size > 0, mixed(a ^ mixed(b + size.astype(np.uint64))).view(np.int64), 0)


def index_keys(value: np.ndarray, kind: np.ndarray, threshold: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of one set from its members and their classes (0 once, 1 rare, 2 frequent).

    With each key comes the loss that the prefix before it survives: a prefix that is to survive ``lose`` members ends
    with the last key whose number is no larger.
    """
    n = len(value)
    lose = n - -(-threshold * n // 100)
    ranked = np.lexsort((value, kind))
    once, rare = int((kind == 0).sum()), int((kind < 2).sum())
    if once > lose:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, before = [value[ranked[once : min(rare, lose + 1)]]], [np.arange(once, min(rare, lose + 1))]
    if rare <= lose:
        common = value[ranked[rare:]]
        level = int(np.searchsorted(levels, n, side="right")) - 1
        if level < 1:  # singly, for similar sets below the first level
            keys.append(common[: lose + 1 - rare])
            before.append(np.arange(rare, rare + len(keys[-1])))
        for scheme in (level, level + 1):
            if scheme >= 0 and (level >= 0 or n * 100 // threshold >= levels[0]):
                pairs, survived = _full_pairs(common, rare, lose, int(levels[scheme]) // 4, scheme)
                keys.append(mixed(pairs))
                before.append(survived)
    return np.concatenate(keys), np.concatenate(before)


def _full_pairs(common: np.ndarray, rare: int, lose: int, classes: int, scheme: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within hash classes of the shortest prefix that survives the loss of ``lose`` members.

    Also tells the loss that the prefix before the later member of each pair survives.
    """
    cell = (mixed(common + np.uint64(scheme + 1)) % np.uint64(classes)).astype(np.int64)
    _, at = np.unique(cell, return_index=True)
    fresh = np.ones(len(cell), np.int64)
    fresh[at] = 0  # the first of a class adds nothing
    survives = rare + np.cumsum(fresh)
    enough = np.flatnonzero(survives >= lose + 1)
    if not len(enough):
        raise ValueError("a set is too small for its number of classes")
    end = int(enough[0]) + 1
    before = np.append(rare, survives[:-1])
    order = np.argsort(cell[:end], kind="stable")
    cell, members, before = cell[order], common[order], before[order]
    pairs, survived, step = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 1
    while step < end:
        same = cell[step:] == cell[:-step]
        if not same.any():
            break
        pairs.append(((members[:-step][same] * np.uint64(3)) ^ mixed(members[step:][same])) + np.uint64(scheme))
        survived.append(before[step:][same])
        step += 1
    return np.concatenate(pairs), np.concatenate(survived)


def near_duplicate_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, threshold: int = THRESHOLD, rare: int = RARE
) -> DataFrame:
    """``key, n_shingles, component_id`` of every row: the smallest key reachable over links.

    Words are runs of characters that are no ASCII white space, with A-Z lower-cased; a text with fewer words than a
    shingle has one, a null or blank text none: it stays alone. Repeated rows stay repeated. Rows with a null key stay,
    with a null component if they are linked with nothing else. Other columns are not read.
    """
    levels = _levels(threshold)

    def distinct(documents: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(shingle_sets(documents, words)[0], return_counts=True)

    def signed(chunk: int, documents: pa.Table, answers: list[dict] | None) -> pa.Table | None:
        value, offsets = shingle_sets(documents, words)
        kind = kinds_of(answers)[np.searchsorted(np.unique(value), value)] if len(value) else np.zeros(0, np.uint8)
        ids = _set_id(value, offsets)
        keys, before, members = [], [], []
        met: set[int] = set()
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            found, survived = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            if b > a and ids[i] not in met:  # a set that is repeated in the chunk is indexed once
                met.add(ids[i])
                found, survived = index_keys(value[a:b], kind[a:b], threshold, levels)
            keys.append(found.view(np.int64))
            before.append(survived)
            members.append(pack_sorted(value[a:b]) if len(found) else None)
        once = np.diff(np.concatenate([[0], np.cumsum(kind == 0)])[offsets])
        longs = pa.list_(pa.int64())
        return pa.table(
            {
                "key": documents.column("key").combine_chunks(),
                "set_id": pa.array(ids, pa.int64()),
                "n": pa.array(np.diff(offsets), pa.int64()),
                "once": pa.array(once, pa.int64()),
                "keys": pa.array(keys, longs),
                "survived": pa.array(before, longs),
                "members": pa.array(members, pa.binary()),
            }
        )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, set_id long, n long, once long, keys array<long>, survived array<long>, members binary"
    spark = docs.sparkSession
    with passing(spark):
        with passing(spark):
            chunks = chunked(docs, key, text, "jaccard-chunks")
            answered = with_answers(chunks, distinct, (2, rare + 1), "jaccard-counts", density=0.17)
            sets = materialize(each_chunk(answered, signed, schema, "answers"), "jaccard-sets", keep=True)
        members = sets.where("members IS NOT NULL").dropDuplicates(["set_id"])
        # What may be lost to a set no smaller; of two sets, the smaller has its key in this part of its prefix.
        own = F.expr(f"r * {100 + threshold} <= n * {100 - threshold}")
        posted = members.select("set_id", "n", "once", F.explode(F.arrays_zip(F.col("keys").alias("k"), F.col("survived").alias("r"))).alias("p"))
        postings = posted.select("set_id", "n", "once", "p.k", "p.r").withColumn("own", own)
        shared = postings.groupBy("k").agg(F.count("*").alias("times"), F.max("own").alias("any_own")).where("times > 1 AND any_own").select("k")
        held = materialize(postings.join(shared, "k"), "jaccard-postings", keep=True)
        meeting = members.select("set_id", "n", "members").join(held.select("set_id").distinct(), "set_id", "left_semi")
        members = materialize(meeting, "jaccard-members", keep=True)
        every = materialize(sets.select("key", "n", "set_id"), "jaccard-rows", keep=True)
    rows = held.count()
    found, rest = None, held.withColumn("component", F.col("set_id"))
    for turn in range(_ROUNDS):
        links = materialize(in_few_tasks(_led(rest, members, threshold, turn), rows, _TASK_POSTINGS), "jaccard-links")
        found = components(links if found is None else links.union(found)).toDF("set_id", "component")
        placed = held.join(found, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
        rest = materialize(in_few_tasks(_open(placed), rows), "jaccard-rest")
    # What is left, across components: a set that looks for smaller ones, and those listed under its keys.
    listed = rest.where("own").select("k", F.struct("n", "set_id", "r", "component").alias("y"))
    across = rest.select("k", F.struct("n", "set_id", "r", "component").alias("x")).join(listed, "k")
    smaller = "struct(y.n, y.set_id) < struct(x.n, x.set_id) AND x.component <> y.component"
    pairs = across.where(f"{smaller} AND {_may_link('x.n', 'x.r', 'y.n', 'y.r', threshold)}").select(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b"))
    more = materialize(in_few_tasks(_linked(pairs.distinct(), members, threshold), rows, _TASK_POSTINGS), "jaccard-links")
    nodes = components(more.union(found)).toDF("set_id", "component")
    rows = every.join(nodes, "set_id", "left")
    rows = rows.withColumn("class", F.when(F.col("n") > 0, F.coalesce("component", "set_id")))
    smallest = rows.where("class IS NOT NULL").groupBy("class").agg(F.min("key").alias("least"))
    out = rows.join(smallest, "class", "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("least", "key").alias("component_id"))


def _may_link(n: str, r: str, m: str, q: str, threshold: int) -> str:
    """Whether a key lies in the prefixes in which sets of ``n`` and ``m`` members that reach the threshold meet."""
    share = f"{threshold} * ({n} + {m})"
    return f"100 * least({n}, {m}) >= {threshold} * greatest({n}, {m}) AND {100 + threshold} * least({n} - {r}, {m} - {q}) >= {share}"


def _open(placed: DataFrame) -> DataFrame:
    """Postings of the keys whose nodes are in several components."""
    mixed_keys = placed.groupBy("k").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("own").alias("any_own"))
    return placed.join(mixed_keys.where("lo < hi AND any_own").select("k"), "k", "left_semi")


def _led(rest: DataFrame, members: DataFrame, threshold: int, turn: int) -> DataFrame:
    """Compare every set with a few leaders of its keys: the links found.

    The leaders of a key come from the largest component and have few members that no other document has, as the text
    that others were copied from: the fewest, and the first under a few hash orders among those with about as few.
    """
    sizes = rest.select("set_id", "component").distinct().groupBy("component").agg(F.count("*").alias("size"))
    ranked = rest.join(sizes, "component")
    own = [F.col("once") if i == 0 else F.floor(F.log2(F.col("once") + 1)) for i in range(_LEADERS)]
    orders = [F.struct(-F.col("size"), F.xxhash64("component"), own[i].alias("own"), F.xxhash64("set_id", F.lit(_LEADERS * turn + i))) for i in range(_LEADERS)]
    node = F.struct("set_id", "n", "r", "component")
    leaders = ranked.groupBy("k").agg(*[F.min_by(node, order).alias(f"l{i}") for i, order in enumerate(orders)])
    tried = rest.join(leaders, "k").select("set_id", "n", "r", "component", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"l{i}").alias("l")) for i in range(_LEADERS)])).alias("t"))
    able = tried.where(f"component <> t.l.component AND {_may_link('n', 'r', 't.l.n', 't.l.r', threshold)}")
    counted = able.groupBy("set_id", F.col("t.i").alias("i"), F.col("t.l.set_id").alias("leader")).agg(F.count("*").alias("keys"))
    best = counted.groupBy("set_id", "i").agg(F.max_by("leader", F.struct("keys", "leader")).alias("b"))
    pairs = best.select(F.greatest("set_id", "b").alias("a"), F.least("set_id", "b").alias("b")).distinct()
    return _linked(pairs, members, threshold)


def _linked(pairs: DataFrame, members: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose sets reach the threshold, compared member by member."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                n, m = batch.column(2)[i].as_py(), batch.column(4)[i].as_py()
                x, y = unpack_sorted(batch.column(3)[i].as_py(), n), unpack_sorted(batch.column(5)[i].as_py(), m)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (n + m - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])
        give_back()

    left = pairs.join(members.toDF("a", "a_n", "a_members"), "a")
    both = left.join(members.toDF("b", "b_n", "b_members"), "b").select("a", "b", "a_n", "a_members", "b_n", "b_members")
    return both.mapInArrow(verify, "a long, b long")
