"""Approximate nearest neighbours by learned partitions.

On a bounded sample, partly of the longest vectors, the graph of nearest neighbours by inner product is cut into balanced parts. A small network learns
the part of a vector from its direction and norm and files every vector; a second one learns in which parts, so filed, the
nearest of a query lie, and sends a query to its several likeliest ones, where candidates are compared by their exact inner
products. Parts are split into blocks of bounded size,
so one part with very many vectors, or very many queries, is no task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxframe.session import materialize

#: Vectors that the graph and the networks are fitted on: so many by hash, and as many of the longest, which are nearest
#: to most queries where norms differ.
SAMPLE = 4096
#: Neighbours of a vector in the graph.
DEGREE = 16
#: Vectors of a part, about; parts, at least and at most, as powers of two.
PART_SIZE, LEAST_PARTS, MOST_PARTS = 1000, 8, 64
#: Steps of a fit, at least, also on a small sample.
STEPS = 200
#: A query goes to its likeliest parts until this share of its neighbours is met there, as measured on unseen queries.
MASS = 0.96
#: Vectors in a block of candidates, and queries in a block.
BLOCK, QUERIES = 16_384, 4096
#: Tasks that the parts of one block of queries are dealt to.
LANES = 8


@dataclass(frozen=True)
class Network:
    """A network with one hidden layer; ``parts`` outputs."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0.0) @ self.w2 + self.b2


@dataclass(frozen=True)
class Router:
    """Two networks: one files a vector by its direction and norm, one sends a query by its direction."""

    filer: Network
    sender: Network
    middle: float
    spread: float
    enough: float  # expected share of its neighbours up to which a query is sent on

    def logits(self, vectors: np.ndarray, filing: bool) -> np.ndarray:
        return (self.filer if filing else self.sender).logits(features(vectors, self.middle, self.spread, filing))


def directions(vectors: np.ndarray) -> np.ndarray:
    with_scale = vectors / np.maximum(np.abs(vectors).max(axis=1, keepdims=True, initial=0.0), 1e-300)  # squares neither vanish nor overflow
    return with_scale / np.maximum(np.linalg.norm(with_scale, axis=1, keepdims=True), 1e-300)


def log_norms(vectors: np.ndarray) -> np.ndarray:
    largest = np.maximum(np.abs(vectors).max(axis=1, initial=0.0), 1e-300)
    return np.log(largest) + np.log(np.maximum(np.linalg.norm(vectors / largest[:, None], axis=1), 1e-300))


def features(vectors: np.ndarray, middle: float, spread: float, with_norm: bool) -> np.ndarray:
    """Directions, and the norm on a logarithmic scale; the order of inner products with a query does not depend on its norm."""
    norm = np.clip((log_norms(vectors) - middle) / spread, -4, 4) if with_norm else np.zeros(len(vectors))
    return np.column_stack([directions(vectors) * np.sqrt(vectors.shape[1]), norm])


def neighbour_graph(sample: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Indices of the nearest others of every sampled vector, by inner product."""
    x = directions(sample)
    degree = min(degree, len(x) - 1)
    out = np.empty((len(x), degree), np.int64)
    for at in range(0, len(x), 512):
        scores = x[at : at + 512] @ sample.T
        scores[np.arange(len(scores)), at + np.arange(len(scores))] = -np.inf
        out[at : at + 512] = np.argpartition(-scores, degree - 1, axis=1)[:, :degree] if degree else 0
    return out


def balanced_parts(graph: np.ndarray, vectors: np.ndarray, parts: int) -> np.ndarray:
    """Cut a graph into ``parts`` of equal size, halving along the second eigenvector and then swapping across the cut."""
    label = np.zeros(len(graph), np.int64)
    source = np.repeat(np.arange(len(graph)), graph.shape[1])
    target = graph.ravel()
    width = 1
    while width < parts:
        for part in range(width):
            members = np.flatnonzero(label == part)
            if len(members) > 1:
                place = np.full(len(graph), -1)
                place[members] = np.arange(len(members))
                inside = (label[source] == part) & (label[target] == part)
                upper = _half(place[source[inside]], place[target[inside]], len(members), vectors[members])
                label[members[upper]] = part + width
        width *= 2
    return label


def _half(a: np.ndarray, b: np.ndarray, n: int, vectors: np.ndarray) -> np.ndarray:
    """True for one half of ``n`` nodes, with few edges to the other."""
    u, v = np.concatenate([a, b]), np.concatenate([b, a])
    degree = np.bincount(u, minlength=n) + 1.0
    # starts along the direction of largest spread, so that the iteration is short and repeatable
    centred = vectors - vectors.mean(0)
    value = centred @ np.linalg.eigh(centred.T @ centred)[1][:, -1]
    for _ in range(60):
        value = value - (value * degree).sum() / degree.sum()
        value = (value + np.bincount(u, weights=value[v], minlength=n)) / degree
        value /= max(np.abs(value).max(), 1e-300)
    upper = np.zeros(n, bool)
    upper[np.argsort(value, kind="stable")[n // 2 :]] = True
    for _ in range(20):  # swap the nodes that gain most on either side
        across = np.bincount(u, weights=np.where(upper[u] != upper[v], 1.0, -1.0), minlength=n)
        up, down = np.flatnonzero(upper), np.flatnonzero(~upper)
        up, down = up[np.argsort(-across[up], kind="stable")], down[np.argsort(-across[down], kind="stable")]
        m = min(len(up), len(down))
        gain = across[up[:m]] + across[down[:m]]
        take = int((gain > 2).sum()) // 2
        if not take:
            break
        upper[up[:take]], upper[down[:take]] = False, True
    return upper


def _trained(x: np.ndarray, share: np.ndarray, hidden: int, epochs: int) -> Network:
    """Learn the ``share`` of every part from the features ``x``."""
    random = np.random.default_rng(7)
    inputs, parts = x.shape[1], share.shape[1]
    w = [random.normal(0, np.sqrt(2 / inputs), (inputs, hidden)), np.zeros(hidden), random.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    mean, square = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    step = 0
    for _ in range(max(epochs, -(-STEPS * 256 // max(len(x), 1)))):
        order = random.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            inner = np.maximum(x[rows] @ w[0] + w[1], 0)
            logits = inner @ w[2] + w[3]
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            off = (chance - share[rows]) / len(rows)
            back = (off @ w[2].T) * (inner > 0)
            step += 1
            for i, grad in enumerate((x[rows].T @ back + 1e-4 * w[0], back.sum(0), inner.T @ off + 1e-4 * w[2], off.sum(0))):
                mean[i] = 0.9 * mean[i] + 0.1 * grad
                square[i] = 0.99 * square[i] + 0.01 * grad * grad
                w[i] = w[i] - 3e-3 * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-8)
    return Network(*w)


def fit_router(sample: np.ndarray, parts: int, mass: float = MASS, hidden: int = 64, epochs: int = 12) -> Router:
    """Learn which part a vector belongs to, then in which parts, as filed by that, the nearest of a query lie.

    Every fourth query is kept out of the second fit. It tells up to which expected share a query must be sent on so that
    ``mass`` of the nearest of queries not seen before are met, and at least up to ``mass``. The sample is bounded by the caller.
    """
    norms = log_norms(sample)
    middle, spread = (float(norms.mean()), max(float(norms.std()), 1e-3)) if len(sample) else (0.0, 1.0)
    x, asked = (features(sample, middle, spread, with_norm) for with_norm in (True, False))
    if len(sample) < 8:
        share = np.full((len(sample), parts), 1 / parts)
        return Router(_trained(x, share, hidden, epochs), _trained(asked, share, hidden, epochs), middle, spread, 1.0)
    graph = neighbour_graph(sample)
    filer = _trained(x, np.eye(parts)[balanced_parts(graph, x, parts)], hidden, epochs)
    filed = np.round(filer.logits(x), 9).argmax(1)
    share = np.zeros((len(sample), parts))
    np.add.at(share, (np.repeat(np.arange(len(sample)), graph.shape[1]), filed[graph.ravel()]), 1)
    unseen = np.arange(len(sample)) % 4 == 0
    sender = _trained(asked[~unseen], share[~unseen] / graph.shape[1], hidden, epochs)
    best, expected = _expected(sender.logits(asked[unseen]))
    place = np.argsort(best, axis=1, kind="stable")  # where a part stands for a query
    before = np.column_stack([np.zeros(len(best)), expected[:, :-1]])
    nearest_parts = filed[graph[unseen]]
    met = np.take_along_axis(before, np.take_along_axis(place, nearest_parts, 1), 1)
    return Router(filer, sender, middle, spread, max(mass, float(np.nextafter(np.quantile(met, mass, method="higher"), 2.0))))


def _expected(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts from the likeliest on, and the share of the neighbours expected in each and those before it."""
    best = np.argsort(-np.round(logits, 9), axis=1, kind="stable")
    chance = np.exp(logits - logits.max(1, keepdims=True, initial=-np.inf))
    return best, np.cumsum(np.take_along_axis(chance, best, 1), 1) / chance.sum(1, keepdims=True)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    key: str = "vec_id",
    embedding: str = "embedding",
    mass: float = MASS,
    sample_size: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, <key>, score``: the ``k`` nearest of ``vectors`` found for every row of ``queries``.

    Nearness is the inner product in double precision; ties go to the smaller key. Rows with the query's own key are no
    candidates. Null vectors, zero ones, those with a null or non-finite component, and those of another length than the
    commonest in the sample take no part; neither do null keys. A query whose key is repeated is asked once. A query goes
    to at least as many parts as hold ``k`` others. Other columns are not read.
    """
    rows = _usable(vectors, key, embedding)
    drawn = rows.orderBy(F.xxhash64("key"), "key").limit(sample_size).collect()  # bounded
    lengths = [len(r["v"]) for r in drawn]
    dimension = max(set(lengths), key=lambda n: (lengths.count(n), -n)) if lengths else 1
    rows = rows.where(F.size("v") == dimension)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    drawn += rows.orderBy(norm.desc(), "key").limit(sample_size).collect()  # bounded
    some = {(r["key"], *r["v"]): r["v"] for r in drawn if len(r["v"]) == dimension}
    sample = np.array(list(some.values()), np.float64).reshape(-1, dimension)
    count = rows.count()
    parts = LEAST_PARTS
    while parts < MOST_PARTS and parts * PART_SIZE < count:
        parts *= 2
    router = fit_router(sample, parts, mass)
    filed = materialize(_routed(rows, router, True).select("key", "v", F.get("parts", 0).alias("part")), "vectors")
    sizes = {r["part"]: r["n"] for r in filed.groupBy("part").agg(F.count("*").alias("n")).collect()}  # a row per part
    asked = _usable(queries, key, embedding).where(F.size("v") == dimension).dropDuplicates(["key"])
    sent = _routed(asked, router, False, k, [sizes.get(p, 0) for p in range(parts)]).select("key", "v", F.explode("parts").alias("part"))
    # Blocks of bounded size on either side; a part's blocks meet pairwise.
    blocks = F.create_map(*[F.lit(x) for p in range(parts) for x in (p, max(1, -(-sizes.get(p, 0) // BLOCK)))])
    many = max(1, -(-queries.count() // QUERIES))
    item = F.struct("key", "v")
    left = filed.withColumn("block", F.pmod(F.xxhash64("key"), blocks[F.col("part")])).groupBy("part", "block").agg(F.collect_list(item).alias("vectors"))
    right = sent.withColumn("share", F.pmod(F.xxhash64("key"), F.lit(many))).groupBy("part", "share").agg(F.collect_list(item).alias("queries"))
    pairs = left.repartition("part", "block").join(right.hint("shuffle_hash"), "part")
    # The parts of a share of queries go to a few tasks, which pass on the nearest of all they have seen.
    pairs = pairs.select("share", F.pmod("part", F.lit(LANES)).alias("lane"), "vectors", "queries").repartition("share", "lane").sortWithinPartitions("share")
    kind = vectors.schema[key].dataType.simpleString()
    found = pairs.select("vectors", "queries", "share").mapInArrow(_comparer(k, dimension), f"query_id {kind}, key {kind}, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), "score")


def _usable(rows: DataFrame, key: str, embedding: str) -> DataFrame:
    v = F.col(embedding).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.select(F.col(key).alias("key"), v.alias("v"), fine.alias("fine")).where("fine AND key IS NOT NULL").select("key", "v")


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _routed(rows: DataFrame, router: Router, filing: bool, k: int = 0, sizes: list[int] | None = None) -> DataFrame:
    """``key, v, parts``: the likeliest parts of every vector, best first.

    One for filing; for a query as many as the router holds enough and as have, by ``sizes``, more than ``k`` vectors.
    """
    shared = rows.sparkSession.sparkContext.broadcast(router)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = shared.value
        dimension, parts = router.filer.w1.shape[0] - 1, len(router.filer.b2)
        size = np.array(sizes or [1] * parts)
        for batch in batches:
            best, expected = _expected(router.logits(_matrix(batch.column(1), dimension), filing))
            enough = np.maximum((expected < router.enough).sum(1), (np.cumsum(size[best], 1) <= k).sum(1)) + 1
            enough = np.ones(len(best), np.int64) if filing else enough
            taken = np.arange(parts) < enough[:, None]
            offsets = np.concatenate([[0], np.cumsum(taken.sum(1))])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(best[taken], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["key", "v", "parts"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, v array<double>, parts array<int>")


def _comparer(k: int, dimension: int):
    """Compare every query of a block with every vector of a block and keep the ``k`` nearest of all blocks."""

    def compared(vectors: pa.Array, queries: pa.Array) -> Iterator[tuple[object, np.ndarray, np.ndarray]]:
        number, own = (x.field("key").to_numpy(zero_copy_only=False) for x in (vectors, queries))
        x, q = _matrix(vectors.field("v"), dimension), _matrix(queries.field("v"), dimension)
        by = np.argsort(number, kind="stable")
        number, x = number[by], x[by]
        spread = np.abs(x).max() * dimension * 1e-13
        for at in range(0, len(q), 256):
            part = q[at : at + 256] @ x.T
            part[own[at : at + 256, None] == number[None, :]] = -np.inf
            kth = -np.partition(-part, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
            margin = np.abs(q[at : at + 256]).max(1) * spread
            for j in range(len(part)):
                near = np.flatnonzero((part[j] >= kth[j] - margin[j]) & (part[j] > -np.inf))
                exact = (x[near] * q[at + j]).sum(1)  # equal vectors give equal scores
                top = np.argsort(-exact, kind="stable")[:k]  # by key among equals
                yield own[at + j], number[near[top]], exact[top]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[object, tuple[np.ndarray, np.ndarray]] = {}
        share = kind = None

        def flush() -> pa.RecordBatch:
            asked = [q for q, (keys, _) in best.items() for _ in keys]
            keys, scores = (np.concatenate([b[i] for b in best.values()]) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(asked, kind), pa.array(keys, kind), pa.array(scores)], ["query_id", "key", "score"])

        for batch in batches:
            kind = batch.column(0).type.value_type.field("key").type
            for i in range(batch.num_rows):
                if batch.column(2)[i].as_py() != share:
                    if best:
                        yield flush()
                    best, share = {}, batch.column(2)[i].as_py()
                for query, keys, scores in compared(batch.column(0)[i].values, batch.column(1)[i].values):
                    if query in best:
                        keys, scores = np.concatenate([best[query][0], keys]), np.concatenate([best[query][1], scores])
                        order = np.lexsort((keys, -scores))[:k]
                        keys, scores = keys[order], scores[order]
                    best[query] = keys, scores
        if best:
            yield flush()

    return run
