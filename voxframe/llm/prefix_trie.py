"""Prefix trie of conversations by a recursion that cuts depths in halves.

A range of depths is cut at its half. The prefixes that end at a cut are named by their smallest member: members agree on
the name at the range's start and on the turns from there to the cut. The upper trie and the lower forests, which hang
from the names, are built in the next round together, so a trie of depth ``d`` takes about ``log2(d)`` rounds. Prefixes
of a single member need no names, so only shared ranges are cut further. Totals go the other way: a node knows the totals
of its own aligned range of depths, and a round doubles the range by grafting what the cut nodes below have on to the
nodes between them and the range's start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.operators.ordering import ranks_of, spread_sorted
from voxframe.session import materialize

# ---- fixed values -----------------------------------------------------------
FAMILY = 5
BORROWED = 9
# -----------------------------------------------------------------------------
_PACKED = 50_000  # member ids that one packed row holds at most
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, at, digest, n_bytes``: every turn's place from 0, a digest of its role and text, and its text's UTF-8 bytes.

    Turns go by ``turn``, nulls first, then by their digests; repeated rows are turns of their own. A null role or text is
    empty. Rows without a key belong to no conversation. Texts do not move, and a conversation may lie on many tasks.
    """
    said, told = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(said).cast("string"), F.lit(":"), said, told).cast("binary")))
    rows = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"), F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(told).cast("long").alias("n_bytes")
    )
    frame = spread_sorted(rows, "conv", F.asc_nulls_first("turn"), "digest")
    return ranks_of(frame, ["conv"], "at").select("conv", "at", "digest", "n_bytes")


def regrown(turns: DataFrame) -> DataFrame:
    """Conversations that share openings, from ``conv, at, digest, n_bytes``; one with no turn left has a row with a null ``at``.

    The first ``h`` turns come from the first conversation of the family of ``FAMILY`` keys, the others are its own from
    place ``h``; ``h`` is the crc32 of the key, modulo ``BORROWED``.
    """
    own = F.col("conv") - F.col("conv") % FAMILY
    sizes = materialize(turns.groupBy("conv").agg(F.count("*").alias("size")), "trie-sizes")
    rules = sizes.select("conv", "size", own.alias("first"), (F.crc32(F.col("conv").cast("string")) % BORROWED).alias("h"))
    given = sizes.select(F.col("conv").alias("first"), F.col("size").alias("first_size"))
    rules = rules.join(given, "first", "left").withColumn("lent", F.least("h", F.coalesce("first_size", F.lit(0))))
    rules = materialize(rules.select("conv", "first", "h", "lent", "size"), "trie-rules")
    opening = turns.where(F.col("at") < BORROWED).withColumnRenamed("conv", "first")
    lent = opening.join(rules.select("conv", "first", "lent"), "first").where("at < lent").select("conv", "at", "digest", "n_bytes")
    kept = turns.join(rules.select("conv", "h", "lent"), "conv").where("at >= h").select("conv", (F.col("at") - F.col("h") + F.col("lent")).alias("at"), "digest", "n_bytes")
    none = rules.where("lent = 0 AND size <= h").select("conv", F.lit(None).cast("long").alias("at"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n_bytes"))
    return lent.unionByName(kept).unionByName(none)


def _blocks(turns: DataFrame, rounds: int) -> list[DataFrame]:
    """For each power of two, digests of the aligned runs of that many turns: ``conv, block, digest``."""
    levels = [materialize(turns.select("conv", F.col("at").alias("block"), "digest"), "trie-blocks")]
    for _ in range(1, rounds):
        halves = levels[-1].groupBy("conv", F.shiftright("block", 1).alias("block")).agg(
            F.max(F.when(F.col("block") % 2 == 0, F.col("digest"))).alias("left"), F.max(F.when(F.col("block") % 2 == 1, F.col("digest"))).alias("right")
        )
        whole = halves.where("left IS NOT NULL AND right IS NOT NULL")
        levels.append(materialize(whole.select("conv", "block", F.unhex(F.md5(F.concat("left", "right"))).alias("digest")), "trie-blocks"))
    return levels


def shared_prefixes(turns: DataFrame) -> DataFrame:
    """``conv, depth, name, n_convs`` for every prefix that a conversation shares, from ``conv, at, digest``.

    ``name`` is the smallest member. The root is shared if there are two conversations.
    """
    spark = turns.sparkSession
    convs = materialize(turns.select("conv").distinct(), "trie-convs")
    root = convs.agg(F.min("conv").alias("name"), F.count("*").alias("n_convs")).first()
    longest = turns.agg(F.max("at")).first()[0]
    longest = 0 if longest is None else longest + 1
    rounds = longest.bit_length()
    # ranges of depths: where one starts, and the name there
    ranges = convs.where(F.lit(root["n_convs"] > 1)).select("conv", *[F.lit(v).cast("long").alias(c) for c, v in (("depth", 0), *root.asDict().items())])
    found = [materialize(ranges, "trie-shared")]
    blocks = _blocks(turns.where(F.col("at").isNotNull()), rounds)
    for level in reversed(range(rounds)):
        started = found[0]
        for more in found[1:]:
            started = started.unionByName(more)
        span = 1 << level
        left = blocks[level].where(F.col("block") % 2 == 0).select("conv", (F.col("block") * span).alias("depth"), "digest")
        at_cut = left.join(started.select("conv", "depth", "name"), ["conv", "depth"])
        at_cut = materialize(at_cut, "trie-cut")
        # written first, so that the join below has stages of its own and a very common prefix can be split in it
        names = at_cut.groupBy("depth", "name", "digest").agg(F.min("conv").alias("new"), F.count("*").alias("n_convs")).where("n_convs > 1")
        names = materialize(names, "trie-names")
        named = at_cut.join(names, ["depth", "name", "digest"])
        found.append(materialize(named.select("conv", (F.col("depth") + span).alias("depth"), F.col("new").alias("name"), "n_convs"), "trie-shared"))
    out = spark.createDataFrame([], found[0].schema)
    for part in found:
        out = out.unionByName(part)
    return out


def _grafted(nodes: DataFrame, paths: DataFrame, rounds: int) -> DataFrame:
    """``name, depth, leaves, saved`` summed over the shared nodes below each shared node, itself included.

    ``nodes`` holds each node's own values, ``paths`` the node of every conversation at every shared depth.
    """
    totals = materialize(nodes.select("name", "depth", "leaves", "saved"), "trie-totals")
    for level in range(rounds):
        half = F.shiftright("depth", level)
        cuts = totals.where((half % 2 == 1) & (F.col("depth") % (1 << level) == 0)).select(F.col("name").alias("conv"), (half - 1).alias("half"), "leaves", "saved")
        above = paths.withColumn("half", half).where(F.col("half") % 2 == 0).join(cuts, ["conv", "half"])
        gained = above.groupBy("name", "depth").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        both = totals.join(gained, ["name", "depth"], "left")
        leaves = F.col("leaves") + F.coalesce("more_leaves", F.lit(0))
        totals = materialize(both.select("name", "depth", leaves.alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "trie-totals")
    return totals


def _end_digests(ends: DataFrame) -> DataFrame:
    """``name, depth, ends_sha256`` over the members that end at a node, in order, from rows ``name, depth, conv``.

    Members are sorted over the cluster and packed into long rows, so a node of very many members is read as few rows; its
    digest is serial, and the task that makes it holds one packed row at a time.
    """
    ranged = ends.repartitionByRange("name", "depth", "conv").sortWithinPartitions("name", "depth", "conv")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"name": [node[0]], "depth": [node[1]], "first": [ids[0]], "members": [",".join(map(str, ids))]})

        for batch in batches:
            for name, depth, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (name, depth) != node or len(ids) >= _PACKED:
                    if ids:
                        yield row()
                    node, ids = (name, depth), []
                ids.append(conv)
        if ids:
            yield row()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        done: list[tuple[int, int, str]] = []

        def table() -> pa.RecordBatch:
            columns = list(zip(*done)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["name", "depth", "ends_sha256"])

        for batch in batches:
            for name, depth, members in zip(*(c.to_pylist() for c in batch.columns)):
                if (name, depth) == node:
                    state.update(b"," + members.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (name, depth), hashlib.sha256(members.encode())
            if len(done) >= 10_000:
                yield table()
                done.clear()
        if node is not None:
            done.append((*node, state.hexdigest()))
        yield table()

    packed = ranged.select("name", "depth", "conv").mapInArrow(pack, "name long, depth long, first long, members string")
    ordered = materialize(packed, "trie-members").repartition("name", "depth").sortWithinPartitions("name", "depth", "first")
    return ordered.select("name", "depth", "members").mapInArrow(digest, "name long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """The nodes of the trie over ``conv, at, digest, n_bytes``, a null ``at`` standing for a conversation without turns.

    One row per distinct prefix: ``key``, its smallest member; ``depth``; ``parent_<key>``; ``n_convs``; ``n_children``;
    ``n_leaves`` and ``saved_tokens`` of its subtree; ``ends_sha256`` of the members that end there. Saved are the bytes of
    a node's last text for every member but one. No conversations, no nodes.
    """
    turns = materialize(turns, "trie-turns")
    paths = materialize(shared_prefixes(turns), "trie-paths")
    sizes = turns.groupBy("conv").agg(F.count("at").alias("size"))
    reached = paths.groupBy("conv").agg(F.max(F.struct("depth", "name")).alias("last"))
    # the root of a lone conversation is shared by nobody
    sizes = materialize(sizes.join(reached, "conv", "left").select("conv", "size", F.coalesce("last.depth", F.lit(-1)).alias("shared"), F.col("last.name").alias("name")), "trie-ends")
    single = sizes.select("conv", "size", "shared", "name", F.explode(F.sequence(F.col("shared") + 1, "size")).alias("depth")).where("depth > shared AND depth <= size")
    # nodes with more than one member; the smallest knows the node above and the last turn
    own = paths.where("conv = name").select("name", "depth", "n_convs")
    above = paths.select(F.col("conv").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    last = turns.select(F.col("conv").alias("name"), (F.col("at") + 1).alias("depth"), "n_bytes")
    nodes = own.join(above, ["name", "depth"], "left").join(last, ["name", "depth"], "left")
    nodes = materialize(nodes.withColumn("n_bytes", F.coalesce("n_bytes", F.lit(0)).cast("long")), "trie-nodes")
    tops = single.where("depth = shared + 1 AND shared >= 0").select(F.col("name").alias("parent"), F.col("shared").alias("depth"), F.lit(1).alias("alone"))
    below = nodes.where("depth > 0").select("parent", (F.col("depth") - 1).alias("depth"), F.lit(0).alias("alone"))
    children = below.unionByName(tops).groupBy(F.col("parent").alias("name"), "depth").agg(F.count("*").alias("n_children"), F.sum("alone").alias("alone"))
    nodes = nodes.join(children, ["name", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("alone")).cast("long")
    nodes = materialize(nodes.withColumn("leaves", leaves).withColumn("saved", (F.col("n_convs") - 1) * F.col("n_bytes")), "trie-nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = _grafted(nodes, paths, deepest.bit_length())
    ends = _end_digests(sizes.where("size = shared").select("name", F.col("shared").alias("depth"), "conv"))
    parent = f"parent_{key}"
    shared = nodes.drop("leaves", "saved").join(totals, ["name", "depth"]).join(ends, ["name", "depth"], "left").select(
        F.col("name").alias(key), "depth", F.col("parent").alias(parent), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )
    ended = F.col("depth") == F.col("size")
    lone = single.select(
        F.col("conv").alias(key), "depth",
        F.when(F.col("depth") > 0, F.when(F.col("depth") == F.col("shared") + 1, F.col("name")).otherwise(F.col("conv"))).alias(parent),
        F.lit(1).cast("long").alias("n_convs"), (~ended).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(ended, F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(_NO_ENDS)).alias("ends_sha256"),
    )
    return shared.unionByName(lone)


def conversation_trie(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """The trie of the regrown conversations of a table of turns. Other columns are not read."""
    return prefix_trie(regrown(materialize(ordered_turns(conversations, key), "trie-ordered")), key)


#: DuckDB SQL for the query over the whole table. A prefix is known by the digests of its turns end to end.
TRIE_SQL = """
WITH turns AS (
    SELECT conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (
    SELECT conv, count(*) AS size, conv - conv % 5 AS first,
        xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv::VARCHAR, ''),
            lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 9 AS h
    FROM turns GROUP BY conv),
rules AS (SELECT s.*, least(s.h, coalesce(f.size, 0)) AS lent FROM sizes s LEFT JOIN sizes f ON f.conv = s.first),
rebuilt AS (
    SELECT r.conv, t.place, t.role, t.text FROM rules r JOIN turns t ON t.conv = r.first AND t.place < r.lent
    UNION ALL SELECT r.conv, t.place - r.h + r.lent, t.role, t.text FROM rules r JOIN turns t ON t.conv = r.conv AND t.place >= r.h),
steps AS (
    SELECT conv, place + 1 AS depth, octet_length(encode(text)) AS n_bytes,
        md5(string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv ORDER BY place)) AS node
    FROM rebuilt UNION ALL SELECT conv, 0, 0, 'root' FROM rules),
ends AS (SELECT conv, max(depth) AS size FROM steps GROUP BY conv),
nodes AS (
    SELECT node, depth, min(s.conv) AS conv, count(*) AS n_convs, min(n_bytes) AS n_bytes,
        sha256(coalesce(string_agg(s.conv::VARCHAR, ',' ORDER BY s.conv) FILTER (WHERE depth = size), '')) AS ends_sha256
    FROM steps s JOIN ends e ON e.conv = s.conv GROUP BY node, depth),
parents AS (SELECT n.node, p.node AS parent FROM nodes n JOIN steps p ON p.conv = n.conv AND p.depth = n.depth - 1),
children AS (SELECT parent AS node, count(*) AS n FROM parents GROUP BY parent),
totals AS (
    SELECT a.node, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.n_bytes) AS saved
    FROM nodes n LEFT JOIN children c ON c.node = n.node JOIN steps a ON a.conv = n.conv AND a.depth <= n.depth GROUP BY a.node)
SELECT n.conv::BIGINT AS conv_id, n.depth::BIGINT AS depth, q.conv::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
    t.n_leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.node = n.node LEFT JOIN children c ON c.node = n.node
LEFT JOIN parents p ON p.node = n.node LEFT JOIN nodes q ON q.node = p.parent
"""
