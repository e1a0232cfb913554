"""The prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

from voxframe.llm.prefix_trie import conversation_trie
from voxframe.llm.queries import QUERIES


def expected(rows):
    """Nodes from ``(conv, turn, role, text)``; turns that tie must be equal."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - int(c - 5 * int(c / 5))
        made[c] = tuple(own.get(first, [])[:h]) + tuple(turns[h:])
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    out = set()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if made[c] == p)
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(frame):
    rows = [tuple(r) for r in frame.select(COLUMNS).collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def test_whole_table(spark, small):
    table = spark.read.parquet(f"{small}/conversations.parquet")
    result = QUERIES["op12_conversation_prefix_trie"](spark, small)
    assert {f.dataType.simpleString() for f in result.schema if f.name != "ends_sha256"} == {"bigint"}
    assert found(result) == expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_copies_long_and_short(spark):
    draw = random.Random(3)
    rows = []
    for c in range(-12, 60):
        if c % 11 == 3:
            continue
        size = draw.choice([1, 2, 3, 5, 8, 9, 13, 40])
        rows += [(c, t, "user" if t % 2 else "assistant", draw.choice("ab") if t > 3 or c % 3 else "é") for t in range(size)]
    rows += [(1000 + i, t, "user", "same") for i in range(40) for t in range(17)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert found(conversation_trie(frame)) == expected(rows)


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, name string, depth int, at int"
    rows = [(7, None, None, "q"), (7, 1, "user", None), (7, 1, "user", None), (None, 0, "user", "n"), (9, 0, "user", "y" * 200_000), (8, 0, "", ""), (4, 0, "user", "x")]
    frame = spark.createDataFrame([(*r, "n", 1, 2) for r in rows], schema)
    assert found(conversation_trie(frame)) == expected(rows)
    one = spark.createDataFrame([(1, 0, "user", "a")], "conv_id int, turn int, role string, text string")
    assert found(conversation_trie(one)) == expected([(1, 0, "user", "a")])
    assert found(conversation_trie(frame.limit(0))) == set()
