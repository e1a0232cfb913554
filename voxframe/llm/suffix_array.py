"""Exact removal of repeated byte strings over a Burrows-Wheeler transform.

A string of ``LENGTH`` bytes is to go from every document but the smallest that has it. Windows are grouped by their
anchor, the least hash of ``GRAM`` bytes in them, so equal windows are in one group. Anchors that only one document has
are counted out first; of the rest, the different stretches of text around each anchor go to its bucket once per chunk.
There the transform of all stretches is searched breadth first: every interval of a string is extended backwards by each
byte that precedes it, which finds the common prefixes of neighbouring suffixes by increasing length, up to ``LENGTH``.
Neighbours that no shorter string has parted by then share ``LENGTH`` bytes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.llm.chunks import answered, chunked, each_chunk, kinds_of, mixed, placed, runs_of_least, smallest_in_windows, text_buffers, with_answers, word_hashes

LENGTH = 50
GRAM = 26
#: Anchors in so many documents are split: each window around them goes to a bucket of its own.
HOT = 1000
#: Bytes of text that come to a bucket, about, and that it compares at once.
BUCKET, BATCH = 2 << 20, 1 << 20
_LAST = np.iinfo(np.int64).max
_BLOCK = 1 << 15  # windows whose hashes are made at once, in a core's cache; a multiple of the places told apart
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = mixed(np.arange(1, GRAM // 8 + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` symbols, by doubling; symbols are below 511."""
    n = len(symbols)
    known = min(depth, 7)  # seven symbols of nine bits fill a number
    padded = np.zeros(n + known, np.int64)
    padded[:n] = symbols + 1
    value = np.zeros(n, np.int64)
    for i in range(known):
        value = (value << 9) | padded[i : n + i]
    several = max(63 // (n + 2).bit_length(), 2)  # ranks that fill a number
    while True:
        order = np.argsort(value)
        if known >= depth:
            return order
        rank = np.zeros(n + several * known, np.int64)  # nothing follows the last symbol
        ranked = value[order]
        rank[order] = np.cumsum(np.diff(ranked, prepend=ranked[0]) != 0) + 1
        value, reach = rank[:n].copy(), known
        for _ in range(several - 1):
            step = min(known, depth - reach)  # from where the next rank reaches on
            if step <= 0:
                break
            at = reach - (known - step)
            value *= n + 2
            value += rank[at : at + n]
            reach += step
        known = reach


def parted_suffixes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and where in it the common prefix with the suffix before is shorter than ``length``.

    Works on the Burrows-Wheeler transform: level by level, each interval of suffixes that begin with one string of
    ``level`` symbols is extended backwards. An interval whose end is met for the first time parts two suffixes with a
    common prefix of ``level - 1`` symbols, and only such intervals are extended further.
    """
    symbols = np.append(symbols + 1, 0).astype(np.int16)  # an end below all symbols
    n = len(symbols)
    order = suffix_order(symbols, length)
    head = symbols[order]
    stable = np.argsort(symbols[order - 1], kind="stable")  # of the transform; the first suffix is preceded by the end
    back = np.empty(n, np.int32)
    back[stable] = np.arange(n, dtype=np.int32)  # where the suffix one symbol longer is
    parted = np.zeros(n + 1, bool)
    parted[0] = True
    owner = np.empty(n, np.int32)  # by place, the interval that was extended to it
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(length):
        size = high - low
        one = size == 1
        new_low = [back[low[one]].astype(np.int64)]
        new_high = [new_low[0] + 1]
        wide_low, wide = low[~one], size[~one]
        if len(wide):
            ends = np.cumsum(wide)
            member = np.arange(int(ends[-1])) + np.repeat(wide_low - ends + wide, wide)
            to = back[member]
            owner[to] = np.repeat(np.arange(len(wide), dtype=np.int32), wide)
            to.sort()  # places of one interval and one preceding symbol are neighbours
            whose, by = owner[to], head[to]
            cut = np.ones(len(to), bool)
            cut[1:] = (whose[1:] != whose[:-1]) | (by[1:] != by[:-1])
            first = np.flatnonzero(cut)
            begin = to[first].astype(np.int64)
            new_low.append(begin)
            new_high.append(begin + np.diff(np.append(first, len(to))))
        low, high = np.concatenate(new_low), np.concatenate(new_high)
        fresh = ~parted[high]
        low, high = low[fresh], high[fresh]
        parted[high] = True
        if not len(low):
            break
    return order[1:], parted[1:n]  # without the end, which comes first


def _byte_grams(data: np.ndarray) -> np.ndarray:
    """Hash of ``GRAM`` bytes from every start; the text is padded behind."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(GRAM + 16, np.uint8)])
    eight = np.empty(n + GRAM, np.uint64)
    for shift in range(8):
        part = padded[shift : shift + 8 * ((len(padded) - shift) // 8)].view(np.uint64)
        target = eight[shift::8]
        target[:] = part[: len(target)]
    out = eight[:n] * _FACTORS[0]
    for i, at in enumerate((*range(8, GRAM - 8, 8), GRAM - 8)):
        out += eight[at : at + n] * _FACTORS[i + 1]
    out ^= out >> np.uint64(32)
    out *= _FACTORS[0]  # the high bits, which are compared, depend on all
    return out


def _runs(documents: pa.Table) -> tuple[np.ndarray, ...]:
    data, offsets = text_buffers(documents.column("text"))
    valid = np.ones(max(len(data) - LENGTH + 1, 0), bool)
    for end in offsets[1:].tolist():  # windows that would leave their document
        valid[max(end - LENGTH + 1, 0) : end] = False
    least = np.empty(len(valid), np.uint64)
    for at in range(0, len(valid), _BLOCK):
        part = least[at : at + _BLOCK]
        part[:] = smallest_in_windows(placed(_byte_grams(data[at : at + _BLOCK + LENGTH - 1])), LENGTH - GRAM + 1)[: len(part)]
    anchor, first, last = runs_of_least(least, valid)
    # least hashes crowd near zero; a product spreads them over the buckets and leaves their low bits empty
    return data, offsets, anchor * _SPREAD, first, last


def _owner(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The document that each byte belongs to."""
    return np.searchsorted(offsets, at, side="right") - 1


def _stretches(documents: pa.Table, answers: list[dict] | None) -> tuple[np.ndarray, ...]:
    """The different shared stretches of a chunk, in the order of their buckets.

    Gives for every shared run its stretch, and for every stretch the route, first window, last window and smallest key.
    """
    data, offsets, anchor, first, last = _runs(documents)
    keys = documents.column("key").combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)
    kind = kinds_of(answers)[np.searchsorted(np.unique(anchor), anchor)] if len(anchor) else np.zeros(0, np.uint8)
    one = np.flatnonzero(kind == 1)
    hot = np.flatnonzero(kind == 2)
    count = last[hot] - first[hot] + 1
    single = np.repeat(first[hot], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    first, last = np.concatenate([first[one], single]), np.concatenate([last[one], single])
    content = word_hashes(data, first, last + LENGTH)
    route = np.concatenate([anchor[one], content[len(one) :]])
    # a stretch is the same if route and content are
    key = keys[_owner(offsets, first)]
    number = np.lexsort((key, content, route))
    fresh = np.ones(len(number), bool)
    r, c = route[number], content[number]
    fresh[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
    stretch = np.empty(len(number), np.int64)
    stretch[number] = np.cumsum(fresh) - 1
    head = number[fresh]  # has the smallest key
    return data, offsets, key, first, last, stretch, route[head], first[head], last[head], key[head]


def _packed(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(a.tobytes() for a in arrays), codec="zstd", asbytes=True)


def _compare(pieces: list[bytes], least: np.ndarray) -> np.ndarray:
    """The smallest key that has each window of each of these different stretches of text, end to end."""
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), np.int16)  # 0 ends a stretch
    inside = np.ones(len(symbols), bool)
    inside[starts + sizes] = False
    symbols[inside] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int16) + 1
    order, parted = parted_suffixes(symbols, LENGTH)
    whole = np.arange(len(symbols)) + LENGTH <= np.repeat(starts + sizes, sizes + 1)
    key = np.where(whole, np.repeat(least, sizes + 1), _LAST)[order]
    first = np.flatnonzero(parted)
    found = np.empty(len(symbols), np.int64)
    found[order] = np.repeat(np.minimum.reduceat(key, first), np.diff(np.append(first, len(key))))
    return found[whole]


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of every range, end to end."""
    return np.arange(int(count.sum())) + np.repeat(start - np.cumsum(count) + count, count)


def _answer(part: pd.DataFrame) -> pd.DataFrame:
    """For every stretch that a chunk sent, a bit for each window that a smaller key has as well."""
    routes, keys, texts = [], [], []
    for n, payload, size in zip(part["n"], part["payload"], part["size"]):
        raw = pa.decompress(payload, decompressed_size=int(size), codec="zstd", asbytes=True)
        routes.append(np.frombuffer(raw, np.uint64, n))
        keys.append(np.frombuffer(raw, np.int64, n, 8 * n))
        ends = np.cumsum(np.frombuffer(raw, np.uint8, n, 16 * n).astype(np.int64)) + 17 * n
        texts += [raw[a:b] for a, b in zip([17 * n, *ends[:-1].tolist()], ends.tolist())]
    route, key = np.concatenate(routes), np.concatenate(keys)
    distinct: dict[tuple[int, bytes], int] = {}
    number = np.fromiter((distinct.setdefault(x, len(distinct)) for x in zip(route.tolist(), texts)), np.int64, len(texts))
    least = np.full(len(distinct), _LAST)
    np.minimum.at(least, number, key)
    names = [text for _, text in distinct]
    groups = np.array([r for r, _ in distinct], np.uint64)
    windows = np.array([len(text) - LENGTH + 1 for text in names])
    start = np.cumsum(windows) - windows
    bound = np.repeat(least, windows)  # by window; alone, a stretch shares its windows with no other text
    by = np.argsort(groups, kind="stable")
    cuts = np.flatnonzero(np.diff(groups[by], prepend=~groups[by[0]]))
    count = np.diff(np.append(cuts, len(by)))
    text = np.add.reduceat(windows[by] + LENGTH - 1, cuts)
    cuts, count, text = cuts[count > 1], count[count > 1], text[count > 1]
    text = np.concatenate([[0], np.cumsum(text)])
    at = 0
    while at < len(cuts):  # whole groups, until a batch is full
        stop = min(int(np.searchsorted(text, text[at] + BATCH)), len(cuts))
        members = by[_ranges(cuts[at:stop], count[at:stop])]
        bound[_ranges(start[members], windows[members])] = _compare([names[i] for i in members.tolist()], least[members])
        at = stop
    masks = np.zeros(len(texts), np.uint64)
    for i in range(LENGTH - GRAM + 1):
        has = np.flatnonzero(windows[number] > i)
        less = bound[start[number[has]] + i] < key[has]
        masks[has[less]] |= np.uint64(1 << i)
    cuts = np.cumsum(part["n"].to_numpy())[:-1]
    return pd.DataFrame({"chunk": part["chunk"], "bucket": part["bucket"], "n": part["n"], "masks": [_packed(x) for x in np.split(masks, cuts)]})


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``removed array<struct<start, end>>`` and the ``kept`` bytes of every row.

    A byte goes if a string of ``LENGTH`` bytes around it also starts in a document with a smaller key. Overlaps count,
    matches never leave a document, and strings are judged on the input. A null text is empty; a null key is larger than
    all others, rows with equal keys take nothing from each other. Keys are integers; other columns are not read.
    """
    chunks = chunked(docs, key, text, "bytes-chunks")
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    width = max(int(total * 0.7) // BUCKET, 7).bit_length()

    def anchors(documents: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        _, offsets, anchor, first, _ = _runs(documents)
        keys = documents.column("key").combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False)
        pairs = np.unique(np.stack([anchor.view(np.int64), keys[_owner(offsets, first)]], 1), axis=0) if len(anchor) else np.zeros((0, 2), np.int64)
        return np.unique(np.ascontiguousarray(pairs[:, 0]).view(np.uint64), return_counts=True)

    def send(chunk: int, documents: pa.Table, answers: list[dict] | None) -> pa.Table | None:
        data, _, _, _, _, _, route, first, last, least = _stretches(documents, answers)
        if not len(route):
            return None
        bucket = (route >> np.uint64(64 - width)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        raw = data.tobytes()
        rows: dict[str, list] = {"bucket": [], "chunk": [], "n": [], "size": [], "payload": []}
        for a, b in zip(cuts, [*cuts[1:], len(route)]):
            texts = b"".join(raw[f : e + LENGTH] for f, e in zip(first[a:b].tolist(), last[a:b].tolist()))
            sizes = (last[a:b] - first[a:b] + LENGTH).astype(np.uint8)
            rows["bucket"].append(int(bucket[a]))
            rows["chunk"].append(chunk)
            rows["n"].append(int(b - a))
            rows["size"].append(17 * int(b - a) + len(texts))
            rows["payload"].append(_packed(route[a:b], least[a:b], sizes, np.frombuffer(texts, np.uint8)))
        kinds = [("bucket", pa.int64()), ("chunk", pa.int64()), ("n", pa.int32()), ("size", pa.int64()), ("payload", pa.binary())]
        return pa.table(rows, pa.schema(kinds))

    def cut(chunk: int, documents: pa.Table, answers: list[dict] | None, masks: list[dict] | None) -> pa.Table:
        data, offsets, key, first, last, stretch, _, _, _, least = _stretches(documents, answers)
        bits = np.zeros(len(least), np.uint64)
        if masks:
            bits = np.concatenate([np.frombuffer(pa.decompress(m["masks"], decompressed_size=8 * m["n"], codec="zstd", asbytes=True), np.uint64) for m in masks])
        smallest = key == least[stretch]
        hit = np.where(smallest, bits[stretch], ~np.uint64(0))  # all windows, if a smaller key in the chunk has them
        covers = np.zeros(len(data), np.int32)
        for i in range(LENGTH - GRAM + 1):
            covers[first[((hit >> np.uint64(i)) & np.uint64(1) == 1) & (first + i <= last)] + i] = 1
        covers = np.cumsum(covers, dtype=np.int32)  # windows that are to go, up to each start
        gone = covers > 0
        gone[LENGTH:] = covers[LENGTH:] > covers[:-LENGTH]
        edge = np.zeros(len(data) + 1, bool)  # a removed run ends with its document
        edge[offsets] = True
        turn = np.diff(gone, prepend=False)
        starts = np.flatnonzero(gone & (turn | edge[:-1]))
        ends = np.flatnonzero(gone & (np.append(turn[1:], True) | edge[1:])) + 1 if len(data) else starts
        home = _owner(offsets, starts)
        base = offsets[home]
        spans = pa.StructArray.from_arrays([pa.array(starts - base, pa.int64()), pa.array(ends - base, pa.int64())], ["start", "end"])
        cuts = np.concatenate([[0], np.cumsum(np.bincount(home, minlength=len(offsets) - 1))]).astype(np.int32)
        left = data[~gone]
        lengths = np.concatenate([[0], np.cumsum(~gone)])[offsets]
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(lengths.astype(np.int64).tobytes()), pa.py_buffer(left.tobytes())])
        return pa.table({"key": documents.column("key"), "n_bytes": pa.array(np.diff(offsets), pa.int64()), "removed": pa.ListArray.from_arrays(pa.array(cuts), spans), "kept": kept.cast(pa.binary())})

    counted = with_answers(chunks, anchors, (2, HOT), "bytes-anchors", density=0.08)
    sent = each_chunk(counted, send, "bucket long, chunk long, n int, size long, payload binary", "answers")
    told = answered(counted, sent, _answer, "masks", "masks", "bytes-windows")
    kind = docs.schema[key].dataType.simpleString()
    out = each_chunk(told, cut, f"key {kind}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary", "answers", "masks")
    return out.withColumnRenamed("key", key)


def repeat_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sizes and digest of what ``without_repeats`` leaves of every document."""
    return without_repeats(docs, key, text).select(
        key,
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
