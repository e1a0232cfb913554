"""Exact removal of repeated word sequences over prefix-partitioned suffix trees.

A sequence of ``WINDOW`` words stays where it starts first and goes everywhere else. Only suffixes whose window may be
repeated take part: windows are anchored at their least hash of ``GRAM`` words, and anchors that occur once are counted
out. The remaining suffixes, made distinct within a chunk, are dealt out by their prefix: by its first symbol of five
words, and by two or all four symbols where the text is frequent, so that no group outgrows its task. Each task sorts its
suffixes into a tree; an internal node as deep as a window is a repeat, whose first occurrence is kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.llm.chunks import anchored_runs, answered, chunked, each_chunk, gram_hashes, kinds_of, mixed, text_buffers, with_answers, word_bounds, word_hashes

WINDOW = 20
GRAM = 10
SYMBOL = 5
DEPTH = WINDOW // SYMBOL
#: An anchor that occurs so often makes its suffixes' prefixes one, two or four symbols long.
CLASSES = (2, 1024, 32_768)
_PREFIX = (0, 1, 2, DEPTH)
#: Suffixes that one task sorts on average.
GROUP = 1_000_000
_LAST = np.iinfo(np.int64).max


def _windows(documents: pa.Table) -> tuple[np.ndarray, ...]:
    """Words of a chunk, and anchor and content of all windows."""
    data, offsets = text_buffers(documents.column("text"))
    starts, ends, owner = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    n = max(len(words) - WINDOW + 1, 0)
    valid = owner[:n] == owner[WINDOW - 1 :] if n else np.zeros(0, bool)
    anchor, first, last = anchored_runs(gram_hashes(words, GRAM), WINDOW - GRAM + 1, valid)
    count = last - first + 1
    at = np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    content = gram_hashes(words, WINDOW)[at] if len(at) else np.zeros(0, np.uint64)
    return data, offsets, starts, ends, owner, words, anchor, np.repeat(np.arange(len(anchor)), count), at, content


def _occurrences(documents: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of a chunk and how often each occurs; windows that are equal within a run count as well."""
    *_, anchor, run, _, content = _windows(documents)
    if not len(anchor):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    order = np.argsort(content, kind="stable")
    again = np.zeros(len(content), bool)
    again[order[1:]] = content[order[1:]] == content[order[:-1]]
    more = np.bincount(run[again], minlength=len(anchor))
    values, inverse = np.unique(anchor, return_inverse=True)
    return values, np.bincount(inverse, weights=1 + more).astype(np.int64)


def _suffixes(documents: pa.Table, answers: list[dict] | None) -> tuple[np.ndarray, ...]:
    """Candidate windows of a chunk, and its different suffixes in the order of their routes."""
    data, offsets, starts, ends, owner, words, anchor, run, at, content = _windows(documents)
    keys = documents.column("key").combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)
    kind = kinds_of(answers)[np.searchsorted(np.unique(anchor), anchor)] if len(anchor) else np.zeros(0, np.uint8)
    level = kind[run]
    keep = level > 0
    at, content, level = at[keep], content[keep], level[keep]
    before = np.searchsorted(owner, np.arange(len(offsets) - 1))  # the first word of each document
    key, start = keys[owner[at]], at - before[owner[at]]
    order = np.lexsort((start, key, content))
    fresh = np.ones(len(order), bool)
    fresh[1:] = content[order[1:]] != content[order[:-1]]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    head = order[fresh]
    symbols = (gram_hashes(words, SYMBOL)[at[head][:, None] + SYMBOL * np.arange(DEPTH)] >> np.uint64(32)).astype(np.uint32) if len(head) else np.zeros((0, DEPTH), np.uint32)
    route = np.zeros(len(head), np.uint64)
    length = np.array(_PREFIX)[level[head]]
    for i in range(DEPTH):
        route = np.where(i < length, mixed(route * np.uint64(31) + symbols[:, i] + np.uint64(1)), route)
    by = np.argsort(route, kind="stable")
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    head = head[by]
    return data, offsets, starts, ends, owner, at, key, start, place[group], route[by], symbols[by], key[head], start[head]


def _packed(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), codec="zstd", asbytes=True)


def repeated_suffixes(symbols: np.ndarray, key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which suffixes are not the first, by key and start, below a node as deep as all symbols.

    Neighbours in sorted order part at the first symbol that differs; nodes are the runs that stay together to the end.
    """
    order = np.lexsort((start, key, *(symbols[:, i] for i in reversed(range(symbols.shape[1])))))
    sorted_symbols = symbols[order]
    common = np.cumprod(sorted_symbols[1:] == sorted_symbols[:-1], axis=1).sum(1)  # length of the common prefix
    new = np.append(True, common < symbols.shape[1])
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.empty(len(order), bool)
    out[order] = (key[order] > key[first]) | ((key[order] == key[first]) & (start[order] > start[first]))
    return out


def _answer(part: pd.DataFrame) -> pd.DataFrame:
    symbols, keys, starts = [], [], []
    for n, payload in zip(part["n"].tolist(), part["payload"]):
        raw = pa.decompress(payload, decompressed_size=n * (4 * DEPTH + 12), codec="zstd", asbytes=True)
        symbols.append(np.frombuffer(raw, np.uint32, n * DEPTH).reshape(DEPTH, n).T)
        keys.append(np.frombuffer(raw, np.int64, n, 4 * DEPTH * n))
        starts.append(np.frombuffer(raw, np.int32, n, (4 * DEPTH + 8) * n))
    later = repeated_suffixes(np.concatenate(symbols), np.concatenate(keys), np.concatenate(starts))
    cuts = np.cumsum(part["n"].to_numpy())[:-1]
    bits = [np.packbits(x).tobytes() for x in np.split(later, cuts)]
    return pd.DataFrame({"chunk": part["chunk"], "bucket": part["bucket"], "n": part["n"], "later": bits})


def without_repeated_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``removed array<struct<start, end>>`` (words) and the ``kept`` words of every row.

    A word goes if a window of ``WINDOW`` words around it also starts earlier: in a document with a smaller key, or in
    the same one before it. Windows are judged on the input and never leave a document. A null text has no words; a null
    key is larger than all others; rows with equal keys are compared by the start alone. Keys are integers; other columns
    are not read.
    """
    chunks = chunked(docs, key, text, "words-chunks")
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    width = max(int(total * 0.08) // GROUP, 7).bit_length()

    def send(chunk: int, documents: pa.Table, answers: list[dict] | None) -> pa.Table | None:
        *_, route, symbols, key, start = _suffixes(documents, answers)
        if not len(route):
            return None
        bucket = (route >> np.uint64(64 - width)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        rows: dict[str, list] = {"bucket": [], "chunk": [], "n": [], "payload": []}
        for a, b in zip(cuts, [*cuts[1:], len(route)]):
            rows["bucket"].append(int(bucket[a]))
            rows["chunk"].append(chunk)
            rows["n"].append(int(b - a))
            rows["payload"].append(_packed(symbols[a:b].T, key[a:b], start[a:b].astype(np.int32)))
        return pa.table(rows, pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("n", pa.int32()), ("payload", pa.binary())]))

    def cut(chunk: int, documents: pa.Table, answers: list[dict] | None, later: list[dict] | None) -> pa.Table:
        data, offsets, starts, ends, owner, at, key, start, head, _, _, head_key, head_start = _suffixes(documents, answers)
        told = np.zeros(len(head_key), bool)
        if later:
            told = np.concatenate([np.unpackbits(np.frombuffer(x["later"], np.uint8), count=x["n"]).astype(bool) for x in later])
        hit = at[told[head] | (key > head_key[head]) | (start > head_start[head])]
        change = np.zeros(len(starts) + 1, np.int64)
        np.add.at(change, hit, 1)
        np.add.at(change, hit + WINDOW, -1)
        gone = np.cumsum(change[:-1]) > 0
        n = len(offsets) - 1
        edge = np.ones(len(starts) + 1, bool)
        edge[1:-1] = owner[1:] != owner[:-1]
        begin = np.flatnonzero(gone & (edge[:-1] | ~np.append(False, gone[:-1])))
        stop = np.flatnonzero(gone & (edge[1:] | ~np.append(gone[1:], False))) + 1
        base = np.searchsorted(owner, np.arange(n))
        home = owner[begin]
        spans = pa.StructArray.from_arrays([pa.array(begin - base[home], pa.int64()), pa.array(stop - base[home], pa.int64())], ["start", "end"])
        span_cuts = np.concatenate([[0], np.cumsum(np.bincount(home, minlength=n))]).astype(np.int32)
        left = np.flatnonzero(~gone)
        size = ends[left] - starts[left] + 1  # with a space behind
        into = np.cumsum(size) - size
        source = np.repeat(starts[left] - into, size) + np.arange(int(size.sum()))
        out = np.append(data, np.uint8(32))[np.minimum(source, len(data))]
        out[into + size - 1] = 32
        last = np.append(owner[left][1:] != owner[left][:-1], True) if len(left) else np.zeros(0, bool)
        keep = np.ones(len(out), bool)
        keep[(into + size - 1)[last]] = False  # no space behind the last word
        lengths = np.bincount(owner[left], weights=size - last, minlength=n).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        kept = pa.LargeStringArray.from_buffers(n, pa.py_buffer(bounds.tobytes()), pa.py_buffer(out[keep].tobytes()))
        words = np.bincount(owner, minlength=n)
        return pa.table({"key": documents.column("key"), "n_words": pa.array(words, pa.int64()), "removed": pa.ListArray.from_arrays(pa.array(span_cuts), spans), "kept": kept.cast(pa.string())})

    counted = with_answers(chunks, _occurrences, CLASSES, "words-anchors", density=0.03)
    sent = each_chunk(counted, send, "bucket long, chunk long, n int, payload binary", "answers")
    told = answered(counted, sent, _answer, "later", "later", "words-suffixes")
    kind = docs.schema[key].dataType.simpleString()
    out = each_chunk(told, cut, f"key {kind}, n_words long, removed array<struct<start:long,end:long>>, kept string", "answers", "later")
    return out.withColumnRenamed("key", key)


def repeated_word_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sizes and digest of what ``without_repeated_words`` leaves of every document."""
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return without_repeated_words(docs, key, text).select(key, "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
