"""Chunks of documents in one row each, and exact counts of fingerprints over all chunks.

A chunk holds a few megabytes of whole documents, compressed, and has an id that stays. Fingerprints of a chunk are
made distinct before they move, so a passage that a third of all documents share is sent once per chunk. They are
counted in buckets of the hash space, and every bucket answers every chunk with a few bits for each of its fingerprints.
Neither fingerprints nor answers ever meet in one task or on the driver.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.session import materialize

CHUNK_BYTES = 1 << 20
#: Fingerprints that one bucket holds on average.
BUCKET_SIZE = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = values ^ (values >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def give_back() -> None:
    """Return to the system what this process has freed: a Python worker outlives its task, and what it holds counts."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000, size: int = 4 << 20, text: int = 1) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` rows and, but for a single longer text, ``size`` bytes, or elements, of column ``text``.

    So what is made of a batch stays small; memory is given back at the end.
    """
    for batch in batches:
        column = batch.column(text)
        lengths = pc.list_value_length(column) if pa.types.is_list(column.type) else pc.binary_length(column)
        ends = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = int(ends[at - 1]) if at else 0
            stop = min(max(int(np.searchsorted(ends, base + size, side="right")), at + 1), at + rows)
            yield batch.slice(at, stop - at)
            at = stop
    give_back()


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(payload: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.py_buffer(payload)) as source:
        return source.read_all()


def text_buffers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; a null text is empty."""
    texts = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunked(docs: DataFrame, key: str, text: str, label: str, size: int = CHUNK_BYTES) -> DataFrame:
    """Write ``docs`` as rows ``(chunk, n_bytes, payload)``; a payload has the columns ``key`` and ``text``.

    A document longer than ``size`` is a chunk of its own.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        total = 0

        def row() -> pa.RecordBatch:
            payload = pack(pa.Table.from_batches(held))
            return pa.RecordBatch.from_pydict({"chunk": [number], "n_bytes": [total], "payload": [payload]})

        for batch in batches:
            lengths = np.diff(text_buffers(batch.column(1))[1])
            ends = np.cumsum(lengths)
            at = 0
            while at < batch.num_rows:
                base = ends[at - 1] if at else 0
                stop = max(int(np.searchsorted(ends, base + size - total, side="right")), at + (not held))
                if stop > at:
                    held.append(batch.slice(at, stop - at))
                    total += int(ends[stop - 1] - base)
                if stop < batch.num_rows:
                    yield row()
                    number, held, total = number + 1, [], 0
                at = stop
            # what is held shares its memory with the batch, so it is copied
            held = [pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in b.columns], schema=b.schema) for b in held]
        if held:
            yield row()
        held.clear()
        give_back()

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return materialize(rows.mapInArrow(gather, "chunk long, n_bytes long, payload binary"), label)


def _planes(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as compressed byte planes of their differences."""
    steps = np.diff(values, prepend=np.uint64(0))
    return pa.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def _from_planes(blob: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(blob, decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(np.uint64).ravel(), dtype=np.uint64)


pack_sorted, unpack_sorted = _planes, _from_planes


def each_chunk(chunks: DataFrame, work: Callable[..., pa.Table | None], schema: str, *columns: str) -> DataFrame:
    """Apply ``work(chunk id, documents, *columns)`` to every chunk and union the tables it returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for i in range(batch.num_rows):
                more = [batch.column(2 + k)[i].as_py() for k in range(len(columns))]
                out = work(batch.column(0)[i].as_py(), unpack(batch.column(1)[i].as_py()), *more)
                if out is not None:
                    yield from out.combine_chunks().to_batches()

    return chunks.select("chunk", "payload", *columns).mapInArrow(run, schema)


def with_answers(
    chunks: DataFrame,
    fingerprints: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]],
    classes: tuple[int, ...],
    label: str,
    density: float,
    bucket_size: int = BUCKET_SIZE,
) -> DataFrame:
    """Add to every chunk the column ``answers``: a class for each of its distinct fingerprints, in ascending order.

    ``fingerprints(documents)`` gives the distinct 64-bit hashes of a chunk, sorted, and how often each occurs there.
    The class is the number of the bounds in ``classes`` that the sum over all chunks reaches: with ``(2, 65)`` a
    fingerprint occurring once has class 0, one occurring 65 times class 2. ``density`` is the expected number of
    fingerprints per byte; it only sets how many buckets there are.
    """
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    width = max(int(total * density / bucket_size), 7).bit_length()
    top = max(classes)

    def send(chunk: int, documents: pa.Table) -> pa.Table | None:
        values, counts = fingerprints(documents)
        if not len(values):
            return None
        bucket = (values >> np.uint64(64 - width)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        rows: dict[str, list] = {"bucket": [], "chunk": [], "n": [], "hashes": [], "counts": []}
        for a, b in zip(cuts, [*cuts[1:], len(values)]):
            rows["bucket"].append(int(bucket[a]))
            rows["chunk"].append(chunk)
            rows["n"].append(int(b - a))
            rows["hashes"].append(_planes(values[a:b]))
            rows["counts"].append(pa.compress(np.minimum(counts[a:b], top).astype(np.uint16).tobytes(), codec="zstd", asbytes=True))
        return pa.table(rows, pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("n", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]))

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        sizes = part["n"].to_numpy()
        values = np.concatenate([_from_planes(h, n) for h, n in zip(part["hashes"], sizes)])
        counts = np.concatenate([np.frombuffer(pa.decompress(c, decompressed_size=2 * int(n), codec="zstd", asbytes=True), np.uint16) for c, n in zip(part["counts"], sizes)])
        order = np.argsort(values, kind="stable")
        fresh = np.diff(values[order], prepend=~values[order[0]]) != 0
        sums = np.add.reduceat(counts[order].astype(np.int64), np.flatnonzero(fresh))
        kind = np.zeros(len(sums), np.uint8)
        for bound in classes:
            kind += sums >= bound
        back = np.empty(len(values), np.uint8)
        back[order] = kind[np.cumsum(fresh) - 1]
        cuts = np.cumsum(sizes)[:-1]
        blobs = [pa.compress(x.tobytes(), codec="zstd", asbytes=True) for x in np.split(back, cuts)]
        return pd.DataFrame({"chunk": part["chunk"], "bucket": part["bucket"], "n": part["n"], "kinds": blobs})

    sent = each_chunk(chunks, send, "bucket long, chunk long, n int, hashes binary, counts binary")
    return answered(chunks, sent, answer, "kinds", "answers", label)


def answered(chunks: DataFrame, sent: DataFrame, answer: Callable[[pd.DataFrame], pd.DataFrame], part: str, column: str, label: str) -> DataFrame:
    """Let ``answer`` treat what was sent to every bucket, and give each chunk its answers, in the order of buckets."""

    def told(bucket: pd.DataFrame) -> pd.DataFrame:
        out = answer(bucket)
        give_back()
        return out

    answers = sent.groupBy("bucket").applyInPandas(told, f"chunk long, bucket long, n int, {part} binary")
    per_chunk = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "n", part))).alias(column))
    return chunks.join(materialize(per_chunk, label), "chunk", "left")


def kinds_of(answers: list[dict] | None) -> np.ndarray:
    """The classes of a chunk's fingerprints from the column ``answers``."""
    if not answers:
        return np.zeros(0, np.uint8)
    return np.concatenate([np.frombuffer(pa.decompress(a["kinds"], decompressed_size=a["n"], codec="zstd", asbytes=True), np.uint8) for a in answers])


def smallest_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` consecutive keys from every start."""
    if len(keys) < width:
        return np.zeros(0, keys.dtype)
    least, have = keys, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


_LOW = np.uint64(0xFFF)


def placed(grams: np.ndarray) -> np.ndarray:
    """Hashes whose low bits give way to the place, so that the first of equal ones is the least."""
    return (grams & ~_LOW) | (np.arange(len(grams), dtype=np.uint64) & _LOW)


def runs_of_least(least: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of valid windows with one anchor, from the least placed hash of every window: the anchor's hash, first and last window."""
    turn = least[1:] != least[:-1]
    begins, ends = valid.copy(), valid.copy()
    begins[1:] &= turn | ~valid[:-1]
    ends[:-1] &= turn | ~valid[1:]
    first = np.flatnonzero(begins)
    return least[first] & ~_LOW, first, np.flatnonzero(ends)


def anchored_runs(grams: np.ndarray, width: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: the anchor's hash, and the first and the last window of the run.

    A window starts at every gram and spans ``width`` of them; its anchor is the least. Equal windows have anchors of
    equal hash, wherever they are. ``valid`` tells which windows count. The low bits of a hash give way to the place.
    """
    least = smallest_in_windows(placed(grams), width)[: len(valid)]
    return runs_of_least(least, valid[: len(least)])


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word ``[^\\x20\\x09-\\x0D]+`` and the document it belongs to."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    wordy = ~blank
    before = np.empty(len(data) + 1, bool)  # the byte before is no part of the same word
    before[0] = True
    before[1:] = blank
    before[offsets[:-1]] = True
    after = np.empty(len(data) + 1, bool)
    after[-1] = True
    after[:-1] = blank
    after[offsets] = True
    starts = np.flatnonzero(wordy & before[:-1])
    ends = np.flatnonzero(wordy & after[1:]) + 1
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, owner


_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
_BASE = 0x9E3779B97F4A7C15 | 5
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * _MIX)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept between calls."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        inverse = pow(_BASE, -1, 1 << 64)
        for k, base in enumerate((_BASE, inverse)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _POWERS[k] = np.multiply.accumulate(table)
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, from prefix sums of a polynomial over scrambled byte values."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, inverses = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * powers[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * inverses[starts]
    return mixed(value ^ (ends - starts).astype(np.uint64) * _MIX)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of ``n`` consecutive words from every start; runs over the ends of documents are the caller's to leave out."""
    count = max(len(words) - n + 1, 0)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out = (out ^ words[i : i + count]) * _MIX
        out ^= out >> np.uint64(29)
    return mixed(out)
