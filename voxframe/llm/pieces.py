"""Exact merge-type piece encoding by backtracking, and decoding.

The pieces of a text follow from merging neighbours, best score first, the leftmost first among equals. That result is
the only split into pieces in which every piece and every pair of neighbours merges back to itself. It is found by taking
the longest piece at each place, shorter ones if a pair of neighbours does not keep, and stepping back where no piece is
left; a bit for each place that led nowhere keeps the search linear. Pieces never hold a blank after another character,
so runs of blanks with the word behind them are encoded apart, and frequent ones from a bounded memory; so are letters and other
characters if the vocabulary never joins them.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.llm.chunks import give_back, slices

BLANK = "▁"
#: Words kept in memory by a worker, and the longest of them.
REMEMBERED = 250_000
REMEMBERED_LENGTH = 48
#: Pairs of neighbouring pieces kept in memory by a worker.
REMEMBERED_PAIRS = 300_000
_WORD = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
# Letters apart from other characters, for vocabularies in which no piece joins them.
_RUN = re.compile(rf"{BLANK}*(?:[^\W\d_²³¹]+|(?:[^\w{BLANK}]+|[\d_²³¹]+)+)|{BLANK}+")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores; ``byte`` pieces stand for single bytes and ``special`` ones never come from a text."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte: tuple[int, ...]  # ids of the 256 bytes
    special: frozenset[int]
    end: int
    dummy_blank: bool = True

    @classmethod
    def from_model(cls, path: str) -> Vocabulary:
        """Read pieces and scores of a sentencepiece model of the merging kind with byte fallback."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        special = frozenset(i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        byte = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
        return cls(tuple(model.id_to_piece(i) for i in ids), tuple(model.get_score(i) for i in ids), byte, special, model.eos_id())


@dataclass
class Encoder:
    """Encoding with one vocabulary; holds what it has learnt about pieces and pairs."""

    vocabulary: Vocabulary
    _pairs: dict[tuple[str, str], bool] = field(default_factory=dict)

    def __post_init__(self) -> None:
        v = self.vocabulary
        hidden = v.special | set(v.byte)
        self.raw = {p: i.to_bytes(4, "little") for i, p in enumerate(v.pieces) if i not in hidden}
        self.raw_bytes = [i.to_bytes(4, "little") for i in v.byte]
        self.scores = {p: s for i, (p, s) in enumerate(zip(v.pieces, v.scores)) if i not in hidden}
        self.word = _RUN if all(_RUN.fullmatch(p) for p in self.scores) else _WORD
        # Pieces that merging never reaches are no candidates.
        self.reached = {p: p for p in self.scores if self.merge(p) == [p]}
        self.longest = ahocorasick.Automaton()
        for piece in self.reached:
            self.longest.add_word(piece, len(piece))
        self.longest.make_automaton()

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by repeated merging."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def keeps(self, left: str, right: str) -> bool:
        """Whether two neighbouring pieces stay apart."""
        pair = (left, right)
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= REMEMBERED_PAIRS:
                self._pairs.clear()
            known = self._pairs[pair] = self.merge(left + right) == [left, right]
        return known

    def split(self, word: str) -> list[str]:
        """Pieces of a word; a character without a piece stands for itself."""
        size = len(word)
        best = [1] * size  # length of the longest piece that starts here: matches come by their ends
        for last, length in self.longest.iter(word):
            best[last + 1 - length] = length
        failed = None  # a bit for each place from which no split keeps
        reached, pairs = self.reached, self._pairs
        parts: list[str] = []
        before = None
        at, length = 0, best[0] if size else 0
        while at < size:
            while length:
                stop = at + length
                piece = word[at:stop]
                piece = reached.get(piece) or (piece if length == 1 else None)  # one object for each piece
                if piece is not None and not (failed and failed[stop >> 3] >> (stop & 7) & 1):
                    if before is None:
                        break
                    known = pairs.get((before, piece))
                    if self.keeps(before, piece) if known is None else known:
                        break
                length -= 1
            if length:
                parts.append(piece)
                before, at = piece, stop
                if at < size:
                    length = best[at]
            else:
                if before is None:
                    raise ValueError("no split of the word keeps")
                failed = failed or bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                parts.pop()
                length = len(before) - 1
                at -= length + 1
                before = parts[-1] if parts else None
        return parts

    def word_ids(self, word: str) -> bytes:
        """Ids of a word, four bytes each."""
        raw = self.raw
        return b"".join([raw[p] if p in raw else b"".join([self.raw_bytes[b] for b in p.encode("utf-8")]) for p in self.split(word)])


class _Words(dict):
    """Encoded words as bytes of 32-bit ids; a bounded memory."""

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        value = self.encoder.word_ids(word)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = value
        return value

    def text(self, text: str) -> bytes:
        """Ids of a whole text, without an end."""
        if not text:
            return b""
        if self.encoder.vocabulary.dummy_blank:
            text = " " + text
        return b"".join(map(self.__getitem__, self.encoder.word.findall(text.replace(" ", BLANK))))


_ENCODERS: dict[int, _Words] = {}


def _words(vocabulary: Vocabulary, number: int) -> _Words:
    """One encoder for each worker and vocabulary, so that words stay known between tasks."""
    if number not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[number] = _Words(Encoder(vocabulary))
    return _ENCODERS[number]


def encode(texts: Iterable[str], vocabulary: Vocabulary, end: bool = True) -> list[list[int]]:
    """Ids of a few texts, in this process."""
    words = _Words(Encoder(vocabulary))
    last = [vocabulary.end] if end else []
    return [np.frombuffer(words.text(t), np.int32).tolist() + last for t in texts]


def _ids(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, end: bool) -> Iterator[pa.RecordBatch]:
    """``key, ids`` of batches of keys and texts."""
    words = _words(vocabulary, hash(vocabulary.pieces))
    last = np.array([vocabulary.end] if end else [], np.int32).tobytes()
    for batch in slices(batches):
        rows = [words.text(t or "") + last for t in batch.column(1).to_pylist()]
        offsets = np.cumsum([0, *(len(r) // 4 for r in rows)])
        ids = pa.array(np.frombuffer(b"".join(rows), np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids)], ["key", "ids"])
    words.clear()  # an idle worker keeps no words
    give_back()


def _spoken(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    """``key, ids, text`` of batches of keys and ids."""
    codecs.register_error("each_byte", lambda error: ("\ufffd" * (error.end - error.start), error.end))
    said = [b"" if i in vocabulary.special else p.replace(BLANK, " ").encode("utf-8") for i, p in enumerate(vocabulary.pieces)]
    for b, i in enumerate(vocabulary.byte):
        said[i] = bytes([b])
    table = pa.array(said, pa.large_binary())
    for batch in slices(batches):
        lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
        spoken = table.take(lists.flatten())
        cuts = np.frombuffer(spoken.buffers()[1], np.int64)[: len(spoken) + 1] if len(spoken) else np.zeros(1, np.int64)
        raw = memoryview(spoken.buffers()[2]) if len(spoken) and spoken.buffers()[2] is not None else memoryview(b"")
        ends = np.cumsum([0, *(lists.value_lengths().fill_null(0).to_pylist())])
        texts = [str(raw[a:b], "utf-8", "each_byte") for a, b in zip(cuts[ends[:-1]].tolist(), cuts[ends[1:]].tolist())]
        if vocabulary.dummy_blank:
            texts = [t.removeprefix(" ") for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["key", "ids", "text"])


def encoded(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text", end: bool = True) -> DataFrame:
    """``key`` and ``ids array<int>`` of every row; a null text is empty. Other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # its size is the vocabulary's, not the data's
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _ids(batches, shared.value, end), f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decoded(rows: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", ids: str = "ids", text: str = "text") -> DataFrame:
    """``key``, ``ids`` and the decoded ``text`` of every row.

    Special pieces say nothing, byte pieces are read as UTF-8 with U+FFFD for each byte that is none, blanks become spaces,
    and one leading space is dropped. Null ids give an empty text.
    """
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    kind = rows.schema[key].dataType.simpleString()
    out = rows.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(lambda batches: _spoken(batches, shared.value), f"key {kind}, ids array<int>, text string")
    return out.toDF(key, ids, text)


def read_back(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text", end: bool = True) -> DataFrame:
    """``key``, ``ids`` as :func:`encoded` gives them and the ``text`` that :func:`decoded` makes of them.

    Both steps run in one Python worker for each task: two would hold the vocabulary twice, and stay when the task is over.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    out = rows.mapInArrow(lambda batches: _spoken(_ids(batches, shared.value, end), shared.value), f"key {kind}, ids array<int>, text string")
    return out.withColumnRenamed("key", key)


def piece_digests(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Number and digest of the ids of every text with an end, and digest of what they decode to."""
    return read_back(docs, vocabulary, key, text).select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
