"""Language identification by prediction by partial matching over bytes.

Every language gets a context tree of byte contexts up to ``ORDER`` bytes, counted on a bounded labelled sample. A
symbol that a context has not seen is coded by an escape (method C, with exclusion) and the next shorter context. With
frozen counts the code length of a symbol depends on the context alone, so the trees become one table of code lengths
``(context, symbol, language)``, and a whole text is scored by looking up every byte once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxframe.llm.chunks import slices

ORDER = 3
#: Bounds of the training sample: rows for each language, and characters of a sampled row.
SAMPLE_ROWS = 200
SAMPLE_CHARS = 20_000
UNDETERMINED = "und"
_BLOCK = 1 << 18  # bytes looked up at once
_START = 10  # a text is coded as if it followed line feeds


@dataclass(frozen=True)
class LanguageModel:
    """Frozen code lengths.

    ``classes`` maps a byte to its symbol, the last symbol standing for all bytes not seen in training; ``nodes`` maps
    the last three symbols to the deepest known context; ``bits[node * symbols + symbol]`` has a column per language.
    """

    languages: tuple[str, ...]
    classes: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray

    @property
    def symbols(self) -> int:
        return int(self.classes.max()) + 1


def is_held_out(key: Column, folds: int = 5) -> Column:
    """True where crc32 of the key's text leaves no remainder; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(False))


def training_sample(
    docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS
) -> DataFrame:
    """At most ``rows`` labelled texts of each language, in the order of a hash of the key.

    Of a text longer than ``chars`` a slice of that length is taken, at a place that its hash chooses. Rows without label,
    key or text, and empty texts, are left out; rows that repeat key, label and text are one. Rows are ranked without
    their texts; a limit per language applies in every task before the shuffle.
    """
    fit = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (F.length(text) > 0) & F.col(key).isNotNull())
    fit = fit.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(text).cast("string").alias("text")).withColumn("mark", F.xxhash64("text"))
    at = F.pmod(F.xxhash64("mark"), F.greatest(F.length("text") - chars + 1, F.lit(1))) + 1
    order = Window.partitionBy("label").orderBy("_h", "key", "mark")
    ranked = fit.select("key", "label", "mark", F.xxhash64(F.col("key").cast("string")).alias("_h")).distinct()
    chosen = ranked.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= rows).select("key", "label", "mark")
    sliced = fit.select("key", "label", "mark", F.substring("text", at.cast("int"), F.lit(chars)).alias("sample"))
    found = sliced.join(F.broadcast(chosen), ["key", "label", "mark"], "left_semi")  # no more rows than the sample
    return found.dropDuplicates(["key", "label", "mark"]).select("label", "sample")


def fit_languages(sample: list[tuple[str, str]]) -> LanguageModel:
    """Build the context trees of all languages from labelled texts, which the caller has bounded."""
    languages = tuple(sorted({label for label, _ in sample}))
    joined = {}
    for name in languages:
        texts = sorted(text.lower().encode("utf-8", "replace") for label, text in sample if label == name)
        joined[name] = np.frombuffer(b"".join(bytes([_START] * ORDER) + text for text in texts), np.uint8)
    known = np.zeros(256, bool)
    known[_START] = True
    for data in joined.values():
        known[data] = True
    classes = np.where(known, np.cumsum(known) - 1, known.sum()).astype(np.uint8)
    if known.all():
        classes = np.arange(256, dtype=np.uint8)
    size = int(classes.max()) + 1
    grams = {name: _context_grams(classes[data].astype(np.int64), size) for name, data in joined.items()}
    # Contexts that any language has seen, by order; the empty context is node 0.
    contexts = [np.zeros(1, np.int64)]
    for order in range(1, ORDER + 1):
        seen = [np.unique(g[order][0] // size) for g in grams.values()]
        contexts.append(np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64))
    first = np.cumsum([0] + [len(c) for c in contexts])
    bits = np.zeros((int(first[-1]), size, max(len(languages), 1)), np.float32)
    for column, name in enumerate(languages):
        _code_lengths(grams[name], contexts, first, size, bits[:, :, column])
    nodes = np.zeros(size**ORDER, np.int32)
    full = np.arange(size**ORDER, dtype=np.int64)
    for order in range(1, ORDER + 1):
        suffix = full % size**order
        at = np.minimum(np.searchsorted(contexts[order], suffix), max(len(contexts[order]) - 1, 0))
        if len(contexts[order]):
            hit = contexts[order][at] == suffix
            nodes[hit] = (first[order] + at[hit]).astype(np.int32)
    return LanguageModel(languages, classes, nodes, bits.reshape(-1, bits.shape[2]))


def _context_grams(symbols: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order the codes of (context, symbol) and their counts."""
    out = []
    for order in range(ORDER + 1):
        code = np.zeros(max(len(symbols) - order, 0), np.int64)
        for i in range(order + 1):
            code = code * size + symbols[i : len(symbols) - order + i]
        out.append(np.unique(code, return_counts=True))
    return out


def _code_lengths(grams, contexts, first, size: int, bits: np.ndarray) -> None:
    """Fill ``bits[node, symbol]`` for one language, shorter contexts first.

    ``tail`` is the code length of a symbol once its context has been left by an escape.
    """
    tails, counts = [], []
    for order in range(ORDER + 1):
        keys = contexts[order]
        count = np.zeros((len(keys), size))
        codes, times = grams[order]
        if len(codes):
            count[np.searchsorted(keys, codes // size), codes % size] = times
        counts.append(count)
        seen = count > 0
        if order == 0:
            tail = np.full((1, size), np.log2(256.0))  # order -1: all bytes alike
        else:
            parent = np.searchsorted(contexts[order - 1], keys % size ** (order - 1)) if order > 1 else np.zeros(len(keys), np.int64)
            tail = np.empty_like(count)
            for at in range(0, len(keys), 4096):  # bounded working space
                part = slice(at, at + 4096)
                above, gone = counts[order - 1][parent[part]], seen[part]
                left = np.where(gone, 0, above)
                total, kinds = left.sum(1, keepdims=True), (left > 0).sum(1, keepdims=True)
                with np.errstate(divide="ignore", invalid="ignore"):
                    direct = np.log2(total + kinds) - np.log2(left)
                    escape = np.where(kinds > 0, np.log2(total + kinds) - np.log2(kinds), 0.0)
                tail[part] = np.where(left > 0, direct, escape + tails[order - 1][parent[part]])
        tails.append(tail)
        total, kinds = count.sum(1, keepdims=True), seen.sum(1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            direct = np.log2(total + kinds) - np.log2(count)
            escape = np.where(kinds > 0, np.log2(total + kinds) - np.log2(kinds), 0.0)
        bits[first[order] : first[order + 1]] = np.where(seen, direct, escape + tail)


def text_bits(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code length in bits of every text under every language; texts are slices of lower-cased UTF-8 bytes."""
    size, n = model.symbols, len(offsets) - 1
    total = np.zeros((n, len(model.languages)))
    start, end = int(offsets[0]), int(offsets[-1])
    begin = model.classes[_START]
    for at in range(start, end, _BLOCK):
        stop = min(at + _BLOCK, end)
        low = max(at - ORDER, start)
        symbols = model.classes[data[low:stop]].astype(np.int64)
        own = np.searchsorted(offsets, np.arange(at, stop), side="right") - 1
        depth = np.arange(at, stop) - offsets[own]
        context = np.zeros(stop - at, np.int64)
        for back in range(ORDER, 0, -1):
            index = np.arange(at, stop) - back - low
            context = context * size + np.where(depth >= back, symbols[np.maximum(index, 0)], begin)
        cost = model.bits[model.nodes[context].astype(np.int64) * size + symbols[at - low :]]
        for column in range(cost.shape[1]):
            total[:, column] += np.bincount(own, weights=cost[:, column], minlength=n)
    return total


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every row, as :func:`with_language` gives them."""
    return with_language(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), model, "text", ["key"]).withColumnRenamed("key", key)


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text", kept: list[str] | None = None) -> DataFrame:
    """The ``kept`` columns of every row (all, if not given), its language and a score, from the whole text alone.

    The score is the probability of the language if all are equally likely beforehand. A null text, an empty one, one
    without a letter, or a model without languages gives ``und`` and 0.0. Ties go to the first name in order. Repeated
    rows are scored each for itself; other columns are passed on as they are. A kept text is not sent twice.
    """
    kept = docs.columns if kept is None else kept
    once = text in kept and isinstance(docs.schema[text].dataType, T.StringType)
    at = kept.index(text) if once else len(kept)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        labels = np.array([*model.languages, UNDETERMINED], object)
        for batch in slices(batches, text=at):
            lower = pc.utf8_lower(pc.fill_null(batch.column(at), "")).cast(pa.large_string())
            letters = pc.match_substring_regex(lower, r"\p{L}").to_numpy(zero_copy_only=False)
            offsets = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset : lower.offset + len(lower) + 1]
            raw = lower.buffers()[2]
            data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
            best, chance = np.full(len(lower), len(model.languages)), np.zeros(len(lower))
            if model.languages and len(lower):
                bits = text_bits(model, data, offsets)
                best = np.where(letters, bits.argmin(1), len(model.languages))
                odds = np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000.0)).sum(1)
                chance = np.where(letters, 1.0 / odds, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(labels[best], pa.string()), pa.array(chance)], [*kept, "lang_pred", "score"])

    rows = docs.select(*kept) if once else docs.select(*kept, F.col(text).cast("string").alias("text to score"))
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(scored, schema)


def learnt(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", folds: int = 5) -> LanguageModel:
    """The model of the rows that are not held out."""
    sample = training_sample(docs.where(~is_held_out(F.col(key), folds)), key, text, label).collect()  # bounded by its two limits
    return fit_languages([(row["label"], row["sample"]) for row in sample])


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", folds: int = 5) -> DataFrame:
    """Fit on the rows that are not held out and identify all rows: ``key, held_out, lang_pred, score``."""
    found = identify(docs, learnt(docs, key, text, label, folds), key, text)
    return found.select(key, is_held_out(F.col(key), folds).alias("held_out"), "lang_pred", "score")
