"""Edit distance between token arrays: totals, S/D/I splits, alignments, span projection.

Only the total distance is unique. The split depends on which of several cheapest
paths is taken; here the path is the one found walking back from the end and
preferring an equal pair, then an insertion, a deletion, a substitution.

The distance alone stays in the JVM. The split and the alignment need the path and
run in Arrow batches on bit vectors, one step per hypothesis token; of a very large
cost table only a part is kept at a time, so long texts are handled whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from voxframe.functions.arrays import each_with

_CODE_BASE = 0x10000  # first code point above the surrogates' plane
_WHOLE_TABLE_BITS = 1 << 28  # larger cost tables (two bits or more per cell) are kept in part only
_TOKENS_AT_ONCE = 20_000  # tokens that are Python objects at a time, about

COUNT_FIELDS = ["substitutions", "deletions", "insertions", "reference_units"]
COUNTS = T.StructType([T.StructField(n, T.IntegerType()) for n in COUNT_FIELDS])
ALIGNMENT = T.StructType(
    [
        T.StructField("op", T.ArrayType(T.StringType())),
        T.StructField("ref_at", T.ArrayType(T.IntegerType())),
        T.StructField("hyp_at", T.ArrayType(T.IntegerType())),
    ]
)


# ---- distance in the JVM ----------------------------------------------------


def _encoded(tokens: Column, vocabulary: Column) -> Column:
    """One code point per token, numbered within the pair's own vocabulary."""
    codes = each_with(vocabulary, tokens, lambda v, w: F.lpad(F.hex(F.array_position(v, w) + _CODE_BASE), 8, "0"))
    return F.decode(F.unhex(F.array_join(codes, "")), "UTF-32")


def token_distance(reference: Column, hypothesis: Column) -> Column:
    """Unit-cost edit distance of two string arrays, computed by the built-in ``levenshtein``."""
    vocabulary = F.array_distinct(F.concat(reference, hypothesis))
    return F.levenshtein(_encoded(reference, vocabulary), _encoded(hypothesis, vocabulary))


def text_distance(reference: Column, hypothesis: Column) -> Column:
    """Unit-cost edit distance of two strings, by character."""
    return F.levenshtein(reference, hypothesis)


# ---- path-dependent results -------------------------------------------------


def _columns(masks: list[int], up: int, down: int, full: int) -> Iterator[tuple[int, int, int]]:
    """Columns of the cost table as bit vectors over the reference (Hyyro's form of Myers' algorithm).

    Yields where the cost grows from the column before, and where it grows and falls
    from the reference token before, for one hypothesis token after the other.
    """
    for mask in masks:
        zero = ((((mask & up) + up) ^ up) | mask | down) & full
        grows = (down | ~(zero | up)) & full
        falls = up & zero
        shifted = ((grows << 1) | 1) & full
        up = ((falls << 1) | ~(zero | shifted)) & full
        down = shifted & zero
        yield grows, up, down


def _shared_end(reference: Sequence[str], hypothesis: Sequence[str]) -> int:
    count = 0
    for a, b in zip(reversed(reference), reversed(hypothesis)):
        if a != b:
            break
        count += 1
    return count


def _path(reference: Sequence[str], hypothesis: Sequence[str]) -> tuple[list[str], list, list]:
    """The preferred path: operations with the reference and hypothesis positions they touch.

    A common end is all equal pairs, because the way back prefers them. Of a large cost
    table only every k-th column is kept; those between are computed again on the way back.
    """
    reference, hypothesis = list(reference), list(hypothesis)
    tail = _shared_end(reference, hypothesis)
    i, j = len(reference) - tail, len(hypothesis) - tail
    rows, last = i, j
    places: dict[str, int] = {}
    for at in range(rows):
        places[reference[at]] = places.get(reference[at], 0) | (1 << at)
    masks = [places.get(token, 0) for token in hypothesis[:last]]
    full = (1 << rows) - 1
    step = max(1, last if rows * last <= _WHOLE_TABLE_BITS else isqrt(last))
    kept = {0: (full, 0)}
    if step < last:
        for column, (_, up, down) in enumerate(_columns(masks, full, 0, full), 1):
            if column % step == 0:
                kept[column] = (up, down)
    steps: list[tuple[str, int | None, int | None]] = []
    start, block = -1, []
    while i or j:
        if j and (j - 1) // step * step != start:
            start = (j - 1) // step * step
            block = list(_columns(masks[start : start + step], *kept[start], full))
        if i and j and reference[i - 1] == hypothesis[j - 1]:
            i, j = i - 1, j - 1
            steps.append(("equal", i, j))
        elif j and (i == 0 or block[j - 1 - start][0] >> (i - 1) & 1):
            j -= 1
            steps.append(("insertion", None, j))
        elif j == 0 or block[j - 1 - start][1] >> (i - 1) & 1:
            i -= 1
            steps.append(("deletion", i, None))
        else:
            i, j = i - 1, j - 1
            steps.append(("substitution", i, j))
    steps.reverse()
    steps += [("equal", rows + k, last + k) for k in range(tail)]
    return [s[0] for s in steps], [s[1] for s in steps], [s[2] for s in steps]


def _tally(ops: Sequence[str], units: int) -> tuple[int, int, int, int]:
    return ops.count("substitution"), ops.count("deletion"), ops.count("insertion"), units


def _counts(reference: Sequence[str], hypothesis: Sequence[str]) -> tuple[int, int, int, int]:
    return _tally(_path(reference, hypothesis)[0], len(reference))


def _rows(columns: Sequence[pa.Array], make: Callable[..., tuple], kind: T.StructType) -> pa.Array:
    """``make`` of every row as structs of ``kind``; as Python objects only a few rows, or one long one, at a time."""
    wanted = to_arrow_type(kind)
    sizes = sum(pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns if pa.types.is_list(c.type))
    ends, parts, at = np.cumsum(sizes), [pa.array([], wanted)], 0
    while at < len(ends):
        stop = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _TOKENS_AT_ONCE, side="right")), at + 1)
        found = [make(*row) for row in zip(*(c.slice(at, stop - at).to_pylist() for c in columns))]
        fields = [pa.array(values, field.type) for values, field in zip(zip(*found), wanted)]
        parts.append(pa.StructArray.from_arrays(fields, fields=list(wanted)))
        at = stop
    return pa.concat_arrays(parts)


@F.arrow_udf(COUNTS)
def edit_counts(reference: pa.Array, hypothesis: pa.Array) -> pa.Array:
    """S/D/I and reference length of two token arrays."""
    return _rows([reference, hypothesis], _counts, COUNTS)


@F.arrow_udf(ALIGNMENT)
def alignment(reference: pa.Array, hypothesis: pa.Array) -> pa.Array:
    """Operations with the 0-based reference and hypothesis positions they touch."""
    return _rows([reference, hypothesis], _path, ALIGNMENT)


_SCORE_PARTS = ["utterance_word", "utterance_character", "number_word", "number_character"]
_SCORE = T.StructType([T.StructField(f"{p}_{n}", T.IntegerType()) for p in _SCORE_PARTS for n in COUNT_FIELDS])


def _scores(ref: Sequence[str], hyp: Sequence[str], a: int, b: int) -> tuple:
    ops, ref_at, hyp_at = _path(ref, hyp)
    touched = [h for r, h in zip(ref_at, hyp_at) if r is not None and a <= r < b and h is not None]
    heard = hyp[touched[0] : touched[-1] + 1] if touched else hyp[:0]
    said = ref[a:b]
    return _tally(ops, len(ref)) + _counts("".join(ref), "".join(hyp)) + _counts(said, heard) + _counts("".join(said), "".join(heard))


@F.arrow_udf(_SCORE)
def _flat_scores(reference: pa.Array, hypothesis: pa.Array, start: pa.Array, end: pa.Array) -> pa.Array:
    return _rows([reference, hypothesis, start, end], _scores, _SCORE)


def row_scores(reference: Column, hypothesis: Column, start: Column, end: Column) -> Column:
    """Word and character counts of the utterance and of the number span projected into the hypothesis.

    ``reference`` and ``hypothesis`` are token arrays; a span outside the reference is an error.
    """
    inside = (start >= 0) & (start < end) & (end <= F.size(reference))
    checked = F.when(inside, start).otherwise(F.raise_error("number span is outside the reference").cast("int"))
    flat = _flat_scores(reference, hypothesis, checked, end)

    def part(name: str) -> Column:
        return F.struct(*[flat[f"{name}_{n}"].alias(n) for n in COUNT_FIELDS])

    return F.struct(
        F.struct(part("utterance_word").alias("word"), part("utterance_character").alias("character")).alias("utterance"),
        F.struct(part("number_word").alias("word"), part("number_character").alias("character")).alias("number"),
    )


def distance(counts: Column) -> Column:
    """Total errors of a counts struct."""
    return counts["substitutions"] + counts["deletions"] + counts["insertions"]


def error_rate(counts: Column) -> Column:
    """Errors per reference unit; null when the reference is empty."""
    return F.try_divide(distance(counts), counts["reference_units"])
