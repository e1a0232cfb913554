"""Operators on array columns: vectors, token lists, sample series and JSON forms."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
IGNORE_ID = -1
TOKEN_MAX = 6560
NORM_FLOOR = 1e-12
# -----------------------------------------------------------------------------


def _doubles(values: Column) -> Column:
    return F.transform(values, lambda v: v.cast("double"))


def _int(value: int | Column) -> Column:
    return F.lit(value) if isinstance(value, int) else value.cast("int")


def each_with(whole: Column, items: Column, make: Callable[[Column, Column], Column]) -> Column:
    """``[make(whole, item) for item in items]`` with ``whole`` computed once per row.

    Inside a lambda an expression over the row is evaluated again for every element;
    repeating its value beside the elements avoids that.
    """
    return F.zip_with(F.array_repeat(whole, F.size(items)), items, make)


def once(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make(value)`` with ``value`` computed once, also where the planner would copy it, as in a pushed filter."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def indices(n: Column | int) -> Column:
    """``[0, n)`` as an array; empty for n below 1."""
    size = _int(n)
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))


def l2_norm(values: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))


def l2_normalize(values: Column) -> Column:
    """Unit vector; the zero vector stays zero."""
    norm = F.greatest(l2_norm(values), F.lit(NORM_FLOOR))
    return each_with(norm, values, lambda n, v: v.cast("double") / n)


def default_vectors(utterance: Column, speaker: Column, computed: Column) -> tuple[Column, Column]:
    """Utterance and speaker vector; where both are absent, one computed vector stands for both."""
    absent = utterance.isNull() & speaker.isNull()
    return F.when(absent, computed).otherwise(utterance), F.when(absent, computed).otherwise(speaker)


def pad_right(values: Column, size: Column | int, fill: Column | int | float = 0) -> Column:
    """Append ``fill`` up to ``size``; longer arrays are kept."""
    value = fill if isinstance(fill, Column) else F.lit(fill)
    missing = F.greatest(_int(size) - F.size(values), F.lit(0))
    return F.concat(values, F.array_repeat(value, missing))


def pad_to_multiple(values: Column, n: int, fill: float = 0.0) -> Column:
    """Append ``fill`` until the size is a multiple of ``n``."""
    return F.concat(values, F.array_repeat(F.lit(fill), F.pmod(-F.size(values), F.lit(n))))


def pad_mask(length: Column, longest: Column | int) -> Column:
    """True where a position lies beyond ``length``."""
    return F.transform(indices(longest), lambda i: i >= length)


def crop_or_pad(values: Column, size: int, start: Column, fill: float = 0.0) -> Column:
    """Exactly ``size`` values: a window from ``start`` (0-based) when longer, else zero-padded."""
    window = F.slice(values, (start + 1).cast("int"), F.lit(size))
    return F.when(F.size(values) > size, window).otherwise(pad_right(values, size, fill))


def align_two_rates(features: Column, tokens: Column, ratio: int = 2) -> tuple[Column, Column]:
    """Cut both arrays so that one token spans exactly ``ratio`` feature frames."""
    keep = F.least(F.floor(F.size(features) / ratio).cast("int"), F.size(tokens))
    return F.slice(features, F.lit(1), keep * ratio), F.slice(tokens, F.lit(1), keep)


def limit_peak(samples: Column) -> Column:
    """Divide by the peak only when it exceeds 1."""
    peak = F.array_max(F.transform(samples, lambda v: F.abs(v.cast("double"))))
    return F.when(peak > 1, each_with(peak, samples, lambda p, v: v.cast("double") / p)).otherwise(_doubles(samples))


def to_mono(channels: Column) -> Column:
    """Mean over channels of an ``array<array<..>>`` with equally long channels."""
    count = F.size(channels)
    zero = F.transform(channels[0], lambda v: F.lit(0.0))
    total = F.aggregate(channels, zero, lambda acc, ch: F.zip_with(acc, ch, lambda a, b: a + b.cast("double")))
    return each_with(count, total, lambda n, v: v / n)


def interleave_applies(text: Column, speech: Column, coin: Column, text_block: int = 5, speech_block: int = 15) -> Column:
    """Interleave when the coin falls below one half and speech is longer than the block ratio asks."""
    return (coin < 0.5) & (F.size(speech) / F.size(text) > F.lit(speech_block / text_block))


def interleaved_target(
    text: Column, speech: Column, fill_id: int, end_id: int, instruct_len: Column | int = 0, text_block: int = 5, speech_block: int = 15
) -> Column:
    """Training target of the interleaved layout.

    A start slot and the instruction are ignored, then blocks follow: the text of a
    full block is ignored but for its last slot, its speech block follows and the
    fill id closes it. The last, incomplete text block carries the remaining speech
    and the end id.
    """
    full = F.floor(F.size(text) / text_block).cast("int")
    head = F.array_repeat(F.lit(IGNORE_ID), 1 + _int(instruct_len))
    ignored = F.array_repeat(F.lit(IGNORE_ID), F.lit(text_block - 1))
    blocks = each_with(
        speech,
        indices(full),
        lambda s, j: F.concat(ignored, F.slice(s, j * speech_block + 1, F.lit(speech_block)), F.array(F.lit(fill_id))),
    )
    rest_text = F.array_repeat(F.lit(IGNORE_ID), F.size(text) - full * text_block)
    rest_speech = F.slice(speech, full * speech_block + 1, F.greatest(F.size(speech) - full * speech_block, F.lit(0)))
    return F.concat(head, F.flatten(blocks), rest_text, rest_speech, F.array(F.lit(end_id)))


def plain_target(text: Column, speech: Column, end_id: int, instruct_len: Column | int = 0) -> Column:
    """Training target of the plain layout: ignored start, instruction and text, then speech and the end id."""
    ignored = F.array_repeat(F.lit(IGNORE_ID), 1 + _int(instruct_len) + F.size(text))
    return F.concat(ignored, speech, F.array(F.lit(end_id)))


def equal_chunks(values: Column, size: int, lookahead: int = 0) -> Column:
    """Chunks of ``size`` (+ look-ahead) while that much is left; the last chunk takes the rest."""
    n = F.size(values)
    whole = F.greatest(F.floor((n - lookahead) / size), F.lit(0)).cast("int")
    chunks = each_with(values, indices(whole), lambda v, i: F.slice(v, i * size + 1, F.lit(size + lookahead)))
    rest = F.slice(values, whole * size + 1, F.greatest(n - whole * size, F.lit(0)))
    return F.concat(chunks, F.array(rest))


def doubling_chunks(values: Column, first: int = 25, lookahead: int = 0) -> Column:
    """Like :func:`equal_chunks` with chunk i of size ``first * 2**i``, starting at ``first * (2**i - 1)``."""
    n = F.size(values)
    # Chunk i is emitted while first * (2**(i+1) - 1) + lookahead <= n; sizes are ints, so 31 steps cover all.
    fits = each_with(
        n, F.sequence(F.lit(0), F.lit(30)), lambda size, i: (F.pow(F.lit(2.0), i + 1) - 1) * first + lookahead <= size
    )
    whole = F.size(F.filter(fits, lambda fit: fit))
    offset = lambda i: (F.pow(F.lit(2.0), i) - 1) * first
    chunks = each_with(
        values,
        indices(whole),
        lambda v, i: F.slice(v, offset(i).cast("int") + 1, (F.pow(F.lit(2.0), i) * first).cast("int") + lookahead),
    )
    begin = offset(whole).cast("int")
    return F.concat(chunks, F.array(F.slice(values, begin + 1, F.greatest(n - begin, F.lit(0)))))


def contains_run(values: Column, run: Column) -> Column:
    """Whether ``run`` occurs as a contiguous part of ``values``."""
    starts = indices(F.size(values) - F.size(run) + 1)
    both = F.struct(values.alias("values"), run.alias("run"))
    found = each_with(both, starts, lambda b, i: F.slice(b["values"], i + 1, F.size(b["run"])) == b["run"])
    return F.exists(found, lambda f: f)


def cross_fade(incoming: Column, outgoing: Column, window: Column) -> Column:
    """Blend the head of ``incoming`` with the tail of ``outgoing``; the window holds both ramps."""
    n = F.floor(F.size(window) / 2).cast("int")
    rising, falling = F.slice(window, F.lit(1), n), F.slice(window, n + 1, n)
    head = F.zip_with(F.slice(incoming, F.lit(1), n), rising, lambda v, w: v.cast("double") * w)
    tail = F.zip_with(F.slice(outgoing, F.size(outgoing) - n + 1, n), falling, lambda v, w: v.cast("double") * w)
    blended = F.zip_with(head, tail, lambda a, b: a + b)
    rest = _doubles(F.slice(incoming, n + 1, F.greatest(F.size(incoming) - n, F.lit(0))))
    return F.concat(blended, rest)


def linear_resize(values: Column, size: int | Column) -> Column:
    """Linear interpolation to ``size`` points with half-pixel centres."""
    target = _int(size)

    def point(v: Column, i: Column) -> Column:
        n = F.size(v)
        at = F.greatest((i + 0.5) * n / target - 0.5, F.lit(0.0))
        low = F.least(F.floor(at).cast("int"), n - 1)
        high = F.least(low + 1, n - 1)
        share = at - low
        return F.get(v, low) * (1 - share) + F.get(v, high) * share

    return each_with(values, indices(target), point)


def valid_tokens(tokens: Column, declared: Column | None = None, most: int = TOKEN_MAX) -> Column:
    """Non-empty ids within 0..most, of the declared length when one is given."""
    ok = (F.size(tokens) > 0) & F.forall(tokens, lambda t: t.isNotNull() & (t >= 0) & (t <= most))
    return F.coalesce(ok if declared is None else ok & (F.size(tokens) == declared), F.lit(False))


def overlap_add(chunks: Column, overlap: int) -> Column:
    """Join chunks whose neighbours share ``overlap`` samples, with linear ramps over the shared part.

    Every chunk must be at least twice the overlap long.
    """
    ramp = F.transform(F.sequence(F.lit(0), F.lit(overlap - 1)), lambda i: i / float(max(overlap - 1, 1)))

    def seam(i: Column) -> Column:
        current, before = F.get(chunks, i), F.get(chunks, i - 1)
        rising = F.zip_with(F.slice(current, F.lit(1), F.lit(overlap)), ramp, lambda v, r: v.cast("double") * r)
        tail = F.slice(before, F.size(before) - overlap + 1, F.lit(overlap))
        falling = F.zip_with(tail, ramp, lambda v, r: v.cast("double") * (1 - r))
        body = F.slice(current, F.lit(overlap + 1), F.greatest(F.size(current) - 2 * overlap, F.lit(0)))
        return F.concat(F.zip_with(rising, falling, lambda a, b: a + b), _doubles(body))

    first = F.get(chunks, F.lit(0))
    last = F.get(chunks, F.size(chunks) - 1)
    head = _doubles(F.slice(first, F.lit(1), F.size(first) - overlap))
    seams = F.flatten(F.transform(F.sequence(F.lit(1), F.size(chunks) - 1), seam))
    tail = _doubles(F.slice(last, F.size(last) - overlap + 1, F.lit(overlap)))
    return (
        F.when(F.size(chunks) == 0, F.array().cast("array<double>"))
        .when(F.size(chunks) == 1, _doubles(first))
        .otherwise(F.concat(head, seams, tail))
    )


def canonical_json(columns: Sequence[str]) -> Column:
    """Compact JSON of the named columns with sorted keys, nulls written out."""
    fields = F.struct(*[F.col(c) for c in sorted(columns)])
    return F.to_json(fields, {"ignoreNullFields": "false"})


def finite_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """Canonical JSON that refuses NaN and infinities in floating-point columns."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    body = canonical_json(columns)
    for name in columns:
        if kinds[name] in ("float", "double"):
            value = F.col(name)
            bad = F.coalesce(F.isnan(value) | (F.abs(value) == float("inf")), F.lit(False))
            body = F.when(bad, F.raise_error(F.lit(f"{name} is not a finite number")).cast("string")).otherwise(body)
    return body


def canonical_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the canonical JSON."""
    return F.sha2(canonical_json(columns), 256)
