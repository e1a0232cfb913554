"""Row predicates. Each returns a boolean Column or a reason Column, for ``where`` or for audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxframe.functions.arrays import once
from voxframe.functions.signal import least_pcm_bytes
from voxframe.operators.columns import PHASE_BOUNDARY


def length_drop_reason(
    frames: Column,
    text_tokens: Column,
    speech_tokens: Column | None = None,
    rejected_tokens: Column | None = None,
    most_frames: float = 10240,
    least_frames: float = 10,
    most_tokens: int = 200,
    least_tokens: int = 1,
    least_ratio: float = 0.0005,
    most_ratio: float = 1,
) -> Column:
    """First length rule a row breaks, or null.

    The counts are numbers, not arrays. Token ratios are not tested without frames;
    speech and rejected tokens only when they are precomputed.
    """
    given = F.struct(
        frames.alias("frames"),
        text_tokens.alias("tokens"),
        (F.lit(1) if speech_tokens is None else speech_tokens).alias("speech"),
        (F.lit(1) if rejected_tokens is None else rejected_tokens).alias("rejected"),
    )

    def first_broken(v: Column) -> Column:
        ratio = F.try_divide(v["tokens"], v["frames"])
        return (
            F.when(v["frames"] < least_frames, "frames<min")
            .when(v["frames"] > most_frames, "frames>max")
            .when(v["tokens"] < least_tokens, "tokens<min")
            .when(v["tokens"] > most_tokens, "tokens>max")
            .when(v["speech"] == 0, "no speech tokens")
            .when(v["rejected"] == 0, "no rejected tokens")
            .when(ratio < least_ratio, "ratio<min")
            .when(ratio > most_ratio, "ratio>max")
        )

    return once(given, first_broken)


def rate_acceptable(rate: Column, target: int, least: int = 16000) -> Column:
    """A rate other than the target must reach the minimum."""
    return (rate == target) | (rate >= least)


def tokens_unless_long(tokens: Column, seconds: Column, most: float = 30) -> Column:
    """Empty token list for over-long audio; the row stays."""
    return F.when(seconds > most, F.array().cast("array<int>")).otherwise(tokens)


def rejection_sampling_usable(seconds: Column, limit: float = 30) -> Column:
    """Audio short enough for rejection sampling."""
    return seconds < limit


def finite(value: Column, key: Column) -> Column:
    """The value, or null; NaN and infinities stop the job with the row's key."""
    odd = F.isnan(value.cast("double")) | (F.abs(value.cast("double")) == float("inf"))
    message = F.concat(F.lit("agreement is not finite: "), F.coalesce(key.cast("string"), F.lit("null")))
    return F.when(F.coalesce(odd, F.lit(False)), F.raise_error(message).cast("double")).otherwise(value)


def reservable(agreement: Column, exclusion: Column, boundary: float = PHASE_BOUNDARY) -> Column:
    """Rows that may be reserved as prompts."""
    return F.coalesce(agreement >= boundary, F.lit(False)) & exclusion.isNull()


def training_row_issue(df: DataFrame, boundary: float = PHASE_BOUNDARY) -> Column:
    """What is wrong with a phase 1 or 2 plan row, or null; other rows are not judged."""
    text_missing = F.coalesce(F.col("text") == "", F.lit(True))
    instruct_missing = F.coalesce(F.col("instruct") == "", F.lit(True))
    agreement = F.col("agreement")
    issue = (
        F.when(text_missing, "text")
        .when(instruct_missing, "instruct")
        .when(F.coalesce(F.col("text_token_count") < 1, F.lit(True)), "text_token_count")
        .when(agreement.isNull() | F.isnan(agreement), "agreement")
        .when((F.col("phase") == 1) & ~(agreement < boundary), "agreement for phase 1")
        .when((F.col("phase") == 2) & ~(agreement >= boundary), "agreement for phase 2")
        .when(F.coalesce(F.col("reserved"), F.lit(True)), "reserved")
        .when(F.col("model_limit_exclusion").isNotNull(), "exclusion")
    )
    return F.when(F.col("phase").isin(1, 2), issue)


def route_issue(phase: Column, reserved: Column, agreement: Column) -> Column:
    """Violation of the routing rules of a plan row, or null."""
    return (
        F.when(reserved & phase.isNotNull(), "reserved row has a phase")
        .when(phase.isNotNull() & ~phase.isin(1, 2), "unknown phase")
        .when(phase.isNotNull() & agreement.isNull(), "phase without agreement")
    )


def pcm_issue(pcm_bytes: Column, min_tokens: Column, rate: int) -> Column:
    """Odd or too short 16-bit output, or null."""
    return F.when(pcm_bytes % 2 != 0, "odd byte count").when(
        pcm_bytes < least_pcm_bytes(min_tokens, rate), "too little audio"
    )


def shorter_than_prompt(text: Column, prompt: Column) -> Column:
    """Text less than half as long as its prompt."""
    return F.char_length(text) < F.char_length(prompt) * 0.5


def capped(df: DataFrame, count: int, *order: str | Column) -> DataFrame:
    """First ``count`` rows of a stable order; the cap a caller asks for."""
    return df.orderBy(*order).limit(count)
