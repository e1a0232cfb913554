"""Level, duration, reward and preference arithmetic."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------
FRAMES_PER_SECOND = 100
TOKENS_PER_SECOND = 25
SAMPLE_RATE = 24000
MOST_NEW_TOKENS = 2048
LEAST_TOKEN_RATIO = 2
MOST_TOKEN_RATIO = 20
PCM_SCALE = 32768.0
# -----------------------------------------------------------------------------

AUDIO_METRICS = T.StructType(
    [
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("silence_ratio", T.DoubleType()),
        T.StructField("leading_silence_sec", T.DoubleType()),
        T.StructField("trailing_silence_sec", T.DoubleType()),
        T.StructField("rms_dbfs", T.DoubleType()),
        T.StructField("peak_dbfs", T.DoubleType()),
    ]
)


def _decibels(value: float) -> float | None:
    return 20.0 * math.log10(value) if value > 0.0 else None


def _measure(samples: np.ndarray, rate: int, threshold: float) -> tuple:
    total = len(samples)
    if total == 0:
        return (0.0, 1.0, 0.0, 0.0, None, None)
    level = np.abs(samples)
    loud = np.flatnonzero(level > threshold)
    lead = int(loud[0]) if len(loud) else total
    trail = total - 1 - int(loud[-1]) if len(loud) else total
    rms = float(np.sqrt(np.mean(samples * samples)))
    return (
        total / rate,
        (total - len(loud)) / total,
        lead / rate,
        trail / rate,
        _decibels(rms),
        _decibels(float(level.max())),
    )


def audio_metrics(samples: Column, rate: Column, silence_dbfs: float = -50.0) -> Column:
    """Duration, silence shares and levels of a float sample array in [-1, 1]."""
    threshold = 10 ** (silence_dbfs / 20.0)

    @F.pandas_udf(AUDIO_METRICS)
    def measure(arrays: pd.Series, rates: pd.Series) -> pd.DataFrame:
        rows = [_measure(np.asarray(a, dtype=np.float64), int(r), threshold) for a, r in zip(arrays, rates)]
        return pd.DataFrame(rows, columns=AUDIO_METRICS.fieldNames())

    return measure(samples, rate)


@F.pandas_udf(T.ArrayType(T.FloatType()))
def pcm16_samples(payload: pd.Series) -> pd.Series:
    """Float samples of little-endian 16-bit mono PCM bytes; a dangling last byte is ignored."""
    return payload.map(
        lambda b: np.frombuffer(b[: len(b) // 2 * 2], dtype="<i2").astype(np.float32) / np.float32(PCM_SCALE),
        na_action="ignore",
    )


def samples_from_shorts(samples: Column) -> Column:
    """Float samples of an ``array<short>``."""
    return F.transform(samples, lambda v: (v / PCM_SCALE).cast("float"))


def frame_count(samples: Column, rate: Column) -> Column:
    """Number of 10 ms frames."""
    return samples / rate * FRAMES_PER_SECOND


def duration_seconds(frames: Column, rate: Column) -> Column:
    """Length in seconds."""
    return frames / rate


def token_rate(tokens: Column, seconds: Column) -> Column:
    """Tokens per second, null without duration."""
    return F.try_divide(tokens, seconds)


def transcript_reward(error_rate: Column) -> Column:
    """Reward in [0, 1] that falls with the error rate."""
    return F.least(F.greatest(1 - F.tanh(error_rate * 3), F.lit(0.0)), F.lit(1.0))


def token_bounds(text_tokens: Column) -> tuple[Column, Column]:
    """Fewest and most speech tokens to generate for a text of that many tokens (one at least)."""
    n = F.greatest(text_tokens, F.lit(1))
    low = n * LEAST_TOKEN_RATIO
    high = F.least(F.lit(MOST_NEW_TOKENS), F.greatest(low, n * MOST_TOKEN_RATIO))
    return low, high


def least_pcm_bytes(min_tokens: Column, rate: int = SAMPLE_RATE) -> Column:
    """Bytes below which 16-bit output is too short for its token bound."""
    seconds = F.greatest(F.lit(0.05), min_tokens / float(TOKENS_PER_SECOND) * 0.5)
    return (seconds * rate * 2).cast("bigint")


def _log_sigmoid(x: Column) -> Column:
    # log(sigmoid(x)) = min(x, 0) - log1p(exp(-|x|)), stable at both ends.
    return F.least(x, F.lit(0.0)) - F.log1p(F.exp(-F.abs(x)))


def preference_loss(
    policy_chosen: Column,
    policy_rejected: Column,
    base_chosen: Column,
    base_rejected: Column,
    beta: float,
    smoothing: float = 0.0,
    squared: bool = False,
) -> tuple[Column, Column, Column]:
    """Loss, chosen reward and rejected reward from the four log-probabilities of a pair.

    ``squared`` takes the squared form around ``1 / (2 beta)`` instead of the logistic one.
    """
    margin = (policy_chosen - policy_rejected) - (base_chosen - base_rejected)
    if squared:
        gap = margin - 1 / (2 * beta)
        loss = gap * gap
    else:
        loss = -_log_sigmoid(margin * beta) * (1 - smoothing) - _log_sigmoid(-margin * beta) * smoothing
    return loss, (policy_chosen - base_chosen) * beta, (policy_rejected - base_rejected) * beta
