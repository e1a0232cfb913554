"""Request telemetry on batch tables and streams alike.

The watermark and the handling of late rows are this package's own policy: a row later
than the watermark is dropped, a request silent for the timeout is closed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.functions.signal import SAMPLE_RATE

# ---- fixed values -----------------------------------------------------------
WATERMARK = "10 minutes"
REQUEST_TIMEOUT = "5 minutes"
# -----------------------------------------------------------------------------


def windowed_counts(events: DataFrame, labels: Sequence[str], ts: str = "ts", width: str = "1 hour", late: str = WATERMARK) -> DataFrame:
    """Requests per tumbling window and label set."""
    counted = events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), *labels)
    return counted.agg(F.count(F.lit(1)).alias("requests")).select(
        F.col("w.start").alias("window_start"), *labels, "requests"
    )


def windowed_histogram(
    events: DataFrame,
    labels: Sequence[str],
    value: str,
    edges: Sequence[float],
    ts: str = "ts",
    width: str = "1 day",
    slide: str | None = None,
    late: str = WATERMARK,
) -> DataFrame:
    """Cumulative histogram per tumbling or sliding window, one column per edge plus sum and count."""
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    below = [F.count_if(F.col(value) <= e).alias(f"le_{i}") for i, e in enumerate(edges)]
    counted = events.withWatermark(ts, late).groupBy(window.alias("w"), *labels).agg(
        *below, F.sum(value).alias("total"), F.count(value).alias("observations")
    )
    return counted.select(
        F.col("w.start").alias("window_start"), *labels, *[f"le_{i}" for i in range(len(edges))], "total", "observations"
    )


def request_lifecycle(
    events: DataFrame,
    request: str = "request_id",
    ts: str = "ts",
    kind: str = "kind",
    size: str = "bytes",
    rate: int = SAMPLE_RATE,
    timeout: str = REQUEST_TIMEOUT,
    late: str = WATERMARK,
) -> DataFrame:
    """One row per request: chunks, bytes, first-chunk latency, total time, RTF and status.

    A request ends when it has been silent for ``timeout``; without a ``stream_done`` or
    ``error`` event by then it is ``unfinished``. Everything is an ordinary aggregate, so
    rows are combined before they are shuffled.
    """
    at = F.col(ts)
    is_kind = lambda k: F.col(kind) == k
    grouped = events.withWatermark(ts, late).groupBy(F.session_window(ts, timeout).alias("w"), request).agg(
        F.min(F.when(is_kind("stream_start"), at)).alias("_start"),
        F.min(F.when(is_kind("chunk"), at)).alias("_first"),
        F.max(F.when(is_kind("stream_done") | is_kind("error"), at)).alias("_end"),
        F.count_if(is_kind("chunk")).alias("chunks"),
        F.coalesce(F.sum(F.when(is_kind("chunk"), F.col(size))), F.lit(0)).alias("bytes"),
        F.bool_or(is_kind("error")).alias("_failed"),
    )
    seconds = lambda a, b: (F.unix_micros(b) - F.unix_micros(a)) / 1e6
    total = seconds(F.col("_start"), F.col("_end"))
    audio = F.col("bytes") / 2.0 / rate
    status = F.when(F.col("_failed"), "error").when(F.col("_end").isNull(), "unfinished").otherwise("ok")
    return grouped.select(
        request,
        F.col("w.start").alias("opened"),
        "chunks",
        "bytes",
        seconds(F.col("_start"), F.col("_first")).alias("first_chunk_seconds"),
        total.alias("total_seconds"),
        F.when(F.col("bytes") > 0, total / audio).when(total.isNotNull(), F.lit(0.0)).alias("rtf"),
        status.alias("status"),
    )


def active_level(events: DataFrame, labels: Sequence[str], delta: str) -> DataFrame:
    """Current number of active requests per label set from +1 and -1 events."""
    return events.groupBy(*labels).agg(F.sum(delta).alias("active"))


def user_sessions(events: DataFrame, user: str, ts: str = "ts", gap: str = "30 minutes", late: str = WATERMARK) -> DataFrame:
    """Sessions of a user's requests: a longer pause than ``gap`` starts a new one."""
    return (
        events.withWatermark(ts, late)
        .groupBy(F.session_window(ts, gap).alias("w"), user)
        .agg(F.count(F.lit(1)).alias("requests"), F.max(ts).alias("last_request"))
        .select(user, F.col("w.start").alias("session_start"), "last_request", "requests")
    )
