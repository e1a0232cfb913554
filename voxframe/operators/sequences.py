"""Row sequences: streaks, request latencies, levels and sessions, also for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxframe.functions.arrays import overlap_add
from voxframe.operators.ordering import previous_row, ranks_of, running_total, spread_sorted

# ---- fixed values -----------------------------------------------------------
PASSES_NEEDED = 3
# -----------------------------------------------------------------------------


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp with or without time zone."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(column.cast("timestamp"))


def longest_streaks(df: DataFrame, within: Sequence[str], order: Sequence[str], passed: str, need: int = PASSES_NEEDED) -> DataFrame:
    """Longest run of consecutive passes per group and whether it reaches ``need``."""
    failed = df.withColumn("_failed", (~F.coalesce(F.col(passed), F.lit(False))).cast("int"))
    islands = running_total(spread_sorted(failed, *within, *order), "_failed", "_island", within)
    runs = islands.groupBy(*within, "_island").agg(F.count_if(F.col("_failed") == 0).alias("_run"))
    return runs.groupBy(*within).agg(F.max("_run").alias("longest")).withColumn("reached", F.col("longest") >= need)


def chunk_latencies(df: DataFrame, request: str, ts: str, *tie: str) -> DataFrame:
    """Seconds from a request's first event to its second, and from the second to the third."""
    ranked = ranks_of(spread_sorted(df.select(request, ts, *tie), request, ts, *tie), [request])
    at = lambda n: F.max(F.when(F.col("rank") == n, micros(ts)))
    times = ranked.groupBy(request).agg(at(0).alias("_a"), at(1).alias("_b"), at(2).alias("_c"))
    return times.select(
        request,
        ((F.col("_b") - F.col("_a")) / 1e6).alias("first_chunk_seconds"),
        ((F.col("_c") - F.col("_b")) / 1e6).alias("second_chunk_seconds"),
    )


def gaps(df: DataFrame, request: str, ts: str, *tie: str) -> DataFrame:
    """Seconds since the previous event of the same request; null for its first."""
    stepped = previous_row(spread_sorted(df, request, ts, *tie), [ts], "_prev", [request])
    seconds = (micros(ts) - micros(f"_prev.{ts}")) / 1e6
    return stepped.withColumn("gap_seconds", seconds).drop("_prev", "_part", "_pos")


def active_levels(df: DataFrame, delta: str, *order: str, within: Sequence[str] = ()) -> DataFrame:
    """Running number of active requests after each +1 or -1 event."""
    return running_total(spread_sorted(df, *within, *order), delta, "active", within).drop("_part", "_pos")


def sessions(df: DataFrame, user: str, ts: str, tie: str, gap_seconds: float) -> DataFrame:
    """Sessions per user: a pause longer than the gap starts a new one."""
    stepped = previous_row(spread_sorted(df.select(user, ts, tie), user, ts, tie), [ts], "_prev", [user])
    pause = micros(ts) - micros(f"_prev.{ts}")
    opened = stepped.withColumn("_opens", F.coalesce(pause >= gap_seconds * 1e6, F.lit(True)).cast("int"))
    numbered = running_total(opened, "_opens", "session", [user])
    return numbered.groupBy(user, "session").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("last_request"), F.count(F.lit(1)).alias("requests")
    )


def reassembled(df: DataFrame, request: str, order: str, chunk: str, rate: int, overlap: int = 0) -> DataFrame:
    """A request's chunks in arrival order as one array, with its duration; empty chunks are skipped.

    With ``overlap`` neighbouring chunks share that many samples and are blended.
    """
    arrived = F.transform(F.sort_array(F.collect_list(F.struct(order, chunk))), lambda s: s[chunk])
    chunks = F.filter(arrived, lambda c: F.size(c) > 0)
    grouped = df.groupBy(request).agg(chunks.alias("_chunks"))
    joined = overlap_add(F.col("_chunks"), overlap) if overlap else F.flatten("_chunks")
    return grouped.select(request, joined.alias("samples")).withColumn("duration", F.size("samples") / float(rate))
