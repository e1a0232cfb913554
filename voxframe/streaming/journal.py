"""Evaluation journal: records arrive repeatedly, only sound and unambiguous ones count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxframe.functions.arrays import canonical_hash

# ---- fixed values -----------------------------------------------------------
RECORD_FIELDS = [
    "benchmark_id",
    "evaluation_identity_sha256",
    "item_sha256",
    "hypothesis",
    "audio_path",
    "audio_sha256",
    "generation_latency_seconds",
    "asr_latency_seconds",
]
# -----------------------------------------------------------------------------


def with_record_hash(records: DataFrame, fields: list[str] = RECORD_FIELDS) -> DataFrame:
    """Hash of a record over all its fields but the hash itself."""
    return records.withColumn("record_sha256", canonical_hash(fields))


def record_valid(identity: str, item_hash: Column, fields: list[str] = RECORD_FIELDS) -> Column:
    """Sound record of the current identity and item whose own hash is right.

    The hypothesis is there, even if empty, the audio hash is a SHA-256 in lower-case hex,
    and both latencies are finite and not negative.
    """

    def latency(name: str) -> Column:
        value = F.col(name).cast("double")
        return value.isNotNull() & ~F.isnan(value) & (value >= 0) & (value < float("inf"))

    checks = (
        (F.col("evaluation_identity_sha256") == identity)
        & (F.col("item_sha256") == item_hash)
        & (F.col("record_sha256") == canonical_hash(fields))
        & F.col("hypothesis").isNotNull()
        & F.col("audio_sha256").rlike("^[0-9a-f]{64}$")
        & latency("generation_latency_seconds")
        & latency("asr_latency_seconds")
    )
    return F.coalesce(checks, F.lit(False))


def usable_records(records: DataFrame, expected: DataFrame, identity: str, key: str = "benchmark_id", source: str | None = None) -> DataFrame:
    """Records to reuse: expected, valid, and the only copy of their id.

    ``expected`` holds the id and its ``expected_item_sha256``, and may hold the
    ``expected_audio_path``. Any second copy of an id
    discards them all, whether valid or not. With ``source``, a file that holds a
    malformed line (``malformed`` true) is discarded whole.
    """
    if source:
        broken = records.where("malformed").select(source).distinct()
        records = records.join(broken, source, "left_anti")
    known = records.join(expected, key)
    repeated = known.groupBy(key).agg(F.count(F.lit(1)).alias("_copies")).where(F.col("_copies") > 1).select(key)
    valid = record_valid(identity, F.col("expected_item_sha256"))
    if "expected_audio_path" in expected.columns:
        valid = valid & F.coalesce(F.col("audio_path") == F.col("expected_audio_path"), F.lit(False))
    return known.where(valid).join(repeated, key, "left_anti").drop("expected_item_sha256", "expected_audio_path")
