"""Corpus shards: manifests to utterance rows to fixed-size Parquet shards with their indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.operators.aggregates import mean_vectors
from voxframe.operators.joins import optional
from voxframe.session import materialize
from voxframe.sources.sinks import ROWS_PER_SHARD, shard_files, shard_index, sharded, write_shards


def with_vectors(rows: DataFrame, vectors: DataFrame) -> DataFrame:
    """Utterance vector where there is one, and the mean vector of the utterance's speaker.

    The speakers' means are written first: the planner then knows their size and
    broadcasts them if they are small, otherwise it joins by speaker and splits the
    speakers that are too big for one task.
    """
    owned = vectors.join(rows.select("utt", "spk"), "utt")
    speakers = materialize(mean_vectors(owned, ["spk"], "vector", "spk_embedding"), "speakers")
    own = vectors.select("utt", F.col("vector").alias("utt_embedding"))
    return rows.join(own, "utt", "left").join(speakers, "spk", "left")


def with_tokens(rows: DataFrame, tokens: DataFrame | None, rejected: DataFrame | None) -> DataFrame:
    """Speech tokens and rejected tokens where they exist."""
    out = optional(rows, tokens, "utt", "speech_token", "array<int>")
    return optional(out, rejected, "utt", "reject_speech_token", "array<int>")


def build_shards(rows: DataFrame, path: str, size: int = ROWS_PER_SHARD) -> dict[str, DataFrame]:
    """Write shards of ``size`` utterances; returns the utterance, speaker and shard-file lists.

    The rows are shuffled once, into utterance order.
    """
    write_shards(sharded(rows, ["utt"], size), path)
    written = rows.sparkSession.read.parquet(path)
    return {
        "utterances": shard_index(written, "utt"),
        "speakers": shard_index(written, "spk"),
        "shards": shard_files(written, path),
    }
