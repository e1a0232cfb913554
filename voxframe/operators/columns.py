"""Column derivation: identities, shards, limits, phases, prompt and chat records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxframe.functions.arrays import canonical_hash, canonical_json, once
from voxframe.functions.text import ensure_prompt_prefix, token_string

# ---- fixed values -----------------------------------------------------------
SHARD_COUNT = 519
SHARD_PATTERN = r"^(\d{6})/[^/]+\.mp3$"
MOST_TEXT_TOKENS = 200
PHASE_BOUNDARY = 0.95
TRAINING_COLUMNS = ["source_relative_path", "text", "instruct", "speech_token", "speech_token_len"]
# Fields a mode does not use: prompt text and tokens, or the speaker embedding.
MODE_DROPS = {
    "sft": ["prompt_text", "prompt_speech_token"],
    "zero_shot": [],
    "cross_lingual": ["prompt_text", "prompt_speech_token"],
    "instruct2": ["llm_embedding"],
}
# -----------------------------------------------------------------------------


def training_columns(df: DataFrame, columns: Sequence[str] = TRAINING_COLUMNS) -> DataFrame:
    """Only the text and token columns, so that the scan never touches a payload."""
    return df.select(*columns)


def file_stem(path: Column) -> Column:
    """Last path component without its extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def speaker_of(utterance: Column) -> Column:
    """Speaker id: the part before the first underscore."""
    return F.split_part(utterance, F.lit("_"), F.lit(1))


def shard_of(path: Column, shards: int = SHARD_COUNT) -> Column:
    """Shard number of ``NNNNNN/name.mp3``; null when the path has another form or the number is too high."""
    number = F.regexp_extract(path, SHARD_PATTERN, 1)
    value = F.when(number != "", number.cast("int"))
    return F.when(value < shards, value)


def strict_shard_of(path: Column, shards: int = SHARD_COUNT) -> Column:
    """Like :func:`shard_of`, but a bad path stops the job."""
    return F.coalesce(
        shard_of(path, shards), F.raise_error(F.concat(F.lit("bad shard path: "), path)).cast("int")
    )


def with_instruct(df: DataFrame, instruct: str | None) -> DataFrame:
    """Constant instruction column when one is configured."""
    return df if instruct is None else df.withColumn("instruct", F.lit(instruct))


def text_limit_exclusion(tokens: Column, most: int = MOST_TEXT_TOKENS) -> Column:
    """Why a row's text is unusable, or null. The row itself is kept."""
    return once(
        tokens,
        lambda n: F.when(n == 0, F.lit("text_token_length=0")).when(n > most, F.lit(f"text_token_length>{most}")),
    )


def phase_of(exclusion: Column, agreement: Column, reserved: Column, boundary: float = PHASE_BOUNDARY) -> Column:
    """Phase 1 below the boundary, 2 from it on; null when excluded, without agreement, or reserved."""
    return (
        F.when(exclusion.isNotNull() | agreement.isNull() | reserved, F.lit(None).cast("int"))
        .when(agreement < boundary, F.lit(1))
        .otherwise(F.lit(2))
    )


def prompt_record(text: Column, split: Column, index: Column, data_source: str) -> Column:
    """Nested record for reinforcement learning: two chat turns, the rule to score by, and provenance."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.struct(
        F.lit(data_source).alias("data_source"),
        F.array(turn("user", text), turn("assistant", F.lit(""))).alias("prompt"),
        F.lit("text-to-speech").alias("ability"),
        F.struct(F.lit("rule").alias("style"), text.alias("ground_truth")).alias("reward_model"),
        F.struct(split.alias("split"), index.alias("index"), text.alias("text")).alias("extra_info"),
    )


def chat_turns(mode: Column, text: Column, prompt_text: Column, instruct: Column, prompt_tokens: Column) -> Column:
    """Chat messages by mode; an unknown mode stops the job."""
    blank = F.lit("")
    filled = lambda c: F.when(c != "", c)
    zero_shot = F.concat(F.coalesce(prompt_text, blank), text)
    instructed = F.concat(F.coalesce(filled(prompt_text), filled(instruct), blank), text)
    content = (
        F.when(mode.isin("sft", "cross_lingual"), text)
        .when(mode == "zero_shot", zero_shot)
        .when(mode == "instruct2", instructed)
        .otherwise(F.raise_error(F.concat(F.lit("unsupported mode: "), mode)).cast("string"))
    )
    turn = lambda role, value: F.struct(F.lit(role).alias("role"), value.alias("content"))
    voiced = mode.isin("zero_shot", "cross_lingual") & (F.size(prompt_tokens) > 0)
    reply = F.when(voiced, turn("assistant", token_string(prompt_tokens)))
    return F.array_compact(F.array(turn("user", ensure_prompt_prefix(content)), reply))


def mode_fields(df: DataFrame, mode: str = "mode") -> DataFrame:
    """Blank the input fields each row's mode does not use."""
    out = df
    for column in {c for cs in MODE_DROPS.values() for c in cs} & set(df.columns):
        unused = [m for m, cs in MODE_DROPS.items() if column in cs]
        out = out.withColumn(column, F.when(~F.col(mode).isin(*unused), F.col(column)))
    return out


def with_item_identity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Canonical JSON of the listed columns and its hash, as the identity of a work item."""
    return df.withColumn("item_json", canonical_json(columns)).withColumn("item_sha256", canonical_hash(columns))


def outcome_records(requests: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Every request with its result columns; a request without result is an error with nulls."""
    joined = requests.join(results, key, "left")
    status = F.coalesce("status", F.lit("error")) if "status" in results.columns else F.lit("error")
    return joined.withColumn("status", status)
