"""Split plan: join two sidecars, set aside unusable texts, reserve prompts, assign phases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.functions.text import whitespace_token_count
from voxframe.operators.aggregates import split_counts
from voxframe.operators.columns import phase_of, text_limit_exclusion
from voxframe.operators.filters import finite, reservable
from voxframe.operators.joins import strict_join
from voxframe.operators.sampling import RESERVED_PROMPTS, SEED, reserved_prompts
from voxframe.session import materialize


def joined_sidecars(
    texts: DataFrame, agreements: DataFrame, key: str = "source_relative_path", expected: int | None = None
) -> DataFrame:
    """Text from one sidecar, agreement from the other; any key defect or non-finite agreement stops the job.

    With ``expected`` the joined rows, and so the rows of either sidecar, must be that many.
    """
    joined = strict_join(texts, agreements, key, ["text"], ["agreement"]).withColumn("agreement", finite(F.col("agreement"), F.col(key)))
    if expected is None:
        return joined
    written = materialize(joined, "sidecars")
    rows = written.count()
    if rows != expected:
        raise ValueError(f"the sidecars hold {rows} rows, {expected} were expected")
    return written


def with_text_limits(rows: DataFrame) -> DataFrame:
    """Token count of the text and the exclusion it causes."""
    counted = rows.withColumn("text_token_count", whitespace_token_count(F.col("text")))
    return counted.withColumn("model_limit_exclusion", text_limit_exclusion(F.col("text_token_count")))


def split_plan(
    rows: DataFrame,
    key: str = "source_relative_path",
    reserve: int = RESERVED_PROMPTS,
    seed: int = SEED,
    strict: bool = True,
) -> DataFrame:
    """Rows with exclusion, reservation and phase. The input needs ``text`` and ``agreement``.

    A non-finite agreement stops the job, and so do too few rows to reserve unless
    ``strict`` is false. The reserved ids are at most ``reserve`` rows, picked by a top-k
    that each task limits first; marking them is a join against that handful.
    """
    limited = with_text_limits(rows.withColumn("agreement", finite(F.col("agreement"), F.col(key))))
    eligible = limited.where(reservable(F.col("agreement"), F.col("model_limit_exclusion")))
    chosen = reserved_prompts(eligible, key, reserve, seed, strict).select(key, "reservation_score")
    marked = limited.join(chosen, key, "left")
    reserved = F.col("reservation_score").isNotNull()
    return marked.withColumn("reserved", reserved).withColumn(
        "phase", phase_of(F.col("model_limit_exclusion"), F.col("agreement"), F.col("reserved"))
    )


def split_summary(
    rows: DataFrame, key: str = "source_relative_path", reserve: int = RESERVED_PROMPTS, seed: int = SEED, strict: bool = True
) -> DataFrame:
    """Counts of a split plan as one row."""
    return split_counts(split_plan(rows, key, reserve, seed, strict))
