"""Evaluation of transcripts: scores, summary, worst rows, published records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxframe.functions.arrays import indices, once
from voxframe.functions.edit import alignment, distance, edit_counts, row_scores
from voxframe.operators.aggregates import error_summary

# ---- fixed values -----------------------------------------------------------
METRIC_PARTS = {
    "utt-wer": ("utterance", "word"),
    "utt-cer": ("utterance", "character"),
    "num-wer": ("number", "word"),
    "num-cer": ("number", "character"),
}
# -----------------------------------------------------------------------------


def with_row_scores(pairs: DataFrame, reference: str, hypothesis: str, start: str = "start", end: str = "end") -> DataFrame:
    """Score struct of each row from its token arrays and number span."""
    scored = row_scores(F.col(reference), F.col(hypothesis), F.col(start), F.col(end))
    return pairs.withColumn("scores", scored)


def metric_summary(scored: DataFrame, category: str = "category") -> DataFrame:
    """Micro and macro error rates overall and by category from ``scores``."""
    columns, metrics = [], {}
    for name, (region, unit) in METRIC_PARTS.items():
        counts = F.col(f"scores.{region}.{unit}")
        columns += [distance(counts).alias(f"{name}_errors"), counts["reference_units"].alias(f"{name}_units")]
        metrics[name] = (f"{name}_errors", f"{name}_units")
    renamed = {m: (e.replace("-", "_"), u.replace("-", "_")) for m, (e, u) in metrics.items()}
    flat = scored.select(category, *columns).toDF(
        category, *[c.replace("-", "_") for pair in metrics.values() for c in pair]
    )
    return error_summary(flat, renamed, category)


def flattened_metrics(summary: DataFrame) -> DataFrame:
    """Summary as ``(name, value)`` scalars; category metrics are named ``category/<category>/<metric>``."""
    name = F.when(F.col("level") == "overall", F.col("metric")).otherwise(
        F.concat_ws("/", F.lit("category"), F.col("category"), F.col("metric"))
    )
    return summary.select(name.alias("name"), "value")


def with_edit_counts(pairs: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """S/D/I and reference length of each row's token arrays as top-level columns."""
    return pairs.withColumn("_counts", edit_counts(F.col(reference), F.col(hypothesis))).select(*pairs.columns, "_counts.*")


def _steps(reference: str, hypothesis: str) -> Column:
    """Alignment of each row as an array of ``(op, ref, hyp)`` with the tokens themselves, null where absent."""
    found = alignment(F.col(reference), F.col(hypothesis))
    places = once(found, lambda a: F.arrays_zip(a["op"].alias("op"), a["ref_at"].alias("r"), a["hyp_at"].alias("h")))
    return F.transform(
        places,
        lambda s: F.struct(s["op"].alias("op"), F.get(F.col(reference), s["r"]).alias("ref"), F.get(F.col(hypothesis), s["h"]).alias("hyp")),
    )


def aligned_rows(pairs: DataFrame, keys: Sequence[str], reference: str, hypothesis: str) -> DataFrame:
    """One row per alignment step: position, operation, reference and hypothesis token (null where absent).

    The tokens are placed in the steps first, so no row carries the whole texts along.
    """
    steps = pairs.select(*keys, _steps(reference, hypothesis).alias("_steps"))
    return steps.select(*keys, F.posexplode("_steps").alias("pos", "s")).select(*keys, "pos", "s.op", "s.ref", "s.hyp")


def error_segments(pairs: DataFrame, keys: Sequence[str], reference: str, hypothesis: str) -> DataFrame:
    """Runs of successive errors merged into one segment; equal tokens stay single.

    A segment is a slice of the row's own alignment, so nothing is shuffled.
    """

    def sliced(steps: Column) -> Column:
        wrong = lambda i: F.get(steps, i)["op"] != "equal"
        starts = F.filter(indices(F.size(steps)), lambda i: (i == 0) | ~wrong(i) | ~F.coalesce(wrong(i - 1), F.lit(False)))
        return once(
            starts,
            lambda at: F.transform(at, lambda i, k: F.slice(steps, i + 1, F.coalesce(F.get(at, k + 1), F.size(steps)) - i)),
        )

    def side(part: str) -> Column:
        tokens = F.filter(F.transform("s", lambda t: t[part]), lambda t: t.isNotNull())
        return F.when(F.size(tokens) == 0, "*").otherwise(F.array_join(tokens, " "))

    segments = pairs.select(*keys, once(_steps(reference, hypothesis), sliced).alias("_segments"))
    rows = segments.select(*keys, F.posexplode("_segments").alias("k", "s"))
    named = rows.select(
        *keys,
        (F.col("k") + 1).cast("bigint").alias("segment"),
        (F.get("s", F.lit(0))["op"] != "equal").alias("is_error"),
        side("ref").alias("ref"),
        side("hyp").alias("hyp"),
    )
    shown = F.when(F.col("is_error"), F.concat(F.lit("("), F.col("ref"), F.lit("->"), F.col("hyp"), F.lit(")"))).otherwise(F.col("ref"))
    return named.withColumn("shown", shown)
