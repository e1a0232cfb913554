"""Aggregations. All combine on the map side; none gathers an unbounded group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxframe.functions.arrays import canonical_hash
from voxframe.operators.ordering import running_total, spread_sorted

# ---- fixed values -----------------------------------------------------------
EXCLUSION_REASONS = ["text_token_length=0", "text_token_length>200"]
HTTP_MS_EDGES = [5, 10, 25, 50, 100, 200, 400, 800, 1500, 3000, 5000, 10000, 20000]
FIRST_CHUNK_MS_EDGES = [10, 25, 50, 100, 200, 400, 800, 1500, 3000, 5000, 10000, 20000]
COMPLETE_MS_EDGES = [10, 25, 50, 100, 200, 400, 800, 1500, 3000, 5000, 10000, 20000, 30000, 60000]
RTF_EDGES = [0.05, 0.1, 0.2, 0.4, 0.8, 1.0, 1.5, 2.0, 3.0, 5.0, 10.0]
DURATION_SEC_EDGES = [0.1, 0.25, 0.5, 1, 2, 3, 5, 8, 12, 20, 30, 45, 60]
LATENCY_PERCENTILES = [50, 90, 95, 99]
DIGEST_LEVELS = (8, 6, 4, 2)
# -----------------------------------------------------------------------------


def mean_vectors(df: DataFrame, by: Sequence[str], vector: str, out: str = "mean_vector") -> DataFrame:
    """Element-wise mean of an array column per group; arrays of one group must have one length."""
    present = df.where(F.col(vector).isNotNull())
    return present.groupBy(*by).agg(vector_to_array(Summarizer.mean(array_to_vector(F.col(vector)))).alias(out))


def grouped_lists(df: DataFrame, by: str, value: str, chunk: int = 10000, out: str = "values") -> DataFrame:
    """Sorted values per group as lists of at most ``chunk``; a big group takes several ``part`` rows.

    Copies of a value are counted before anything is ordered and written out again inside
    the lists, so neither a hot group nor a hot value meets in one task.
    """
    counted = df.groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(spread_sorted(counted, by, value), "_n", "_end", [by])
    placed = placed.withColumn("_start", F.col("_end") - F.col("_n"))
    whole = lambda column: F.floor(column / chunk)
    parts = placed.withColumn("part", F.explode(F.sequence(whole(F.col("_start")), whole(F.col("_end") - 1))))
    copies = F.least("_end", (F.col("part") + 1) * chunk) - F.greatest("_start", F.col("part") * chunk)
    lists = parts.groupBy(by, F.col("part").cast("int").alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("_start", F.col(value), copies.cast("int").alias("_copies")))).alias("_rows")
    )
    return lists.select(by, "part", F.flatten(F.transform("_rows", lambda r: F.array_repeat(r[value], r["_copies"]))).alias(out))


def split_counts(plan: DataFrame) -> DataFrame:
    """Excluded, null, reserved and phase counts of a split plan; each row counts once, in that order."""
    excluded = F.col("model_limit_exclusion").isNotNull()
    null = ~excluded & F.col("agreement").isNull()
    reserved = ~excluded & ~null & F.col("reserved")
    rest = ~excluded & ~null & ~reserved
    return plan.agg(
        F.count_if(rest & (F.col("phase") == 1)).alias("phase1"),
        F.count_if(rest & (F.col("phase") == 2)).alias("phase2"),
        F.count_if(null).alias("null_agreement"),
        F.count_if(reserved).alias("reserved"),
        F.count_if(excluded).alias("excluded"),
        F.count(F.lit(1)).alias("total"),
    )


def exclusion_counts(plan: DataFrame, known: Sequence[str] = EXCLUSION_REASONS) -> DataFrame:
    """Rows per exclusion reason; an unknown reason stops the job."""
    reason = F.col("model_limit_exclusion")
    checked = F.when(reason.isin(*known), reason).otherwise(
        F.raise_error(F.concat(F.lit("unknown exclusion reason: "), reason)).cast("string")
    )
    rows = plan.where(reason.isNotNull()).groupBy("model_limit_exclusion").agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(checked.alias("reason"), "rows")


def reconciled_counts(counts: DataFrame, total: str, parts: Sequence[str], expected: Mapping[str, int] | None = None) -> DataFrame:
    """One-row count table; parts must add up and equal the expected constants, else the job stops."""
    ok = sum((F.col(p) for p in parts), F.lit(0)) == F.col(total)
    for name, value in (expected or {}).items():
        ok = ok & (F.col(name) == value)
    return counts.where(F.when(ok, F.lit(True)).otherwise(F.raise_error("counts do not reconcile").cast("boolean")))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, sorted by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(column)


def token_audit(df: DataFrame, by: Sequence[str], tokens: str) -> DataFrame:
    """Rows and the smallest and largest token per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(F.array_min(tokens)).alias("token_min"),
        F.max(F.array_max(tokens)).alias("token_max"),
    )


def rolled_up(audit: DataFrame, by: Sequence[str]) -> DataFrame:
    """Second-level roll-up of :func:`token_audit`."""
    return audit.groupBy(*by).agg(
        F.count(F.lit(1)).alias("shards"),
        F.sum("row_count").alias("row_count"),
        F.min("token_min").alias("token_min"),
        F.max("token_max").alias("token_max"),
    )


def micro_rate(errors: Column, units: Column) -> Column:
    """Total errors over total reference units."""
    return F.try_divide(F.sum(errors), F.sum(units))


def macro_rate(errors: Column, units: Column) -> Column:
    """Mean of the rows' own rates; rows without reference units have none."""
    return F.avg(F.try_divide(errors, units))


def error_summary(scores: DataFrame, metrics: Mapping[str, tuple[str, str]], category: str) -> DataFrame:
    """Micro and macro rates overall and by category, as ``(level, category, metric, value)``.

    ``metrics`` maps a metric name to its error and reference-unit columns. Rows with
    an empty reference are counted in ``empty-reference-rows``.
    """
    aggregates = []
    for name, (errors, units) in metrics.items():
        aggregates.append(micro_rate(F.col(errors), F.col(units)).alias(name))
        aggregates.append(macro_rate(F.col(errors), F.col(units)).alias(f"macro-{name}"))
    first_units = next(iter(metrics.values()))[1]
    aggregates.append(F.count_if(F.col(first_units) == 0).cast("double").alias("empty-reference-rows"))
    names = [n for m in metrics for n in (m, f"macro-{m}")] + ["empty-reference-rows"]
    wide = (
        scores.groupingSets([[F.col(category)], []], category)
        .agg(F.grouping(category).alias("_all"), *aggregates)
        .withColumn("level", F.when(F.col("_all") == 1, "overall").otherwise("category"))
    )
    return wide.unpivot(["level", category], [f"`{n}`" for n in names], "metric", "value").select(
        "level", F.col(category).alias("category"), F.regexp_replace("metric", "`", "").alias("metric"), "value"
    )


def corpus_error_line(counts: DataFrame) -> DataFrame:
    """Errors by kind, correct units, reference length and the rate in percent to two decimals."""
    sums = counts.agg(
        F.sum("insertions").alias("insertions"),
        F.sum("deletions").alias("deletions"),
        F.sum("substitutions").alias("substitutions"),
        F.sum("reference_units").alias("reference_units"),
    )
    errors = F.col("insertions") + F.col("deletions") + F.col("substitutions")
    return sums.withColumn(
        "correct", F.col("reference_units") - F.col("deletions") - F.col("substitutions")
    ).withColumn("rate_percent", F.round(F.try_divide(errors * 100.0, F.col("reference_units")), 2))


def confusion_counts(aligned: DataFrame) -> DataFrame:
    """Counts per operation and token pair, most frequent and then largest first within an operation."""
    errors = aligned.where(F.col("op") != "equal")
    counted = errors.groupBy("op", "ref", "hyp").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy("op", F.desc("count"), F.desc("ref"), F.desc("hyp"))


def per_word_stats(aligned: DataFrame) -> DataFrame:
    """Per word: correct, total errors, occurrences in reference and hypothesis."""
    op = F.col("op")
    sides = F.array(
        F.struct(F.col("ref").alias("word"), F.lit("ref").alias("side")),
        F.struct(F.col("hyp").alias("word"), F.lit("hyp").alias("side")),
    )
    rows = aligned.select(op, F.explode(sides).alias("s")).where(F.col("s.word").isNotNull())
    ref_side, hyp_side = F.col("s.side") == "ref", F.col("s.side") == "hyp"
    counted = rows.groupBy(F.col("s.word").alias("word")).agg(
        F.count_if(ref_side & (op == "equal")).alias("correct"),
        F.count_if(ref_side & (op == "substitution")).alias("ref_sub"),
        F.count_if(hyp_side & (op == "substitution")).alias("hyp_sub"),
        F.count_if(op == "insertion").alias("ins"),
        F.count_if(op == "deletion").alias("dels"),
    )
    return counted.select(
        "word",
        "correct",
        (F.col("ref_sub") + F.col("hyp_sub") + F.col("ins") + F.col("dels")).alias("errors"),
        (F.col("correct") + F.col("ref_sub") + F.col("dels")).alias("ref_count"),
        (F.col("correct") + F.col("hyp_sub") + F.col("ins")).alias("hyp_count"),
    )


def exact_percentiles(df: DataFrame, value: str, percents: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated percentiles, exact, without bringing a group's values together.

    Equal values are counted first, the distinct values are sorted across the cluster,
    and running counts locate the two neighbours of every percentile.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_count"))
    sorted_counts = spread_sorted(counts, *by, value)
    ranked = running_total(sorted_counts, "_count", "_upto", by)
    totals = sorted_counts.groupBy(*by).agg(F.sum("_count").alias("_n"))
    placed = ranked.join(totals, list(by)) if by else ranked.withColumn("_n", F.lit(totals.first()["_n"]))
    low_aggs = []
    for p in percents:
        at = (F.col("_n") - 1) * (p / 100.0)
        for name, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (index < F.col("_upto")) & (index >= F.col("_upto") - F.col("_count"))
            low_aggs.append(F.max(F.when(here, F.col(value))).alias(f"_{name}_{p}"))
        low_aggs.append(F.max(at - F.floor(at)).alias(f"_share_{p}"))
    picked = placed.groupBy(*by).agg(*low_aggs)
    columns = [
        (F.col(f"`_lo_{p}`") + (F.col(f"`_hi_{p}`") - F.col(f"`_lo_{p}`")) * F.col(f"`_share_{p}`")).alias(f"p{p:g}")
        for p in percents
    ]
    return picked.select(*by, *columns)


def latency_summary(df: DataFrame, seconds: str, by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Mean and percentiles in milliseconds, variance of the seconds times 1000, and the true variance in ms².

    ``approximate`` trades the exact percentiles, which need a sort, for sketches.
    """
    present = df.where(F.col(seconds).isNotNull())
    s = F.col(seconds)
    basic = present.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        (F.avg(s) * 1000).alias("mean_ms"),
        (F.var_pop(s) * 1000).alias("variance_x1000"),
        (F.var_pop(s) * 1000000).alias("variance_ms2"),
        *(
            [F.percentile_approx(s, p / 100.0).alias(f"p{p:g}") for p in LATENCY_PERCENTILES]
            if approximate
            else []
        ),
    )
    if not approximate:
        percentiles = exact_percentiles(present, seconds, LATENCY_PERCENTILES, by)
        if by:
            basic = basic.join(percentiles, list(by))
        else:
            found = percentiles.first()
            basic = basic.withColumns({name: F.lit(found[name]) for name in percentiles.columns})
    scaled = {f"p{p:g}_ms": F.col(f"p{p:g}") * 1000 for p in LATENCY_PERCENTILES}
    return basic.withColumns(scaled).drop(*[f"p{p:g}" for p in LATENCY_PERCENTILES])


def real_time_factor(elapsed: Column, audio_seconds: Column) -> Column:
    """Elapsed over audio time; infinite without audio."""
    return F.when(audio_seconds == 0, F.lit(float("inf"))).otherwise(F.try_divide(elapsed, audio_seconds))


def stage_totals(df: DataFrame, by: Sequence[str], stage: str, stages: Sequence[str], seconds: str) -> DataFrame:
    """Total seconds per stage, one column per stage."""
    return df.groupBy(*by).pivot(stage, list(stages)).agg(F.sum(seconds))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of batch values weighted by batch size."""
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def histogram(df: DataFrame, labels: Sequence[str], value: str, edges: Sequence[float]) -> DataFrame:
    """Cumulative histogram: one row per label set and edge with the rows at or below it, plus sum and count."""
    below = [F.count_if(F.col(value) <= e).alias(f"_b{i}") for i, e in enumerate(edges)]
    counted = df.where(F.col(value).isNotNull()).groupBy(*labels).agg(
        *below, F.count(F.lit(1)).alias("_count"), F.sum(value).alias("_sum")
    )
    buckets = F.array(
        *[F.struct(F.lit(float(e)).alias("le"), F.col(f"_b{i}").alias("n")) for i, e in enumerate(edges)],
        F.struct(F.lit(float("inf")).alias("le"), F.col("_count").alias("n")),
    )
    return counted.select(*labels, F.explode(buckets).alias("b"), "_sum", "_count").select(
        *labels, F.col("b.le").alias("le"), F.col("b.n").alias("bucket"), F.col("_sum").alias("sum"), F.col("_count").alias("count")
    )


def batch_statistics(df: DataFrame, model: str, size: str, count: str, ns: str) -> DataFrame:
    """Per model and batch size: executions, total and mean time in ms, mean per sample; unused sizes are left out."""
    total = F.col("total_ms")
    return (
        df.groupBy(model, size)
        .agg(F.sum(count).alias("executions"), (F.sum(ns) / 1e6).alias("total_ms"))
        .where(F.col("executions") > 0)
        .withColumn("mean_ms", total / F.col("executions"))
        .withColumn("mean_ms_per_sample", F.try_divide(total / F.col("executions"), F.col(size)))
    )


def masked_matches(predicted: Column, target: Column, ignore: int = -1) -> Column:
    """``struct<matches, units>`` over the positions whose target is not ignored."""
    hits = F.zip_with(predicted, target, lambda p, t: F.when(t != ignore, (p == t).cast("int")))
    counted = F.filter(hits, lambda h: h.isNotNull())
    return F.struct(
        F.aggregate(counted, F.lit(0), lambda a, h: a + h).alias("matches"), F.size(counted).alias("units")
    )


def all_exact(df: DataFrame, check: Sequence[str], correct: str, target: str) -> DataFrame:
    """Per check: is every sample right in all positions?"""
    return df.groupBy(*check).agg(F.bool_and(F.col(correct) == F.col(target)).alias("all_exact"), F.count(F.lit(1)).alias("samples"))


def dataset_digest(df: DataFrame, columns: Sequence[str], levels: Sequence[int] = DIGEST_LEVELS) -> DataFrame:
    """Order-independent digest of a table as a hash tree.

    Rows are hashed, equal rows counted, and hashes with a common prefix digested
    together, level by level. The prefix lengths are part of the digest's definition and
    the same for every table: the first leaves few rows to a group up to some 10**12 rows,
    and every other node has at most 256 children.
    """
    level = df.groupBy(canonical_hash(columns).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    level = level.select("_h", F.concat_ws(":", "_h", "_n").alias("_leaf"), "_n")
    for length in [*levels, 0]:
        level = (
            level.groupBy(F.substring("_h", 1, length).alias("_h"))
            .agg(
                F.sha2(F.array_join(F.sort_array(F.collect_list("_leaf")), ","), 256).alias("_d"),
                F.sum("_n").alias("_n"),
            )
            .select("_h", F.concat_ws(":", "_h", "_d").alias("_leaf"), "_n", "_d")
        )
    return level.select(F.col("_d").alias("digest"), F.col("_n").alias("rows"))


def preference_metrics(df: DataFrame, chosen: str, rejected: str, loss: str) -> DataFrame:
    """Mean rewards, mean loss and the share of pairs whose chosen reward is higher."""
    return df.agg(
        F.avg(chosen).alias("chosen_reward"),
        F.avg(rejected).alias("rejected_reward"),
        F.avg((F.col(chosen) > F.col(rejected)).cast("double")).alias("accuracy"),
        F.avg(loss).alias("loss"),
    )


def distinct_check(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Rows, distinct values and whether every value is distinct."""
    distinct = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(F.count(column).alias("rows"), distinct.alias("distinct_values")).withColumn(
        "all_distinct", F.col("rows") == F.col("distinct_values")
    )
