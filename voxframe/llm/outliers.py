"""Quality rules: fixed rules, and robust multivariate outliers, in DataFrame functions only.

A document's statistics are transformed and put on an integer grid. Documents of one language and source form a stratum;
strata of too few documents are pooled by language, and what is still too small over all languages. Every stratum gets a
minimum-covariance-determinant estimate: from three starts around the medians, concentration steps keep the ``COVERED``
share of documents that are nearest by Mahalanobis distance. After ``TRIALS`` steps the start of the least determinant
goes on until the determinant settles, and gives centre and scatter. Documents further off than ``CUTOFF`` of a
chi-squared variable are rejected.

A step is one aggregation: equal vectors are one row with a count, distances go into bins of equal ratio that enter the
kept share whole, and each bin carries sums of whole numbers, so a result depends neither on order nor on partitions, and
no stratum meets in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxframe.session import materialize

# ---- fixed values -----------------------------------------------------------
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
REPEATED = 3
LEAST_WORDS = 50
MOST_REPEATED = 50
# -----------------------------------------------------------------------------

STATISTICS = ["log_words", "log_word_length", "symbol_share", "repeated_lines", "repeated_words"]
_P = len(STATISTICS)
GRID = 64  # grid steps per unit of a transformed statistic
SPREAD = 8  # least standard deviation of a statistic, in grid steps
LEAST_ROWS = 50  # documents that a stratum of its own needs
COVERED = 0.75
CUTOFF = 1 - 1e-9
TRIALS, STEPS = 2, 15  # steps of all starts, and at most
SETTLED = 0.01  # a step that lowers no log determinant by more is the last
_BINS = 64  # distance bins per doubling of one plus the squared distance
_PAIRS = [(i, j) for i in range(_P) for j in range(i + 1)]


def chi_squared(x: float, degrees: int) -> float:
    """Probability that a chi-squared variable is at most ``x``, by the series of the incomplete gamma function."""
    a, x = degrees / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-17:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a)) if x > 0 else 0.0


def chi_squared_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1e3
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_squared(middle, degrees) < p else (low, middle)
    return high


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang", source: str = "source") -> DataFrame:
    """A row for every row: ``key, language, source``, the counts, ``n_lines`` with a word, and ``base_failed``.

    A null text has no words. Rows that repeat are rows of their own; a missing language or source column is null.
    """
    named = [(F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(n) for c, n in ((language, "language"), (source, "source"))]
    rows = docs.select(F.col(key).alias("key"), *named, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    bare = F.translate("text", " \t\n\x0b\x0c\r", "")
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.translate(line, " \t\x0b\x0c\r", "") != "")
    rows = rows.withColumns({"words": F.array_remove(F.split("text", BLANK, -1), ""), "lines": lines, "word_chars": F.length(bare), "n_symbols": F.length("text") - F.length(F.translate("text", SYMBOLS, ""))})
    rows = rows.withColumns({"n_words": F.size("words"), "n_lines": F.size("lines"), "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")), "codes": F.transform("words", lambda w: F.xxhash64(w))}).drop("text", "words", "lines")
    following = lambda c, i: F.xxhash64(c, *[F.get("codes", i + k) for k in range(1, REPEATED)])
    starts = F.slice("codes", F.lit(1), F.greatest(F.size("codes") - (REPEATED - 1), F.lit(0)))
    rows = rows.withColumn("windows", F.transform(starts, following)).drop("codes")
    rows = rows.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows"))
    ranked = F.when(F.col("repeats"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("ranked", ranked).drop("windows")
    same = lambda x, i, j: F.coalesce(F.get("ranked", j)["h"] == x["h"], F.lit(False))
    again = F.filter("ranked", lambda x, i: same(x, i, i - 1) | same(x, i, i + 1))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(*[x["i"] + k for k in range(REPEATED)]))))
    rows = rows.withColumn("n_repeat_words", F.when(F.col("repeats"), F.size(covered)).otherwise(0)).drop("ranked", "repeats")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words").cast("long") > MOST_REPEATED * F.col("n_words").cast("long"))
    counts = [F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")]
    return rows.select("key", "language", "source", *counts, failed.alias("base_failed"))


def _transformed() -> list[Column]:
    """The statistics on their grid; a document without words reads as one of one letter."""
    words, chars, lines = (F.greatest(c, F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    values = [F.log(words), F.log(chars / words), F.log1p(1000 * F.col("n_symbols") / chars), F.sqrt(F.col("n_dup_lines") / lines), F.sqrt(F.col("n_repeat_words") / words)]
    return [F.floor(GRID * v + 0.5).cast("long").alias(name) for v, name in zip(values, STATISTICS)]


def _strata(rows: DataFrame) -> DataFrame:
    """``language, source, stratum``: each pair's own stratum, its language's pool, the pool of all, or none if that is too small."""

    def name(level: int, *fields: str) -> Column:
        return F.to_json(F.struct(F.lit(level).alias("level"), *fields))

    counts = materialize(rows.groupBy("language", "source").agg(F.count("*").alias("n")), "quality-strata")
    small = counts.where(F.col("n") < LEAST_ROWS)
    pools = small.groupBy(F.col("language").alias("pool")).agg(F.sum("n").alias("in_pool"))
    rest = pools.where(F.col("in_pool") < LEAST_ROWS).agg(F.coalesce(F.sum("in_pool"), F.lit(0)).alias("n")).first()["n"]
    placed = counts.join(pools, F.col("language").eqNullSafe(F.col("pool")), "left")
    stratum = (
        F.when(F.col("n") >= LEAST_ROWS, name(0, "language", "source"))
        .when(F.col("in_pool") >= LEAST_ROWS, name(1, "language"))
        .when(F.lit(rest >= LEAST_ROWS), name(2))
    )
    return materialize(placed.select(F.col("language").alias("l"), F.col("source").alias("s"), stratum.alias("stratum")), "quality-strata")


def _medians(cells: DataFrame, value) -> DataFrame:
    """``stratum`` and the weighted lower median of ``value(i)`` for each statistic, as an array ``m``."""
    long = cells.select("stratum", "n", F.posexplode(F.array(*[value(i) for i in range(_P)])).alias("i", "x"))
    counted = long.groupBy("stratum", "i", "x").agg(F.sum("n").alias("n"))
    within = Window.partitionBy("stratum", "i")  # no more rows than a statistic has grid places
    so_far = counted.withColumns({"upto": F.sum("n").over(within.orderBy("x")), "all": F.sum("n").over(within)})
    middle = so_far.where(2 * F.col("upto") >= F.col("all")).groupBy("stratum", "i").agg(F.min("x").alias("x"))
    return middle.groupBy("stratum").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("m"))


def _kept_share(binned: DataFrame) -> DataFrame:
    """Centre, inverse scatter and log determinant of the nearest share, per ``stratum, start`` of rows with a ``bin``; ``was`` is carried."""
    sums = {f"s{i}": f"sum(n * {x}) AS s{i}" for i, x in enumerate(STATISTICS)}
    sums |= {f"s{i}{j}": f"sum(n * {STATISTICS[i]} * {STATISTICS[j]}) AS s{i}{j}" for i, j in _PAIRS}
    bins = binned.groupBy("stratum", "start", "bin").agg(F.sum("n").alias("n"), F.max("was").alias("was"), *map(F.expr, sums.values()))
    within = Window.partitionBy("stratum", "start")  # no more rows than there are bins
    bins = bins.withColumns({"before": F.sum("n").over(within.orderBy("bin")) - F.col("n"), "all": F.sum("n").over(within)})
    kept = bins.where(F.col("before") < F.ceil(COVERED * F.col("all")))
    kept = kept.groupBy("stratum", "start").agg(F.sum("n").alias("n"), F.max("was").alias("was"), *[F.sum(k).alias(k) for k in sums])
    centre = ", ".join(f"s{i} / n" for i in range(_P))
    kept = kept.selectExpr("*", f"array({centre}) AS centre")
    spread = [f"s{max(i, j)}{min(i, j)} / n - centre[{i}] * centre[{j}] + {float(SPREAD**2) if i == j else 0.0}D" for i in range(_P) for j in range(_P)]
    kept = kept.selectExpr("stratum", "start", "centre", "was", f"array({', '.join(spread)}) AS matrix")
    return kept.select("stratum", "start", "centre", "was", _inverse("matrix").alias("i")).select("stratum", "start", "centre", "i.inverse", "i.logdet", "was")


def _inverse(matrix: str) -> Column:
    """Inverse, row by row in one array, and log determinant of a positive definite matrix, by sweeping out each row."""
    pivot, row, place = f"s.inverse[k * {_P} + k]", f"s.inverse[k * {_P} + p % {_P}]", f"p div {_P}"
    cell = f"""CASE WHEN {place} = k AND p % {_P} = k THEN 1 / x WHEN {place} = k THEN x / {pivot}
        WHEN p % {_P} = k THEN -x / {pivot} ELSE x - s.inverse[int({place}) * {_P} + k] * {row} / {pivot} END"""
    return F.expr(
        f"""aggregate(array({", ".join(map(str, range(_P)))}), named_struct('inverse', {matrix}, 'logdet', 0.0D),
        (s, k) -> named_struct('inverse', transform(s.inverse, (x, p) -> {cell}), 'logdet', s.logdet + ln({pivot})))"""
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of a vector from ``centre`` by ``inverse``."""
    off = [f"({name} - centre[{i}])" for i, name in enumerate(STATISTICS)]
    rows = [" + ".join(f"inverse[{i * _P + j}] * {off[j]}" for j in range(_P)) for i in range(_P)]
    return F.expr(f"greatest(0.0D, {' + '.join(f'{o} * ({r})' for o, r in zip(off, rows))})")


def _bin(distance: Column) -> Column:
    return F.floor(_BINS * F.log2(1 + distance)).cast("int").alias("bin")


def scatter_estimates(cells: DataFrame) -> DataFrame:
    """``stratum, centre, inverse, scale`` from rows ``stratum``, the statistics on their grid, and ``n``, a row's count."""
    middle = materialize(_medians(cells, lambda i: F.col(STATISTICS[i])).withColumnRenamed("m", "median"), "quality-medians")
    around = cells.join(middle, "stratum")
    apart = _medians(around, lambda i: F.abs(F.col(STATISTICS[i]) - F.get("median", F.lit(i)))).withColumnRenamed("m", "apart")
    around = around.join(materialize(apart, "quality-spreads"), "stratum")
    units = [F.abs(F.col(s) - F.get("median", F.lit(i))) / F.greatest(1.4826 * F.get("apart", F.lit(i)), F.lit(float(SPREAD))) for i, s in enumerate(STATISTICS)]
    norms = F.array(sum(units, F.lit(0.0)), sum((u * u for u in units), F.lit(0.0)), F.greatest(*units))
    started = around.select("stratum", *STATISTICS, "n", F.posexplode(norms).alias("start", "norm"))
    state = materialize(_kept_share(started.withColumn("bin", _bin(F.col("norm"))).withColumn("was", F.lit(None).cast("double"))).drop("was"), "quality-steps")
    for step in range(STEPS):
        after = _kept_share(cells.join(state.withColumnRenamed("logdet", "was"), "stratum").withColumn("bin", _bin(_distance())))
        if step == TRIALS:  # from here on the better start alone
            best = F.min(F.struct("logdet", "start", "centre", "inverse", "was"))
            after = after.groupBy("stratum").agg(best.alias("b")).select("stratum", "b.start", "b.centre", "b.inverse", "b.logdet", "b.was")
        state = materialize(after, "quality-steps")
        moving = state.where(F.col("was") - F.col("logdet") > SETTLED).limit(1).count()
        state = state.drop("was")
        if step >= TRIALS and not moving:
            break
    # of a normal variable, the nearest share has this much of the scatter
    within = chi_squared_quantile(COVERED, _P)
    return state.select("stratum", "centre", "inverse", F.lit(COVERED / chi_squared(within, _P + 2)).alias("scale"))


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang", source: str = "source") -> DataFrame:
    """The statistics of every row, ``base_failed``, ``distance`` and ``kept``.

    Estimates are made of the documents that pass the fixed rules; in tables too small for any stratum these all are kept,
    with a null distance. Null languages and sources are strata like others. An empty table gives no rows; other columns
    are not read.
    """
    rows = materialize(document_statistics(docs, key, text, language, source), "quality-statistics")
    passed = rows.where(~F.col("base_failed"))
    same = F.col("language").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    strata = _strata(passed)
    cells = passed.join(strata, same).where(F.col("stratum").isNotNull()).select("stratum", *_transformed())
    cells = materialize(cells.groupBy("stratum", *STATISTICS).agg(F.count("*").alias("n")), "quality-cells")
    estimates = materialize(scatter_estimates(cells), "quality-estimates")
    judged = rows.join(strata.join(estimates, "stratum"), same & ~F.col("base_failed"), "left")
    judged = judged.select(*rows.columns, "centre", "inverse", "scale", *_transformed()).withColumn("distance", _distance() / F.col("scale"))
    near = F.coalesce(F.col("distance") <= chi_squared_quantile(CUTOFF, _P), F.lit(True))
    return judged.select(F.col("key").alias(key), *[c for c in rows.columns if c not in ("key", "base_failed")], "base_failed", "distance", (~F.col("base_failed") & near).alias("kept"))


def quality_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and verdicts of every row."""
    return quality(docs, key, text).select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
