"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.aligning import COUNTS_SQL
from voxframe.catalog.base import UTTERANCES_SQL, query, table, turn_pairs, utterance_rows
from voxframe.catalog.writing import CACHE_SQL, token_cache
from voxframe.functions.edit import token_distance
from voxframe.operators.quality import (
    audit_differences,
    filled,
    fingerprint,
    finite_or_null,
    id_coverage,
    non_negative,
    one_of,
    optional_string,
    oversized_groups,
    table_differences,
    violation_counts,
)
from voxframe.session import materialize, scratch_path
from voxframe.sources.sinks import cache_manifest, changed_files, file_checksums, published_or_built

_SPOILED = "CASE user_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN 'Infinity'::DOUBLE ELSE value END"


@query(
    "finite_or_null_values",
    "DQ-01",
    sql=f"SELECT event_id, v IS NULL OR isfinite(v) AS ok FROM (SELECT event_id, {_SPOILED} AS v FROM events)",
)
def finite_or_null_values(spark, folder):
    n = F.col("user_id") % 5
    value = F.when(n == 0, None).when(n == 1, float("nan")).when(n == 2, float("inf")).otherwise(F.col("value"))
    return table(spark, folder, "events").select("event_id", finite_or_null(value).alias("ok"))


@query(
    "constraint_violations",
    "DQ-02",
    sql="""SELECT * FROM (SELECT unnest(['lang filled', 'optional source', 'n_chars non-negative', 'lang known', 'agreement finite']) AS "constraint", unnest([a, b, c, d, e]) AS violations FROM (
SELECT count(*) FILTER (lang = 'es') AS a, count(*) FILTER (source = 'src3') AS b, count(*) FILTER (n_chars < 50) AS c, count(*) FILTER (lang NOT IN ('en', 'de')) AS d, 0::BIGINT AS e FROM documents))""",
)
def constraint_violations(spark, folder):
    rows = utterance_rows(spark, folder)
    lang = F.when(F.col("lang") == "es", "").otherwise(F.col("lang"))
    source = F.when(F.col("source") == "src3", "").when(F.col("source") == "src4", None).otherwise(F.col("source"))
    return violation_counts(
        rows,
        {
            "lang filled": filled(lang),
            "optional source": optional_string(source),
            "n_chars non-negative": non_negative(F.col("n_chars") - 50),
            "lang known": one_of(F.col("lang"), ["en", "de"]),
            "agreement finite": finite_or_null(F.col("agreement")),
        },
    )


@query(
    "benchmark_id_coverage",
    "DQ-03",
    sql="""SELECT min(doc_id) AS first_id, max(doc_id) AS last_id, count(*) AS rows, count(DISTINCT doc_id) AS distinct_ids, count(DISTINCT lang) AS categories,
min(doc_id) = 0 AND count(*) = count(DISTINCT doc_id) AND count(*) = max(doc_id) + 1 AND count(DISTINCT lang) = 4 AS covered FROM documents""",
)
def benchmark_id_coverage(spark, folder):
    return id_coverage(table(spark, folder, "documents"), "doc_id", 0, categories=("lang", 4))


@query(
    "oversized_shards",
    "DQ-04",
    sql="""SELECT o_custkey AS "group", count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) > 12""",
)
def oversized_shards(spark, folder):
    return oversized_groups(table(spark, folder, "orders"), "o_custkey", 12)


@query(
    "changed_file_report",
    "DQ-05",
    sql="SELECT 'lang=' || lang AS folder, CASE lang WHEN 'de' THEN 'changed' WHEN 'fr' THEN 'unexpected' END AS change FROM documents WHERE lang IN ('de', 'fr') GROUP BY lang UNION ALL SELECT 'lang=xx', 'missing'",
)
def changed_file_report(spark, folder):
    """Checksums of files by language against a manifest with one changed, one absent and one extra language.

    Every task writes a file of its own for each language it meets; a folder is reported once.
    """
    path = scratch_path(spark, "checksummed")
    table(spark, folder, "documents").select("lang", "text").write.partitionBy("lang").parquet(path)
    hashed = materialize(file_checksums(spark, path, "*.parquet"), "checksums")
    found = hashed.withColumn("lang", F.regexp_extract("path", "lang=(..)/", 1))
    sums = F.when(F.col("lang") == "de", "00").otherwise(F.col("sha256"))
    manifest = found.where("lang <> 'fr'").select("path", sums.alias("sha256")).unionByName(
        found.where("lang = 'en'").select(F.regexp_replace("path", "lang=en/", "lang=xx/").alias("path"), "sha256")
    )
    return changed_files(manifest, found).select(F.regexp_extract("path", "(lang=..)/", 1).alias("folder"), "change").distinct()


@query(
    "cache_audit",
    "DQ-06",
    sql=f"""WITH {CACHE_SQL}, a AS (SELECT phase, shard, count(*) AS n, min(list_min(speech_token)) AS lo, max(list_max(speech_token)) AS hi FROM cache GROUP BY 1, 2)
SELECT phase, shard, 'row_count' AS fact, (n + 1)::VARCHAR AS declared, n::VARCHAR AS found FROM a WHERE shard < 4
UNION ALL SELECT phase, shard, 'token_max', NULL, hi::VARCHAR FROM a WHERE shard = 5 AND hi IS NOT NULL
UNION ALL SELECT phase, shard, 'token_min', NULL, lo::VARCHAR FROM a WHERE shard = 5 AND lo IS NOT NULL
UNION ALL SELECT phase, shard, 'row_count', NULL, n::VARCHAR FROM a WHERE shard = 5""",
)
def cache_audit(spark, folder):
    """A manifest that miscounts the first shards and lacks shard 5, against the recomputed facts."""
    found = cache_manifest(token_cache(spark, folder))
    declared = found.where("shard <> 5").withColumn("row_count", F.col("row_count") + (F.col("shard") < 4).cast("int"))
    return audit_differences(declared, found, ["phase", "shard"], ["row_count", "token_min", "token_max"])


@query(
    "published_row_differences",
    "DQ-07",
    sql=f"""WITH RECURSIVE {COUNTS_SQL}, d AS (SELECT conv_id, turn, substitutions + deletions + insertions AS errors FROM counts JOIN conversations USING (conv_id, turn) WHERE role = 'system')
SELECT conv_id, turn, -1 AS errors, 'published' AS only_in FROM d UNION ALL SELECT conv_id, turn, errors, 'recomputed' FROM d""",
)
def published_row_differences(spark, folder):
    """Scores published, spoiled for system turns, and recomputed."""
    pairs = turn_pairs(spark, folder)
    scored = pairs.select("conv_id", "turn", "category", token_distance(F.col("ref"), F.col("hyp")).alias("errors"))
    spoiled = scored.withColumn("errors", F.when(F.col("category") == "system", -1).otherwise(F.col("errors")))
    path = scratch_path(spark, "published-scores")
    spoiled.drop("category").write.parquet(path)
    return table_differences(spark.read.parquet(path), scored.drop("category"))


@query(
    "reused_publication",
    "DQ-08",
    sql=f"""WITH {UTTERANCES_SQL} SELECT run, reused, count(*) AS rows FROM utterances, (VALUES (1, false), (2, true), (3, false)) r(run, reused) GROUP BY 1, 2""",
)
def reused_publication(spark, folder):
    """Built once, reused for the same seed and input, built again for another seed."""
    rows = utterance_rows(spark, folder).select("source_relative_path", "agreement")
    root = scratch_path(spark, "reusable")
    out = []
    for run, seed in ((1, 1986), (2, 1986), (3, 1987)):
        identity = fingerprint(rows, ["source_relative_path", "agreement"], seed, 1)
        current, reused = published_or_built(spark, root, identity, lambda: rows)
        out.append(current.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(run).alias("run"), F.lit(reused).alias("reused"), "rows"))
    return out[0].unionByName(out[1]).unionByName(out[2])
