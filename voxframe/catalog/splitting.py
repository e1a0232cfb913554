"""Split plan: the flagship and its parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.base import PLAN_SQL, UTTERANCES_SQL, query, table, utterance_rows
from voxframe.functions.hashing import stable_key
from voxframe.functions.text import whitespace_token_count
from voxframe.operators.aggregates import exclusion_counts, reconciled_counts, split_counts
from voxframe.operators.joins import membership
from voxframe.operators.sampling import lowest_per_group, lowest_scores
from voxframe.plans.split import split_plan, split_summary

RESERVE = 5


@query(
    "split_plan_counts",
    "AGG-03",
    "PRJ-05",
    "PRJ-06",
    "TOP-01",
    "JOIN-08",
    "UDF-02",
    sql=f"""WITH {PLAN_SQL}
SELECT count(*) FILTER (model_limit_exclusion IS NULL AND agreement IS NOT NULL AND NOT reserved AND phase = 1) AS phase1,
       count(*) FILTER (model_limit_exclusion IS NULL AND agreement IS NOT NULL AND NOT reserved AND phase = 2) AS phase2,
       count(*) FILTER (model_limit_exclusion IS NULL AND agreement IS NULL) AS null_agreement,
       count(*) FILTER (model_limit_exclusion IS NULL AND agreement IS NOT NULL AND reserved) AS reserved,
       count(*) FILTER (model_limit_exclusion IS NOT NULL) AS excluded,
       count(*) AS total
FROM plan""",
)
def split_plan_counts(spark, folder):
    return split_summary(utterance_rows(spark, folder), reserve=RESERVE, strict=False)


@query(
    "split_plan_rows",
    "PRJ-05",
    "PRJ-06",
    "TOP-01",
    "STR-15",
    sql=f"""WITH {PLAN_SQL}
SELECT source_relative_path, agreement, text_token_count::INTEGER AS text_token_count, model_limit_exclusion, reserved,
       reservation_score, phase::INTEGER AS phase
FROM plan""",
)
def split_plan_rows(spark, folder):
    return split_plan(utterance_rows(spark, folder), reserve=RESERVE, strict=False).select(
        "source_relative_path",
        "agreement",
        "text_token_count",
        "model_limit_exclusion",
        "reserved",
        "reservation_score",
        "phase",
    )


@query(
    "exclusion_reason_counts",
    "AGG-04",
    sql=f"""WITH {PLAN_SQL}
SELECT model_limit_exclusion AS reason, count(*) AS rows FROM plan WHERE model_limit_exclusion IS NOT NULL GROUP BY 1""",
)
def exclusion_reason_counts(spark, folder):
    return exclusion_counts(split_plan(utterance_rows(spark, folder), reserve=RESERVE, strict=False))


@query(
    "reconciled_split_counts",
    "AGG-05",
    sql=f"""WITH {PLAN_SQL}
SELECT count(*) AS total, count(*) FILTER (model_limit_exclusion IS NOT NULL) AS excluded FROM plan""",
)
def reconciled_split_counts(spark, folder):
    counts = split_counts(split_plan(utterance_rows(spark, folder), reserve=RESERVE, strict=False))
    parts = ["phase1", "phase2", "null_agreement", "reserved", "excluded"]
    return reconciled_counts(counts, "total", parts).select("total", "excluded")


@query(
    "pilot_rows",
    "TOP-02",
    sql=f"""WITH {UTTERANCES_SQL}
SELECT source_relative_path, sha256('1986' || chr(0) || source_relative_path) AS score FROM utterances ORDER BY 2, 1 LIMIT 33""",
)
def pilot_rows(spark, folder):
    return lowest_scores(utterance_rows(spark, folder).select("source_relative_path"), "source_relative_path", 33)


@query(
    "sampled_rows_per_phase",
    "TOP-03",
    sql=f"""WITH {PLAN_SQL}
SELECT phase::INTEGER AS phase, source_relative_path, score, place::INTEGER AS place FROM (
  SELECT phase, source_relative_path, sha256('1986' || chr(0) || source_relative_path) AS score,
         row_number() OVER (PARTITION BY phase ORDER BY sha256('1986' || chr(0) || source_relative_path), source_relative_path) AS place
  FROM plan WHERE phase IS NOT NULL) WHERE place <= 32""",
)
def sampled_rows_per_phase(spark, folder):
    plan = split_plan(utterance_rows(spark, folder), reserve=RESERVE, strict=False).where(F.col("phase").isNotNull())
    return lowest_per_group(plan.select("phase", "source_relative_path"), "phase", "source_relative_path", 32)


@query(
    "stable_keys",
    "STR-15",
    sql="""SELECT o_orderkey, sha256('1986' || chr(0) || o_orderstatus || chr(0) || o_orderkey) AS stable_key FROM orders""",
)
def stable_keys(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", stable_key(1986, "o_orderstatus", "o_orderkey").alias("stable_key"))


@query(
    "reserved_membership",
    "JOIN-08",
    sql="""WITH best AS (SELECT o_orderkey FROM orders ORDER BY sha256('7' || chr(0) || o_orderkey), o_orderkey LIMIT 100)
SELECT l_orderkey, count(*) AS lines, l_orderkey IN (SELECT o_orderkey FROM best) AS reserved FROM lineitem GROUP BY 1""",
)
def reserved_membership(spark, folder):
    chosen = lowest_scores(table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", 100, 7)
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    return membership(lines, chosen, "l_orderkey", "reserved").select("l_orderkey", "lines", "reserved")


@query(
    "whitespace_token_counts",
    "UDF-02",
    sql=r"""SELECT doc_id, len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''))::INTEGER AS tokens FROM documents""",
)
def whitespace_token_counts(spark, folder):
    return table(spark, folder, "documents").select("doc_id", whitespace_token_count(F.col("text")).alias("tokens"))
