"""Checked joins over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.base import PLAN_SQL, WORDS_SQL, query, table, utterance_rows
from voxframe.functions.text import words
from voxframe.operators.joins import (
    counter_difference,
    enrich,
    issue_counts,
    matched_and_unmatched,
    mismatches,
    optional,
    pending,
    preference_pairs,
    random_partner,
    reconcile,
    reconciled_rows,
    round_robin,
    strict_join,
    two_hop,
    unexpected,
)
from voxframe.plans.split import joined_sidecars, split_plan
from voxframe.session import materialize


def _line_totals(spark, folder):
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("key"))
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


@query(
    "strict_one_to_one_join",
    "JOIN-01",
    sql="""SELECT l_orderkey AS key, count(*) AS lines, sum(l_quantity::BIGINT)::BIGINT AS quantity, any_value(o_orderpriority) AS o_orderpriority
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
)
def strict_one_to_one_join(spark, folder):
    """Orders that have lines against line totals: both sides hold each key once."""
    totals = materialize(_line_totals(spark, folder), "totals")
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "key").join(totals.select("key"), "key", "left_semi")
    return strict_join(orders, totals, "key", ["o_orderpriority"], ["lines", "quantity"])


@query(
    "strict_sidecar_join",
    "JOIN-01",
    sql=f"WITH {PLAN_SQL} SELECT source_relative_path, md5(text) AS text_md5, agreement FROM utterances",
)
def strict_sidecar_join(spark, folder):
    rows = utterance_rows(spark, folder)
    joined = joined_sidecars(rows.select("source_relative_path", "text"), rows.select("source_relative_path", "agreement"))
    return joined.select("source_relative_path", F.md5("text").alias("text_md5"), "agreement")


@query(
    "join_issue_counts",
    "JOIN-01",
    sql="""WITH l AS (SELECT o_custkey AS key, count(*) AS n FROM orders GROUP BY 1), r AS (SELECT c_custkey AS key, count(*) AS n FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1)
SELECT issue, count(*) AS keys FROM (SELECT CASE WHEN l.n IS NULL THEN 'missing_left' WHEN r.n IS NULL THEN 'missing_right'
WHEN l.n > 1 THEN 'duplicate_left' WHEN r.n > 1 THEN 'duplicate_right' END AS issue FROM l FULL JOIN r USING (key)) WHERE issue IS NOT NULL GROUP BY 1""",
)
def join_issue_counts(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("key"))
    customers = table(spark, folder, "customer").where("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("key"))
    return issue_counts(reconcile(orders, customers, "key"))


@query(
    "mandatory_enrichment",
    "JOIN-02",
    sql="SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def mandatory_enrichment(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return enrich(orders, customers, "c_custkey", ["c_name", "c_mktsegment"]).select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "two_hop_vectors",
    "JOIN-03",
    sql="""WITH v AS (SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY 1)
SELECT d.doc_id, 'src' || (right(source, 1)) AS spk, v.vec_id FROM documents d LEFT JOIN v ON v.label = right(source, 1)::INTEGER""",
)
def two_hop_vectors(spark, folder):
    """Document to speaker (last digit of the source) to the first vector of that label."""
    docs = table(spark, folder, "documents")
    owners = docs.select("doc_id", F.concat(F.lit("src"), F.right("source", F.lit(1))).alias("spk"))
    vectors = table(spark, folder, "embeddings").groupBy(F.concat(F.lit("src"), "label").alias("spk")).agg(F.min("vec_id").alias("vec_id"))
    return two_hop(docs.select("doc_id"), owners, vectors, "doc_id", "spk").select("doc_id", "spk", "vec_id")


@query("optional_labels", "JOIN-04", sql="SELECT d.doc_id, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def optional_labels(spark, folder):
    return optional(table(spark, folder, "documents").select("doc_id"), table(spark, folder, "labels"), "doc_id", "toxic", "int")


@query(
    "plan_archive_reconciliation",
    "JOIN-05",
    sql="""WITH a AS (SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_quantity > 25), b AS (SELECT p_partkey AS key FROM part WHERE p_size > 5)
SELECT key, CASE WHEN a.key IS NULL THEN 'missing_left' ELSE 'missing_right' END AS issue FROM a FULL JOIN b USING (key) WHERE a.key IS NULL OR b.key IS NULL""",
)
def plan_archive_reconciliation(spark, folder):
    members = table(spark, folder, "lineitem").where("l_quantity > 25").select(F.col("l_partkey").alias("key")).distinct()
    plan = table(spark, folder, "part").where("p_size > 5").select(F.col("p_partkey").alias("key"))
    return reconcile(members, plan, "key").where(F.col("issue").isNotNull()).select("key", "issue")


@query(
    "cache_plan_rows",
    "JOIN-06",
    sql=f"WITH {PLAN_SQL} SELECT source_relative_path, md5(text) AS text_md5, instruct, text_token_count::INTEGER AS text_token_count FROM plan WHERE phase IN (1, 2)",
)
def cache_plan_rows(spark, folder):
    plan = materialize(split_plan(utterance_rows(spark, folder), reserve=5, strict=False), "plan").where("phase in (1, 2)")
    cache = plan.select("source_relative_path", "text", "instruct")
    joined = reconciled_rows(cache, plan, "source_relative_path", ["text", "instruct"], ["text_token_count"])
    return joined.select("source_relative_path", F.md5("text").alias("text_md5"), "instruct", "text_token_count")


@query(
    "cache_plan_mismatches",
    "JOIN-06",
    sql="""WITH c AS (SELECT doc_id, CASE WHEN lang = 'de' THEN text || '!' ELSE text END AS text, source FROM documents WHERE lang <> 'fr'),
p AS (SELECT doc_id, text, source FROM documents WHERE lang <> 'es')
SELECT doc_id, CASE WHEN c.doc_id IS NULL THEN 'missing_left' WHEN p.doc_id IS NULL THEN 'missing_right' WHEN c.text <> p.text THEN 'text differs' END AS issue
FROM c FULL JOIN p USING (doc_id) WHERE c.doc_id IS NULL OR p.doc_id IS NULL OR c.text <> p.text""",
)
def cache_plan_mismatches(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    text = F.when(F.col("lang") == "de", F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    cache = docs.where("lang <> 'fr'").withColumn("text", text)
    return mismatches(cache, docs.where("lang <> 'es'"), "doc_id", ["text", "source"])


@query(
    "labelled_hypotheses",
    "JOIN-07",
    sql="SELECT d.doc_id, b.text AS label, d.n_chars FROM documents d JOIN benchmark b ON b.item_id = d.doc_id",
)
def labelled_hypotheses(spark, folder):
    hypotheses = table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = table(spark, folder, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("label"))
    return matched_and_unmatched(hypotheses, labels, "doc_id")[0]


@query(
    "unlabelled_hypotheses",
    "JOIN-07",
    sql="SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT item_id FROM benchmark)",
)
def unlabelled_hypotheses(spark, folder):
    hypotheses = table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = table(spark, folder, "benchmark").select(F.col("item_id").alias("doc_id"))
    return matched_and_unmatched(hypotheses, labels, "doc_id")[1]


@query(
    "round_robin_voices",
    "JOIN-09",
    sql="""WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents),
n AS (SELECT n_name, row_number() OVER (ORDER BY n_name) - 1 AS j, count(*) OVER () AS k FROM nation)
SELECT doc_id, i AS item_ordinal, n_name FROM d JOIN n ON i % k = j""",
)
def round_robin_voices(spark, folder):
    items = table(spark, folder, "documents").select("doc_id")
    return round_robin(items, table(spark, folder, "nation").select("n_name"), "doc_id", "n_name")


@query(
    "exact_record_coverage",
    "JOIN-10",
    sql="""WITH a AS (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1), e AS (SELECT doc_id, 1 AS n FROM documents WHERE lang = 'en')
SELECT issue, count(*) AS keys FROM (SELECT CASE WHEN a.n IS NULL THEN 'missing_left' WHEN e.n IS NULL THEN 'missing_right' WHEN a.n > 1 THEN 'duplicate_left' END AS issue
FROM a FULL JOIN e USING (doc_id)) WHERE issue IS NOT NULL GROUP BY 1""",
)
def exact_record_coverage(spark, folder):
    items = table(spark, folder, "documents").where("lang = 'en'").select("doc_id")
    return issue_counts(reconcile(table(spark, folder, "labels").select("doc_id"), items, "doc_id"))


@query("pending_work", "JOIN-11", sql="SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_work(spark, folder):
    return pending(table(spark, folder, "documents").select("doc_id"), table(spark, folder, "labels"), "doc_id")


@query(
    "unexpected_work",
    "JOIN-11",
    sql="SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')",
)
def unexpected_work(spark, folder):
    expected = table(spark, folder, "documents").where("lang = 'en'").select("doc_id")
    return unexpected(expected, table(spark, folder, "labels").select("doc_id"), "doc_id")


@query(
    "counter_differences",
    "JOIN-12",
    sql="""WITH s AS (SELECT event_type AS model, user_id AS batch_size, CAST(props->>'k' AS BIGINT) AS k, ts < TIMESTAMP '2024-01-04' AS early FROM events),
a AS (SELECT model, batch_size, count(*) AS executions, sum(k)::BIGINT AS ns FROM s GROUP BY ALL),
b AS (SELECT model, batch_size, count(*) AS executions, sum(k)::BIGINT AS ns FROM s WHERE early GROUP BY ALL)
SELECT a.model, a.batch_size, a.executions - coalesce(b.executions, 0) AS executions, a.ns - coalesce(b.ns, 0) AS ns
FROM a LEFT JOIN b ON a.model = b.model AND a.batch_size = b.batch_size""",
)
def counter_differences(spark, folder):
    """Counters at the end against counters on the fourth day, by event type and user."""
    events = table(spark, folder, "events").select(
        F.col("event_type").alias("model"), F.col("user_id").alias("batch_size"), F.get_json_object("props", "$.k").cast("bigint").alias("k"), "ts"
    )
    counters = lambda rows: rows.groupBy("model", "batch_size").agg(F.count(F.lit(1)).alias("executions"), F.sum("k").alias("ns"))
    early = events.where(F.col("ts") < F.lit("2024-01-04").cast("timestamp"))
    return counter_difference(counters(events), counters(early), ["model", "batch_size"], ["executions", "ns"])


@query(
    "preference_pair_rows",
    "JOIN-13",
    sql=f"""WITH t AS (SELECT conv_id, turn, len({WORDS_SQL})::INTEGER AS n FROM conversations)
SELECT c.conv_id || '-' || c.turn AS utt, c.n AS chosen_n, r.n AS rejected_n FROM t c JOIN t r ON r.conv_id = c.conv_id AND r.turn = c.turn + 2""",
)
def preference_pair_rows(spark, folder):
    """Every turn as chosen against the turn two places on as rejected."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", F.size(words(F.col("text"))).alias("n"))
    chosen = turns.select(F.concat_ws("-", "conv_id", "turn").alias("utt"), "n")
    rejected = turns.select(F.concat_ws("-", F.col("conv_id"), F.col("turn") - 2).alias("utt"), "n")
    return preference_pairs(chosen, rejected, "utt", "n")


@query(
    "random_prompt_partners",
    "JOIN-14",
    sql="""WITH p AS (SELECT item_id, replace(text, ' ', '') AS prompt, row_number() OVER (ORDER BY item_id) - 1 AS j, count(*) OVER () AS n FROM benchmark)
SELECT d.doc_id, p.item_id, md5(p.prompt) AS prompt_md5 FROM documents d JOIN p
ON p.j = ('0x' || sha256('3' || chr(0) || d.doc_id)[1:15])::BIGINT % p.n""",
)
def random_prompt_partners(spark, folder):
    prompts = table(spark, folder, "benchmark").select("item_id", F.replace("text", F.lit(" "), F.lit("")).alias("prompt"))
    items = table(spark, folder, "documents").select("doc_id")
    drawn = random_partner(items, prompts, "doc_id", "item_id", 3)
    return drawn.select("doc_id", "item_id", F.md5("prompt").alias("prompt_md5"))
