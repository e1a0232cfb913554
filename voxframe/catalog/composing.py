"""Stage chains and injected callables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.aggregating import rounded_vector
from voxframe.catalog.base import WORDS_SQL, query, texts
from voxframe.catalog.listing import TOKENS_SQL
from voxframe.functions.injected import OutOfMemory, batch_scores, tokenized, tokenizer, vector_extractor, whitespace_tokens
from voxframe.operators.aggregates import mean_vectors
from voxframe.operators.filters import length_drop_reason
from voxframe.operators.packing import budget_batches, epoch_order
from voxframe.plans.batches import padded_batches
from voxframe.plans.stages import StageRegistry
from voxframe.session import materialize


def _kept(df, least_frames, most_tokens):
    reason = length_drop_reason(F.col("n_chars"), F.size("text_token"), least_frames=least_frames, most_tokens=most_tokens, most_ratio=10)
    return df.where(reason.isNull()).withColumn("frames", F.col("n_chars")).drop("text")


def _packed(df, budget, seed):
    df = materialize(df, "tokenized")  # tokens are made once; only ids and lengths are put in order
    ordered = epoch_order(df.select("doc_id", "frames"), "doc_id", seed)
    batches = budget_batches(ordered, "ordinal", "doc_id", ["frames"], budget, 500)
    members = batches.select("window", "batch", F.explode("rows").alias("m")).select("window", "batch", "m.place", "m.doc_id")
    joined = members.join(df, "doc_id")
    rows = F.sort_array(F.collect_list(F.struct("place", "doc_id", "frames", "text_token")))
    return joined.groupBy("window", "batch").agg(rows.alias("rows"))


STAGES = (
    StageRegistry()
    .register("tokenize", lambda df: tokenized(df, whitespace_tokens))
    .register("filter", _kept)
    .register("batch", _packed)
    .register("pad", lambda df: padded_batches(df, "rows", "frames", ["text_token"], ["doc_id"]))
)
DECLARED = ["tokenize", {"filter": {"least_frames": 100, "most_tokens": 2000}}, {"batch": {"budget": 50000, "seed": 1986}}, "pad"]


@query(
    "declared_stage_chain",
    "UDF-01",
    sql=f"""WITH k AS (SELECT doc_id, {TOKENS_SQL} AS t FROM documents WHERE n_chars BETWEEN 100 AND 10240 AND len({WORDS_SQL}) BETWEEN 1 AND 2000 AND len({WORDS_SQL}) / n_chars::DOUBLE BETWEEN 0.0005 AND 10)
SELECT doc_id, len(t)::INTEGER AS text_token_len, list_sum(t)::BIGINT AS token_sum FROM k""",
)
def declared_stage_chain(spark, folder):
    """Tokenise, filter, batch and pad by declaration; unbatched again, no row and no token is lost."""
    docs = texts(spark, folder).select("doc_id", "text", "n_chars")
    batches = STAGES.chain(docs, DECLARED)
    rows = batches.select(F.explode(F.arrays_zip("doc_id", "text_token", "text_token_len")).alias("r"))
    return rows.select(
        "r.doc_id", "r.text_token_len", F.aggregate("r.text_token", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("token_sum")
    )


@query(
    "injected_tokenizer",
    "UDF-02",
    sql=r"""SELECT doc_id, len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''))::INTEGER AS text_tokens, 1::INTEGER AS instruct_tokens FROM documents""",
)
def injected_tokenizer(spark, folder):
    encode = tokenizer(lambda s: [len(w) for w in s.split()])
    docs = texts(spark, folder).withColumn("instruct", F.col("lang"))
    rows = tokenized(docs, encode)
    return rows.select("doc_id", F.size("text_token").alias("text_tokens"), F.size("instruct_token").alias("instruct_tokens"))


def _tight_model(texts: list) -> list:
    """Stands for a model that holds 20,000 characters at once."""
    if len(texts) > 1 and sum(map(len, texts)) > 20000:
        raise OutOfMemory
    return [len(t.split()) for t in texts]


@query(
    "batched_model_scores",
    "UDF-03",
    sql=r"""SELECT doc_id, len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''))::INTEGER AS score FROM documents""",
)
def batched_model_scores(spark, folder):
    return batch_scores(texts(spark, folder), _tight_model, "doc_id", "text", "score", "int")


@query(
    "extracted_speaker_means",
    "UDF-04",
    "AGG-01",
    sql="""SELECT source, printf('%.5f', avg(length(text))) || ' ' || printf('%.5f', avg(length(text) - length(replace(text, ' ', '')))) AS mean_vector FROM documents GROUP BY 1""",
)
def extracted_speaker_means(spark, folder):
    """Length and number of blanks as an injected two-number vector, averaged per source."""
    extract = vector_extractor(lambda text: [len(text), text.count(" ")])
    docs = texts(spark, folder).select("source", extract(F.col("text")).alias("v"))
    return mean_vectors(docs, ["source"], "v").select("source", rounded_vector("mean_vector").alias("mean_vector"))
