"""Training-data pipeline over ``documents``: each stage works on all rows its predecessor kept.

Texts without a language go, one document of each group of near copies stays, documents with benchmark passages go,
personal data is generalised, and what is left is encoded. A stage that drops rows decides by key and text together, a
null key being a key like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxframe.llm.decontaminate import contamination
from voxframe.llm.jaccard import near_duplicate_classes
from voxframe.llm.languages import UNDETERMINED, learnt, with_language
from voxframe.llm.pieces import piece_digests
from voxframe.llm.privacy import sanitised
from voxframe.llm.queries import piece_vocabulary
from voxframe.session import materialize, may_be_listed, passing


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; null texts and texts without a letter go."""
    numbered = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])  # no name meets those of the answer
    found = with_language(numbered, learnt(docs), f"_{docs.columns.index('text')}")
    return found.where(F.col("lang_pred") != UNDETERMINED).select(numbered.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, of the smallest id; a null id comes last. Rows without a word stay."""
    with passing(spark):
        classes = materialize(near_duplicate_classes(_marked(docs), "row"), "pipeline-classes", keep=True)
    later = classes.where(F.col("component_id") < F.col("row")).select("row")
    repeated = classes.where("n_shingles > 0 AND component_id = row").groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row")
    one = _without(docs, repeated, "left_semi").groupBy("doc_id", F.xxhash64("text").alias("_mark")).agg(F.min(F.struct(*docs.columns)).alias("_one"))
    return _without(docs, later.union(repeated)).union(one.select("_one.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, contamination(_marked(docs), items, "row").where("contaminated"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts generalised; ``n_chars`` follows the text."""
    clean = sanitised(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of all documents and what they decode to, as digests."""
    return piece_digests(docs, piece_vocabulary())


def _marked(docs: DataFrame) -> DataFrame:
    """``row, text``: the row's key and a hash of its text, null keys after all others."""
    return docs.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("mark")).alias("row"), "text")


def _without(docs: DataFrame, gone: DataFrame, how: str = "left_anti") -> DataFrame:
    # The list is written first and tells by a filter which rows may be on it: only those are shuffled, if it is too
    # large to be broadcast.
    named = materialize(gone.select(F.col("row.doc_id").alias("_key"), F.col("row.mark").alias("_mark")).distinct(), "pipeline-rows")
    told = may_be_listed(docs, F.xxhash64("text"), named, "_mark")
    on = F.col("doc_id").eqNullSafe(F.col("_key")) & (F.xxhash64("text") == F.col("_mark"))
    met = told.where("_listed").join(named, on, how).select(docs.columns)
    return met if how == "left_semi" else met.union(told.where("NOT _listed").select(docs.columns))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", sentencepiece),
]

#: Language models, tokens and classes of near copies have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
