"""Query registry and the inputs several queries share, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxframe.functions.text import words
from voxframe.session import balanced

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A registered query: what runs, the SQL it must equal, and the survey rows it covers."""

    run: Run
    sql: str | None
    rows: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, *rows: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name``."""

    def keep(run: Run) -> Run:
        if name in REGISTRY:
            raise KeyError(f"query registered twice: {name}")
        REGISTRY[name] = Query(run, sql, rows)
        return run

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str = "documents", key: str = "doc_id") -> DataFrame:
    """A table with texts, spread over the cores when it is a single file."""
    return balanced(table(spark, folder, name), key)


def tidy(text: Column) -> Column:
    """A text on one line: whitespace runs as single blanks, trimmed."""
    return F.array_join(words(text), " ")


# The same in SQL, for a column named text.
WORDS_SQL = r"list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')"
TIDY_SQL = rf"array_to_string({WORDS_SQL}, ' ')"
PATH_SQL = "lpad((doc_id % 519)::VARCHAR, 6, '0') || '/' || doc_id || '.mp3'"


def shard_path(doc_id: str = "doc_id") -> Column:
    """``NNNNNN/<id>.mp3`` with the shard taken from the id."""
    return F.format_string("%06d/%d.mp3", F.pmod(F.col(doc_id), F.lit(519)), F.col(doc_id))


def utterance_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as utterances with an agreement where they are labelled."""
    labelled = table(spark, folder, "labels").select("doc_id", F.lit(True).alias("labelled"))
    joined = texts(spark, folder).join(labelled, "doc_id", "left")
    agreement = F.when(F.col("labelled"), (F.col("n_chars") % 100) / 100.0)
    return joined.select(
        shard_path().alias("source_relative_path"),
        "doc_id",
        "text",
        "lang",
        "source",
        "n_chars",
        F.lit("Read it aloud.").alias("instruct"),
        agreement.alias("agreement"),
    )


UTTERANCES_SQL = f"""utterances AS (
  SELECT {PATH_SQL} AS source_relative_path, d.doc_id, d.text, d.lang, d.source, d.n_chars,
         'Read it aloud.' AS instruct,
         CASE WHEN l.doc_id IS NOT NULL THEN (d.n_chars % 100) / 100.0::DOUBLE END AS agreement
  FROM (SELECT * FROM documents) d LEFT JOIN (SELECT doc_id AS doc_id FROM labels) l USING (doc_id))"""
UTTERANCES_SQL = UTTERANCES_SQL.replace("(doc_id % 519)", "(d.doc_id % 519)").replace("'/' || doc_id", "'/' || d.doc_id")

PLAN_SQL = (
    UTTERANCES_SQL
    + rf""",
limited AS (
  SELECT *, CASE WHEN text_token_count = 0 THEN 'text_token_length=0'
                 WHEN text_token_count > 200 THEN 'text_token_length>200' END AS model_limit_exclusion
  FROM (SELECT *, len({WORDS_SQL}) AS text_token_count FROM utterances)),
chosen AS (
  SELECT source_relative_path, sha256('1986' || chr(0) || source_relative_path) AS reservation_score
  FROM limited WHERE agreement >= 0.95 AND model_limit_exclusion IS NULL
  ORDER BY 2, 1 LIMIT 5),
plan AS (
  SELECT l.*, c.reservation_score, c.reservation_score IS NOT NULL AS reserved,
         CASE WHEN model_limit_exclusion IS NOT NULL OR agreement IS NULL OR c.reservation_score IS NOT NULL THEN NULL
              WHEN agreement < 0.95 THEN 1 ELSE 2 END AS phase
  FROM limited l LEFT JOIN chosen c USING (source_relative_path))"""
)

TURNS_SQL = r"""turns AS (
  SELECT a.conv_id, a.turn, a.role AS category,
         list_filter(string_split_regex(a.text, '\s+'), lambda w: w <> '') AS r,
         list_filter(string_split_regex(b.text, '\s+'), lambda w: w <> '') AS h
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"""


def turn_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each turn as reference and the next turn as hypothesis, as token arrays."""
    turns = texts(spark, folder, "conversations", "conv_id")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), words(F.col("text")).alias("hyp"))
    return turns.select("conv_id", "turn", F.col("role").alias("category"), words(F.col("text")).alias("ref")).join(
        following, ["conv_id", "turn"]
    )
