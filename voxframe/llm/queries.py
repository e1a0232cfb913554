"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxframe.llm.chat import conversation_digests, formatted
from voxframe.llm.decontaminate import CONTAMINATION_SQL, contamination
from voxframe.llm.jaccard import near_duplicate_classes
from voxframe.llm.languages import identified
from voxframe.llm.neighbours import nearest
from voxframe.llm.outliers import quality_digests
from voxframe.llm.pages import extracted
from voxframe.llm.pieces import Vocabulary, piece_digests
from voxframe.llm.prefix_trie import TRIE_SQL, conversation_trie
from voxframe.llm.privacy import personal_data_digests
from voxframe.llm.spelling import spelling_variants
from voxframe.llm.suffix_array import repeat_digests
from voxframe.llm.suffix_tree import repeated_word_digests

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def keep(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return keep


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_suffix_array_dedup")
def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the strings of 50 bytes that a smaller document has."""
    return repeat_digests(_table(spark, folder, "documents"))


@_query("op2_benchmark_decontamination", CONTAMINATION_SQL)
def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie inside benchmark passages."""
    return contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query("op3_language_id")
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learnt from four fifths of them."""
    return identified(_table(spark, folder, "documents"))


@_query("op4_ngram_jaccard_join")
def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near copies of every document."""
    return near_duplicate_classes(_table(spark, folder, "documents"))


def piece_vocabulary(name: str = "piece_bpe_32k.model") -> Vocabulary:
    """Vocabulary of an installed public tokenizer."""
    import public_tokenizers

    return Vocabulary.from_model(public_tokenizers.path(name))


@_query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and what they decode to."""
    return piece_digests(_table(spark, folder, "documents"), piece_vocabulary())


@_query("op8_pii")
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    return personal_data_digests(_table(spark, folder, "documents"))


@_query("op10_substring_dedup")
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the sequences of 20 words that start earlier."""
    return repeated_word_digests(_table(spark, folder, "documents"))


#: A conversation that says nothing but control strings.
CONTROL_ROWS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@_query("op5_chat_formatting")
def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one more, formatted and read back."""
    more = spark.createDataFrame(CONTROL_ROWS, "conv_id long, turn long, role string, text string")
    turns = _table(spark, folder, "conversations").select(more.columns)
    return conversation_digests(formatted(turns.unionByName(more)))


@_query("op7_nearest_neighbours")
def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    vectors = _table(spark, folder, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


@_query("op9_html_extraction")
def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    found = extracted(_table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@_query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words one letter apart, each with the far more frequent one that it is a variant of."""
    return spelling_variants(_table(spark, folder, "documents"))


@_query("op12_conversation_prefix_trie", TRIE_SQL)
def op12_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, with shared openings."""
    return conversation_trie(_table(spark, folder, "conversations"))


@_query("op11_quality_outliers")
def op11_quality_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Quality counts of every document, and whether it is kept."""
    return quality_digests(_table(spark, folder, "documents"))
