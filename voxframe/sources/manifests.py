"""Text, JSON and Parquet readers for corpus manifests, sidecars and file lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxframe.operators.columns import file_stem, with_instruct
from voxframe.operators.joins import fail_on_issue, optional
from voxframe.operators.quality import require_schema

CORRUPT = "_corrupt_record"

UTTERANCE = T.StructType(
    [
        T.StructField("utt", T.StringType()),
        T.StructField("audio_data", T.BinaryType()),
        T.StructField("wav", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("spk", T.StringType()),
        T.StructField("utt_embedding", T.ArrayType(T.FloatType())),
        T.StructField("spk_embedding", T.ArrayType(T.FloatType())),
        T.StructField("speech_token", T.ArrayType(T.IntegerType())),
        T.StructField("instruct", T.StringType()),
        T.StructField("reject_speech_token", T.ArrayType(T.IntegerType())),
    ]
)


def _bare(path: Column) -> Column:
    """Local paths without their scheme, which readers spell in different ways."""
    return F.regexp_replace(path, "^file:/+", "/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the path's own file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _lines_with_order(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a number that grows along each file and, file name first, across files."""
    lines = spark.read.text(path)
    start = F.col("_metadata.file_block_start")
    return lines.select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            start.alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("line_no"),
    )


def key_values(spark: SparkSession, path: str, free_text: bool = False) -> DataFrame:
    """``(utt, value)`` of a whitespace-separated manifest; a repeated key keeps its last line.

    With ``free_text`` the value is the rest of the line joined by single blanks.
    """
    parts = F.filter(F.split("value", r"(?U)\s+"), lambda w: w != "")
    value = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), " ") if free_text else F.get(parts, F.lit(1))
    rows = _lines_with_order(spark, path).where(F.size(parts) > 0)
    return (
        rows.select(F.get(parts, F.lit(0)).alias("utt"), value.alias("value"), "line_no")
        .groupBy("utt")
        .agg(F.max_by("value", "line_no").alias("value"))
    )


def key_members(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """``(utt, member)`` rows of ``key member member ...`` lines.

    With ``parts`` a key reads ``key/part`` and loses its last component, so the members of
    all parts come under one key.
    """
    fields = F.filter(F.split("value", r"(?U)\s+"), lambda w: w != "")
    name = F.get(fields, F.lit(0))
    key = F.regexp_replace(name, r"/[0-9]+$", "") if parts else name
    rows = spark.read.text(path).where(F.size(fields) > 1)
    return rows.select(key.alias("utt"), F.explode(F.slice(fields, F.lit(2), F.size(fields) - 1)).alias("member"))


def optional_key_values(spark: SparkSession, path: str, free_text: bool = False) -> DataFrame | None:
    """Like :func:`key_values`, or None when the manifest is not there."""
    return key_values(spark, path, free_text) if path_exists(spark, path) else None


def with_optional_manifest(df: DataFrame, path: str, column: str, free_text: bool = True) -> DataFrame:
    """Column from an optional manifest; null throughout when the file is absent."""
    table = optional_key_values(df.sparkSession, path, free_text)
    named = None if table is None else table.withColumnRenamed("value", column)
    return optional(df, named, "utt", column, "string")


def paired_texts(spark: SparkSession, root: str, audio_glob: str = "*.wav", text_suffix: str = ".normalized.txt") -> tuple[DataFrame, DataFrame]:
    """Audio files below ``root`` with the first line of their text sibling, and those without sibling.

    Only paths are read from the audio files; their bytes are never loaded.
    """

    def listing(glob: str) -> DataFrame:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        return reader.load(root).select("path")

    audio = listing(audio_glob).withColumn("stem", F.regexp_replace("path", r"\.[^./]*$", ""))
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{text_suffix}").text(root)
    first = texts.where(F.col("_metadata.file_block_start") == 0).select(
        F.regexp_replace(F.col("_metadata.file_path"), f"{text_suffix.replace('.', chr(92) + '.')}$", "").alias("stem"),
        "value",
        F.monotonically_increasing_id().alias("line"),
    )
    head = first.groupBy("stem").agg(F.min_by("value", "line").alias("text"))
    left = audio.withColumn("stem", _bare(F.col("stem")))
    right = head.withColumn("stem", _bare(F.col("stem")))
    return left.join(right, "stem").select("path", file_stem(F.col("path")).alias("utt"), "text"), left.join(
        right, "stem", "left_anti"
    ).select("path")


def tab_separated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Tab-separated table with a header row; fields are trimmed."""
    raw = spark.read.schema(schema).csv(path, sep="\t", header=True, quote="", enforceSchema=False)
    return raw.select(*[F.trim(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else f.name for f in schema])


def pipe_manifest(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """Four-field manifest ``utt|prompt_text|prompt_wav|text``; another arity stops the job.

    A relative audio path is taken from the manifest's folder.
    """
    folder = base if base is not None else path.rsplit("/", 1)[0]
    parts = F.split("value", r"\|")
    arity = F.when(F.size(parts) != 4, F.concat(F.lit("expected 4 fields: "), F.col("value")))
    rows = spark.read.text(path).where(F.trim("value") != "").withColumn("issue", arity)
    checked = fail_on_issue(rows, "manifest")
    wav = F.trim(parts[2])
    return checked.select(
        file_stem(F.trim(parts[0])).alias("utt"),
        F.trim(parts[1]).alias("prompt_text"),
        F.when(wav.startswith("/"), wav).otherwise(F.concat(F.lit(f"{folder}/"), wav)).alias("prompt_wav"),
        F.trim(parts[3]).alias("text"),
    )


def sidecar(spark: SparkSession, path: str, schema: T.StructType, version: int = 1) -> DataFrame:
    """Typed JSON lines with an ``issue``: not an object of the schema, or another ``schema_version``."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(full).json(path, columnNameOfCorruptRecord=CORRUPT)
    issue = F.when(F.col(CORRUPT).isNotNull(), "malformed").when(
        ~F.col("schema_version").eqNullSafe(F.lit(version)), "schema_version"
    )
    return rows.withColumn("issue", issue)


def valid_sidecar(spark: SparkSession, path: str, schema: T.StructType, version: int = 1) -> DataFrame:
    """Like :func:`sidecar`, but the first bad line stops the job."""
    return fail_on_issue(sidecar(spark, path, schema, version), "sidecar").drop(CORRUPT)


def parquet_files(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None, skip_unreadable: bool = True
) -> DataFrame:
    """Parquet files by path; unreadable files are skipped (and logged by the tasks) when asked."""
    reader = spark.read.option("ignoreCorruptFiles", skip_unreadable)
    return (reader.schema(schema) if schema else reader).parquet(*paths)


def listed_files(spark: SparkSession, list_path: str) -> list[str]:
    """Paths named in a list file, one per line; a list of shards, so it fits the driver."""
    rows = spark.read.text(list_path).where(F.trim("value") != "").select(F.trim("value").alias("value"))
    return [r["value"] for r in rows.toLocalIterator()]


def parquet_list(spark: SparkSession, list_path: str) -> DataFrame:
    """All Parquet files a list file names, as one table."""
    return parquet_files(spark, listed_files(spark, list_path))


def merged_json_indexes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(key, value)`` of JSON objects in several files; a later file of the list wins."""
    order = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "file string, place int")
    reader = spark.read.option("recursiveFileLookup", True)
    documents = reader.text(list(paths), wholetext=True).withColumn("file", _bare(F.col("_metadata.file_path")))
    placed = documents.join(order.withColumn("file", _bare(F.col("file"))), "file")
    entries = placed.select("place", F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))
    return entries.groupBy("key").agg(F.max_by("value", "place").alias("value"))


def snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table that must have exactly the given columns."""
    return require_schema(spark.read.parquet(path), schema)


def one_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """One shard of a table partitioned by ``shard``; other folders are not listed into the scan."""
    return spark.read.parquet(path).where(F.col("shard") == shard)


def row_at(df: DataFrame, ordinal: str, index: int) -> DataFrame:
    """Row with a global ordinal."""
    return df.where(F.col(ordinal) == index)


def requested_texts(value: Column) -> Column:
    """JSON object of utterance to texts as a map column."""
    return F.from_json(value, "map<string,array<string>>")


def request_rows(df: DataFrame, value: str = "value") -> DataFrame:
    """One row per utterance and text of a request document, with the text's position."""
    per_utterance = df.select(F.explode(requested_texts(F.col(value))).alias("utt", "texts"))
    return per_utterance.select("utt", F.posexplode("texts").alias("position", "text"))


def request_file(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a request file."""
    return request_rows(spark.read.text(path, wholetext=True))


def utterances(
    wavs: DataFrame, texts: DataFrame, speakers: DataFrame, instruct: str | None = None
) -> DataFrame:
    """Utterance rows of three key-value manifests; a missing text or speaker stops the job."""
    from voxframe.operators.joins import enrich

    rows = wavs.withColumnRenamed("value", "wav")
    rows = enrich(rows, texts.withColumnRenamed("value", "text"), "utt", ["text"])
    rows = enrich(rows, speakers.withColumnRenamed("value", "spk"), "utt", ["spk"])
    return with_instruct(rows, instruct)
