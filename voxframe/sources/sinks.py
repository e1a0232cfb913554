"""Writers: manifests, fixed-size shards, plans, result tables and verified publication."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxframe.functions.arrays import canonical_hash, canonical_json, valid_tokens
from voxframe.functions.text import joined_characters
from voxframe.operators.aggregates import grouped_lists, token_audit
from voxframe.operators.ordering import with_ordinal
from voxframe.operators.quality import require_schema

# ---- fixed values -----------------------------------------------------------
ROWS_PER_SHARD = 1000
POINTER = "CURRENT"
# -----------------------------------------------------------------------------

PHASE_ROWS = T.StructType(
    [
        T.StructField("source_relative_path", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("instruct", T.StringType()),
        T.StructField("agreement", T.DoubleType()),
        T.StructField("speech_token", T.ArrayType(T.IntegerType())),
        T.StructField("speech_token_len", T.IntegerType()),
    ]
)


def manifest_lines(df: DataFrame, key: str, value: str) -> DataFrame:
    """``key value`` lines."""
    return df.select(F.concat_ws(" ", key, value).alias("value"))


def grouped_manifest_lines(df: DataFrame, key: str, member: str, chunk: int | None = None) -> DataFrame:
    """``key member member ...`` lines, members sorted: one line for each key.

    A line is one record however many members it has. With ``chunk`` a line holds at most
    that many and its key reads ``key/part``, so that no reader takes one part for the
    whole; ``key_members`` puts the parts together again.
    """
    if chunk is None:
        lists = df.groupBy(key).agg(F.sort_array(F.collect_list(member)).alias("members"))
        name = F.col(key).cast("string")
    else:
        lists = grouped_lists(df, key, member, chunk, "members")
        name = F.concat(F.col(key).cast("string"), F.lit("/"), F.col("part").cast("string"))
    return lists.select(F.concat_ws(" ", name, F.array_join("members", " ")).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Write the ``value`` column as text files."""
    lines.select("value").write.text(path)


def sharded(df: DataFrame, keys: Sequence[str], rows: int = ROWS_PER_SHARD) -> DataFrame:
    """Shard number of consecutive runs of ``rows`` rows in key order; the rows come back in that order."""
    return with_ordinal(df, *keys).withColumn("shard", F.floor(F.col("ordinal") / rows)).drop("ordinal")


def write_shards(df: DataFrame, path: str, compression: str = "zstd") -> None:
    """Write the result of :func:`sharded` by shard.

    Its rows already lie in shard order, so every task writes whole shards but for its
    first and last one, without another shuffle.
    """
    df.write.option("compression", compression).partitionBy("shard").parquet(path)


def shard_index(df: DataFrame, key: str) -> DataFrame:
    """Distinct (key, shard) pairs."""
    return df.select(key, "shard").distinct()


def shard_files(df: DataFrame, path: str) -> DataFrame:
    """Folder of each shard of a written table."""
    return df.select("shard").distinct().select("shard", F.format_string(f"{path}/shard=%d", "shard").alias("file"))


def phase_rows(plan_with_tokens: DataFrame) -> DataFrame:
    """Rows of phases 1 and 2 in the fixed cache schema, plus ``phase`` and ``shard``; no payload column."""
    routed = plan_with_tokens.where(F.col("phase").isin(1, 2))
    return routed.select(*[F.col(f.name).cast(f.dataType) for f in PHASE_ROWS], "phase", "shard")


def write_phase_tables(rows: DataFrame, path: str) -> None:
    """Write phase tables as zstd Parquet by phase and shard.

    The path is part of the range, so a shard too big for one task becomes several files.
    """
    spread = rows.repartitionByRange("phase", "shard", "source_relative_path")
    spread.write.option("compression", "zstd").partitionBy("phase", "shard").parquet(path)


def plan_lines(plan: DataFrame, columns: Sequence[str]) -> DataFrame:
    """JSON line of each plan row, keys sorted and nulls written, with its shard."""
    return plan.select("shard", canonical_json(columns).alias("value"))


def write_plan_lines(lines: DataFrame, path: str) -> None:
    """Write plan lines as text by shard; a big shard becomes several files."""
    lines.repartitionByRange("shard", "value").write.partitionBy("shard").text(path)


def result_lines(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Canonical JSON and hash of each result row, ordered by key."""
    return df.select(key, canonical_json(columns).alias("value"), canonical_hash(columns).alias("record_sha256")).orderBy(key)


def roll_up_manifest(audit: DataFrame) -> DataFrame:
    """One row: rows per phase as a map, shards and rows in total."""
    per_phase = audit.groupBy("phase").agg(F.sum("row_count").alias("rows"), F.count_distinct("shard").alias("shards"))
    # Two phases at most, so the list is bounded.
    return per_phase.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("phase", "rows")))).alias("phase_rows"),
        F.sum("rows").alias("row_count"),
    )


def transcript_lines(df: DataFrame, key: str, reference: str, hypothesis: str, by_character: bool = False) -> DataFrame:
    """Two lines per row, ``ref=`` and ``hyp=``, of the token arrays or their characters."""
    form = lambda c: joined_characters(F.col(c)) if by_character else F.col(c)
    shown = lambda c: F.concat(F.lit("['"), F.array_join(form(c), "', '"), F.lit("']"))
    line = lambda name, c: F.concat(F.col(key).cast("string"), F.lit(f":\t{name}="), shown(c))
    return df.select(key, F.posexplode(F.array(line("ref", reference), line("hyp", hypothesis))).alias("line", "value"))


def json_cells(df: DataFrame) -> DataFrame:
    """Every column, sorted by name, as a string column of JSON cells; null becomes ``null``."""

    def cell(name: str):
        # to_json takes only structs, maps and arrays: wrap in an array and strip its brackets.
        wrapped = F.to_json(F.array(F.col(name)), {"ignoreNullFields": "false"})
        return F.substring(wrapped, F.lit(2), F.char_length(wrapped) - 2).alias(name)

    return df.select(*[cell(c) for c in sorted(df.columns)])


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, root: str) -> str | None:
    """Folder the pointer of a published table names, or None."""
    pointer, files = _file_system(spark, f"{root}/{POINTER}")
    if not files.exists(pointer):
        return None
    return f"{root}/{spark.read.text(f'{root}/{POINTER}').first()['value']}"


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """Current version of a published table."""
    path = current_version(spark, root)
    if path is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    return spark.read.parquet(path)


def _set_pointer(spark: SparkSession, root: str, version: str) -> None:
    staged, files = _file_system(spark, f"{root}/{POINTER}-{uuid.uuid4().hex}")
    stream = files.create(staged)
    stream.write(bytearray(version, "utf-8"))
    stream.close()
    target, _ = _file_system(spark, f"{root}/{POINTER}")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(context.makeQualified(staged), context.makeQualified(target), options)


def publish(
    df: DataFrame,
    root: str,
    checks: Sequence[Callable[[DataFrame], None]] = (),
    partition_by: Sequence[str] = (),
) -> str:
    """Write a new version, reopen and check it, then point readers to it.

    The pointer is replaced in one rename after every check has passed, so a failure at
    any point leaves the previous version current.
    """
    spark = df.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    path = f"{root}/{version}"
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    reopened = spark.read.parquet(path)
    for check in checks:
        check(reopened)
    _set_pointer(spark, root, version)
    return path


def check_schema(schema: T.StructType) -> Callable[[DataFrame], None]:
    """Publication check: exact columns."""
    return lambda df: require_schema(df, schema) and None


def check_rows(count: int) -> Callable[[DataFrame], None]:
    """Publication check: row count."""

    def check(df: DataFrame) -> None:
        found = df.count()
        if found != count:
            raise ValueError(f"expected {count} rows, found {found}")

    return check


def check_tokens(tokens: str, declared: str) -> Callable[[DataFrame], None]:
    """Publication check: every token list is valid and as long as declared."""

    def check(df: DataFrame) -> None:
        bad = df.where(~valid_tokens(F.col(tokens), F.col(declared))).limit(1).count()
        if bad:
            raise ValueError("invalid token list")

    return check


def published_or_built(
    spark: SparkSession, root: str, identity: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()
) -> tuple[DataFrame, bool]:
    """The published table when it was made from the same identity, else a new publication.

    Returns the table and whether it was reused.
    """
    marker = f"{root}/IDENTITY"
    path, files = _file_system(spark, marker)
    if files.exists(path) and current_version(spark, root) and spark.read.text(marker).first()["value"] == identity:
        return read_published(spark, root), True
    if files.exists(path):
        files.delete(path, False)
    publish(build(), root, partition_by=partition_by)
    stream = files.create(path)
    stream.write(bytearray(identity, "utf-8"))
    stream.close()
    return read_published(spark, root), False


def file_checksums(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SHA-256 and size of every file below a folder. Files are hashed in pieces inside the tasks."""
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    ).select("path", "length")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        from pyarrow import fs

        for batch in batches:
            sums = []
            for uri in batch["path"]:
                store, inner = fs.FileSystem.from_uri(uri.replace("file:/", "file:///") if uri.startswith("file:/") and not uri.startswith("file://") else uri)
                hasher = hashlib.sha256()
                with store.open_input_stream(inner) as stream:
                    while piece := stream.read(1 << 22):
                        hasher.update(piece)
                sums.append(hasher.hexdigest())
            yield pd.DataFrame({"path": batch["path"], "length": batch["length"], "sha256": sums})

    return listing.mapInPandas(digest, "path string, length bigint, sha256 string")


def changed_files(manifest: DataFrame, checksums: DataFrame, key: str = "path") -> DataFrame:
    """Files missing, unexpected or changed against a manifest of ``(path, sha256)``."""
    left = manifest.select(key, F.col("sha256").alias("declared"))
    right = checksums.select(key, F.col("sha256").alias("found"))
    joined = left.join(right, key, "full_outer")
    change = (
        F.when(F.col("found").isNull(), "missing")
        .when(F.col("declared").isNull(), "unexpected")
        .when(F.col("declared") != F.col("found"), "changed")
    )
    return joined.withColumn("change", change).where(F.col("change").isNotNull())


def cache_manifest(cache: DataFrame) -> DataFrame:
    """Rows and token range per phase and shard."""
    return token_audit(cache, ["phase", "shard"], "speech_token")


