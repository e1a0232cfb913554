"""Run a stream over everything available and read what it wrote."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxframe.session import scratch_path


def drain(stream: DataFrame, mode: str, keys: Sequence[str] = (), checkpoint: str | None = None, target: str | None = None) -> DataFrame:
    """Process all available input and return the final rows.

    Each micro-batch overwrites its own folder, so a repeated batch changes nothing.
    ``append`` returns all rows, ``update`` the last version per key, ``complete`` the
    last state.
    """
    spark = stream.sparkSession
    root = target or scratch_path(spark, "stream")
    state = checkpoint or f"{root}-checkpoint"

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={number}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
    query.awaitTermination()
    columns = T.StructType([*stream.schema.fields, T.StructField("batch", T.IntegerType())])
    rows = spark.read.schema(columns).parquet(root)
    if mode == "append":
        return rows.drop("batch")
    if mode == "complete":
        last = rows.agg(F.max("batch")).first()[0]
        return rows.where(F.col("batch") == F.lit(last)).drop("batch")
    others = [c for c in stream.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def table_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the Parquet files of one table in a folder: a single file, or a folder of its own."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop_path).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)  # a stream reads folders only


def new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    build: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    partition_by: Sequence[str],
    files_per_batch: int = 100,
) -> None:
    """Process shard files that were not processed before and write their results by partition.

    The checkpoint remembers finished files. A batch repeated after a failure replaces
    its own partitions and nothing else.
    """

    def save(batch: DataFrame, number: int) -> None:
        (
            build(batch)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(*partition_by)
            .parquet(target)
        )

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()
    )
    query.awaitTermination()
