"""Session helpers: the shared checkpoint folder and tables written into it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables written inside each open :func:`passing`, the innermost last.
_PASSING: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())
#: Bits of the filter of :func:`may_be_listed` for each listed row, and at most: broadcast, it then has about 16 MB.
_BITS_EACH = 16
_MOST_BITS = 1 << 24


def checkpoint_root(spark: SparkSession) -> str:
    """Return the folder all executors share for intermediate tables.

    ``spark.checkpoint.dir`` decides. Only a local session without that setting
    gets a temporary folder of its own; a cluster must name a shared one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="voxframe-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    application = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark)}/voxframe-{application}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table", keep: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    The result has no lineage to recompute after an executor is lost, and later
    steps still read only the columns they use. With ``keep`` it outlives the
    innermost :func:`passing` that it is written in.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    around = _PASSING.get()[:-1] if keep else _PASSING.get()
    if around:
        around[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Delete the tables materialized inside at its end, but those written with ``keep``.

    Nothing that is used later may read them: what is made of them has to be kept as a table.
    """
    made: list[str] = []
    token = _PASSING.set((*_PASSING.get(), made))
    try:
        yield
    finally:
        _PASSING.reset(token)
    for path in made:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def may_be_listed(rows: DataFrame, hashed: Column, listed: DataFrame, column: str, name: str = "_listed") -> DataFrame:
    """``rows`` with the boolean ``name``: true wherever ``hashed``, a 64-bit hash, is in ``column`` of ``listed``, and rarely else.

    ``listed`` is a stored table. Its hashes set bits that are broadcast, so no row is shuffled to be told apart. The
    bits grow with the list up to a fixed number; beyond it more rows are told true, none is told false wrongly.
    """
    bits = min(max(1 << (_BITS_EACH * listed.count()).bit_length(), 64), _MOST_BITS)
    place = F.pmod(F.col(column), F.lit(bits))
    at = listed.select(F.floor(place / 64).alias("_word"), (place % 64).cast("int").alias("_bit")).where("_bit IS NOT NULL")
    words = at.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    found = rows.withColumn("_place", F.pmod(hashed, F.lit(bits))).withColumn("_word", F.floor(F.col("_place") / 64))
    found = found.join(F.broadcast(words), "_word", "left")
    is_set = F.getbit("_bits", (F.col("_place") % 64).cast("int")) == 1
    return found.select(*rows.columns, F.coalesce(is_set, F.lit(False)).alias(name))


def in_few_tasks(df: DataFrame, rows: int, each: int = 1_000_000) -> DataFrame:
    """``df``, whose last step has a task for every ``each`` of about ``rows`` rows, but one for every core at least.

    For small tables that many rounds write and read again: a task and a file for each of many shuffle partitions
    would cost more than the rows in them. Nothing is shuffled for it, and no tasks are added.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once its results are written."""
    _delete(spark, f"{checkpoint_root(spark)}/voxframe-{spark.sparkContext.applicationId}")


def balanced(scan: DataFrame, *keys: str) -> DataFrame:
    """Spread a small scan over the cores before expensive work on each row.

    A small table is often one file and so one task. A scan that already has a
    partition for every core is left where it is, so large tables are not moved.
    Meant for scans: counting the partitions of a shuffled result would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(3 * cores, *keys)
