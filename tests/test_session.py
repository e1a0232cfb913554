import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from voxframe.session import balanced, checkpoint_root, drop_scratch, materialize, may_be_listed, passing

SCRIPT = """
import sys
from pyspark.sql import SparkSession
from voxframe.session import materialize
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
print(materialize(spark.range(3), "t").inputFiles()[0])
"""


def test_folder_named_by_the_session_is_used(tmp_path):
    home = str(Path(__file__).resolve().parent.parent)
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path)], capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": home}
    )
    assert str(tmp_path) in run.stdout.splitlines()[-1], run.stderr[-2000:]


def test_scratch_tables_can_be_dropped(spark):
    root = checkpoint_root(spark)
    assert root == checkpoint_root(spark)
    stored = materialize(spark.range(10), "t")
    assert stored.count() == 10
    folder = f"{root}/voxframe-{spark.sparkContext.applicationId}".removeprefix("file:")
    assert os.path.isdir(folder)
    drop_scratch(spark)
    assert not os.path.isdir(folder)


def test_passing_tables_go_and_kept_ones_stay(spark):
    with passing(spark):
        with passing(spark):
            inner = materialize(spark.range(3), "inner")
            outer = materialize(inner.selectExpr("id + 1 AS id"), "outer", keep=True)
            folders = [os.path.dirname(df.inputFiles()[0].removeprefix("file://")) for df in (inner, outer)]
            assert all(map(os.path.isdir, folders))
        assert [os.path.isdir(f) for f in folders] == [False, True]
        kept = materialize(outer, "kept", keep=True)
    assert not os.path.isdir(folders[1]) and sorted(r[0] for r in kept.collect()) == [1, 2, 3]


def test_listed_rows_are_never_told_unlisted(spark):
    rows = spark.range(20_000).union(spark.range(5)).withColumn("h", F.xxhash64("id")).union(spark.sql("SELECT -1L, CAST(NULL AS BIGINT)"))
    for count in (0, 1, 700):
        listed = materialize(spark.range(count).select(F.xxhash64("id").alias("mark")), "listed")
        told = may_be_listed(rows, F.col("h"), listed, "mark")
        assert told.columns == ["id", "h", "_listed"] and told.count() == 20_006
        found = {r["id"] for r in told.where("_listed").collect()}
        assert set(range(count)) <= found and len(found) < count + 2_000 and -1 not in found


def test_only_small_scans_are_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    assert balanced(spark.read.parquet(str(tmp_path / "one")), "id").rdd.getNumPartitions() > 1
    enough = spark.range(0, 800, 1, 8)
    assert balanced(enough, "id") is enough
