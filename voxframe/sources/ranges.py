"""Ranged reads: members of tar archives and rows of Parquet files, found by an index and read by offset.

An index is an ordinary table: one row per member of an archive, or per row group of a file. Making it reads headers and
footers only. What is wanted is joined with the index, and many tasks read their own byte ranges of one large file.
Files are opened by URI through :func:`opened`, or by a callable of the user's for other stores.
"""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxframe.operators.joins import fail_on_issue
from voxframe.operators.ordering import running_total, spread_sorted
from voxframe.session import materialize
from voxframe.sources.archives import ArchiveError

#: Bytes of an archive that one range covers, about.
SPLIT = 64 << 20
#: Bytes of payload in a batch, about.
BATCH = 8 << 20
#: Bytes read ahead.
AHEAD = 1 << 20

Opener = Callable[[str], BinaryIO]


def opened(uri: str) -> BinaryIO:
    """A seekable file of a path or URI: local, or of an object store or HDFS."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    store, path = fs.FileSystem.from_uri(uri)
    return io.BufferedReader(store.open_input_file(path), AHEAD)


def _spread(paths: DataFrame) -> DataFrame:
    cores = paths.sparkSession.sparkContext.defaultParallelism
    return paths.distinct().repartition(4 * cores, *paths.columns)


def _headers(archive: BinaryIO, path: str) -> Iterator[tuple[int, str, bool, int, int]]:
    """Position, name, whether it is a file, offset and size of every member; payloads are skipped by seeking."""
    try:
        with tarfile.open(fileobj=archive, mode="r:") as members:
            position = 0
            while (member := members.next()) is not None:
                yield position, member.name, member.isfile(), member.offset_data, member.size
                members.members.clear()  # the list would hold every header
                position += 1
    except (tarfile.TarError, EOFError) as error:
        raise ArchiveError(f"damaged archive: {path}") from error


def member_index(paths: DataFrame, archive: str = "archive", open_file: Opener = opened) -> DataFrame:
    """``archive, position, member, is_file, offset, size`` of every member of the listed archives; headers only are read.

    Written once, so that later steps and later jobs need no scan. A damaged archive stops the job.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["position", "member", "is_file", "offset", "size"]
        for batch in batches:
            for path in batch["archive"]:
                held: list[tuple] = []
                with open_file(path) as raw:
                    for header in _headers(raw, path):
                        held.append(header)
                        if len(held) == 10_000:
                            yield pd.DataFrame(held, columns=names).assign(archive=path)
                            held = []
                yield pd.DataFrame(held, columns=names).assign(archive=path)

    listed = _spread(paths.select(F.col(archive).alias("archive")).where("archive IS NOT NULL"))
    index = listed.mapInPandas(read, "position long, member string, is_file boolean, offset long, size long, archive string")
    return materialize(index.select("archive", "position", "member", "is_file", "offset", "size"), "member-index")


def read_pieces(rows: DataFrame, open_file: Opener = opened, split: int = SPLIT) -> DataFrame:
    """``archive, member, contents``: the bytes of every piece of ``rows`` (``archive, member, pieces``: offsets and sizes).

    Rows of one stretch of ``split`` bytes are read by one task, in the order of their offsets, each archive opened once.
    ``rows`` is read twice; write it first where it is expensive.
    """
    total = rows.agg(F.sum(F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["size"]))).first()[0] or 0
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // split))
    first = F.get("pieces", 0)["offset"]
    placed = rows.select("archive", "member", "pieces", first.alias("_at")).repartition(tasks, "archive", F.floor(first / split))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, raw = None, None
        names, members, contents, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(members, pa.string()), pa.array(contents, pa.list_(pa.binary()))], ["archive", "member", "contents"]
            )

        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if row["archive"] != path:
                        if raw is not None:
                            raw.close()
                        path, raw = row["archive"], open_file(row["archive"])
                    found = []
                    for piece in row["pieces"]:
                        raw.seek(piece["offset"])
                        found.append(raw.read(piece["size"]))
                        if len(found[-1]) != piece["size"]:
                            raise ArchiveError(f"damaged archive: {path}")
                    names.append(path)
                    members.append(row["member"])
                    contents.append(found)
                    held += sum(map(len, found))
                    if held >= BATCH:
                        yield flush()
                        names, members, contents, held = [], [], [], 0
            if names:
                yield flush()
        finally:
            if raw is not None:
                raw.close()

    return placed.sortWithinPartitions("archive", "_at").drop("_at").mapInArrow(read, "archive string, member string, contents array<binary>")


def members_by_range(wanted: DataFrame, index: DataFrame, open_file: Opener = opened, split: int = SPLIT) -> DataFrame:
    """``archive, member, payload`` of the listed members (``archive, member``); each must exist once in its archive."""
    asked = wanted.select("archive", "member").distinct()
    named = index.where("is_file").groupBy("archive", "member").agg(F.count("*").alias("_n"), F.min(F.struct("offset", "size")).alias("_piece"))
    found = asked.join(named, ["archive", "member"], "left")
    issue = F.when(F.col("_n").isNull(), "no such member").when(F.col("_n") > 1, "repeated member")
    sound = fail_on_issue(found.withColumn("issue", issue), "archive", key="member")
    pieces = materialize(sound.select("archive", "member", F.array("_piece").alias("pieces")), "wanted-members")
    return read_pieces(pieces, open_file, split).select("archive", "member", F.get("contents", 0).alias("payload"))


def pairs_by_range(index: DataFrame, payload_suffix: str = ".mp3", open_file: Opener = opened, split: int = SPLIT) -> DataFrame:
    """``source_relative_path, metadata, payload`` of adjacent JSON and audio members, in either order.

    The layout is checked on the index before a payload is read: a directory, another suffix, a missing partner, a
    repeated pair, a name unlike ``shard_NNNNNN.tar`` and a JSON that names another path stop the job.
    """
    shard = F.regexp_extract("archive", r"(?:^|/)shard_(\d{6})\.tar$", 1)
    stem, suffix = F.regexp_extract("member", r"(?s)^([^/]+)(\.[^./]*)$", 1), F.regexp_extract("member", r"(?s)^([^/]+)(\.[^./]*)$", 2)
    wrong = (
        F.when(shard == "", "archive must be named shard_NNNNNN.tar")
        .when(~F.col("is_file"), "not a file")
        .when((stem == "") | ~suffix.isin(".json", payload_suffix), "unexpected member")
    )
    sound = fail_on_issue(index.withColumn("issue", wrong), "archive", key="member")
    half = F.struct("offset", "size")
    halves = sound.withColumns({"shard": shard, "stem": stem, "suffix": suffix, "pair": F.floor(F.col("position") / 2)})
    # By name: a pair that is not adjacent, or comes twice, shows as more than one place.
    pairs = halves.groupBy("archive", "shard", "stem").agg(
        F.count("*").alias("n"),
        F.min("pair").alias("low"),
        F.max("pair").alias("high"),
        F.max(F.when(F.col("suffix") == ".json", half)).alias("text"),
        F.max(F.when(F.col("suffix") == payload_suffix, half)).alias("audio"),
    )
    broken = (
        F.when(F.col("n") > 2, "repeated pair")
        .when((F.col("n") < 2) | (F.col("low") < F.col("high")), "no partner")
        .when(F.col("text").isNull() | F.col("audio").isNull(), "repeated member")
    )
    whole = fail_on_issue(pairs.withColumn("issue", broken), "archive", key="stem")
    pieces = whole.select("archive", F.concat_ws("/", "shard", F.concat("stem", F.lit(payload_suffix))).alias("member"), F.array("text", "audio").alias("pieces"))
    contents = read_pieces(materialize(pieces, "archive-pairs"), open_file, split)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for expected, both in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = both[0].as_py()
                try:
                    value = json.loads(raw)
                except ValueError as error:
                    raise ArchiveError(f"bad JSON for {expected}") from error
                if not isinstance(value, dict) or value.get("source_relative_path") != expected:
                    raise ArchiveError(f"JSON does not name {expected}")
                texts.append(raw.decode("utf-8"))
            audio = pa.array([both[1].as_py() for both in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), audio], ["source_relative_path", "metadata", "payload"])

    return contents.select("member", "contents").mapInArrow(described, "source_relative_path string, metadata string, payload binary")


def footer_index(spark: SparkSession, paths: Sequence[str], open_file: Opener = opened) -> DataFrame:
    """``file, row_group, first_ordinal, rows`` of Parquet files; ordinals run through the files by name, footers only are read.

    Written once. Row groups without rows have no entry.
    """
    files = spark.createDataFrame([(p,) for p in sorted(spark.read.parquet(*paths).inputFiles())], "file string")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["file"]:
                with open_file(path) as raw:
                    footer = pq.ParquetFile(raw).metadata
                    sizes = [footer.row_group(i).num_rows for i in range(footer.num_row_groups)]
                yield pd.DataFrame({"file": path, "row_group": range(len(sizes)), "rows": sizes})

    groups = _spread(files).mapInPandas(read, "file string, row_group int, rows long").where("rows > 0")
    counted = running_total(spread_sorted(groups, "file", "row_group"), "rows", "_through")
    return materialize(counted.select("file", "row_group", (F.col("_through") - F.col("rows")).alias("first_ordinal"), "rows"), "footer-index")


def rows_at(index: DataFrame, wanted: DataFrame, columns: Sequence[str], ordinal: str = "ordinal", open_file: Opener = opened) -> DataFrame:
    """The ``columns`` of the rows at the ordinals of ``wanted``; only the row groups they lie in, and those columns, are read.

    ``wanted`` may repeat an ordinal, which gives its row once; a null is no ordinal. One outside the table stops the job.
    """
    spark = index.sparkSession
    asked = wanted.select(F.col(ordinal).cast("long").alias("ordinal")).where("ordinal IS NOT NULL").distinct()
    # Ordinals and row groups meet by blocks as long as the longest row group, of which a group touches two at most.
    longest = index.agg(F.max("rows")).first()[0] or 1
    blocks = F.explode(F.sequence(F.floor(F.col("first_ordinal") / longest), F.floor((F.col("first_ordinal") + F.col("rows") - 1) / longest)))
    touched = index.withColumn("block", blocks)
    inside = (F.col("ordinal") >= F.col("first_ordinal")) & (F.col("ordinal") < F.col("first_ordinal") + F.col("rows"))
    near = asked.withColumn("block", F.floor(F.col("ordinal") / longest)).withColumnRenamed("block", "at")
    met = near.join(touched, (F.col("at") == F.col("block")) & inside, "left")
    sound = fail_on_issue(met.withColumn("issue", F.when(F.col("file").isNull(), "no such row")), "ordinal", key="ordinal")
    found = sound.select("file", "row_group", "ordinal", (F.col("ordinal") - F.col("first_ordinal")).alias("place"))
    sorted_rows = found.repartition(4 * spark.sparkContext.defaultParallelism, "file", "row_group").sortWithinPartitions("file", "row_group", "place")
    some = index.select("file").first()
    listed = list(columns)
    schema = spark.read.parquet(some["file"]).select(*listed).schema if some else None
    if schema is None:
        raise ValueError("the index names no row group")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, path, raw, parquet, group = None, None, None, None, None
        for batch in batches:
            keys = pd.DataFrame({"file": batch.column(0).to_pylist(), "row_group": batch.column(1).to_pylist()})
            for (file, number), rows in keys.groupby(["file", "row_group"], sort=False).indices.items():
                if file != path:
                    if raw is not None:
                        raw.close()
                    path, raw = file, open_file(file)
                    parquet = pq.ParquetFile(raw)
                if (file, number) != at:
                    at, group = (file, number), parquet.read_row_group(int(number), columns=listed).select(listed)
                taken = group.take(batch.column(3).take(pa.array(rows)))
                full = taken.add_column(0, "ordinal", batch.column(2).take(pa.array(rows)))
                yield from full.combine_chunks().to_batches()
        if raw is not None:
            raw.close()

    fields = ", ".join(["ordinal long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)])
    return sorted_rows.mapInArrow(read, fields).withColumnRenamed("ordinal", ordinal)
