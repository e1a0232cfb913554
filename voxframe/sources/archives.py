"""Tar archives as Spark sources: paired members, selected members, compressed sidecars.

One archive is one task, because a tar can only be read from front to back. Payloads
are read into a row one by one; an archive is never held whole.
"""

from __future__ import annotations

import json
import re
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAIRS = T.StructType(
    [
        T.StructField("source_relative_path", T.StringType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
_ARCHIVE = re.compile(r"shard_(\d{6})\.tar")


class ArchiveError(ValueError):
    """An archive breaks the layout of adjacent JSON and audio members."""


def _archives(path: str) -> list[str]:
    import glob
    import os

    local = re.sub("^file:/+", "/", path)
    found = sorted(glob.glob(os.path.join(local, "*.tar")) if os.path.isdir(local) else glob.glob(local))
    if not found:
        raise ArchiveError(f"no archive at {path}")
    return found


def _member_key(member: tarfile.TarInfo, payload_suffix: str) -> tuple[str, str]:
    if not member.isfile():
        raise ArchiveError(f"not a file: {member.name}")
    stem, dot, suffix = member.name.rpartition(".")
    if "/" in member.name or not stem or dot + suffix not in (".json", payload_suffix):
        raise ArchiveError(f"unexpected member: {member.name}")
    return stem, dot + suffix


def _members(archive: tarfile.TarFile) -> Iterator[tarfile.TarInfo]:
    """Members as they stream by, without the list that would hold every header."""
    while (member := archive.next()) is not None:
        yield member
        archive.members.clear()


def paired_members(path: str, payload_suffix: str = ".mp3") -> Iterator[tuple[str, str, bytes]]:
    """Yield ``(path, json text, payload)`` of the adjacent pairs of one archive, in either order."""
    named = _ARCHIVE.fullmatch(path.rsplit("/", 1)[-1])
    if named is None:
        raise ArchiveError(f"archive must be named shard_NNNNNN.tar: {path}")
    finished: set[str] = set()
    half: tuple[str, str, bytes] | None = None
    with tarfile.open(path, "r|") as archive:
        for member in _members(archive):
            key, suffix = _member_key(member, payload_suffix)
            content = archive.extractfile(member).read()
            if half is None:
                if key in finished:
                    raise ArchiveError(f"repeated pair: {key}")
                half = (key, suffix, content)
                continue
            if half[0] != key:
                raise ArchiveError(f"no partner for {half[0]}{half[1]}")
            if half[1] == suffix:
                raise ArchiveError(f"repeated member: {member.name}")
            text, payload = (content, half[2]) if suffix == ".json" else (half[2], content)
            try:
                described = json.loads(text)
            except ValueError as error:
                raise ArchiveError(f"bad JSON for {key}") from error
            expected = f"{named.group(1)}/{key}{payload_suffix}"
            if not isinstance(described, dict) or described.get("source_relative_path") != expected:
                raise ArchiveError(f"JSON of {key} does not name {expected}")
            yield expected, text.decode("utf-8"), payload
            finished.add(key)
            half = None
    if half is not None:
        raise ArchiveError(f"no partner for {half[0]}{half[1]}")


class _OneArchive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _PairReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.suffix = options.get("payloadSuffix", ".mp3")

    def partitions(self) -> list[InputPartition]:
        return [_OneArchive(p) for p in _archives(self.path)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from paired_members(partition.path, self.suffix)


class TarPairs(DataSource):
    """``spark.read.format("tar_pairs").load(folder)``: one partition per archive."""

    @classmethod
    def name(cls) -> str:
        return "tar_pairs"

    def schema(self) -> T.StructType:
        return PAIRS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _PairReader(self.options)


def tar_pairs(spark: SparkSession, path: str) -> DataFrame:
    """All pairs of the archives at a folder or glob."""
    spark.dataSource.register(TarPairs)
    return spark.read.format("tar_pairs").load(path)


def _pick(path: str, wanted: set[str]) -> Iterator[tuple[str, bytes]]:
    left = set(wanted)
    with tarfile.open(path, "r|") as archive:
        for member in _members(archive):
            if member.name in left:
                yield member.name, archive.extractfile(member).read()
                left.remove(member.name)
                if not left:
                    return
    raise ArchiveError(f"{path} lacks {sorted(left)[:5]}")


def selected_members(wanted: DataFrame, archive: str = "archive", member: str = "member") -> DataFrame:
    """Payloads of listed members, reading only the archives named and stopping once all are found.

    The names wanted from one archive are at most its own members; each must exist.
    """
    lists = wanted.select(archive, member).distinct().groupBy(archive).agg(F.collect_set(member).alias("_members"))
    # Equal batches of archives over the cluster, one archive at a time in each task.
    spread = lists.repartition(archive)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, names in zip(batch[archive], batch["_members"]):
                for name, payload in _pick(path, set(names)):
                    yield pd.DataFrame({"archive": [path], "member": [name], "payload": [payload]})

    return spread.mapInPandas(read, "archive string, member string, payload binary")


def _json_lines(path: str) -> Iterator[str]:
    import zstandard

    with open(path, "rb") as raw:
        if path.endswith(".zst"):
            stream = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
        else:
            stream = raw
        with tarfile.open(fileobj=stream, mode="r|") as archive:
            for member in _members(archive):
                if not member.isfile() or not member.name.endswith(".jsonl"):
                    continue
                for line in iter(archive.extractfile(member).readline, b""):
                    if line.strip():
                        yield line.decode("utf-8").rstrip("\r\n")
        if path.endswith(".zst"):
            # Drain what follows the tar so that a cut-off frame is noticed.
            try:
                while stream.read(1 << 20):
                    pass
            except zstandard.ZstdError as error:
                raise ArchiveError(f"damaged archive: {path}") from error


def sidecar_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(archive, line)`` of the ``*.jsonl`` members of tar or tar.zst files; truncation is an error."""
    files = spark.createDataFrame([(p,) for p in paths], "archive string").repartition(len(paths), "archive")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["archive"]:
                held: list[str] = []
                try:
                    for line in _json_lines(path):
                        held.append(line)
                        if len(held) == 2000:
                            yield pd.DataFrame({"archive": path, "line": held})
                            held = []
                except (tarfile.TarError, EOFError) as error:
                    raise ArchiveError(f"damaged archive: {path}") from error
                if held:
                    yield pd.DataFrame({"archive": path, "line": held})

    return files.mapInPandas(read, "archive string, line string")
