"""Files derived from the given tables by Spark, as inputs for the reader queries.

Each task writes its own files below the shared folder.
"""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.session import balanced, scratch_path


def _local(path: str) -> str:
    return path[len("file:") :] if path.startswith("file:") else path


def _add(archive: tarfile.TarFile, name: str, data: bytes) -> None:
    info = tarfile.TarInfo(name)
    info.size = len(data)
    archive.addfile(info, io.BytesIO(data))
    archive.members.clear()  # the list would hold every header


def write_paired_files(pages: DataFrame) -> str:
    """``pageN.wav`` files with ``.normalized.txt`` siblings where the address has no query; returns the folder."""
    root = scratch_path(pages.sparkSession, "pairs")
    local = _local(root)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        for batch in batches:
            for number, url in zip(batch["page_id"], batch["url"]):
                folder = f"{local}/{number % 10}/{number % 7}"
                os.makedirs(folder, exist_ok=True)
                with open(f"{folder}/page{number}.wav", "wb") as audio:
                    audio.write(b"RIFF")
                if "?" not in url:
                    with open(f"{folder}/page{number}.normalized.txt", "w", encoding="utf-8") as text:
                        text.write(f"{url}\nsecond line\n")
            yield pd.DataFrame({"files": [len(batch)]})

    pages.select("page_id", "url").mapInPandas(write, "files int").agg(F.sum("files")).collect()
    return root


def write_archives(df: DataFrame, folder: str, shard: str, key: str, text: str, payload: str, suffix: str = ".mp3") -> DataFrame:
    """``shard_NNNNNN.tar`` files of paired members, one per shard number; returns rows per shard once run."""
    ordered = df.select(shard, key, text, payload).repartition(F.col(shard)).sortWithinPartitions(shard, key)
    local = _local(folder)

    def written(number: int, rows: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([rows], pa.int32())], ["shard", "rows"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.makedirs(local, exist_ok=True)
        current, archive, rows = None, None, 0
        for batch in batches:
            for row in zip(*batch.columns):  # one payload at a time
                number, name, described, content = (value.as_py() for value in row)
                if number != current:
                    if archive is not None:
                        archive.close()
                        yield written(current, rows)
                    current, rows = number, 0
                    archive = tarfile.open(f"{local}/shard_{number:06d}.tar", "w")
                members = [(f"{name}.json", described.encode("utf-8")), (f"{name}{suffix}", content)]
                for member in members if rows % 2 else reversed(members):
                    _add(archive, *member)
                rows += 1
        if archive is not None:
            archive.close()
            yield written(current, rows)

    return ordered.mapInArrow(write, "shard int, rows int")


def write_sidecar_archives(documents: DataFrame) -> list[str]:
    """``tar.zst`` files of JSON-lines members; returns the paths.

    Every task writes an archive of its own for each language it meets, so no language meets in one task.
    """
    root = scratch_path(documents.sparkSession, "sidecars")
    local = _local(root)
    lines = balanced(documents, "doc_id").select("lang", "doc_id", F.to_json(F.struct("doc_id", "lang", "text")).alias("line"))
    ordered = lines.sortWithinPartitions("lang", "doc_id")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        import zstandard

        os.makedirs(local, exist_ok=True)
        task = TaskContext.get().partitionId()
        current, archive, stream, raw, part = None, None, None, None, 0

        def close() -> None:
            archive.close()
            stream.close()
            raw.close()

        for batch in batches:
            for lang, group in batch.groupby("lang", sort=False):
                if lang != current:
                    if archive is not None:
                        close()
                    current, part = lang, 0
                    raw = open(f"{local}/{lang}-{task:06d}.tar.zst", "wb")
                    stream = zstandard.ZstdCompressor().stream_writer(raw)
                    archive = tarfile.open(fileobj=stream, mode="w|")
                    yield pd.DataFrame({"path": [f"{local}/{lang}-{task:06d}.tar.zst"]})
                _add(archive, f"part{part}.jsonl", ("\n".join(group["line"]) + "\n").encode("utf-8"))
                _add(archive, f"notes{part}.txt", b"not a sidecar")
                part += 1
        if archive is not None:
            close()

    return [r["path"] for r in ordered.mapInPandas(write, "path string").collect()]
