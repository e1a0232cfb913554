"""Server log lines ``[request] event | k=v | k=v`` as typed columns, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
LOG_EVENTS = ["stream_start", "first_chunk", "stream_done"]
LOG_PATTERN = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \| (\w+) +\| \[([^\]]+)\] (\w+) \| (.*)$"
# -----------------------------------------------------------------------------


def request_events(lines: DataFrame, value: str = "value") -> DataFrame:
    """Typed request events; other lines are dropped."""
    line = F.col(value)
    part = lambda i: F.regexp_extract(line, LOG_PATTERN, i)
    fields = F.str_to_map(part(5), F.lit(r" \| "), F.lit("="))
    typed = lines.where(line.rlike(LOG_PATTERN)).select(
        F.to_timestamp(part(1), "yyyy-MM-dd HH:mm:ss").alias("ts"),
        part(2).alias("level"),
        part(3).alias("request_id"),
        part(4).alias("event"),
        fields.alias("f"),
    )
    number = lambda key, kind: F.col("f")[key].try_cast(kind).alias(key)
    return typed.where(F.col("event").isin(LOG_EVENTS)).select(
        "ts",
        "level",
        "request_id",
        "event",
        F.col("f")["mode"].alias("mode"),
        F.col("f")["lang"].alias("lang"),
        number("chars", "int"),
        number("chunks", "int"),
        number("bytes", "bigint"),
        number("audio_ms", "double"),
        number("latency_ms", "double"),
        number("total_ms", "double"),
        number("rtf", "double"),
    )
