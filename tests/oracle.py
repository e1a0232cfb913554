"""Run registered queries beside DuckDB and compare names, types, row counts and values."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voxframe-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _family(kind: str) -> str:
    kind = str(kind).lower()
    for family, names in {
        "int64": ("bigint", "int64"),
        "int32": ("integer", "int32"),
        "float": ("double",),
        "float32": ("float",),
        "string": ("varchar", "string"),
        "bool": ("boolean",),
        "time": ("timestamp",),
    }.items():
        if kind.startswith(names):
            return family
    return "int32" if kind == "int" else kind


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, query, folder: str) -> str:
    """Empty when equal, else what differs."""
    frame = query.run(spark, folder)
    mine = [tuple(r) for r in frame.collect()]
    if query.sql is None:
        return "" if frame.columns else "no columns"
    result = con.execute(query.sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: _family(d[1]) for d in result.description}
    theirs = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    types = {f.name: _family(f.dataType.simpleString()) for f in frame.schema}
    wrong = {n: (types[n], kinds[n]) for n in names if types[n] != kinds[n]}
    order = [frame.columns.index(n) for n in sorted(names)]
    left = sorted(tuple(_cell(r[i]) for i in order) for r in mine)
    order = [names.index(n) for n in sorted(names)]
    right = sorted(tuple(_cell(r[i]) for i in order) for r in theirs)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}; {left[:2]} | {right[:2]}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        return f"{len(different)} of {len(left)} rows differ {sorted(names)}: {str(different[0])[:700]}"
    if wrong:
        return f"types (spark, sql): {wrong}"
    return "" if left else "EMPTY"


def main() -> None:
    from voxframe.catalog import REGISTRY

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = session()
    con = database(folder)
    bad = 0
    for name, item in REGISTRY.items():
        if wanted and not any(w in name or w in item.run.__module__ for w in wanted):
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, item, folder)
        except Exception as error:  # report and go on
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += bool(verdict)
        print(f"{'ok  ' if not verdict else 'BAD '} {name} {time.time() - start:.2f}s {verdict}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
