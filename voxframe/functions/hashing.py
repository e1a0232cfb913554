"""Stable keys for seeded order and sampling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(value: str | int | Column) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(str(value))


def stable_key(seed: int | str, *parts: str | int | Column) -> Column:
    """SHA-256 hex of ``seed NUL part NUL part ...``; string names are taken as columns."""
    columns = [F.col(p).cast("string") if isinstance(p, str) else _text(p) for p in parts]
    return F.sha2(F.concat_ws("\0", _text(seed), *columns), 256)


def hash_fraction(key: Column) -> Column:
    """Uniform number in [0, 1) from the first 13 hex digits of a stable key."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def hash_index(key: Column, n: int | Column) -> Column:
    """Index in [0, n) from the first 15 hex digits of a stable key."""
    size = F.lit(n) if isinstance(n, int) else n
    return F.pmod(F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint"), size)
