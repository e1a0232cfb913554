"""Training batches: seeded order, length windows, greedy batches, padding, ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxframe.operators.packing import (
    LENGTH_WINDOW,
    RANKS,
    assign_ranks,
    budget_batches,
    epoch_order,
    field_lengths,
    padded,
)
from voxframe.operators.sampling import longest_first


def packed_epoch(
    df: DataFrame,
    key: str,
    lengths: Sequence[str],
    budget: int,
    seed: int,
    epoch: int = 0,
    window: int = LENGTH_WINDOW,
    ranks: int = RANKS,
    equal_steps: bool = False,
) -> DataFrame:
    """Batches of one epoch with their rank and step."""
    ordered = epoch_order(df.select(key, *lengths), key, seed, epoch)
    return assign_ranks(budget_batches(ordered, "ordinal", key, lengths, budget, window), ranks, equal_steps)


def padded_batches(batched: DataFrame, rows: str, length: str, arrays: Sequence[str], kept: Sequence[str] = ()) -> DataFrame:
    """Batches as parallel columns, longest row first: kept fields as lists, arrays padded with their lengths."""
    ordered = batched.withColumn("_rows", longest_first(F.col(rows), length))

    def listed(name: str) -> Column:
        return F.transform("_rows", lambda row: row[name]).alias(name)

    columns = [listed(name) for name in kept]
    for name in arrays:
        columns.append(padded(F.col("_rows"), name).alias(name))
        columns.append(field_lengths(F.col("_rows"), name).alias(f"{name}_len"))
    return ordered.select(*[c for c in batched.columns if c != rows], *columns)
