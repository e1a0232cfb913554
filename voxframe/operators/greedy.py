"""Greedy batches over a whole order: one sequence of decisions, taken on all parts of the order at once.

Where a batch ends depends only on where it starts. The order is cut into blocks of consecutive rows, and every block says
for each start inside it which batch is open at its end. Chains of batches soon run together, so that is a short list
whatever the start. The next block closes the open batches and says what is then open at its own end; batches that reach
over several blocks are handed on. The links between open batches form a small table, in which the batches that really
occur are found from the first by doubling, and a last pass over the blocks numbers the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxframe.session import materialize

BLOCK = 1 << 16


class _Block:
    """Lengths of consecutive rows, prepared for finding where batches end."""

    def __init__(self, lengths: np.ndarray, budget: int):
        self.lengths, self.budget = lengths, budget
        self.size = lengths.shape[1]
        # longest of each length over runs of 1, 2, 4, ... rows
        self.longest = [lengths]
        while 2 * (span := 1 << (len(self.longest) - 1)) <= self.size:
            last = self.longest[-1]
            self.longest.append(np.maximum(last[:, : last.shape[1] - span], last[:, span:]))

    def extend(self, at: np.ndarray, held: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Let open batches of ``held`` rows, with their ``most`` of each length, take rows from ``at`` on while they fit."""
        at, held, most = at.copy(), held.copy(), most.copy()
        for level in reversed(range(len(self.longest))):
            span = 1 << level
            inside = at + span <= self.size
            wider = np.maximum(most, self.longest[level][:, np.where(inside, at, 0)])
            fits = inside & ((held + span) * wider.sum(0) <= self.budget)
            at, held, most = at + span * fits, held + span * fits, np.where(fits, wider, most)
        return at, held, most

    def ends(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For a batch that starts at each row: the row that it stops before, its rows and its longest lengths."""
        starts = np.arange(self.size)
        return self.extend(starts + 1, np.ones(self.size, np.int64), self.lengths)

    def last_starts(self, ends: np.ndarray) -> np.ndarray:
        """For each row, the start of the batch that is open at the block's end if a batch starts at the row."""
        following = np.where(ends < self.size, np.minimum(ends, self.size - 1), np.arange(self.size))
        while True:
            further = following[following]
            if (further == following).all():
                return following
            following = further


def _arrays(row, lengths: Sequence[str], budget: int) -> _Block:
    return _Block(np.stack([np.asarray(row[f"_{i}"], np.int64) for i in range(len(lengths))]), budget)


def batch_numbers_over_order(df: DataFrame, ordinal: str, lengths: Sequence[str], budget: int, block: int = BLOCK) -> DataFrame:
    """``df`` with ``batch``: rows in the order of ``ordinal`` (0, 1, 2, ...) fill one batch after the other.

    A batch closes before ``rows * (sum of the longest of each length)`` would exceed the budget; a first row beyond it is
    a batch of its own. Lengths are whole numbers from 0; a null one counts as 0. A task holds one block of rows.
    """
    values = [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(f"_{i}") for i, c in enumerate(lengths)]
    rows = df.select(F.floor(F.col(ordinal) / block).cast("long").alias("_block"), F.col(ordinal).cast("long").alias("_at"), *values)
    packed = rows.groupBy("_block").agg(F.sort_array(F.collect_list(F.struct("_at", *[f"_{i}" for i in range(len(lengths))]))).alias("r"))
    packed = materialize(packed.select("_block", *[F.col(f"r._{i}").alias(f"_{i}") for i in range(len(lengths))]), "greedy-blocks")
    state = "origin long, at_block long, held long, most array<long>"

    def opened(row, starts: np.ndarray, held: np.ndarray, most: np.ndarray) -> pd.DataFrame:
        base = int(row["_block"]) * block
        return pd.DataFrame({"origin": base + starts, "at_block": int(row["_block"]) + 1, "held": held[starts], "most": [most[:, s].tolist() for s in starts]})

    def first_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                made = _arrays(row, lengths, budget)
                ends, held, most = made.ends()
                yield opened(row, np.unique(made.last_starts(ends)), held, most)

    def next_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Close open batches in the block they reach: ``entry`` is where the next one starts, null if still open."""
        for batch in batches:
            for _, row in batch.iterrows():
                made = _arrays(row, lengths, budget)
                last = made.last_starts(made.ends()[0])
                base = int(row["_block"]) * block
                held = np.array([o["held"] for o in row["open"]], np.int64)
                most = np.array([list(o["most"]) for o in row["open"]], np.int64).T.reshape(len(lengths), -1)
                at, held, most = made.extend(np.zeros(len(held), np.int64), held, most)
                for i, o in enumerate(row["open"]):
                    closed = at[i] < made.size
                    yield pd.DataFrame({
                        "origin": [o["origin"]], "at_block": [int(row["_block"]) + 1], "held": [held[i]], "most": [most[:, i].tolist()],
                        "entry": pd.array([base + at[i] if closed else None], "Int64"), "following": pd.array([base + last[at[i]] if closed else None], "Int64"),
                    })

    waiting = materialize(packed.mapInPandas(first_pass, state), "greedy-open")
    links: DataFrame | None = None
    while True:
        lists = waiting.groupBy(F.col("at_block").alias("_block")).agg(F.collect_list(F.struct("origin", "held", "most")).alias("open"))
        passed = materialize(packed.join(lists, "_block").mapInPandas(next_pass, state + ", entry long, following long"), "greedy-passed")
        closed = passed.where("entry IS NOT NULL").select("origin", "entry", "following")
        links = closed if links is None else links.unionByName(closed)
        waiting = passed.where("entry IS NULL").select("origin", "at_block", "held", "most")
        if not waiting.limit(1).count():
            break

    first = packed.where("_block = 0").mapInPandas(_first_open(lengths, budget), "origin long")
    reached, jumps, known = materialize(first, "greedy-reached"), materialize(links.select("origin", "following"), "greedy-jumps"), 0
    while (found := reached.count()) > known:
        known = found
        further = reached.join(jumps, "origin").select(F.col("following").alias("origin"))
        reached = materialize(reached.union(further).distinct(), "greedy-reached")
        second = jumps.select(F.col("origin").alias("following"), F.col("following").alias("further"))
        jumps = materialize(jumps.join(second, "following").select("origin", F.col("further").alias("following")), "greedy-jumps")
    entries = links.join(reached, "origin").select(F.floor(F.col("entry") / block).cast("long").alias("_block"), "entry")

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                made = _arrays(row, lengths, budget)
                ends = made.ends()[0]
                at = int(row["entry"]) - int(row["_block"]) * block if not pd.isna(row["entry"]) else made.size
                marks = np.zeros(made.size, np.int64)
                while at < made.size:
                    marks[at] = 1
                    at = int(ends[at])
                out.append({"_block": row["_block"], "_in_block": np.cumsum(marks).tolist()})
            yield pd.DataFrame(out)

    begun = F.when(F.col("_block") == 0, F.lit(0)).otherwise(F.col("entry")).alias("entry")  # the first batch starts the order
    placed = packed.join(entries, "_block", "left").select("_block", *[f"_{i}" for i in range(len(lengths))], begun)
    numbered = materialize(placed.mapInPandas(number, "_block long, _in_block array<long>"), "greedy-numbers")
    counts = numbered.select("_block", F.array_max("_in_block").alias("n"))
    # one row for each block, far fewer than rows
    before = counts.withColumn("_before", F.coalesce(F.sum("n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    places = numbered.join(before.select("_block", "_before"), "_block").select("_block", "_before", F.posexplode("_in_block").alias("_place", "_n"))
    places = places.select((F.col("_block") * block + F.col("_place")).alias("_at"), (F.col("_before") + F.col("_n") - 1).alias("batch"))
    return df.join(places, F.col(ordinal) == F.col("_at")).select(*df.columns, "batch")


def _first_open(lengths: Sequence[str], budget: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                made = _arrays(row, lengths, budget)
                yield pd.DataFrame({"origin": made.last_starts(made.ends()[0])[:1]})

    return run


def greedy_batches(df: DataFrame, ordinal: str, key: str, lengths: Sequence[str], budget: int, block: int = BLOCK) -> DataFrame:
    """One row per batch of :func:`batch_numbers_over_order`: ``batch``, ``n``, its padded size and its rows in order."""
    numbered = batch_numbers_over_order(df.select(ordinal, key, *lengths), ordinal, lengths, budget, block)
    size = sum((F.coalesce(F.max(c), F.lit(0)) for c in lengths), F.lit(0)) * F.count(F.lit(1))
    members = F.sort_array(F.collect_list(F.struct(ordinal, key, *lengths)))
    return numbered.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), size.alias("padded_size"), members.alias("rows"))
