"""Token rebatching: collect a key's tokens and hand them on in blocks of a fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# ---- fixed values -----------------------------------------------------------
TEXT_BLOCK = 5
# -----------------------------------------------------------------------------

_PROGRESS = T.StructType(
    [
        T.StructField("held", T.ArrayType(T.IntegerType())),  # tokens of the open block
        T.StructField("block", T.LongType()),  # its number
        T.StructField("wanted", T.LongType()),  # the next position in order
        T.StructField("last", T.LongType()),  # the final position, -1 while unknown
        T.StructField("ended", T.BooleanType()),
        T.StructField("timer", T.LongType()),  # -1 for none
    ]
)


class _Rebatch(StatefulProcessor):
    """Per key the open block, what is wanted next, and the chunks that came before their turn, by position."""

    def __init__(self, key: str, size: int, first: int, patience: int | None):
        self.key, self.size, self.first, self.patience = key, size, first, patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.progress = handle.getValueState("progress", _PROGRESS)
        position = T.StructType([T.StructField("position", T.LongType())])
        self.early = handle.getMapState("early", position, T.StructType([T.StructField("tokens", T.ArrayType(T.IntegerType()))]))

    def _load(self) -> None:
        stored = self.progress.get() if self.progress.exists() else ([], 0, self.first, -1, False, -1)
        self.held, self.block, self.wanted = [int(t) for t in stored[0]], int(stored[1]), int(stored[2])
        self.last, self.ended, self.timer = int(stored[3]), bool(stored[4]), int(stored[5])

    def _take(self, tokens, blocks: list[list[int]]) -> None:
        self.held += [int(t) for t in tokens if t is not None] if tokens is not None else []
        full = len(self.held) // self.size * self.size
        blocks += [self.held[i : i + self.size] for i in range(0, full, self.size)]
        self.held = self.held[full:]

    def _end(self, blocks: list[list[int]]) -> None:
        """Flush, and remember that the key has ended: what still comes is late."""
        if self.held:
            blocks.append(self.held)
        self.held, self.ended = [], True
        self.early.clear()

    def _rows(self, key, blocks: list[list[int]]) -> Iterator[pd.DataFrame]:
        if blocks:
            numbers = range(self.block, self.block + len(blocks))
            self.block += len(blocks)
            yield pd.DataFrame({self.key: key[0], "block": numbers, "tokens": blocks})

    def _store(self, wake: int | None) -> None:
        if wake is not None and wake > self.timer:
            if self.timer >= 0:
                self.handle.deleteTimer(self.timer)
            self.handle.registerTimer(wake)
            self.timer = wake
        self.progress.update((self.held, self.block, self.wanted, self.last, self.ended, self.timer))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._load()
        newest = None
        for arrived in rows:
            blocks: list[list[int]] = []
            if self.patience is not None:
                time = int(arrived["millis"].max())
                newest = time if newest is None else max(newest, time)
            arrived = arrived.sort_values("position", kind="stable")
            for position, tokens, final in zip(arrived["position"], arrived["tokens"], arrived["final"]):
                position = int(position)
                if self.ended or position < self.wanted:
                    continue  # late, or here already
                if final and (self.last < 0 or position < self.last):
                    self.last = position
                if position > self.wanted:
                    if not self.early.containsKey((position,)):
                        self.early.updateValue((position,), ([int(t) for t in tokens] if tokens is not None else [],))
                    continue
                self._take(tokens, blocks)
                self.wanted += 1
                while self.early.containsKey((self.wanted,)) and not 0 <= self.last < self.wanted:
                    self._take(self.early.getValue((self.wanted,))[0], blocks)
                    self.early.removeKey((self.wanted,))
                    self.wanted += 1
                if 0 <= self.last < self.wanted:
                    self._end(blocks)
            yield from self._rows(key, blocks)
        self._store(None if newest is None else newest + self.patience)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Nothing came for the key's patience: hand on what waits, gaps left out; a key that had ended is forgotten."""
        self._load()
        if expiredTimerInfo.getExpiryTimeInMs() != self.timer:
            return
        if self.ended:
            self.progress.clear()
            return
        blocks: list[list[int]] = []
        for position in sorted(int(p[0]) for p in self.early.keys()):
            if self.last < 0 or position <= self.last:
                self._take(self.early.getValue((position,))[0], blocks)
        self._end(blocks)
        yield from self._rows(key, blocks)
        self._store(expiredTimerInfo.getExpiryTimeInMs() + self.patience)

    def close(self) -> None:
        pass


def rebatched(
    stream: DataFrame, key: str, size: int = TEXT_BLOCK, first: int = 0, event_time: str | None = None, patience_seconds: int = 600
) -> DataFrame:
    """Blocks of ``size`` tokens per key from rows ``(key, position, tokens, final)`` that arrive in any order.

    Positions of a key are the whole numbers from ``first``. A chunk that comes before its turn waits in state, by its
    position, until the ones before it are there; a block goes out as soon as it is full. Once all positions up to the one
    marked final are there, the remainder goes out as a short block and the key has ended. Copies of a position that was
    taken and positions beyond the final one change nothing; null tokens are none.

    With ``event_time``, a column with a watermark, a key that gets nothing for ``patience_seconds`` of event time is
    flushed by a timer, what waits in order of position with the gaps left out; an ended key is forgotten as long after,
    and until then its late chunks are dropped. Without it a key waits for its missing positions for ever, and a mark of
    each ended key stays. Needs the RocksDB state store provider.
    """
    kind = stream.schema[key].dataType.simpleString()
    times = [] if event_time is None else [F.unix_millis(event_time).alias("millis"), event_time]
    rows = stream.select(key, F.col("position").cast("long").alias("position"), "tokens", F.coalesce("final", F.lit(False)).alias("final"), *times)
    processor = _Rebatch(key, size, first, None if event_time is None else patience_seconds * 1000)
    mode = "none" if event_time is None else "eventTime"
    return rows.groupBy(key).transformWithStateInPandas(processor, f"`{key}` {kind}, block bigint, tokens array<int>", "append", mode)


def rebatched_table(table: DataFrame, key: str, size: int = TEXT_BLOCK) -> DataFrame:
    """The same blocks from a finished table, without state: token positions are numbered and cut.

    A key's tokens are numbered across the cluster, so one long key does not fill a task.
    """
    from voxframe.operators.ordering import with_rank

    single = table.select(key, "position", F.posexplode("tokens").alias("at", "token"))
    ranked = with_rank(single, [key], "position", "at")
    block = F.floor(F.col("rank") / size)
    return (
        ranked.groupBy(key, block.alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("rank", "token"))).alias("_t"))
        .select(key, "block", F.col("_t.token").alias("tokens"))
    )
