"""Chat formatting by incremental rendering of a template that is a black box.

Successive turn prefixes of a conversation are rendered and consecutive outputs compared: what a turn adds is its span.
A template whose output for a prefix is no prefix of the next output rewrites history, and no span could be trusted, so
it is refused. Every prefix is rendered whole, from the first turn, since a template may remember any of them: the work
on one conversation grows with the square of its turns, and its task holds that conversation, but no other. After
``PREFIX`` turns every turn is also rendered from a later start; a template that does not give it the same output has a
longer memory and is refused too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

Turn = tuple[str, str]
Render = Callable[[list[Turn]], str]
PREFIX = 32
LEARNT_ROLE = "assistant"


class HistoryRewritten(ValueError):
    """The template changes the output of earlier turns."""


_CONTROL = re.compile(r"[\\<\[\]]")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """A text in which no control string begins; ``unescape`` gives it back."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def render(turns: list[Turn]) -> str:
    """The default template: instructions in brackets, answers closed by an end mark, other roles by name."""
    out = []
    for role, text in turns:
        if role == "user":
            out.append(f"<s>[INST] {escape(text)} [/INST]")
        elif role == LEARNT_ROLE:
            out.append(f" {escape(text)} </s>")
        else:
            out.append(f"[ROLE {escape(role)}] {escape(text)} [/ROLE]")
    return "".join(out)


#: How a turn of the default template reads: its role, and where its text is.
_PLAIN = r"[^\\<\[\]]*(?:\\.[^\\<\[\]]*)*"
_TURN = re.compile(rf"<s>\[INST\] (?P<user>{_PLAIN}) \[/INST\]| (?P<assistant>{_PLAIN}) </s>|\[ROLE (?P<role>{_PLAIN})\] (?P<text>{_PLAIN}) \[/ROLE\]", re.S)


def read_turn(piece: str) -> tuple[str, str, int, int]:
    """Role, text, and start and end of the escaped text, of one turn's output."""
    match = _TURN.fullmatch(piece)
    if match is None:
        raise ValueError("not the output of one turn")
    name = "text" if match["role"] is not None else "user" if match["user"] is not None else "assistant"
    role = unescape(match["role"]) if name == "text" else name
    return role, unescape(match[name]), *match.span(name)


def turn_outputs(turns: Iterable[Turn], template: Render, prefix: int = PREFIX) -> Iterator[str]:
    """What each turn adds to the output, found by comparing the renderings of successive prefixes, each of them whole."""
    held: list[Turn] = []
    before = ""
    for turn in turns:
        held.append(turn)
        now = template(held)
        if not now.startswith(before):
            raise HistoryRewritten("the output for a prefix of turns is no prefix of the whole output")
        last, before = now[len(before) :], now
        if len(held) > prefix:  # from a later start, the turn must read the same
            shorter = held[-prefix // 2 :]
            shown, upto = template(shorter), template(shorter[:-1])
            if not shown.startswith(upto) or shown[len(upto) :] != last:
                raise HistoryRewritten("a turn reads differently when the turns before it are fewer")
        yield last


def formatted(
    conversations: DataFrame, template: Render = render, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row for every turn, in order within a conversation: ``key, turn_index, start, piece``.

    ``piece`` is the turn's output and ``start`` its place in the conversation's, in code points; the output is the
    pieces end to end. Turns go by ``turn``, then role, then text, nulls first; repeated rows are turns of their own. A
    null role or text is empty; a null key is a conversation of its own. Other columns are not read. A conversation is
    put out turn by turn by one task, which holds that conversation's turns.
    """
    kind = conversations.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())

        out: list[list] = [[], [], [], []]
        size = 0
        for conversation, turns in _runs(rows()):
            start = 0
            for index, piece in enumerate(turn_outputs(turns, template)):
                for column, value in zip(out, (conversation, index, start, piece)):
                    column.append(value)
                start += len(piece)
                size += len(piece)
                if size > 1 << 22 or len(out[0]) >= 10_000:
                    yield _batch(out, batches_type)
                    out, size = [[], [], [], []], 0
        if out[0]:
            yield _batch(out, batches_type)

    batches_type = _key_type(conversations, key)
    order = [F.col(key).alias("key"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")]
    rows = conversations.select(*order, F.col(turn).alias("turn")).repartition("key").sortWithinPartitions("key", "turn", "role", "text")
    return rows.select("key", "role", "text").mapInArrow(run, f"key {kind}, turn_index long, start long, piece string").withColumnRenamed("key", key)


def _key_type(rows: DataFrame, key: str) -> pa.DataType:
    """Arrow type of a key of any type that has one."""
    return to_arrow_schema(rows.select(key).schema)[0].type


def _batch(out: list[list], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out[0], kind), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())], ["key", "turn_index", "start", "piece"])


def _runs(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[Turn]]]:
    """Consecutive rows of one key, each run read as it streams by."""
    pending = next(rows, None)
    while pending is not None:
        key = pending[0]

        def turns() -> Iterator[Turn]:
            nonlocal pending
            while pending is not None and pending[0] == key:
                yield pending[1], pending[2]
                pending = next(rows, None)

        run = turns()
        yield key, run
        for _ in run:  # what the reader left
            pass


def conversation_digests(pieces: DataFrame, key: str = "conv_id") -> DataFrame:
    """Counts and digests of each conversation, read back from the pieces of the default template.

    Reads the rows of ``formatted`` as they come, so nothing is shuffled again and no conversation is held whole.
    """
    kind = pieces.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    key_type = _key_type(pieces, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for conversation, index, start, piece in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    yield conversation, index, (start, piece)

        out: list[tuple] = []

        def table() -> pa.RecordBatch:
            columns = list(zip(*out))
            types = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for conversation, parts in _runs(rows()):
            said, learnt = hashlib.sha256(), hashlib.sha256()
            turns = loss = chars = 0
            for _, (start, piece) in parts:
                role, text, _, _ = read_turn(piece)
                said.update(f"{role}\n{text}\n".encode("utf-8"))
                if role == LEARNT_ROLE:  # the loss mask covers the text of this turn
                    learnt.update(text.encode("utf-8"))
                    loss += len(text)
                turns += 1
                chars = start + len(piece)
            out.append((conversation, turns, said.hexdigest(), loss, learnt.hexdigest(), chars))
            if len(out) >= 10_000:
                yield table()
                out.clear()
        if out:
            yield table()

    return pieces.select(key, "turn_index", "start", "piece").mapInArrow(run, schema)
