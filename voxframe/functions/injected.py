"""Hooks for callables the caller supplies: tokenizers, batch models, vector extractors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxframe.functions.text import words


def tokenizer(encode: Callable[[str], Sequence[int]]) -> Callable[[Column], Column]:
    """Column function from text to token ids for a Python ``encode``."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(text: pd.Series) -> pd.Series:
        return text.map(lambda s: list(encode(s)), na_action="ignore")

    return ids


def whitespace_tokens(text: Column) -> Column:
    """Built-in stand-in for a tokenizer: the length of each whitespace token."""
    return F.transform(words(text), lambda w: F.char_length(w))


def tokenized(
    df: DataFrame, encode: Callable[[Column], Column], text: str = "text", second: str | None = "instruct"
) -> DataFrame:
    """Add ``<column>_token`` for the text and, when present, for a second column."""
    out = df.withColumn(f"{text}_token", encode(F.col(text)))
    if second and second in df.columns:
        out = out.withColumn(f"{second}_token", encode(F.col(second)))
    return out


class OutOfMemory(RuntimeError):
    """Raised by a model that cannot hold a batch; the batch is halved and tried again."""


def score_halving(model: Callable[[list], list], items: list) -> list:
    """Model results for a batch; halves on :class:`OutOfMemory`, refuses results of another length."""
    try:
        results = list(model(items))
    except OutOfMemory:
        if len(items) == 1:
            raise
        middle = len(items) // 2
        return score_halving(model, items[:middle]) + score_halving(model, items[middle:])
    if len(results) != len(items):
        raise ValueError(f"the model returned {len(results)} results for {len(items)} items")
    return results


def batch_scores(
    df: DataFrame, model: Callable[[list], list], key: str, column: str, result: str, result_type: str, batch: int = 16
) -> DataFrame:
    """``(key, result)`` of a batched model, at most ``batch`` items at a time, inside the tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                yield pd.DataFrame({key: part[key].values, result: pd.Series(score_halving(model, list(part[column])), dtype=object)})

    selected = df.select(key, column)
    key_type = selected.schema[key].dataType.simpleString()
    return selected.mapInPandas(run, f"`{key}` {key_type}, `{result}` {result_type}")


def vector_extractor(extract: Callable[[object], Sequence[float]]) -> Callable[[Column], Column]:
    """Column function from a payload to a vector for a Python ``extract``."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def vectors(payload: pd.Series) -> pd.Series:
        return payload.map(lambda p: [float(v) for v in extract(p)], na_action="ignore")

    return vectors
