"""Chain of named DataFrame stages declared as a list, as a configuration file would hold it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

Stage = Callable[..., DataFrame]


class StageRegistry:
    """Stages by name; ``chain`` applies a declared list with ``DataFrame.transform``."""

    def __init__(self) -> None:
        self._stages: dict[str, Stage] = {}

    def register(self, name: str, stage: Stage) -> StageRegistry:
        self._stages[name] = stage
        return self

    def chain(self, df: DataFrame, declared: Sequence[str | Mapping[str, Mapping]]) -> DataFrame:
        """Apply stages in order; an entry is a name, or a name with its arguments."""
        for entry in declared:
            name, arguments = (entry, {}) if isinstance(entry, str) else next(iter(entry.items()))
            if name not in self._stages:
                raise KeyError(f"unknown stage: {name}")
            df = df.transform(self._stages[name], **arguments)
        return df
