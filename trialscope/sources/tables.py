"""A lazy collection of canonical tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Tables(Mapping[str, DataFrame]):
    """Maps table names to DataFrames; a builder runs the first time its table is used."""

    def __init__(self, builders: Mapping[str, Callable[["Tables"], DataFrame] | DataFrame]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            builder = self._builders[name]
            self._built[name] = builder if isinstance(builder, DataFrame) else builder(self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def replacing(self, **frames: DataFrame) -> "Tables":
        """A copy in which some tables are swapped for the given frames."""
        return Tables({**self._builders, **frames})
