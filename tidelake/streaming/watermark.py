"""High-water marks of incremental runs, advanced only to what a run has written, and only upward."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.windows import Window
from ..sources.files import files_of


class Seen:
    """The greatest cursor of a frame's rows, observed by the very write that stores them: a live source may have more by the time it is asked again."""

    def __init__(self, df: DataFrame, cursor: str):
        self.seen = Observation()
        self.numeric = isinstance(df.schema[cursor].dataType, T.NumericType)
        self.df = df.observe(self.seen, F.max(F.col(f"`{cursor}`")).cast("string").alias("top"))

    @property
    def top(self) -> str | None:
        """Known once `df` has been written; None without a row."""
        return self.seen.get["top"]


class WatermarkStore:
    """Marks by name, a new file for each advance, so that a reader never sees half of one and of two racing runs one wins."""

    def __init__(self, spark: SparkSession, root: str):
        self.files = files_of(spark, root)

    def _versions(self, name: str) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(name) if n.endswith(".json") and n[:-5].isdigit()]

    def get(self, name: str) -> str | None:
        have = self._versions(name)
        return json.loads(self.files.read(f"{name}/{max(have):012d}.json"))["value"] if have else None

    def put(self, name: str, value: str) -> bool:
        """False if another run came first."""
        return self.files.claim(f"{name}/{max(self._versions(name), default=-1) + 1:012d}.json", json.dumps({"value": value}))

    def window(self, name: str, cursor: str, upper: str | None = None, inclusive: bool = False) -> Window:
        """The next window of a run; without a mark yet it is everything."""
        value = self.get(name)
        return Window(cursor, value, upper if value is not None else None, inclusive)

    def advance(self, name: str, seen: Seen) -> str | None:
        """Raise the mark to what was written, and return it. An empty run leaves it, and so does one that others have passed."""
        top = seen.top
        order = Decimal if seen.numeric else str.encode
        while top is not None:
            now = self.get(name)
            if now is not None and order(now) >= order(top):
                return now
            if self.put(name, top):
                return top
        return self.get(name)
