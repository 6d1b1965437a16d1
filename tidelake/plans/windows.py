"""Incremental windows over a cursor column: the lower bound is exclusive unless told otherwise, the upper inclusive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column


@dataclass(frozen=True)
class Window:
    """A cursor without a value is a first run: everything."""

    cursor: str | None = None
    value: str | None = None
    upper: str | None = None
    inclusive: bool = False

    def __post_init__(self):
        if self.upper is not None and (self.cursor is None or self.value is None):
            raise ValueError("an upper bound needs a cursor and a lower bound")

    def bounds(self) -> list[tuple[str, str, str]]:
        """(column, comparison, value) of each side."""
        if self.cursor is None or self.value is None:
            return []
        lower = (self.cursor, ">=" if self.inclusive else ">", self.value)
        return [lower] + ([(self.cursor, "<=", self.upper)] if self.upper is not None else [])

    def sql(self, relation: str) -> str:
        """The window as SQL text over a relation; the relation itself on a first run."""
        if not (parts := self.bounds()):
            return relation
        quoted = [f'"{c.replace(chr(34), chr(34) * 2)}" {op} {literal(v)}' for c, op, v in parts]
        return f"(select * from {relation} where {' and '.join(quoted)})"


def literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def compare(column: Column, op: str, value: Column) -> Column:
    return {">": column > value, ">=": column >= value, "<=": column <= value, "<": column < value, "=": column == value}[op]
