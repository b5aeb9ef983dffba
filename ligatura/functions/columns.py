"""Small building blocks for column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Value = Column | str


def col(value: Value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strings(*values: str) -> Column:
    """An array of string literals, typed also when empty."""
    return F.array(*map(F.lit, values)).cast("array<string>")


def lookup(table: dict[str, str]) -> Column:
    """A literal map."""
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))


def among(value: Column, words: Iterable[str]) -> Column:
    return value.isin(list(words))


def non_empty(array: Column) -> Column:
    return F.filter(array, lambda x: x != "")


def split_words(value: Value, sep: str = " ") -> Column:
    """The non-empty parts of a delimited string; null is an empty array."""
    return non_empty(F.split(F.coalesce(col(value), F.lit("")), sep))


def joined(array: Column, sep: str = " ") -> Column:
    return F.array_join(array, sep)
