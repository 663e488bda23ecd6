"""Columns by name, where names may hold dots as vocabulary keys do."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cols(names: Iterable[str]) -> list[Column]:
    return [F.col(quoted(name)) for name in names]


def field(struct: str, name: str) -> Column:
    """A field of a struct column, under its own name."""
    return F.col(f"{struct}.{quoted(name)}").alias(name)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str) -> DataFrame:
    """Join on ``keys`` where null equals null; the keys come from the left side."""
    keys = list(keys)
    other = {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(other)
    on = [F.col(quoted(k)).eqNullSafe(F.col(quoted(other[k]))) for k in keys]
    return left.join(right, on, how).drop(*other.values())
