"""Joins of large logs with small lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

#: Largest lookup table that is sent to every executor.
BROADCAST_ROWS = 100_000


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    few_keys: bool = False,
) -> DataFrame:
    """Join with a lookup table that is broadcast only if it was counted to be small.

    A larger table takes a shuffled join, where adaptive execution splits the
    partitions of hot keys. Where the rows are many but their keys are few (``few_keys``), a larger
    table is first cut to the keys that occur: a shuffle would give each key's rows to few tasks.
    """
    lookup = settle(lookup)
    if few_keys and lookup.count() > max_rows:
        lookup = settle(lookup.join(rows.select(*on).distinct(), list(on), "left_semi"))
    if lookup.count() <= max_rows:
        lookup = F.broadcast(lookup)
    return rows.join(lookup, list(on), how)
