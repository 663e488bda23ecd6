"""Changes that set only some of their columns.

A log with a ``set_columns`` column (an array of payload names; null for all of them) holds
patches: a column that a change doesn't name keeps its earlier value, and a null that it names
overwrites. A hard delete forgets all values, a soft delete forgets none.

State and deltas are aggregations with one cell per (entity, column) and partial combine. History
carries each cell along in one window over the entity; what comes out is a log of whole rows, so
every operator on logs works on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import cols, quoted
from tidemark.operators.joins import join_lookup
from tidemark.operators.ordered import HOT, SLICE, SLICE_ROWS, Latest, Running, running, slice_columns, with_slices
from tidemark.operators.state import STAMPED, position
from tidemark.sources.change_logs import KEY, LOG_COLUMNS, ORDER, REMOVED, is_removed, payload_columns

SET = "set_columns"


def patched_columns(log: DataFrame) -> list[str]:
    return [c for c in payload_columns(log) if c not in (SET, SLICE, HOT)]


def sets(name: str) -> Column:
    """Whether a change sets a column."""
    return F.col(SET).isNull() | F.array_contains(SET, name)


def writes(name: str, soft: bool) -> Column:
    """Whether a change gives a column its value. A soft delete writes its stamp and nothing else."""
    return sets(name) if soft and name in STAMPED else sets(name) & ~is_removed()


def cells(log: DataFrame, soft: bool) -> dict[str, Running]:
    """The last value of each column up to a change, as a running value."""
    out: dict[str, Running] = {}
    for n, c in enumerate(patched_columns(log)):
        cell = F.when(writes(c, soft), F.struct(F.col(quoted(c)).alias("v")))
        if not soft:
            nothing = F.struct(F.lit(None).cast(log.schema[c].dataType).alias("v"))
            cell = F.when(is_removed(), nothing).otherwise(cell)
        out[f"_cell_{n}"] = Latest(cell)
    return out


def completed(log: DataFrame, soft: bool = False, slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """The log with whole rows: each change with the value of every column after it.

    A log that comes with its slices (``slice_rows`` None) keeps them, for the operator after this one.
    """
    payload = patched_columns(log)
    rows = running(with_slices(log, KEY, ORDER, slice_rows), KEY, ORDER, cells(log, soft))
    whole = [F.col(f"_cell_{n}.v").alias(c) for n, c in enumerate(payload)]
    kept = [] if slice_rows is not None else slice_columns(rows)
    return rows.select(*LOG_COLUMNS, *whole, *kept)


def patched_state(log: DataFrame, soft: bool = False) -> DataFrame:
    """:func:`tidemark.operators.state.current_state` of a log of patches."""
    payload = patched_columns(log)
    here = position()
    last = F.max_by(F.struct("change_type", *ORDER), here)
    values = [
        F.max_by(F.struct(F.col(quoted(c)).alias("v"), here.alias("at")), F.when(writes(c, soft), here)).alias(f"_cell_{n}")
        for n, c in enumerate(payload)
    ]
    gone = F.max(F.when(is_removed(), here))
    lived = F.max(F.when(~is_removed(), here))
    entity = log.groupBy(*KEY).agg(last.alias("last"), gone.alias("gone"), lived.alias("lived"), *values)
    entity = entity.where(F.col("lived").isNotNull() if soft else F.col("last.change_type") != REMOVED)

    def value(n: int, name: str) -> Column:
        cell = F.col(f"_cell_{n}")
        if soft:
            return cell["v"].alias(name)
        return F.when(F.col("gone").isNull() | (cell["at"] > F.col("gone")), cell["v"]).alias(name)

    return entity.select(*KEY, *(F.col(f"last.{c}").alias(c) for c in LOG_COLUMNS[2:]), *(value(n, c) for n, c in enumerate(payload)))


def patched_changes_since(log: DataFrame, t: Column, last: Column, soft: bool = False) -> DataFrame:
    """State at ``t`` of the entities that changed after ``last``.

    The entities are found first; only their changes reach the aggregation.
    """
    until = log.where(F.col("ts") <= t)
    touched = until.where(F.col("ts") > last).select(*KEY).distinct()
    return patched_state(join_lookup(until, touched, KEY, "left_semi"), soft)


def without_sets(log: DataFrame) -> DataFrame:
    """The log as it was written, absent columns null."""
    return log.select(*cols(c for c in log.columns if c != SET))
