"""Running values over the ordered rows of each key, safe for very hot keys.

A plain window puts all rows of a key into one task. Here a key that holds more
than ``slice_rows`` rows is cut into slices of consecutive rows. Windows run per
(key, slice); what one slice must know of its neighbours is a single summary row
per slice, computed with ordinary partial aggregation and joined back on
(key, slice). The join reuses the partitioning and the order of the window, so a
log is shuffled once however hot its keys are.

Cut points come from a hash sample of bounded size. They only decide how rows are
spread over tasks; results are exact for any cut points.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import cols, null_safe_join
from tidemark.session import settle

#: Rows a key may hold before it is cut.
SLICE_ROWS = 2_000_000
#: Rows sampled from a log to place the cuts.
SAMPLE_ROWS = 1 << 20
#: Cuts over all keys; the broadcast table of cuts cannot hold more.
MAX_CUTS = 1 << 16

SLICE = "_slice"
#: Whether the key is cut. Windows and joins carry it, so that a filter on it can
#: pass below them to the scan; a filter on the slice would copy its search there.
HOT = "_hot"


@dataclass(frozen=True)
class Following:
    """The value on the next row of the key; null on the last row."""

    value: Column


@dataclass(frozen=True)
class Preceding:
    """The value on the previous row of the key; null on the first row."""

    value: Column


@dataclass(frozen=True)
class Latest:
    """The last non-null value up to and including the row."""

    value: Column


@dataclass(frozen=True)
class RunningSum:
    """The sum of the values up to and including the row."""

    value: Column


Running = Following | Preceding | Latest | RunningSum


def cut_points(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int = SLICE_ROWS
) -> DataFrame | None:
    """Sorted cut points of each key that is too large for one task, or None."""
    total = df.count()
    if total <= slice_rows:
        return None
    stride = max(1, total // SAMPLE_ROWS)
    per_cut = max(1, slice_rows // stride, math.ceil(total / stride / MAX_CUTS))
    sample = df.select(*keys, *order)
    if stride > 1:
        sample = sample.where(F.pmod(F.xxhash64(*keys, *order), F.lit(stride)) == 0)
    points = (
        sample.groupBy(*keys)
        .agg(F.collect_list(F.struct(*order)).alias("_points"))
        .where(F.size("_points") > per_cut)
    )
    cuts = points.select(
        *keys,
        F.filter(
            F.array_sort("_points"),
            lambda _, i: (i + 1) % F.lit(per_cut) == 0,
        ).alias("_cuts"),
    )
    return settle(cuts)


def with_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int | None = SLICE_ROWS
) -> DataFrame:
    """Number the slices of hot keys; a log without hot keys comes back unchanged.

    So does one that was looked at before (``slice_rows`` None): cuts are found by reading the log,
    which would run all that made it once more.
    """
    if slice_rows is None:
        return df
    cuts = cut_points(df, keys, order, slice_rows)
    most = None if cuts is None else cuts.agg(F.max(F.size("_cuts"))).first()[0]
    if most is None:
        return df
    here = F.struct(*order)
    rows = null_safe_join(df, F.broadcast(cuts), keys, "left").withColumn(SLICE, F.lit(0))
    # Binary search for the number of cuts at or before the row. One projection per
    # step keeps the search in generated code.
    for bit in reversed(range(most.bit_length())):
        probe = F.col(SLICE) + (1 << bit)
        beyond = F.get("_cuts", probe - 1) <= here
        rows = rows.withColumn(SLICE, F.when(beyond, probe).otherwise(F.col(SLICE)))
    return rows.select(*cols(df.columns), SLICE, F.col("_cuts").isNotNull().alias(HOT))


def slice_columns(df: DataFrame) -> list[str]:
    return [c for c in (SLICE, HOT) if c in df.columns]


def drop_slices(df: DataFrame) -> DataFrame:
    return df.drop(SLICE, HOT)


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Mapping[str, Running]
) -> DataFrame:
    """Add one column per spec; ``df`` may have been through :func:`with_slices`."""
    sliced = SLICE in df.columns
    window = Window.partitionBy(*keys, *([SLICE, HOT] if sliced else [])).orderBy(*order)
    local = {name: _within(spec, window) for name, spec in specs.items()}
    if not sliced:
        return df.select("*", *(value.alias(name) for name, value in local.items()))

    carried = _between(df.where(HOT), keys, order, specs)
    rows = df.select(
        "*",
        *(value.alias(name) for name, value in local.items()),
        F.lead(F.lit(True)).over(window).isNull().alias("_is_last"),
        F.lag(F.lit(True)).over(window).isNull().alias("_is_first"),
    )
    joined = null_safe_join(rows, carried, [*keys, SLICE, HOT], "left")
    return joined.select(
        *cols(df.columns),
        *(_combine(name, spec).alias(name) for name, spec in specs.items()),
    )


def _within(spec: Running, window) -> Column:
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    match spec:
        case Following(value):
            return F.lead(value).over(window)
        case Preceding(value):
            return F.lag(value).over(window)
        case Latest(value):
            return F.last(value, ignorenulls=True).over(so_far)
        case RunningSum(value):
            return F.sum(value).over(so_far)


def _between(
    hot: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Mapping[str, Running]
) -> DataFrame:
    """What each slice takes over from the slices around it: one row per slice."""
    position = F.struct(*order)

    def summary(spec: Running) -> Column:
        match spec:
            case Following(value):
                return F.min_by(value, position)
            case Preceding(value):
                return F.max_by(value, position)
            case Latest(value):
                return F.max_by(value, F.when(value.isNotNull(), position))
            case RunningSum(value):
                return F.sum(value)

    across = Window.partitionBy(*keys).orderBy(SLICE)
    before = across.rowsBetween(Window.unboundedPreceding, -1)

    def carry(name: str, spec: Running) -> Column:
        match spec:
            case Following():
                return F.lead(name).over(across)
            case Preceding():
                return F.lag(name).over(across)
            case Latest():
                return F.last(name, ignorenulls=True).over(before)
            case RunningSum():
                return F.sum(name).over(before)

    slices = hot.groupBy(*keys, SLICE, HOT).agg(
        *(summary(spec).alias(name) for name, spec in specs.items())
    )
    return settle(
        slices.select(
            *keys, SLICE, HOT, *(carry(name, spec).alias(f"_from_{name}") for name, spec in specs.items())
        )
    )


def _combine(name: str, spec: Running) -> Column:
    here, there = F.col(name), F.col(f"_from_{name}")
    match spec:
        case Following():
            return F.when(F.col("_is_last"), there).otherwise(here)
        case Preceding():
            return F.when(F.col("_is_first"), there).otherwise(here)
        case Latest():
            return F.coalesce(here, there)
        case RunningSum():
            return F.when(there.isNull(), here).when(here.isNull(), there).otherwise(here + there)
