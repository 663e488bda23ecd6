"""Scheduled exports replayed over a versions table.

The instants are ``lo, lo + step, …`` up to ``hi``. Each version works out for itself
which instants it belongs to, so there is no join with the instants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import cols
from tidemark.functions.schedule import seconds
from tidemark.functions.text import instant
from tidemark.operators.temporal import PERIOD


def _step_at_or_after(ts: Column, lo: str, step: int) -> Column:
    """Number of the first instant at or after ``ts``, not below zero."""
    micros = F.timestamp_diff("MICROSECOND", instant(lo), ts)
    return F.greatest(F.lit(0).cast("bigint"), F.expr("-1") * F.floor(-micros / F.lit(step * 1_000_000)))


def _instant_number(number: Column, lo: str, step: int) -> Column:
    return instant(lo) + F.make_dt_interval(secs=(number * step).cast("decimal(18,6)"))


def _steps(lo: str, hi: str, step: int) -> Column:
    return F.floor(F.timestamp_diff("SECOND", instant(lo), instant(hi)) / F.lit(step))


def _first_and_last(lo: str, hi: str, step: int) -> tuple[Column, Column]:
    """Numbers of the first and the last instant a version is visible at."""
    first = _step_at_or_after(F.col("valid_from"), lo, step)
    end = F.least(F.col("valid_to"), instant(hi) + seconds(step))
    return first, F.least(_step_at_or_after(end, lo, step) - 1, _steps(lo, hi, step))


def snapshot_series(ver: DataFrame, step: int, lo: str, hi: str) -> DataFrame:
    """The snapshot at each instant, one row per (instant, entity)."""
    first, last = _first_and_last(lo, hi, step)
    numbered = ver.withColumn("_first", first).withColumn("_last", last)
    numbered = numbered.where(F.col("_first") <= F.col("_last"))
    each = numbered.withColumn("_n", F.explode(F.sequence("_first", "_last")))
    return each.select(
        _instant_number(F.col("_n"), lo, step).alias("instant"),
        *cols(c for c in ver.columns if c not in PERIOD),
    )


def snapshot_counts(ver: DataFrame, step: int, lo: str, hi: str) -> DataFrame:
    """Rows of the snapshot at each instant, per stream.

    A version adds one at its first instant and takes it back after its last, so no row
    is repeated per instant; a window then runs over one row per stream and instant.
    """
    first, last = _first_and_last(lo, hi, step)
    edges = ver.select("stream_id", first.alias("_first"), last.alias("_last"))
    edges = edges.where(F.col("_first") <= F.col("_last")).select(
        "stream_id",
        F.inline(
            F.array(
                F.struct(F.col("_first").alias("_n"), F.lit(1).cast("bigint").alias("_add")),
                F.struct((F.col("_last") + 1).alias("_n"), F.lit(-1).cast("bigint").alias("_add")),
            )
        ),
    )
    changes = edges.groupBy("stream_id", "_n").agg(F.sum("_add").alias("_add"))
    by_instant = Window.partitionBy("stream_id").orderBy("_n")
    until = F.coalesce(F.lead("_n").over(by_instant) - 1, _steps(lo, hi, step))
    counted = changes.select(
        "stream_id", "_n", F.sum("_add").over(by_instant).alias("row_count"), until.alias("_until")
    ).where((F.col("row_count") > 0) & (F.col("_n") <= F.col("_until")))
    each = counted.withColumn("_n", F.explode(F.sequence("_n", "_until")))
    return each.select(_instant_number(F.col("_n"), lo, step).alias("instant"), "stream_id", "row_count")


def delta_series(ver: DataFrame, step: int, lo: str, hi: str) -> DataFrame:
    """The delta between consecutive instants: a version belongs to at most one.

    The first instant is an initial export, so it carries its full snapshot.
    """
    number = _step_at_or_after(F.col("valid_from"), lo, step)
    placed = ver.where(F.col("valid_from") <= instant(hi)).withColumn("_n", number)
    placed = placed.where(F.col("_n") <= _steps(lo, hi, step))
    placed = placed.withColumn("instant", _instant_number(F.col("_n"), lo, step))
    return placed.where(F.col("instant") < F.col("valid_to")).select(
        "instant", *cols(c for c in ver.columns if c not in PERIOD)
    )


def delta_counts(ver: DataFrame, step: int, lo: str, hi: str) -> DataFrame:
    """Rows each scheduled delta carries, per stream."""
    rows = delta_series(ver, step, lo, hi)
    return rows.groupBy("stream_id", "instant").agg(F.count("*").alias("total_rows"))
