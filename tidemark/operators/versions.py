"""System-versioned history: one row per version, valid in ``[valid_from, valid_to)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted
from tidemark.functions.text import instant
from tidemark.operators.ordered import HOT, SLICE, SLICE_ROWS, Following, Latest, running, with_slices
from tidemark.operators.state import STAMPED
from tidemark.sources.change_logs import KEY, ORDER, is_removed, payload_columns

#: Fixed value: the end of a version that is still open.
OPEN_END = "9999-12-31 00:00:00"


def versions(log: DataFrame, soft: bool = False, slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """Every version of every entity.

    Each change closes the version before it. A hard delete opens nothing; a soft
    delete opens a version that keeps the last live payload. Changes at the same time
    give versions of zero length, which no point in time can see.
    """
    payload = [c for c in payload_columns(log) if c not in (SLICE, HOT)]
    kept = [c for c in payload if c not in STAMPED] if soft else []
    specs = {"_next": Following(F.col("ts"))}
    if soft:
        specs["_live"] = Latest(F.when(~is_removed(), F.lit(True)))
        for n, c in enumerate(kept):
            specs[f"_kept_{n}"] = Latest(F.when(~is_removed(), F.struct(F.col(quoted(c)).alias("v"))))
    rows = running(with_slices(log, KEY, ORDER, slice_rows), KEY, ORDER, specs)
    rows = rows.where(F.col("_live") if soft else ~is_removed())
    return rows.select(
        *KEY,
        "change_type",
        F.col("ts").alias("valid_from"),
        F.coalesce("_next", instant(OPEN_END)).alias("valid_to"),
        "seq",
        *(
            F.col(f"_kept_{kept.index(c)}.v").alias(c) if c in kept else F.col(quoted(c))
            for c in payload
        ),
    )


def patch_versions(
    log: DataFrame,
    keys: Sequence[str],
    soft: bool = False,
    properties: str = "properties",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Every version when a change sets only the keys it carries: one column per key.

    A key keeps its value from change to change; a hard delete clears all keys.
    """
    specs = {
        "_next": Following(F.col("ts")),
        "_live": Latest(F.when(~is_removed(), F.lit(True))),
    }
    for n, key in enumerate(keys):
        written = F.struct(F.col(properties)[key].alias("v"))
        cell = F.when(~is_removed() & F.map_contains_key(properties, key), written)
        if not soft:
            cell = F.when(is_removed(), F.struct(F.lit(None).cast("string").alias("v"))).otherwise(cell)
        specs[f"_key_{n}"] = Latest(cell)
    rows = running(with_slices(log, KEY, ORDER, slice_rows), KEY, ORDER, specs)
    rows = rows.where(F.col("_live") if soft else ~is_removed())
    return rows.select(
        *KEY,
        "change_type",
        F.col("ts").alias("valid_from"),
        F.coalesce("_next", instant(OPEN_END)).alias("valid_to"),
        "seq",
        *(F.col(f"_key_{n}.v").alias(key) for n, key in enumerate(keys)),
    )


def current_versions(ver: DataFrame) -> DataFrame:
    """The versions still open."""
    return ver.where(F.col("valid_to") == instant(OPEN_END))
