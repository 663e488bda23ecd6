"""Event batches: up to ``n`` changes of a target, closed early when it falls idle."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import cols
from tidemark.operators.ordered import (
    SLICE_ROWS,
    Latest,
    Preceding,
    RunningSum,
    drop_slices,
    running,
    with_slices,
)
from tidemark.sources.change_logs import ORDER

#: Default batch size and idle time of a target.
BATCH_ROWS = 50
IDLE_MILLIS = 60_000


def idle_batches(
    log: DataFrame,
    target: Sequence[str],
    n: int = BATCH_ROWS,
    idle_millis: int = IDLE_MILLIS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Number the idle-separated sessions of each target and the batches of a session.

    A change that follows the previous one by ``idle_millis`` or more starts a session.
    """
    rows = with_slices(log, target, ORDER, slice_rows)
    rows = running(rows, target, ORDER, {"_before": Preceding(F.col("ts"))})
    gap = F.timestamp_diff("MICROSECOND", F.col("_before"), F.col("ts"))
    starts = F.col("_before").isNull() | (gap >= idle_millis * 1000)
    rows = running(
        rows.withColumn("_starts", starts.cast("bigint")),
        target,
        ORDER,
        {"session": RunningSum(F.col("_starts")), "_row": RunningSum(F.lit(1).cast("bigint"))},
    )
    first = Latest(F.when(F.col("_starts") == 1, F.col("_row")))
    rows = running(rows, target, ORDER, {"_first": first})
    batch = F.floor((F.col("_row") - F.col("_first")) / F.lit(n)).alias("batch")
    return drop_slices(rows).select(*cols(log.columns), "session", batch)


def event_document(columns: Iterable[str]) -> Column:
    """A change as it stands in a batch: all its columns, the type of the change last."""
    rest = cols(c for c in columns if c != "change_type")
    return F.to_json(F.struct(*rest, F.col("change_type").alias("ChangeType")), {"ignoreNullFields": "false"})


def batch_name(container: Column, flushed_at: Column) -> Column:
    """The file name of a batch: its container and its latest time."""
    return F.concat(container, F.lit("."), F.date_format(flushed_at, "yyyy-MM-dd HH-mm-ss.SSSSSSS"), F.lit(".json"))


def event_batches(batched: DataFrame, target: Sequence[str], container: Column) -> DataFrame:
    """One row per batch: its file name, number of items and JSON array.

    A batch holds at most ``n`` items, so what is gathered stays small.
    """
    document = event_document(c for c in batched.columns if c not in ("session", "batch"))
    items = batched.select(
        *target, "session", "batch", container.alias("container"), "ts",
        F.struct(*ORDER, document.alias("document")).alias("item"),
    )
    grouped = items.groupBy(*target, "session", "batch").agg(
        F.max("container").alias("container"),
        F.max("ts").alias("flushed_at"),
        F.count("*").alias("items"),
        F.array_sort(F.collect_list("item")).alias("all"),
    )
    documents = F.transform("all", lambda item: item["document"])
    return grouped.select(
        *target,
        "session",
        "batch",
        batch_name(F.col("container"), F.col("flushed_at")).alias("file_name"),
        "items",
        F.concat(F.lit("["), F.array_join(documents, ","), F.lit("]")).alias("content"),
    )
