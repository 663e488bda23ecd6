"""Streams of changes into a store, documents or event batches.

Every flow writes under the id of its micro-batch, so a batch that is delivered
again after a failure replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import null_safe_join
from tidemark.operators.batches import BATCH_ROWS, IDLE_MILLIS, event_batches, idle_batches
from tidemark.plans.store import ChangeStore
from tidemark.sinks.documents import append_documents, read_event_batches, write_event_batches
from tidemark.sources import files


def _start(source: DataFrame, fold, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Process what is there and stop, or keep going at an interval."""
    writer = source.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def stream_sync(
    source: DataFrame, store: ChangeStore, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep a change store up to date.

    With a ``properties`` map, changes that do not fit the keys of their stream wait
    with the store and are tried again with the next batch.
    """
    guarded = "properties" in source.columns

    def fold(batch: DataFrame, batch_id: int) -> None:
        if not guarded:
            store.append(batch, batch_id)
            return
        waiting = store.rejected(batch_id - 1) if batch_id > 0 else None
        if waiting is not None:
            batch = batch.unionByName(waiting.select(*batch.columns))
        batch = batch.persist()
        fits, rejected = store.guard(batch, batch_id)
        store.append(fits, batch_id)
        store.reject(rejected, batch_id)
        batch.unpersist()

    return _start(source, fold, checkpoint, interval)


def stream_docs(
    source: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep the latest document of each entity; removals take documents away."""
    return _start(
        source, lambda batch, batch_id: append_documents(batch, path, batch_id), checkpoint, interval
    )


class EventStream:
    """Event batches of a stream: by count, or by idle time.

    The last batch of each target may still grow, so it waits in ``pending`` until it
    is full, falls idle, or is flushed. Less than one batch per target ever waits.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        target: Sequence[str],
        container: Column,
        n: int = BATCH_ROWS,
        idle_millis: int = IDLE_MILLIS,
        as_files: bool = False,
    ):
        self.spark, self.path, self.target, self.container = spark, path.rstrip("/"), list(target), container
        self.n, self.idle_millis, self.as_files = n, idle_millis, as_files

    def start(self, source: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
        return _start(source, self._fold, checkpoint, interval)

    def _pending(self, batch_id: int) -> DataFrame | None:
        path = f"{self.path}/pending/batch_id={batch_id}"
        return self.spark.read.parquet(path) if files.exists(self.spark, path) else None

    def _fold(self, batch: DataFrame, batch_id: int) -> None:
        waiting = self._pending(batch_id - 1) if batch_id > 0 else None
        rows = batch if waiting is None else batch.unionByName(waiting.select(*batch.columns))
        batched = idle_batches(rows, self.target, self.n, self.idle_millis).persist()
        group = [*self.target, "session", "batch"]
        sizes = batched.groupBy(*group).agg(F.count("*").alias("_items"), F.max("ts").alias("_end"))
        ends = sizes.groupBy(*self.target).agg(
            F.max(F.struct("session", "batch")).alias("_open"), F.max("_end").alias("_seen")
        )
        clock = sizes.agg(F.max("_end").alias("_now")).first()["_now"]
        if clock is None:
            self._write(batched, batch_id, None)
            batched.unpersist()
            return
        idle = F.timestamp_diff("MICROSECOND", F.col("_seen"), F.lit(clock)) >= self.idle_millis * 1000
        opened = (
            null_safe_join(sizes, ends.where(~idle), self.target, "inner")
            .where((F.struct("session", "batch") == F.col("_open")) & (F.col("_items") < self.n))
            .select(*group)
        )
        closed, waits = (null_safe_join(batched, opened, group, how) for how in ("left_anti", "left_semi"))
        self._write(closed, batch_id, waits)
        batched.unpersist()

    def _write(self, closed: DataFrame, batch_id: int, open_rows: DataFrame | None) -> None:
        done = event_batches(closed, self.target, self.container)
        target = f"{self.path}/events/batch_id={batch_id}"
        write_event_batches(done, target, self.as_files, mode="overwrite")
        if open_rows is not None:
            rows = open_rows.drop("session", "batch")
            rows.write.mode("overwrite").parquet(f"{self.path}/pending/batch_id={batch_id}")
        # Only the batch before this one is needed if this one is delivered again.
        files.delete(self.spark, f"{self.path}/pending/batch_id={batch_id - 2}")

    def flush(self) -> None:
        """Close the batches that still wait, as at a shutdown or before an archive."""
        found = [n.split("=")[1] for n in files.names(self.spark, f"{self.path}/events") if "=" in n]
        numbers = [int(n) for n in found if not n.endswith("-flush")]
        batch_id = max(numbers, default=-1)
        waiting = self._pending(batch_id)
        if waiting is None:
            return
        batched = idle_batches(waiting, self.target, self.n, self.idle_millis)
        done = event_batches(batched, self.target, self.container)
        target = f"{self.path}/events/batch_id={batch_id}-flush"
        write_event_batches(done, target, self.as_files, mode="overwrite")
        files.delete(self.spark, f"{self.path}/pending/batch_id={batch_id}")

    def batches(self) -> DataFrame:
        """File name and JSON array of every batch written."""
        return read_event_batches(self.spark, f"{self.path}/events", self.as_files)
