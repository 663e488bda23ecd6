"""Materialised history that grows by merging batches.

Layout under ``{store}/history-soft`` or ``history-hard``::

    _state/00000001.json    batches merged per source; highest number wins
    closed/merge=…/         versions that ended, written once
    heads/merge=…/          the last change of each entity that a merge touched, as a whole row
    rebuilt/merge=…/        entities whose closed versions of earlier merges no longer hold

A merge reads its new changes and the heads of their entities. Versions that the new changes end
are added to ``closed``, and their entities get new heads; no other file is read or written. A
change that comes before its entity's head is late: that entity's history is built anew from the
store, and ``rebuilt`` sets its earlier versions aside. A merge that fails is done again under its
number, and readers see merges that were committed. ``fold`` joins the files of many merges.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import cols, null_safe_join, quoted
from tidemark.functions.text import instant
from tidemark.operators.joins import join_lookup
from tidemark.operators.ordered import SLICE_ROWS, Following, Latest, drop_slices, running, with_slices
from tidemark.operators.patches import SET, cells, patched_columns
from tidemark.operators.state import STAMPED, position
from tidemark.operators.versions import OPEN_END
from tidemark.plans.store import ChangeStore
from tidemark.session import settle
from tidemark.sources import files
from tidemark.sources.change_logs import CHANGED, KEY, LOG_COLUMNS, ORDER, REMOVED, is_removed

#: Beside a head: whether its entity was ever there, for soft deletes.
LIVE = "_live"


class VersionHistory:
    def __init__(self, store: ChangeStore, soft: bool = False, slice_rows: int = SLICE_ROWS):
        self.store, self.soft, self.slice_rows = store, soft, slice_rows
        self.spark = store.spark
        self.name = f"history-{'soft' if soft else 'hard'}"
        folds = [int(n.rsplit("-", 1)[1]) for n in files.names(self.spark, store.path) if n.startswith(f"{self.name}-")]
        done = [n for n in folds if files.names(self.spark, f"{store.path}/{self.name}-{n}/_state")]
        self.path = f"{store.path}/{self.name}" + (f"-{max(done)}" if done else "")

    # State -------------------------------------------------------------------

    def _state(self) -> tuple[int, dict[str, list[int]]]:
        """The number of the last merge, and per source the last batch merged and how many were."""
        numbers = files.names(self.spark, f"{self.path}/_state")
        if not numbers:
            return 0, {}
        return int(numbers[-1].split(".")[0]), files.read_json(self.spark, f"{self.path}/_state/{numbers[-1]}")

    def _commit(self, number: int, marks: dict[str, list[int]]) -> None:
        files.write_text(self.spark, f"{self.path}/_writing.json", json.dumps(marks))
        files.rename(self.spark, f"{self.path}/_writing.json", f"{self.path}/_state/{number:08d}.json")

    def _read(self, part: str, schema: T.StructType, upto: int) -> DataFrame:
        schema = T.StructType([*schema.fields, T.StructField("merge", T.IntegerType())])
        path = f"{self.path}/{part}"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).where(F.col("merge") <= upto)

    def _write(self, rows: DataFrame, part: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{part}/merge={number}")

    def _payload(self) -> list[T.StructField]:
        return [f for f in self.store.state().schema.fields if f.name not in LOG_COLUMNS]

    def _fields(self, *names: str) -> list[T.StructField]:
        own = {f.name: f for f in self.store.state().schema.fields}
        return [own[n] for n in names]

    def _head_schema(self) -> T.StructType:
        return T.StructType([*self._fields(*LOG_COLUMNS), *self._payload(), T.StructField(LIVE, T.BooleanType())])

    def _closed_schema(self) -> T.StructType:
        times = [T.StructField(n, T.TimestampNTZType()) for n in ("valid_from", "valid_to")]
        return T.StructType([*self._fields(*KEY, "change_type"), *times, *self._fields("seq"), *self._payload()])

    # Merging -----------------------------------------------------------------

    def merge(self) -> int:
        """Take in the batches that the store committed since the last merge; its number.

        Batches of a source are merged in the order of their numbers; one that comes with a lower
        number than one merged before, or was compacted before it was merged, is an error. Merging
        nothing new gives the last number again.
        """
        number, marks = self._state()
        state = self.store.state()
        last = {s: own[0] for s, own in marks.items()}
        batches = {s: self.store.batches(s) for s in self.store.sources()}
        early = [s for s, (n, count) in marks.items() if sum(b <= n for b in batches[s]) != count]
        passed = [s for s, n in state.compacted_to.items() if number and n > last.get(s, -1)]
        if early or passed:
            raise ValueError(f"Sources with batches behind those merged: {early}; compacted before they were merged: {passed}")
        anew = {s: [max(own), len(own)] for s, own in batches.items() if own and max(own) > last.get(s, -1)}
        if not anew:
            return number
        fresh = F.lit(False)
        for source, (newest, _) in anew.items():
            fresh = fresh | ((F.col("source") == source) & (F.col("batch_id") > last.get(source, -1)) & (F.col("batch_id") <= newest))
        names = [f.name for f in state.schema.fields]
        log = self.store.stored().withColumn(SET, self.store.set_columns(state))
        new = log.where(fresh).select(*cols(names), SET)
        taken = fresh
        for source, (n, _) in marks.items():
            taken = taken | ((F.col("source") == source) & (F.col("batch_id") <= n))
        self._merge(new, log.where(taken).select(*cols(names), SET), number)
        self._commit(number + 1, marks | anew)
        return number + 1

    def _merge(self, new: DataFrame, log: DataFrame, number: int) -> None:
        spark, keys = self.spark, list(KEY)
        if not number:
            rows, rebuilt = self._ended(self._as_changes(log)), None
        else:
            touched = settle(self._touched(new, number))
            late = touched.where(F.col("_first") < position()).select(*keys)
            seeds = self._as_seeds(touched.where(F.col("_first") >= position()))
            if late.isEmpty():
                rows, rebuilt = self._ended(seeds.unionByName(self._as_changes(new))), None
            else:
                fresh = null_safe_join(self._as_changes(new), late, keys, "left_anti")
                again = join_lookup(self._as_changes(log), late, keys, "left_semi")
                rows, rebuilt = self._ended(seeds.unionByName(fresh).unionByName(again)), late
        # one write gives what ended and the heads, so the window runs once
        path = f"{self.path}/merging/merge={number + 1}"
        rows.withColumn("is_head", F.col("_next").isNull()).write.mode("overwrite").partitionBy("is_head").parquet(path)
        done = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("is_head", T.BooleanType())])).parquet(path)
        self._write(self._versions(done.where("not is_head")).hint("rebalance", "stream_id").sortWithinPartitions("stream_id", "id", "valid_from"), "closed", number + 1)
        self._write(done.where("is_head").select(*cols(self._head_schema().names)).hint("rebalance"), "heads", number + 1)
        if rebuilt is not None:
            self._write(rebuilt, "rebuilt", number + 1)
        else:
            files.delete(spark, f"{self.path}/rebuilt/merge={number + 1}")  # of an attempt that failed
        files.delete(spark, path)

    def _touched(self, new: DataFrame, number: int) -> DataFrame:
        """The heads of the entities of new changes, with the position of the first of these.

        One aggregation over heads and changes together, with partial combine: no join shuffles the
        heads again, and an entity without the one or the other ends in it.
        """
        heads = self._read("heads", self._head_schema(), number)
        names = [c for c in heads.columns if c not in (*KEY, "merge")]
        old = heads.select(*KEY, "merge", F.struct(*cols(names)).alias("head"), F.lit(None).cast(new.select(position()).schema[0].dataType).alias("first"))
        come = new.select(*KEY, F.lit(None).cast("int").alias("merge"), F.lit(None).cast(old.schema["head"].dataType).alias("head"), position().alias("first"))
        entity = old.unionByName(come).groupBy(*KEY).agg(F.max_by("head", "merge").alias("head"), F.min("first").alias("_first"))
        both = entity.where(F.col("head").isNotNull() & F.col("_first").isNotNull())
        return both.select(*KEY, *(F.col(f"head.{quoted(c)}").alias(c) for c in names), "_first")

    def _as_changes(self, log: DataFrame) -> DataFrame:
        return log.withColumns({"_was": F.lit(None).cast("string"), LIVE: ~is_removed()})

    def _as_seeds(self, heads: DataFrame) -> DataFrame:
        """Heads as the first changes of their entities: whole rows, alive if the entity was ever there."""
        heads = heads.select(*cols(self._head_schema().names))
        kind = F.when(F.col(LIVE), CHANGED).otherwise(F.col("change_type")) if self.soft else F.col("change_type")
        return heads.withColumn("_was", F.col("change_type")).withColumn("change_type", kind).withColumn(SET, F.lit(None).cast("array<string>"))

    def _ended(self, rows: DataFrame) -> DataFrame:
        """Each change as a whole row, with the time of the next one of its entity."""
        payload = [c for c in patched_columns(rows) if c not in ("_was", LIVE)]
        specs = {"_next": Following(F.col("ts")), "_lives": Latest(F.when(F.col(LIVE), F.lit(True)))}
        specs |= cells(rows.select(*LOG_COLUMNS, *cols(payload), SET), self.soft)
        rows = drop_slices(running(with_slices(rows, KEY, ORDER, self.slice_rows), KEY, ORDER, specs))
        whole = [F.col(f"_cell_{n}.v").alias(c) for n, c in enumerate(payload)]
        kind = F.coalesce("_was", "change_type").alias("change_type")
        return rows.select(*KEY, kind, *ORDER, *whole, F.coalesce("_lives", F.lit(False)).alias(LIVE), "_next")

    def _versions(self, rows: DataFrame, end: Column | None = None) -> DataFrame:
        rows = rows.where(F.col(LIVE) if self.soft else F.col("change_type") != REMOVED)
        valid_to = F.col("_next") if end is None else end
        return rows.select(*KEY, "change_type", F.col("ts").alias("valid_from"), valid_to.alias("valid_to"), "seq", *cols(f.name for f in self._payload()))

    # Reading -----------------------------------------------------------------

    def heads(self, upto: int | None = None) -> DataFrame:
        """The last change of each entity."""
        upto = self._state()[0] if upto is None else upto
        rows = self._read("heads", self._head_schema(), upto)
        names = [c for c in rows.columns if c not in (*KEY, "merge")]
        last = rows.groupBy(*KEY).agg(F.max_by(F.struct(*cols(names)), "merge").alias("head"))
        return last.select(*KEY, *(F.col(f"head.{quoted(c)}").alias(c) for c in names))

    def versions(self) -> DataFrame:
        """All versions, as :func:`tidemark.operators.versions.versions` gives them."""
        upto, _ = self._state()
        closed = self._read("closed", self._closed_schema(), upto)
        path = f"{self.path}/rebuilt"
        if files.exists(self.spark, path):
            rebuilt = self._read("rebuilt", T.StructType(self._fields(*KEY)), upto).groupBy(*KEY).agg(F.max("merge").alias("_since"))
            closed = null_safe_join(closed, rebuilt, KEY, "left").where(F.col("_since").isNull() | (F.col("merge") >= F.col("_since"))).drop("_since")
        opened = self._versions(self.heads(upto), instant(OPEN_END))
        names = self._closed_schema().names
        return closed.select(*cols(names)).unionByName(opened.select(*cols(names)))

    def fold(self) -> None:
        """Write the versions and heads of all merges as one, for readers of many small files.

        Files of earlier merges stay for readers that still use them.
        """
        number, marks = self._state()
        if not number:
            return
        heads, ver = self.heads(number), self.versions()
        folded = VersionHistory(self.store, self.soft, self.slice_rows)
        folded.path = f"{self.store.path}/{self.name}-{number}"
        folded._write(ver.where(F.col("valid_to") != instant(OPEN_END)), "closed", number)
        folded._write(heads, "heads", number)
        folded._commit(number, marks)
        self.path = folded.path
