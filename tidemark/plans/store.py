"""The change store: an append-only change log on plain Parquet.

Layout under the root::

    _state/00000001.json       schema, generation and compaction marks; highest number wins
    _batches/{source}/         manifest: content and outcome of every batch of a source
    changes-{generation}/stream_id=…/source=…/batch_id=…/
    rejected/batch_id=…/       changes that did not fit their stream
    known_keys/batch_id=…/     keys each stream was opened with
    closed/                    streams archived after a batch: their keys and rejects no longer count
    versions/                  materialised history, on demand
    archive/{stream}_{time}/   archived streams
    ledger/                    export history entries

Batches are numbered per source. The manifest holds a digest of each batch's content: a batch
that was committed isn't written again, one that was interrupted is written anew, and other
content under a known number is an error. A change is stored with the columns that its batch
gave it, so that a column it lacks keeps its earlier value. One writer per store.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import cols, quoted
from tidemark.operators.envelope import known_keys, schema_guard
from tidemark.operators import temporal
from tidemark.operators.ledger import LEDGER_COLUMNS, LEDGER_SCHEMA, ledger_state
from tidemark.operators.ordered import with_slices
from tidemark.operators.patches import SET, completed
from tidemark.operators.versions import OPEN_END, versions
from tidemark.sources import files
from tidemark.sources.change_logs import KEY, LOG_COLUMNS, ORDER

STRICT, EVOLVE = "strict", "evolve"


#: The source of batches that name none.
MAIN = "main"
#: Beside the columns of the log: what the change sets (null: all there were) and how many columns there were.
_OWN = (T.StructField(SET, T.ArrayType(T.StringType())), T.StructField("known", T.IntegerType()))
_PLACE = (T.StructField("source", T.StringType()), T.StructField("batch_id", T.LongType()))


@dataclass(frozen=True)
class StoreState:
    schema: T.StructType
    generation: int = 0
    #: Per source: batches up to here were merged; delivering them again changes nothing.
    compacted_to: dict[str, int] = field(default_factory=dict)
    #: Whether some change doesn't set all columns.
    partial: bool = False


def digest(batch: DataFrame) -> dict:
    """What a batch holds, whatever the order of its rows: their number and two sums of their hashes."""
    columns = sorted(batch.schema.fields, key=lambda f: f.name)

    def value(f: T.StructField) -> Column:
        column = F.col(quoted(f.name))
        if isinstance(f.dataType, T.MapType) and "map<" not in f.dataType.valueType.simpleString():
            return F.array_sort(F.map_entries(column))
        # maps inside have no hash
        return F.to_json(F.struct(column)) if "map<" in f.dataType.simpleString() else column

    key = F.xxhash64(F.lit(",".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)), *map(value, columns))
    both = batch.select(key.alias("h")).agg(F.count("*"), F.bit_xor("h"), F.sum(F.pmod("h", F.lit((1 << 31) - 1)))).first()
    return {"rows": both[0], "xor": both[1] or 0, "sum": both[2] or 0}


class ChangeStore:
    def __init__(self, spark: SparkSession, path: str, mode: str = STRICT):
        self.spark, self.path, self.mode = spark, path.rstrip("/"), mode

    # State -------------------------------------------------------------------

    def state(self) -> StoreState | None:
        numbers = files.names(self.spark, f"{self.path}/_state")
        if not numbers:
            return None
        raw = files.read_json(self.spark, f"{self.path}/_state/{numbers[-1]}")
        schema = T.StructType.fromJson(raw["schema"])
        return StoreState(schema, raw["generation"], raw["compacted_to"], raw["partial"])

    def _save(self, state: StoreState) -> StoreState:
        numbers = files.names(self.spark, f"{self.path}/_state")
        number = int(numbers[-1].split(".")[0]) + 1 if numbers else 1
        text = json.dumps(
            {
                "schema": state.schema.jsonValue(),
                "generation": state.generation,
                "compacted_to": state.compacted_to,
                "partial": state.partial,
            }
        )
        target = f"{self.path}/_state/{number:08d}.json"
        files.write_text(self.spark, f"{self.path}/_writing.json", text)
        files.rename(self.spark, f"{self.path}/_writing.json", target)
        return state

    def _changes(self, generation: int) -> str:
        return f"{self.path}/changes-{generation}"

    def _agree(self, batch: DataFrame) -> StoreState:
        """The state whose schema holds the batch; the first batch sets it."""
        state = self.state()
        given = [f for f in batch.schema.fields if f.name != SET]
        if state is None:
            fields = [T.StructField(f.name, f.dataType, True) for f in given]
            return self._save(StoreState(T.StructType(fields), partial=SET in batch.columns))
        known = {f.name.lower() for f in state.schema.fields}
        new = [f for f in given if f.name.lower() not in known]
        if new and self.mode == STRICT:
            raise ValueError(f"Unknown columns: {', '.join(f.name for f in new)}")
        grown = T.StructType([*state.schema.fields, *(T.StructField(f.name, f.dataType, True) for f in new)])
        partial = state.partial or bool(new) or len(given) < len(grown) or SET in batch.columns
        agreed = replace(state, schema=grown, partial=partial)
        return state if agreed == state else self._save(agreed)

    # Batches -----------------------------------------------------------------

    def _entry(self, source: str, batch_id: int, outcome: str) -> str:
        return f"{self.path}/_batches/{quote(source, safe='')}/{batch_id:020d}.{outcome}.json"

    def _note(self, source: str, batch_id: int, outcome: str, digest: dict) -> None:
        writing = f"{self.path}/_writing-batch.json"
        files.write_text(self.spark, writing, json.dumps(digest))
        files.rename(self.spark, writing, self._entry(source, batch_id, outcome))

    def batches(self, source: str = MAIN) -> list[int]:
        """The committed batches of a source."""
        found = files.names(self.spark, f"{self.path}/_batches/{quote(source, safe='')}")
        return [int(n.split(".")[0]) for n in found if n.endswith(".committed.json")]

    def sources(self) -> list[str]:
        return [unquote(n) for n in files.names(self.spark, f"{self.path}/_batches")]

    # Changes -----------------------------------------------------------------

    def append(self, batch: DataFrame, batch_id: int, source: str = MAIN) -> None:
        """Add the changes of a batch of a source.

        Columns of the store that the batch lacks keep their earlier values, as do those that a
        row doesn't name in its ``set_columns``, if the batch has that array. A batch may be
        delivered again with the same content, also after it was compacted; other content under
        its number is an error.
        """
        state = self._agree(batch)
        if batch_id <= state.compacted_to.get(source, -1):
            unknown = batch.join(self.log(), ["stream_id", "id", *ORDER], "left_anti")
            if not unknown.isEmpty():
                raise ValueError(f"Batch {batch_id} of {source} is compacted (up to {state.compacted_to[source]}) and holds new changes")
            return
        content = digest(batch)
        begun = files.read_json(self.spark, self._entry(source, batch_id, "begun"))
        if begun is None:
            self._note(source, batch_id, "begun", content)
        elif begun != content:
            raise ValueError(f"Batch {batch_id} of {source} was delivered with other content")
        elif files.exists(self.spark, self._entry(source, batch_id, "committed")):
            return
        present = {c.lower() for c in batch.columns}
        columns = [
            F.col(quoted(f.name)).cast(f.dataType).alias(f.name)
            if f.name.lower() in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in state.schema.fields
        ]
        given = [f.name for f in state.schema.fields if f.name.lower() in present and f.name not in LOG_COLUMNS]
        every = F.array(*map(F.lit, given)).cast("array<string>")
        whole = len(columns) == len([c for c in batch.columns if c != SET])
        own = F.lit(None).cast("array<string>") if whole else every
        if SET in batch.columns:
            own = F.coalesce(F.array_intersect(F.col(SET), every), own)
        rows = batch.select(*columns, own.alias(SET), F.lit(len(columns)).alias("known"), F.lit(source).alias("source"), F.lit(batch_id).cast("bigint").alias("batch_id"))
        self._write_changes(rows, state.generation)
        self._note(source, batch_id, "committed", content)

    def _write_changes(self, rows: DataFrame, generation: int) -> None:
        """Files of a good size per stream: rebalancing splits large streams and joins small ones.

        Rows are sorted by entity, so that a lookup of one entity skips most row groups.
        """
        (
            rows.hint("rebalance", "stream_id")
            .sortWithinPartitions("stream_id", "source", "batch_id", "id", *ORDER)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("stream_id", "source", "batch_id")
            .parquet(self._changes(generation))
        )

    def stored(self) -> DataFrame:
        """Every change with the columns it sets, its source and its batch."""
        state = self.state()
        if state is None:
            raise ValueError(f"No changes at {self.path}")
        schema = T.StructType([*state.schema.fields, *_OWN, *_PLACE])
        path = self._changes(state.generation)
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).select(*cols(schema.names))

    def log(self, streams: Sequence[str] | None = None) -> DataFrame:
        """The changes as written, absent columns null; stream and column filters reach the scan."""
        rows = self.stored()
        log = rows.select(*cols(c for c in rows.columns if c not in (SET, "known", "source", "batch_id")))
        return log if streams is None else log.where(F.col("stream_id").isin(list(streams)))

    def patches(self, streams: Sequence[str] | None = None) -> DataFrame:
        """The changes for point-in-time questions: with ``set_columns`` if some don't set all columns."""
        state = self.state()
        if state is None or not state.partial:
            return self.log(streams)
        rows = self.stored()
        rows = rows if streams is None else rows.where(F.col("stream_id").isin(list(streams)))
        return rows.select(*cols(f.name for f in state.schema.fields), self.set_columns(state).alias(SET))

    def set_columns(self, state: StoreState) -> Column:
        """What a change sets. One from before the store grew doesn't set the columns that came later."""
        fields = [f.name for f in state.schema.fields]
        then = F.slice(F.array(*map(F.lit, fields)), F.lit(1), F.col("known"))
        return F.when(F.col(SET).isNull() & (F.col("known") < len(fields)), then).otherwise(F.col(SET))

    def whole_log(self, soft: bool = False, streams: Sequence[str] | None = None) -> DataFrame:
        """The changes as whole rows: a column that a change doesn't set has its earlier value."""
        log = self.patches(streams)
        return completed(log, soft) if SET in log.columns else log

    def snapshot(self, t: Column, soft: bool = False, streams: Sequence[str] | None = None) -> DataFrame:
        return temporal.snapshot(self.patches(streams), t, soft)

    def changes_since(self, t: Column, last: Column, soft: bool = False, streams: Sequence[str] | None = None) -> DataFrame:
        return temporal.changes_since(self.patches(streams), t, last, soft)

    def compact(self, batch_id: int, source: str = MAIN) -> None:
        """Merge the batches of a source up to ``batch_id`` into the files of a new generation.

        The old generation stays for readers that still use it.
        """
        state = self.state()
        merged = F.when(F.col("source") == source, F.greatest("batch_id", F.lit(batch_id).cast("bigint"))).otherwise(F.col("batch_id"))
        self._write_changes(self.stored().withColumn("batch_id", merged), state.generation + 1)
        marks = state.compacted_to | {source: max(batch_id, state.compacted_to.get(source, -1))}
        self._save(replace(state, generation=state.generation + 1, compacted_to=marks))

    # History -----------------------------------------------------------------

    def versions(self, soft: bool = False, streams: Sequence[str] | None = None) -> DataFrame:
        log = self.patches(streams)
        if SET not in log.columns:
            return versions(log, soft)
        # both windows take the cuts of the log as it was written, so it is completed once
        return versions(completed(with_slices(log, KEY, ORDER), soft, slice_rows=None), soft, slice_rows=None)

    def materialise_versions(self, soft: bool = False) -> None:
        """Write the history, open versions apart from closed ones."""
        ver = self.versions(soft).withColumn(
            "is_open", F.col("valid_to") == F.expr(f"TIMESTAMP_NTZ '{OPEN_END}'")
        )
        (
            ver.hint("rebalance", "is_open", "stream_id")
            .sortWithinPartitions("is_open", "stream_id", "id", "valid_from")
            .write.mode("overwrite")
            .partitionBy("is_open", "stream_id")
            .parquet(f"{self.path}/versions")
        )

    def materialised_versions(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/versions").drop("is_open")

    def archive(self, stream_id: str, now: str) -> str:
        """Move a stream aside under the time ``now`` (yyyyMMddHHmmss).

        Its keys and rejected changes so far are forgotten: its next change opens it anew.
        """
        state = self.state()
        guarded = [int(n.split("=")[1]) for n in files.names(self.spark, f"{self.path}/known_keys") if n.startswith("batch_id=")]
        if guarded:
            mark = self.spark.createDataFrame([(stream_id, max(guarded))], "stream_id string, after bigint")
            mark.coalesce(1).write.mode("append").parquet(f"{self.path}/closed")
        target = f"{self.path}/archive/{stream_id}_{now}"
        files.rename(self.spark, f"{self._changes(state.generation)}/stream_id={stream_id}", target)
        return target

    def archived(self, stream_id: str, now: str) -> DataFrame:
        """The changes of an archived stream."""
        state = self.state()
        fields = [f for f in state.schema.fields if f.name != "stream_id"]
        rows = self.spark.read.schema(T.StructType(fields)).parquet(
            f"{self.path}/archive/{stream_id}_{now}"
        )
        rows = rows.withColumn("stream_id", F.lit(stream_id))
        return rows.select(*cols(f.name for f in state.schema.fields))

    # Schema guard ------------------------------------------------------------

    def _still_open(self, rows: DataFrame, batch: Column) -> DataFrame:
        """``rows`` of a batch without those of streams that were archived after it."""
        path = f"{self.path}/closed"
        if not files.exists(self.spark, path):
            return rows
        closed = self.spark.read.parquet(path).groupBy("stream_id").agg(F.max("after").alias("after"))
        late = rows.select(*cols(rows.columns), batch.cast("bigint").alias("_batch")).alias("r")
        gone = (F.col("r.stream_id") == F.col("c.stream_id")) & (F.col("r._batch") <= F.col("c.after"))
        return late.join(closed.alias("c"), gone, "left_anti").drop("_batch")

    def known_keys(self, upto: int) -> DataFrame | None:
        """The keys of the streams opened by the batches before ``upto``."""
        path = f"{self.path}/known_keys"
        if not files.exists(self.spark, path):
            return None
        known = self.spark.read.parquet(path).where(F.col("batch_id") < upto)
        known = self._still_open(known, F.col("batch_id"))
        return known.groupBy("stream_id").agg(F.min_by("known_keys", "batch_id").alias("known_keys"))

    def guard(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """Changes that fit the keys of their stream, and changes that do not.

        A stream that is new in this batch is opened with the keys of its first change.
        """
        opened = known_keys(batch)
        earlier = self.known_keys(batch_id)
        if earlier is not None:
            opened = opened.join(earlier.select("stream_id"), "stream_id", "left_anti")
        path = f"{self.path}/known_keys/batch_id={batch_id}"
        opened.write.mode("overwrite").parquet(path)
        return schema_guard(batch, self.known_keys(batch_id + 1))

    def reject(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/rejected/batch_id={batch_id}")

    def rejected(self, batch_id: int | None = None) -> DataFrame | None:
        """Changes that wait to be tried again after a batch; the last batch unless named."""
        if batch_id is None:
            found = [n for n in files.names(self.spark, f"{self.path}/rejected") if n.startswith("batch_id=")]
            if not found:
                return None
            batch_id = max(int(n.split("=")[1]) for n in found)
        path = f"{self.path}/rejected/batch_id={batch_id}"
        if not files.exists(self.spark, path):
            return None
        return self._still_open(self.spark.read.parquet(path), F.lit(batch_id))

    # Ledger ------------------------------------------------------------------

    def record(self, entry: dict) -> None:
        """Append one ledger entry."""
        row = tuple(entry.get(c) for c in LEDGER_COLUMNS)
        one = self.spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1)
        one.write.mode("append").parquet(f"{self.path}/ledger")

    def record_all(self, entries: DataFrame) -> None:
        """Append many ledger entries at once; columns they lack are null."""
        empty = self.spark.createDataFrame([], LEDGER_SCHEMA)
        rows = empty.unionByName(entries, allowMissingColumns=True).select(*LEDGER_COLUMNS)
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")

    def history(self) -> DataFrame:
        """The export history: the state of each run."""
        path = f"{self.path}/ledger"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return ledger_state(self.spark.read.schema(LEDGER_SCHEMA).parquet(path))

