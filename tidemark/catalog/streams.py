"""Streaming queries (group I): each runs its flow over the whole table and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog.entities import _KEYED
from tidemark.catalog.exports import _BATCH_FILES, HOUR_MILLIS, IDLE_SQL, batch_summary
from tidemark.catalog.history import EV_COLS, _LAST, _version_sql, period_text
from tidemark.catalog.sql import EVENTS, hard_versions
from tidemark.plans.store import ChangeStore
from tidemark.session import scratch_path
from tidemark.sinks.documents import read_documents
from tidemark.sources.change_logs import as_events_log, table
from tidemark.sources.entities import as_order_entities
from tidemark.streaming.flows import EventStream, stream_docs, stream_sync


def _stream(spark, folder, name):
    """A table as a file stream."""
    schema = table(spark, folder, name).schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return source.parquet(folder)


def _finish(running) -> None:
    running.awaitTermination()


@query("i2_event_stream", f"WITH {EVENTS}, {IDLE_SQL} {_BATCH_FILES}")
def i2_event_stream(spark, folder):
    """Event batches of a stream, with those flushed at the end."""
    out = EventStream(
        spark, scratch_path(spark, "out"), ["event_type"], F.col("event_type"), 50, HOUR_MILLIS
    )
    log = as_events_log(_stream(spark, folder, "events"))
    _finish(out.start(log, scratch_path(spark, "offsets")))
    out.flush()
    return batch_summary(out.batches())


@query("i3_stream_sync", f"WITH {EVENTS}, {hard_versions('ev')} {_version_sql(EV_COLS)}")
def i3_stream_sync(spark, folder):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    log = as_events_log(_stream(spark, folder, "events"))
    _finish(stream_sync(log, store, scratch_path(spark, "offsets")))
    return period_text(store.versions())


@query("i4_stream_docs", f"""WITH {EVENTS}, last AS (SELECT * FROM ev QUALIFY {_LAST})
    SELECT id, substr(id, 1, 2) || '/' || substr(id, 3, 2) || '/' || id || '.json' AS path, event_type
    FROM last WHERE change_type <> 'Removed'""")
def i4_stream_docs(spark, folder):
    path = scratch_path(spark, "docs")
    log = as_events_log(_stream(spark, folder, "events"))
    _finish(stream_docs(log, path, scratch_path(spark, "offsets")))
    kind = F.get_json_object("doc", "$.event_type").alias("event_type")
    return read_documents(spark, path).select("id", "path", kind)


@query("i6_requeued", f"""WITH {_KEYED}
  SELECT k.id, k.seq FROM keyed k JOIN first f USING (stream_id)
  WHERE (has_flag AND NOT knows_flag) OR (has_time AND NOT knows_time)""")
def i6_requeued(spark, folder):
    """Changes that wait to be tried again, as they do not fit their stream."""
    store = ChangeStore(spark, scratch_path(spark, "store"))
    entities = as_order_entities(_stream(spark, folder, "orders"))
    _finish(stream_sync(entities, store, scratch_path(spark, "offsets")))
    return store.rejected().select("id", "seq")
