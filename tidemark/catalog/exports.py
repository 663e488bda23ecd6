"""Store, sink and export queries (groups A10, B7, B8, D7, D11, E and K).

Each writes to a fresh folder under the shared root and returns what it reads back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog.entities import ORDER_ID, ORDER_STREAM, PROPERTIES_SQL, enveloped
from tidemark.catalog.history import EV_COLS, LI_COLS, LI_LAST, LI_T, _LAST, _version_sql, period_text
from tidemark.catalog.sql import (
    EVENTS,
    EVENTS_PAYLOAD,
    LINEITEM,
    LINEITEM_PAYLOAD,
    hard_versions,
    micros,
    soft_versions,
    stream,
)
from tidemark.functions.text import instant
from tidemark.operators import shape
from tidemark.operators.batches import event_batches, idle_batches
from tidemark.operators.envelope import serialize_cells
from tidemark.plans.export import Stream, load_table, run_delta, run_export
from tidemark.plans.exports import run_exports
from tidemark.plans.history import VersionHistory
from tidemark.plans.profiles import ExportProfile
from tidemark.plans.store import ChangeStore
from tidemark.session import scratch_path
from tidemark.sinks import documents, landing, writers
from tidemark.sinks.publish import publish
from tidemark.sources import files
from tidemark.sources.change_logs import LOG_STREAMS, events_log, lineitem_log, stream_guid, stream_id, table

HOUR_MILLIS = 3_600_000


def _utc(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def _store(spark, log, batches: int = 3) -> ChangeStore:
    """A store filled in several batches."""
    store = ChangeStore(spark, scratch_path(spark, "store"))
    for batch_id in range(batches):
        part = F.pmod(F.xxhash64("stream_id", "id", "seq"), F.lit(batches)) == batch_id
        store.append(log.where(part), batch_id)
    return store


@query("a10_list_outputs")
def a10_list_outputs(spark, folder):
    """The files of a fresh Parquet output, listed without reading them."""
    path = scratch_path(spark, "listed")
    lineitem_log(spark, folder).write.parquet(path)
    return files.list_outputs(spark, path).where(F.col("name").startswith("part-")).select("name", "length")


@query("b7_append_changes", f"WITH {LINEITEM}, {soft_versions('li', LINEITEM_PAYLOAD)} {_version_sql(LI_COLS)}")
def b7_append_changes(spark, folder):
    """Three batches, one of them delivered twice, then the history of the whole store."""
    log = lineitem_log(spark, folder)
    store = _store(spark, log)
    store.append(log.where(F.pmod(F.xxhash64("stream_id", "id", "seq"), F.lit(3)) == 1), 1)
    return period_text(store.versions(soft=True))


@query("b7_compacted_versions", f"WITH {EVENTS}, {hard_versions('ev')} {_version_sql(EV_COLS)}")
def b7_compacted_versions(spark, folder):
    """The materialised history of a store whose batches were merged."""
    store = _store(spark, events_log(spark, folder))
    store.compact(2)
    store.materialise_versions()
    return period_text(store.materialised_versions())


#: Every third batch gives all columns, the others lack some.
LACKING = {0: (), 1: ("tax", "linestatus"), 2: ("quantity",)}


def _patched_store(spark, folder) -> ChangeStore:
    log = lineitem_log(spark, folder)
    store = ChangeStore(spark, scratch_path(spark, "store"))
    for batch_id, lacking in LACKING.items():
        store.append(log.where(F.col("seq") % 3 == batch_id).drop(*lacking), batch_id)
    return store


def _patched_sql(soft: bool) -> str:
    """``whole``: the log with each absent column's last value; a hard delete forgets it."""
    cells = []
    for c in LINEITEM_PAYLOAD:
        absent = [str(k) for k, lacking in LACKING.items() if c in lacking]
        given = f"seq % 3 NOT IN ({', '.join(absent)})" if absent else "true"
        gone = "" if soft else f"WHEN change_type = 'Removed' THEN struct_pack(v := CASE WHEN false THEN {c} END) "
        cell = f"CASE {gone}WHEN change_type <> 'Removed' AND {given} THEN struct_pack(v := {c}) END"
        cells.append(f"(last_value({cell} IGNORE NULLS) OVER so_far).v AS {c}")
    return f"""whole AS (SELECT stream_id, id, change_type, ts, seq, {", ".join(cells)} FROM li
      WINDOW so_far AS (PARTITION BY stream_id, id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query("b7_patched_store", f"""WITH {LINEITEM}, {_patched_sql(True)}, {soft_versions('whole', LINEITEM_PAYLOAD)} {_version_sql(LI_COLS)}""")
def b7_patched_store(spark, folder):
    """The history of batches that lack columns: a column keeps its value where it isn't given."""
    return period_text(_patched_store(spark, folder).versions(soft=True))


@query("b7_patched_hard", f"""WITH {LINEITEM}, {_patched_sql(False)}, {hard_versions('whole')} {_version_sql(LI_COLS)}""")
def b7_patched_hard(spark, folder):
    """The same with hard deletes, which forget all values."""
    return period_text(_patched_store(spark, folder).versions())


@query("c1_patched_snapshot", f"""WITH {LINEITEM}, {_patched_sql(False)}, {hard_versions('whole')}
    SELECT stream_id, id, change_type, valid_from AS ts, seq, {LI_COLS} FROM ver
    WHERE valid_from <= TIMESTAMP '{LI_T}' AND TIMESTAMP '{LI_T}' < valid_to""")
def c1_patched_snapshot(spark, folder):
    return _patched_store(spark, folder).snapshot(instant(LI_T))


@query("c2_patched_changes", f"""WITH {LINEITEM}, {_patched_sql(True)}, {soft_versions('whole', LINEITEM_PAYLOAD)}
    SELECT stream_id, id, change_type, valid_from AS ts, seq, {LI_COLS} FROM ver
    WHERE valid_from <= TIMESTAMP '{LI_T}' AND TIMESTAMP '{LI_T}' < valid_to AND valid_from > TIMESTAMP '{LI_LAST}'""")
def c2_patched_changes(spark, folder):
    return _patched_store(spark, folder).changes_since(instant(LI_T), instant(LI_LAST), soft=True)


@query("b7_two_sources", f"""WITH {LINEITEM}, {hard_versions('li')}
    SELECT CASE WHEN seq % 2 = 0 THEN 'even' ELSE 'odd' END AS source, stream_id, id, change_type, seq, {LI_COLS},
      {{valid_from}} AS valid_from, {{valid_to}} AS valid_to FROM ver""".format(
    valid_from=micros("valid_from"), valid_to=micros("valid_to")))
def b7_two_sources(spark, folder):
    """Two sources with the same batch numbers, one of them delivered twice; both are kept."""
    log = lineitem_log(spark, folder)
    store = ChangeStore(spark, scratch_path(spark, "store"))
    for batch_id in range(2):
        for n, source in enumerate(("even", "odd")):
            store.append(log.where(F.col("seq") % 4 == n + 2 * batch_id), batch_id, source)
    store.append(log.where("seq % 4 = 1"), 0, "odd")
    source = F.when(F.col("seq") % 2 == 0, "even").otherwise("odd")
    return period_text(store.versions()).withColumn("source", source)


def _merged(spark, log, parts: list, soft: bool):
    """The history of a store after merging each part of the log in turn."""
    store = ChangeStore(spark, scratch_path(spark, "store"))
    history = VersionHistory(store, soft)
    for batch_id, part in enumerate(parts):
        store.append(log.where(part), batch_id)
        history.merge()
    return period_text(history.versions())


@query("b7_incremental_versions", f"WITH {LINEITEM}, {soft_versions('li', LINEITEM_PAYLOAD)} {_version_sql(LI_COLS)}")
def b7_incremental_versions(spark, folder):
    """Five batches in the order of time, merged one by one into the materialised history."""
    bounds = ["1992-01-01", "1994-01-01", "1995-06-01", "1996-09-01", "1998-01-01", "9999-01-01"]
    parts = [f"ts >= timestamp_ntz '{a}' and ts < timestamp_ntz '{b}'" for a, b in zip(bounds, bounds[1:], strict=False)]
    parts[0] = f"ts < timestamp_ntz '{bounds[1]}'"
    return _merged(spark, lineitem_log(spark, folder), parts, soft=True)


@query("b7_late_versions", f"WITH {EVENTS}, {hard_versions('ev')} {_version_sql(EV_COLS)}")
def b7_late_versions(spark, folder):
    """Batches whose changes come in any order: entities with late changes are built anew."""
    return _merged(spark, events_log(spark, folder), [f"seq % 3 = {k}" for k in (1, 2, 0)], soft=False)


_ARCHIVED = stream("7")


@query("b8_archive", f"""WITH {EVENTS} SELECT stream_id, stream_id = {_ARCHIVED} AS archived, count(*) AS changes
    FROM ev GROUP BY stream_id""")
def b8_archive(spark, folder):
    """Changes per stream, in the store or archived."""
    log = events_log(spark, folder)
    store = _store(spark, log, batches=2)
    store.archive(stream_id(7), "20240821031600")
    kept = store.log().withColumn("archived", F.lit(False))
    moved = store.archived(stream_id(7), "20240821031600").withColumn("archived", F.lit(True))
    rows = kept.unionByName(moved)
    return rows.groupBy("stream_id", "archived").agg(F.count("*").alias("changes"))


_ORDER_ROWS = f"""SELECT {ORDER_ID} AS "Id", {PROPERTIES_SQL}, o_orderkey AS number FROM orders"""
_ORDER_COLUMNS = ("Name", "order.totalPrice", "order.priority", "order.placed", "order.flag")


def _order_rows(spark, folder):
    rows = enveloped(spark, folder)
    return rows.select(F.col("id").alias("Id"), *(f"`{c}`" for c in _ORDER_COLUMNS), F.col("seq").alias("number"))


@query("d7_nullable_schema", _ORDER_ROWS)
def d7_nullable_schema(spark, folder):
    return shape.nullable_schema(_order_rows(spark, folder))


@query("d11_null_cells", """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS label,
    CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS absent FROM events""")
def d11_null_cells(spark, folder):
    """Nulls survive a CSV round trip: an empty cell reads as null."""
    rows = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("label"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("amount"),
    )
    profile = ExportProfile(output_format="csv")
    path = scratch_path(spark, "nulls")
    writers.write(writers.prepare(rows, profile), path, profile)
    back = spark.read.csv(path, header=True, schema="event_id bigint, label string, amount double")
    return back.select("event_id", "label", F.col("amount").isNull().cast("int").alias("absent"))


def _csv(spark, path, schema):
    return spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', multiLine=True)


@query("e1_csv", _ORDER_ROWS)
def e1_csv(spark, folder):
    rows, profile = _order_rows(spark, folder), ExportProfile.azure(output_format="CSV")
    path = scratch_path(spark, "csv")
    writers.write(writers.prepare(rows, profile), path, profile)
    return _csv(spark, path, rows.schema)


@query("e1_csv_mirror_dialect", "SELECT doc_id, md5(text) AS digest, length(text) AS size FROM documents")
def e1_csv_mirror_dialect(spark, folder):
    """Whole texts with quotes, commas and line feeds through the CRLF dialect."""
    rows = table(spark, folder, "documents").select("doc_id", "text")
    profile = ExportProfile.mirrored(output_format="csv")
    path = scratch_path(spark, "crlf")
    writers.write(writers.prepare(rows, profile), path, profile)
    back = spark.read.csv(
        path, schema=rows.schema, header=True, quote='"', escape='"', multiLine=True, lineSep="\r\n",
        maxCharsPerColumn=-1,
    )
    return back.select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("size"))


@query("e2_json", _ORDER_ROWS)
def e2_json(spark, folder):
    """A JSON array per part file; names keep their dots."""
    rows, profile = _order_rows(spark, folder), ExportProfile.azure()
    path = scratch_path(spark, "json")
    writers.write(writers.prepare(rows, profile), path, profile)
    return spark.read.schema(rows.schema).json(path, multiLine=True)


@query("e2_json_nested", f"""SELECT {ORDER_ID} AS "Id", CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 2 END AS edges,
    CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS codes FROM orders""")
def e2_json_nested(spark, folder):
    """JSON text cells become nested arrays in the output."""
    stored = serialize_cells(enveloped(spark, folder, outgoing_edges=True))
    rows = stored.select(F.col("id").alias("Id"), "OutgoingEdges", "Codes")
    profile = ExportProfile.azure(json_lines=True)
    path = scratch_path(spark, "nested")
    writers.write(writers.prepare(rows, profile), path, profile)
    back = spark.read.schema("Id string, OutgoingEdges array<struct<EdgeType: struct<Code: string>>>, Codes array<string>").json(path)
    return back.select("Id", F.size("OutgoingEdges").alias("edges"), F.size("Codes").alias("codes"))


@query("e3_parquet", f"""SELECT {ORDER_ID} AS "Id", 'Order ' || o_orderkey AS "Name",
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "order_totalPrice",
    '/Order#SALES:' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '|/Customer#CRM:' || o_custkey ELSE '' END AS "Codes",
    CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 2 END AS edges FROM orders""")
def e3_parquet(spark, folder):
    """Escaped names and array columns, read back from Parquet."""
    rows = enveloped(spark, folder, outgoing_edges=True)
    rows = rows.select(F.col("id").alias("Id"), "Name", "`order.totalPrice`", "Codes", "OutgoingEdges")
    profile = ExportProfile.databricks(output_format="Parquet", array_columns=True, max_records_per_file=10_000)
    path = scratch_path(spark, "parquet")
    writers.write(writers.prepare(rows, profile), path, profile)
    back = spark.read.parquet(path)
    return back.select(
        "Id", "Name", "order_totalPrice", F.array_join("Codes", "|").alias("Codes"),
        F.size("OutgoingEdges").alias("edges"),
    )


@query("e4_format_dispatch", """SELECT f AS format, count(*) AS row_count, CAST(sum(event_id) AS BIGINT) AS ids
    FROM events, (VALUES ('csv'), ('json'), ('parquet')) x(f) GROUP BY f""")
def e4_format_dispatch(spark, folder):
    """The same rows in every format, whatever the case of its name."""
    rows = table(spark, folder, "events").select("event_id", "event_type")
    totals = None
    for name in ("CSV", "Json", "parquet"):
        profile = ExportProfile(output_format=name)
        path = scratch_path(spark, name)
        writers.write(writers.prepare(rows, profile), path, profile)
        reader = spark.read.schema(rows.schema)
        back = {
            "csv": lambda: reader.csv(path, header=True),
            "json": lambda: reader.json(path, multiLine=True),
            "parquet": lambda: reader.parquet(path),
        }[profile.format]()
        total = back.agg(
            F.lit(profile.format).alias("format"), F.count("*").alias("row_count"), F.sum("event_id").alias("ids")
        )
        totals = total if totals is None else totals.unionByName(total)
    return totals


def _write_parquet(df, path):
    df.write.parquet(path)


@query("e5_publish", "SELECT event_id, event_type FROM events WHERE event_type <> 'view'")
def e5_publish(spark, folder):
    """The second publication replaces the first."""
    rows = table(spark, folder, "events").select("event_id", "event_type")
    path = scratch_path(spark, "published")
    publish(rows, path, _write_parquet, {"run": "1"})
    publish(rows.where("event_type <> 'view'"), path, _write_parquet, {"run": "2"})
    return spark.read.parquet(path)


@query("e6_empty_suppressed", """SELECT 'kept' AS policy, true AS published, 0 AS row_count
    UNION ALL SELECT 'suppressed', false, 0
    UNION ALL SELECT 'full', true, CAST(count(*) AS INTEGER) FROM events""")
def e6_empty_suppressed(spark, folder):
    rows = table(spark, folder, "events").select("event_id")
    none = rows.where("event_id < 0")
    out = []
    for policy, df, keep in (("kept", none, True), ("suppressed", none, False), ("full", rows, False)):
        path = scratch_path(spark, policy)
        count = publish(df, path, _write_parquet, {}, keep_empty=keep)
        out.append((policy, files.exists(spark, path), count))
    return spark.createDataFrame(out, "policy string, published boolean, row_count int")


@query("e7_append", """SELECT event_id FROM events WHERE event_type = 'view'""")
def e7_append(spark, folder):
    """A second publication replaces the first."""
    rows = table(spark, folder, "events")
    path = scratch_path(spark, "appended")
    publish(rows.select("event_id"), path, _write_parquet, {})
    publish(rows.where("event_type = 'view'").select("event_id"), path, _write_parquet, {})
    return spark.read.parquet(path)


@query("e8_load_table", """SELECT CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "order_totalPrice",
    o_orderkey AS number FROM orders""")
def e8_load_table(spark, folder):
    """Escaped rows as a table; its files lie in a fresh folder."""
    rows = shape.escape_columns(_order_rows(spark, folder).select("`order.totalPrice`", "number"))
    path = scratch_path(spark, "table")
    name = "tidemark_" + path.split("/")[-2].split("-")[-1]
    load_table(rows, name, path)
    return spark.table(name)


@query("e9_landing_zone", """SELECT 'first' AS run, event_id, event_type, true AS numbered FROM events WHERE event_id % 2 = 0
    UNION ALL SELECT 'second', event_id, event_type, true FROM events WHERE event_id % 2 = 1""")
def e9_landing_zone(spark, folder):
    """Two runs land flat files; the second is repeated. Each file's number follows the one before."""
    rows = table(spark, folder, "events").select("event_id", "event_type")
    profile, zone = ExportProfile.mirrored(max_records_per_file=300), scratch_path(spark, "zone")
    names = {}
    for n, run in ((0, "first"), (1, "second"), (1, "second")):
        own = landing.land_numbered(rows.where(F.col("event_id") % 2 == n), zone, profile, run)
        names |= {(name, run): None for name in own}
    numbered = [int(name.split(".")[0]) for name, _ in names] == list(range(1, len(names) + 1))
    runs = spark.createDataFrame(list(names), "name string, run string")
    back = spark.read.parquet(zone).withColumn("name", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    return back.join(runs, "name").select("run", "event_id", "event_type", F.lit(numbered).alias("numbered"))


@query("e11_entity_docs", f"""WITH {LINEITEM}, keyed AS (
    SELECT * REPLACE (md5(id) AS id) FROM li), last AS (SELECT * FROM keyed QUALIFY {_LAST})
    SELECT id, substr(id, 1, 2) AS shard1, substr(id, 3, 2) AS shard2,
      substr(id, 1, 2) || '/' || substr(id, 3, 2) || '/' || id || '.json' AS path, linestatus
    FROM last WHERE change_type <> 'Removed'""")
def e11_entity_docs(spark, folder):
    log = lineitem_log(spark, folder).withColumn("id", F.md5("id"))
    docs = documents.entity_docs(log)
    status = F.get_json_object("doc", "$.linestatus").alias("linestatus")
    return docs.select("id", "shard1", "shard2", "path", status)


IDLE_SQL = f"""gaps AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 1 HOUR
      THEN 1 ELSE 0 END AS starts FROM ev WINDOW w AS (PARTITION BY event_type ORDER BY ts, seq)),
  sessions AS (SELECT *, CAST(sum(starts) OVER (PARTITION BY event_type ORDER BY ts, seq) AS BIGINT) AS session FROM gaps),
  batched AS (SELECT *, (row_number() OVER (PARTITION BY event_type, session ORDER BY ts, seq) - 1) // 50 AS batch
    FROM sessions)"""


def batched_events(spark, folder):
    return idle_batches(events_log(spark, folder), ["event_type"], 50, HOUR_MILLIS)


@query("i1_idle_batches", f"WITH {EVENTS}, {IDLE_SQL} SELECT id, seq, event_type, session, batch FROM batched")
def i1_idle_batches(spark, folder):
    return batched_events(spark, folder).select("id", "seq", "event_type", "session", "batch")


_BATCH_FILES = """SELECT event_type || '.' || strftime(max(ts), '%Y-%m-%d %H-%M-%S.%f') || '0.json' AS file_name,
    count(*) AS items, CAST(sum(seq) AS BIGINT) AS total FROM batched GROUP BY event_type, session, batch"""


def batch_summary(batches):
    """Size and check sum of each batch, parsed from its JSON array."""
    items = F.from_json("content", "array<struct<seq: bigint>>")
    total = F.aggregate(items, F.lit(0).cast("bigint"), lambda acc, item: acc + item["seq"])
    return batches.select("file_name", F.size(items).cast("bigint").alias("items"), total.alias("total"))


@query("e12_event_batches", f"WITH {EVENTS}, {IDLE_SQL} {_BATCH_FILES}")
def e12_event_batches(spark, folder):
    batches = event_batches(batched_events(spark, folder), ["event_type"], F.col("event_type"))
    return batch_summary(batches)


#: The whole lineitem log as one stream.
SOURCE = Stream(stream_id(0), "orders")


def _one_stream(log):
    return log.withColumn("stream_id", F.lit(SOURCE.stream_id))


_DELTA_ROWS = f"""valid_from <= TIMESTAMP '{LI_T}' AND TIMESTAMP '{LI_T}' < valid_to
    AND valid_from > TIMESTAMP '{LI_LAST}'"""


@query("k2_run_export", f"""WITH {LINEITEM}, last AS (SELECT * FROM li WHERE ts <= TIMESTAMP '{LI_T}' QUALIFY {_LAST})
    SELECT id AS "Id", {LI_COLS} FROM last WHERE change_type <> 'Removed'""")
def k2_run_export(spark, folder):
    """A manual export of a stream of a store, read back from Parquet."""
    store = _store(spark, _one_stream(lineitem_log(spark, folder)))
    root = scratch_path(spark, "out")
    profile = ExportProfile.azure(output_format="parquet")
    result = run_export(store, root, profile, SOURCE, _utc(LI_T), manual=True)
    return spark.read.parquet(result.path)


@query("k2_patched_export", f"""WITH {LINEITEM}, {_patched_sql(False)}, {hard_versions('whole')}
    SELECT id AS "Id", {LI_COLS} FROM ver WHERE stream_id = {stream('3')} AND valid_from <= TIMESTAMP '{LI_T}' AND TIMESTAMP '{LI_T}' < valid_to""")
def k2_patched_export(spark, folder):
    """An export of one stream of a store whose batches lack columns."""
    root, profile = scratch_path(spark, "out"), ExportProfile.azure(output_format="parquet")
    result = run_export(_patched_store(spark, folder), root, profile, Stream(stream_id(3), "orders"), _utc(LI_T), manual=True)
    return spark.read.parquet(result.path)


def _all_streams(spark, schedule: str = "Weekly", due: str | None = None):
    """A control table of the log's streams, of which one is paused and one has a disabled provider."""
    streams = spark.range(LOG_STREAMS).select(
        stream_guid(F.col("id")).alias("stream_id"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("container_name"),
        F.when(F.col("id") == 5, "Paused").otherwise("Started").alias("status"),
        F.lit("Sync").alias("mode"),
        F.lit(True).alias("cache_enabled"),
        F.when(F.col("id") == 6, 2).otherwise(1).alias("provider_id"),
        F.lit(schedule).alias("schedule"),
        F.lit(due).cast("timestamp_ntz").alias("scheduled"),
    )
    providers = spark.createDataFrame([(1, True, _utc(LI_LAST)), (2, False, _utc(LI_LAST))], "provider_id int, is_enabled boolean, target_created_at timestamp_ntz")
    return streams, providers


def _exported(spark, root: str, outputs: str = "*"):
    """Rows of the outputs below a root, with the name of their output."""
    rows = spark.read.parquet(f"{root}/{outputs}")
    return rows.withColumn("output", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


_NOT_EXPORTED = f"stream_id NOT IN ({stream('5')}, {stream('6')})"


@query("k2_run_exports", f"""WITH {LINEITEM}, {hard_versions('li')}
    SELECT stream_id || '_' || strftime(TIMESTAMP '{LI_T}', '%Y%m%d%H%M%S') || '.parquet' AS output, id AS "Id", {LI_COLS} FROM ver
    WHERE valid_from <= TIMESTAMP '{LI_T}' AND TIMESTAMP '{LI_T}' < valid_to AND {_NOT_EXPORTED}""")
def k2_run_exports(spark, folder):
    """Scheduled exports of all streams in one run."""
    store, root = _store(spark, lineitem_log(spark, folder)), scratch_path(spark, "out")
    run_exports(store, root, ExportProfile.azure(output_format="parquet"), *_all_streams(spark, due=LI_T), _utc("1999-06-01 00:00:00"))
    return _exported(spark, root)


@query("k2_run_deltas", f"""WITH {LINEITEM}, {soft_versions('li', LINEITEM_PAYLOAD)}
    SELECT '{"2".zfill(20)}.parquet' AS output, id AS "Id", {LI_COLS}, CASE change_type WHEN 'Removed' THEN '2' ELSE '4' END AS "__rowMarker__"
    FROM ver WHERE {_DELTA_ROWS} AND {_NOT_EXPORTED}""")
def k2_run_deltas(spark, folder):
    """The second run over all mirrored streams carries what changed since the first."""
    store, root = _store(spark, lineitem_log(spark, folder)), scratch_path(spark, "mirror")
    for time in (LI_LAST, LI_T):
        run_exports(store, root, ExportProfile.mirrored(), *_all_streams(spark, schedule="Never"), _utc(time))
    return _exported(spark, root, f"*/{2:020d}.parquet")


@query("k2_export_ledger", f"""WITH {LINEITEM}, {hard_versions('li')}
    SELECT stream_id AS "StreamId", 'Weekly' AS "CronSchedule", 'Complete' AS "Status", count(*) AS "TotalRows" FROM ver
    WHERE valid_from <= TIMESTAMP '{LI_T}' AND TIMESTAMP '{LI_T}' < valid_to AND {_NOT_EXPORTED} GROUP BY stream_id""")
def k2_export_ledger(spark, folder):
    """The ledger after two runs for the same instant: the second has nothing to do."""
    store, root = _store(spark, lineitem_log(spark, folder)), scratch_path(spark, "out")
    for _ in range(2):
        run_exports(store, root, ExportProfile.azure(output_format="parquet"), *_all_streams(spark, due=LI_T), _utc("1999-06-01 00:00:00"))
    return store.history().select("StreamId", "CronSchedule", "Status", "TotalRows")


@query("i5_run_delta", f"""WITH {LINEITEM}, {soft_versions('li', LINEITEM_PAYLOAD)}
    SELECT id AS "Id", {LI_COLS}, CASE change_type WHEN 'Removed' THEN '2' ELSE '4' END AS "__rowMarker__"
    FROM ver WHERE {_DELTA_ROWS}""")
def i5_run_delta(spark, folder):
    """The second export of a mirrored stream carries what changed since the first."""
    store = _store(spark, _one_stream(lineitem_log(spark, folder)))
    root = scratch_path(spark, "mirror")
    profile = ExportProfile.mirrored()
    run_delta(store, root, profile, SOURCE, _utc(LI_LAST))
    result = run_delta(store, root, profile, SOURCE, _utc(LI_T))
    return spark.read.parquet(result.path)
