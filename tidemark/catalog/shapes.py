"""Shaping and naming queries (groups D and F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog.entities import ORDER_ID, ORDER_STREAM, enveloped
from tidemark.catalog.history import EV_COLS, EV_T
from tidemark.catalog.sql import EVENTS, EVENTS_PAYLOAD, soft_versions
from tidemark.functions import cells, names
from tidemark.functions.text import instant
from tidemark.operators import shape, temporal
from tidemark.operators.envelope import serialize_cells
from tidemark.operators.versions import versions
from tidemark.sources.change_logs import events_log, log_stream, table
from tidemark.sources.entities import order_entities

_SOFT = f"WITH {EVENTS}, {soft_versions('ev', EVENTS_PAYLOAD)}"
_AT = f"valid_from <= TIMESTAMP '{EV_T}' AND TIMESTAMP '{EV_T}' < valid_to"


def _soft_rows(spark, folder):
    """The soft-delete snapshot of events, with its change type as a column."""
    ver = versions(events_log(spark, folder), soft=True)
    rows = temporal.as_of(ver, instant(EV_T)).withColumn("__ChangeType__", F.col("change_type"))
    return shape.entity_columns(rows)


@query("d1_export_columns", f"""{_SOFT} SELECT id AS "Id", {EV_COLS} FROM ver WHERE {_AT}""")
def d1_export_columns(spark, folder):
    return shape.export_columns(_soft_rows(spark, folder), delta_mode=False)


@query("d2_skip_removed", f"""{_SOFT} SELECT id AS "Id", {EV_COLS}, change_type AS "__ChangeType__"
    FROM ver WHERE {_AT} AND change_type <> 'Removed'""")
def d2_skip_removed(spark, folder):
    return shape.skip_removed(_soft_rows(spark, folder), delta_mode=True, initial=True)


@query("d3_row_marker", f"""{_SOFT} SELECT id AS "Id", {EV_COLS},
    CASE change_type WHEN 'Removed' THEN '2' ELSE '4' END AS "__rowMarker__" FROM ver WHERE {_AT}""")
def d3_row_marker(spark, folder):
    return shape.row_marker(_soft_rows(spark, folder), first=False)


@query("d3_row_marker_first", f"""{_SOFT} SELECT id AS "Id", {EV_COLS} FROM ver WHERE {_AT}""")
def d3_row_marker_first(spark, folder):
    return shape.row_marker(_soft_rows(spark, folder), first=True)


@query("d4_escape_columns", """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "order_totalPrice",
    o_orderpriority AS "order_priority", CASE WHEN o_orderkey % 3 = 0 THEN 'true' END AS "order_flag"
    FROM orders""")
def d4_escape_columns(spark, folder):
    rows = enveloped(spark, folder).select(
        F.col("seq").alias("o_orderkey"), "`order.totalPrice`", "`order.priority`", "`order.flag`"
    )
    return shape.escape_columns(rows)


@query("d5_guid_as_string", f"""SELECT o_orderkey, {ORDER_ID} AS d, replace({ORDER_ID}, '-', '') AS n,
    '{{' || {ORDER_ID} || '}}' AS b, '(' || {ORDER_ID} || ')' AS p FROM orders""")
def d5_guid_as_string(spark, folder):
    raw = F.upper("id")
    rows = order_entities(spark, folder).select(
        F.col("seq").alias("o_orderkey"), *(raw.alias(form) for form in "dnbp")
    )
    for form in "dnbp":
        rows = shape.guid_as_string(rows, [form], form)
    return rows


@query("d6_iso_offset", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0+00:00' AS ts FROM events""")
def d6_iso_offset(spark, folder):
    events = table(spark, folder, "events")
    return shape.iso_offset(events.select("event_id", F.col("ts").cast("timestamp").alias("ts")))


@query("d8_codes_to_array", f"""SELECT {ORDER_ID} AS id, 0 AS pos, '/Order#SALES:' || o_orderkey AS code FROM orders
    UNION ALL SELECT {ORDER_ID}, 1, '/Customer#CRM:' || o_custkey FROM orders WHERE o_orderkey % 2 = 0""")
def d8_codes_to_array(spark, folder):
    stored = serialize_cells(enveloped(spark, folder))
    return shape.codes_to_array(stored).select("id", F.posexplode("Codes").alias("pos", "code"))


@query("d9_edges_to_text", f"""SELECT {ORDER_ID} AS id,
    'EdgeType: /PlacedBy; From: §C:/Order#SALES:' || o_orderkey || '; To: Customer§C:/Customer#CRM:' || o_custkey || '; Properties: 0' AS edge
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT {ORDER_ID},
    'EdgeType: /HasPriority; From: §C:/Order#SALES:' || o_orderkey || '; To: §C:/Priority#SALES:' || o_orderpriority || '; Properties: 2'
  FROM orders WHERE o_orderstatus <> 'P'""")
def d9_edges_to_text(spark, folder):
    stored = serialize_cells(enveloped(spark, folder, outgoing_edges=True))
    return shape.edges_to_text(stored).select("id", F.explode("OutgoingEdges").alias("edge"))


_KIND = """CASE WHEN json_valid(t) AND json_type(t) = 'ARRAY' THEN 'array'
  WHEN json_valid(t) AND json_type(t) = 'OBJECT' THEN 'object' ELSE 'text' END"""


@query("d10_json_kind", f"""WITH cells AS (
    SELECT 'event' AS origin, event_id AS id, props AS t FROM events
    UNION ALL SELECT 'document', doc_id, text FROM documents
    UNION ALL SELECT 'embedding', vec_id, CAST(to_json(embedding) AS VARCHAR) FROM embeddings)
  SELECT origin, id, {_KIND} AS kind FROM cells""")
def d10_json_kind(spark, folder):
    """Objects, whole plain texts and arrays, told apart."""

    def cells_of(name, origin, key, text):
        return table(spark, folder, name).select(F.lit(origin).alias("origin"), F.col(key).alias("id"), text.alias("t"))

    every = (
        cells_of("events", "event", "event_id", F.col("props"))
        .unionAll(cells_of("documents", "document", "doc_id", F.col("text")))
        .unionAll(cells_of("embeddings", "embedding", "vec_id", F.to_json("embedding")))
    )
    return every.select("origin", "id", cells.json_kind(F.col("t")).alias("kind"))


@query("d10_rehydrate_json", """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
    event_type AS plain FROM events""")
def d10_rehydrate_json(spark, folder):
    events = table(spark, folder, "events").select("event_id", "props", F.col("event_type").alias("plain"))
    nested = shape.rehydrate_json(events)
    return nested.select(
        "event_id",
        F.try_variant_get("props", "$.k", "int").alias("k"),
        F.try_variant_get("plain", "$", "string").alias("plain"),
    )


@query("d12_hidden_period", f"""{_SOFT} SELECT stream_id, id, change_type, seq, {EV_COLS} FROM ver WHERE {_AT}""")
def d12_hidden_period(spark, folder):
    return temporal.as_of(versions(events_log(spark, folder), soft=True), instant(EV_T))


def _runs(spark, folder):
    """One export per order: its stream, time and a format."""
    kind = F.col("o_orderkey") % 3
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").alias("data_time"),
        log_stream("o_custkey").alias("stream_id"),
        F.concat(F.lit("target-"), F.col("o_orderstatus")).alias("container"),
        F.when(kind == 0, "csv").when(kind == 1, "json").otherwise("parquet").alias("format"),
    )


_FORMAT_SQL = "CASE o_orderkey % 3 WHEN 0 THEN 'csv' WHEN 1 THEN 'json' ELSE 'parquet' END"


def _expand(pattern):
    return names.expand_pattern(
        pattern, F.col("stream_id"), F.col("container"), F.col("data_time"), F.col("format")
    )


@query("f1_expand_pattern", f"""SELECT o_orderkey,
    replace({ORDER_STREAM}, '-', '') || '_' || strftime(o_orderdate, '%Y%m%d%H%M%S') || '.' || {_FORMAT_SQL} AS plain,
    {ORDER_STREAM} || '_' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.0000000+00:00.' || upper({_FORMAT_SQL}) AS full,
    'target-' || o_orderstatus || '/' || strftime(o_orderdate, '%Y.%m.%d-%p') || '_{{Other}}.' || lower({_FORMAT_SQL}) AS mixed
    FROM orders""")
def f1_expand_pattern(spark, folder):
    return _runs(spark, folder).select(
        "o_orderkey",
        _expand("{StreamId:N}_{DataTime:yyyyMMddHHmmss}.{OutputFormat}").alias("plain"),
        _expand("{StreamId}_{DataTime}.{OutputFormat:ToUpper}").alias("full"),
        _expand("{ContainerName:ToUpper}/{DataTime:yyyy.MM.dd-tt}_{Other}.{OutputFormat:tolower}").alias("mixed"),
    )


@query("f2_default_name", f"""SELECT o_orderkey,
    replace({ORDER_STREAM}, '-', '') || '_' || strftime(o_orderdate, '%Y%m%d%H%M%S') || '.' || {_FORMAT_SQL} AS bare,
    {ORDER_STREAM} || '_' || strftime(o_orderdate, '%Y%m%d%H%M%S') || '.' || {_FORMAT_SQL} AS hyphened
    FROM orders""")
def f2_default_name(spark, folder):
    run = (F.col("stream_id"), F.col("data_time"), F.col("format"))
    return _runs(spark, folder).select(
        "o_orderkey",
        names.default_name(*run).alias("bare"),
        names.default_name(*run, form="D").alias("hyphened"),
    )


@query("f3_sub_directory", f"""SELECT o_orderkey, replace({ORDER_STREAM}, '-', '') AS bare,
    'target-' || o_orderstatus || '_table' AS named FROM orders""")
def f3_sub_directory(spark, folder):
    run = (F.col("stream_id"), F.col("container"), F.col("data_time"), F.col("format"))
    return _runs(spark, folder).select(
        "o_orderkey",
        names.sub_directory(None, *run).alias("bare"),
        names.sub_directory("{ContainerName}_table", *run).alias("named"),
    )
