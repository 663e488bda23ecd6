"""Envelope queries (group A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog.sql import guid, stream
from tidemark.functions.cells import edge_text
from tidemark.functions.text import instant
from tidemark.operators import envelope as env
from tidemark.sources.change_logs import table
from tidemark.sources.entities import order_entities

PROVIDER = "c444cda8-d9b5-45cc-a82d-fef28e08d55c"
NOW = "2024-08-20 22:16:00"
DECLARED = {
    "Name": "string",
    "order.totalPrice": "string",
    "order.priority": "string",
    "order.placed": "string",
    "order.flag": "string",
}

_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
_CHANGE = "CASE o_orderstatus WHEN 'O' THEN 'Added' WHEN 'P' THEN 'Removed' ELSE 'Changed' END"
ORDER_ID = guid("'order-' || o_orderkey")
ORDER_STREAM = stream("o_custkey % 20")
_CODE = "'/Order#SALES:' || o_orderkey"
_CUSTOMER = "'/Customer#CRM:' || o_custkey"

PROPERTIES_SQL = f"""'Order ' || o_orderkey AS "Name", {_PRICE} AS "order.totalPrice",
  o_orderpriority AS "order.priority", strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "order.placed",
  CASE WHEN o_orderkey % 3 = 0 THEN 'true' END AS "order.flag" """

SYSTEM_SQL = f"""md5({_PRICE}) AS "PersistHash", CAST(o_orderkey % 7 AS INTEGER) AS "PersistVersion",
  {_CODE} AS "OriginEntityCode", '/Order' AS "EntityType",
  '{PROVIDER}' AS "ProviderDefinitionId", 'orders' AS "ContainerName" """


def enveloped(spark, folder, **options):
    options = {"now": instant(NOW), "provider_definition_id": PROVIDER, "container_name": "orders", **options}
    return env.envelope(order_entities(spark, folder), DECLARED, **options)


@query("a1_envelope", f"""SELECT {ORDER_STREAM} AS stream_id, {ORDER_ID} AS id, {_CHANGE} AS change_type,
  o_orderdate AS ts, o_orderkey AS seq, {PROPERTIES_SQL}, {SYSTEM_SQL},
  '2024-08-20T22:16:00.0000000+00:00' AS "Timestamp", 1724192160000 AS "Epoch",
  {_CODE} || CASE WHEN o_orderkey % 2 = 0 THEN '|' || {_CUSTOMER} ELSE '' END AS "Codes"
  FROM orders""")
def a1_envelope(spark, folder):
    return enveloped(spark, folder).withColumn("Codes", F.array_join("Codes", "|"))


@query("a2_apply_types", """SELECT event_id, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
  CAST(floor(value) AS INTEGER) AS whole, value > 10 AS large, ts AS at,
  CAST(event_id % 200 AS SMALLINT) AS small, event_type AS label,
  CASE WHEN event_id % 2 = 0 THEN event_id ELSE -1 END AS number
  FROM events""")
def a2_apply_types(spark, folder):
    """Typed columns from text, as declared by property; text that is no number becomes null."""
    text = table(spark, folder, "events").select(
        "event_id",
        F.col("value").cast("string").alias("amount"),
        F.floor("value").cast("string").alias("whole"),
        (F.col("value") > 10).cast("string").alias("large"),
        F.col("ts").cast("string").alias("at"),
        (F.col("event_id") % 200).cast("string").alias("small"),
        F.col("event_type").alias("label"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string"))
        .otherwise(F.col("event_type"))
        .alias("number"),
    )
    declared = {
        "amount": "decimal(18,2)", "whole": "Nullable<int>", "large": "bool?", "at": "DateTime",
        "small": "byte", "label": "Uri", "number": "long",
    }
    return env.apply_types(text, declared).fillna({"number": -1}).withColumn(
        "amount", F.col("amount").cast("string")
    )


@query("a2_rejected", """SELECT event_id, concat_ws(',', CASE WHEN event_id % 3 = 0 THEN 'whole' END, CASE WHEN event_id % 2 = 0 THEN 'number' END) AS unparsed,
    CASE WHEN event_id % 2 = 0 THEN event_type END AS number_text FROM events WHERE event_id % 3 = 0 OR event_id % 2 = 0""")
def a2_rejected(spark, folder):
    """Rows with text that is no number, set aside with the names of the columns and their text."""
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    text = events.select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, "12x").when(F.col("event_id") % 5 != 0, "12").alias("whole"),
        F.when(F.col("event_id") % 2 == 0, kind).otherwise(F.col("event_id").cast("string")).alias("number"),
    )
    fits, aside = env.split_unparsed(env.parse_types(text, {"whole": "int", "number": "long"}))
    number = F.get_json_object("as_given", "$.number")
    return aside.select("event_id", F.array_join("unparsed", ",").alias("unparsed"), F.when(F.col("event_id") % 2 == 0, number).alias("number_text"))


@query("a2_accepted", """SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN 12 END AS whole, event_id AS number
    FROM events WHERE event_id % 3 <> 0 AND event_id % 2 <> 0""")
def a2_accepted(spark, folder):
    """The rows beside them: typed, a null text is no failure."""
    text = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, "12x").when(F.col("event_id") % 5 != 0, "12").alias("whole"),
        F.when(F.col("event_id") % 2 == 0, "none").otherwise(F.col("event_id").cast("string")).alias("number"),
    )
    return env.split_unparsed(env.parse_types(text, {"whole": "int", "number": "long"}))[0]


@query("a3_event_time", f"""SELECT {ORDER_ID} AS id,
  CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.0000000+00:00'
    ELSE '2024-08-20T22:16:00.0000000+00:00' END AS "Timestamp",
  1724192160000 AS "Epoch" FROM orders""")
def a3_event_time(spark, folder):
    """Every fifth order brings its own Timestamp; none brings an Epoch."""
    entities = order_entities(spark, folder)
    rows = entities.withColumn("Timestamp", F.col("properties")["Timestamp"])
    return env.with_event_time(rows, instant(NOW)).select("id", "Timestamp", "Epoch")


@query("a4_change_type", f"""SELECT {ORDER_ID} AS id, {_CHANGE} AS "__ChangeType__", {_CHANGE} AS "ChangeType"
  FROM orders""")
def a4_change_type(spark, folder):
    rows = enveloped(spark, folder, delta_mode=True, event_mode=True)
    return rows.select("id", "__ChangeType__", "ChangeType")


@query("a5_attach_edges", f"""
  SELECT {ORDER_ID} AS id, 'out' AS direction, 2 AS edges,
    'EdgeType: /PlacedBy; From: §C:' || {_CODE} || '; To: Customer§C:' || {_CUSTOMER} || '; Properties: 0' AS edge
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT {ORDER_ID}, 'out', 2,
    'EdgeType: /HasPriority; From: §C:' || {_CODE} || '; To: §C:/Priority#SALES:' || o_orderpriority || '; Properties: 2'
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT {ORDER_ID}, 'in', 1,
    'EdgeType: /Placed; From: Customer§C:' || {_CUSTOMER} || '; To: §C:' || {_CODE} || '; Properties: 0'
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT {ORDER_ID}, d, 0, NULL FROM orders, (VALUES ('in'), ('out')) x(d) WHERE o_orderstatus = 'P'""")
def a5_attach_edges(spark, folder):
    rows = enveloped(spark, folder, outgoing_edges=True, incoming_edges=True)
    sides = F.array(
        F.struct(F.lit("out").alias("direction"), F.col("OutgoingEdges").alias("all")),
        F.struct(F.lit("in").alias("direction"), F.col("IncomingEdges").alias("all")),
    )
    each = rows.select("id", F.inline(sides))
    return each.select(
        "id", "direction", F.size("all").alias("edges"),
        F.explode_outer(F.transform("all", edge_text)).alias("edge"),
    )


@query("a6_serialize_cells", f"""SELECT event_id, event_type,
  regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0*$', '') AS at,
  '["' || event_type || '","' || CAST(user_id AS VARCHAR) || '"]' AS tags,
  '{{"a":' || event_id || ',"b":null}}' AS pair, value FROM events""")
def a6_serialize_cells(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id", "event_type", F.col("ts").alias("at"),
        F.array("event_type", F.col("user_id").cast("string")).alias("tags"),
        F.struct(F.col("event_id").alias("a"), F.lit(None).cast("string").alias("b")).alias("pair"),
        "value",
    )
    return env.serialize_cells(rows, text_times=["at"])


@query("a7_order_columns", f"""SELECT {ORDER_ID} AS "Id", {PROPERTIES_SQL}, {SYSTEM_SQL} FROM orders""")
def a7_order_columns(spark, folder):
    rows = enveloped(spark, folder).withColumnRenamed("id", "Id")
    return env.order_columns(
        rows.drop("stream_id", "change_type", "ts", "seq", "Timestamp", "Epoch", "Codes")
    )


_KEYED = f"""keyed AS (SELECT {ORDER_STREAM} AS stream_id, {ORDER_ID} AS id, o_orderdate AS ts, o_orderkey AS seq,
    o_orderkey % 3 = 0 AS has_flag, o_orderkey % 5 = 0 AS has_time FROM orders),
  first AS (SELECT stream_id, arg_min(has_flag, (ts, seq)) AS knows_flag, arg_min(has_time, (ts, seq)) AS knows_time
    FROM keyed GROUP BY stream_id)"""


@query("a8_schema_guard_accepted", f"""WITH {_KEYED} SELECT k.id, k.seq FROM keyed k JOIN first f USING (stream_id)
  WHERE (NOT has_flag OR knows_flag) AND (NOT has_time OR knows_time)""")
def a8_schema_guard_accepted(spark, folder):
    return env.schema_guard(order_entities(spark, folder))[0].select("id", "seq")


@query("a8_schema_guard_rejected", f"""WITH {_KEYED}
  SELECT k.id, k.seq, concat_ws('|', CASE WHEN has_time AND NOT knows_time THEN 'Timestamp' END,
    CASE WHEN has_flag AND NOT knows_flag THEN 'order.flag' END) AS unknown
  FROM keyed k JOIN first f USING (stream_id)
  WHERE (has_flag AND NOT knows_flag) OR (has_time AND NOT knows_time)""")
def a8_schema_guard_rejected(spark, folder):
    rejected = env.schema_guard(order_entities(spark, folder))[1]
    return rejected.select("id", "seq", F.array_join(F.array_sort("unknown_keys"), "|").alias("unknown"))


@query("a9_codes", f"""SELECT {ORDER_ID} AS id, {_CODE} AS code FROM orders
  UNION ALL SELECT {ORDER_ID}, {_CUSTOMER} FROM orders WHERE o_orderkey % 2 = 0""")
def a9_codes(spark, folder):
    entities = order_entities(spark, folder)
    return entities.select("id", F.explode(env.codes(entities)).alias("code"))
