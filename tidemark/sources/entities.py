"""Entity changes with properties, codes and edges, made from the order tables.

Columns: the log columns, ``persist_hash``, ``persist_version``,
``origin_entity_code``, ``entity_type``, ``properties`` (map of text), ``codes``
(array of type, origin and value), ``outgoing_edges`` and ``incoming_edges``. Edges
arrive on the change that carries them, so nothing is gathered per entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import guid_from, iso_text
from tidemark.sources.change_logs import ADDED, CHANGED, REMOVED, log_stream, table

REFERENCE_TYPE = "struct<Name: string, Code: struct<Key: string>>"
EDGE_TYPE = (
    "struct<EdgeType: struct<Code: string>, "
    f"FromReference: {REFERENCE_TYPE}, ToReference: {REFERENCE_TYPE}, "
    "Properties: map<string,string>>"
)


def reference(key: Column, name: Column | None = None) -> Column:
    name = F.lit(None).cast("string") if name is None else name
    return F.struct(name.alias("Name"), F.struct(key.alias("Key")).alias("Code"))


def edge(kind: str, source: Column, target: Column, properties: Column) -> Column:
    return F.struct(
        F.struct(F.lit(kind).alias("Code")).alias("EdgeType"),
        source.alias("FromReference"),
        target.alias("ToReference"),
        properties.alias("Properties"),
    )


def code(kind: str, origin: str, value: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("type"), F.lit(origin).alias("origin"), value.cast("string").alias("value")
    )


def code_text(kind: Column, origin: Column, value: Column) -> Column:
    """An entity code as text: ``{type}#{origin}:{value}``."""
    return F.concat(kind, F.lit("#"), origin, F.lit(":"), value)


def order_entities(spark: SparkSession, folder: str) -> DataFrame:
    return as_order_entities(table(spark, folder, "orders"))


def as_order_entities(orders: DataFrame) -> DataFrame:
    """Orders as entities, linked to their customers and priorities.

    Every third order carries the key ``order.flag``, every fifth brings its own
    ``Timestamp``, and orders with status P have no edges.
    """
    key = F.col("o_orderkey")
    order_key = F.concat(F.lit("/Order#SALES:"), key.cast("string"))
    customer_key = F.concat(F.lit("/Customer#CRM:"), F.col("o_custkey").cast("string"))
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    no_properties = F.lit(None).cast("map<string,string>")
    linked = F.col("o_orderstatus") != "P"
    properties = F.map_filter(
        F.create_map(
            F.lit("Name"), F.concat(F.lit("Order "), key.cast("string")),
            F.lit("order.totalPrice"), price,
            F.lit("order.priority"), F.col("o_orderpriority"),
            F.lit("order.placed"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
            F.lit("order.flag"), F.when(key % 3 == 0, F.lit("true")),
            F.lit("Timestamp"), F.when(key % 5 == 0, iso_text(F.col("o_orderdate"))),
        ),
        lambda _, value: value.isNotNull(),
    )
    return orders.select(
        log_stream("o_custkey").alias("stream_id"),
        guid_from(F.concat(F.lit("order-"), key.cast("string"))).alias("id"),
        F.when(F.col("o_orderstatus") == "O", ADDED)
        .when(F.col("o_orderstatus") == "P", REMOVED)
        .otherwise(CHANGED)
        .alias("change_type"),
        F.col("o_orderdate").alias("ts"),
        key.alias("seq"),
        F.md5(price).alias("persist_hash"),
        (key % 7).cast("int").alias("persist_version"),
        order_key.alias("origin_entity_code"),
        F.lit("/Order").alias("entity_type"),
        properties.alias("properties"),
        F.when(key % 2 == 0, F.array(code("/Order", "SALES", key), code("/Customer", "CRM", F.col("o_custkey"))))
        .otherwise(F.array(code("/Order", "SALES", key)))
        .alias("codes"),
        F.when(
            linked,
            F.array(
                edge("/PlacedBy", reference(order_key), reference(customer_key, F.lit("Customer")), no_properties),
                edge(
                    "/HasPriority",
                    reference(order_key),
                    reference(F.concat(F.lit("/Priority#SALES:"), F.col("o_orderpriority"))),
                    F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("price"), price),
                ),
            ),
        ).alias("outgoing_edges"),
        F.when(
            linked,
            F.array(edge("/Placed", reference(customer_key, F.lit("Customer")), reference(order_key), no_properties)),
        ).alias("incoming_edges"),
    )
