"""Change logs: one row per change of an entity.

Columns: ``stream_id``, ``id``, ``change_type`` (Added, Changed, Removed), ``ts``
(UTC, TIMESTAMP_NTZ), ``seq`` and the payload. ``(stream_id, id, ts, seq)`` is
unique; (ts, seq) is the commit order of an entity.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import guid_from

#: The id first: it tells rows apart early when they are sorted.
KEY = ("id", "stream_id")
ORDER = ("ts", "seq")
LOG_COLUMNS = ("stream_id", "id", "change_type", *ORDER)

ADDED, CHANGED, REMOVED = "Added", "Changed", "Removed"


def is_removed() -> Column:
    return F.col("change_type") == REMOVED


def payload_columns(log: DataFrame) -> list[str]:
    return [c for c in log.columns if c not in LOG_COLUMNS]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_guid(number: Column) -> Column:
    return guid_from(F.concat(F.lit("stream-"), number.cast("string")))


#: The logs of the test tables have this many streams.
LOG_STREAMS = 20


def stream_id(number: int) -> str:
    """What :func:`stream_guid` gives for a number known now."""
    return str(uuid.UUID(hashlib.md5(f"stream-{number}".encode()).hexdigest()))


def log_stream(key: str) -> Column:
    """The stream of a row: one of few, so it is looked up and not computed."""
    known = F.array(*(F.lit(stream_id(n)) for n in range(LOG_STREAMS)))
    return F.get(known, F.col(key) % LOG_STREAMS)


def events_log(spark: SparkSession, folder: str) -> DataFrame:
    """Users as entities: few entities with many versions."""
    return as_events_log(table(spark, folder, "events"))


def as_events_log(events: DataFrame) -> DataFrame:
    return events.select(
        log_stream("user_id").alias("stream_id"),
        F.col("user_id").cast("string").alias("id"),
        F.when(F.col("event_type") == "signup", ADDED)
        .when(F.col("event_type") == "error", REMOVED)
        .otherwise(CHANGED)
        .alias("change_type"),
        "ts",
        F.col("event_id").alias("seq"),
        "event_type",
        "value",
        "props",
    )


def lineitem_log(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as entities: many entities, several changes at the same time."""
    return table(spark, folder, "lineitem").select(
        log_stream("l_orderkey").alias("stream_id"),
        F.col("l_orderkey").cast("string").alias("id"),
        F.when(F.col("l_returnflag") == "A", ADDED)
        .when(F.col("l_returnflag") == "R", REMOVED)
        .otherwise(CHANGED)
        .alias("change_type"),
        F.col("l_shipdate").alias("ts"),
        (
            F.col("l_linenumber").cast("bigint") * 10_000_000_000
            + F.col("l_partkey") * 10_000
            + F.col("l_suppkey")
        ).alias("seq"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_linestatus").alias("linestatus"),
    )
