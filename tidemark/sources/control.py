"""Streams, providers and an export ledger, made from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.schedule import seconds
from tidemark.functions.text import instant
from tidemark.operators.ledger import COMPLETE, JOB_SERVER, LEDGER_COLUMNS, SCHEDULER, STARTING
from tidemark.sources.change_logs import stream_guid, table

CREATED = "1998-07-01 06:30:00"


def ledger_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Two entries for each order that is not pending, one for a pending order.

    The stream is the customer, the data time is the order date.
    """
    key = F.col("o_orderkey")
    start = F.col("o_orderdate") + seconds((key % 86_400).cast("decimal(18,6)"))
    runs = table(spark, folder, "orders").select(
        stream_guid(F.col("o_custkey")).alias("StreamId"),
        F.col("o_orderdate").alias("DataTime"),
        F.when(key % 4 == 0, JOB_SERVER).otherwise(SCHEDULER).alias("TriggerSource"),
        F.lit("Daily").alias("CronSchedule"),
        F.concat(F.lpad(key.cast("string"), 20, "0"), F.lit(".parquet")).alias("FilePath"),
        F.lit("parquet").alias("FileFormat"),
        start.alias("StartTime"),
        F.lit("host-1").alias("ExporterHostName"),
        F.floor(F.col("o_totalprice") % 7).cast("bigint").alias("rows"),
        (F.col("o_orderstatus") != "P").alias("done"),
    )
    starting = runs.withColumns(
        {
            "EndTime": F.lit(None).cast("timestamp_ntz"),
            "TotalRows": F.lit(None).cast("bigint"),
            "Status": F.lit(STARTING),
        }
    )
    complete = runs.where("done").withColumns(
        {"EndTime": F.col("StartTime") + seconds(30), "TotalRows": F.col("rows"), "Status": F.lit(COMPLETE)}
    )
    return starting.select(*LEDGER_COLUMNS).unionByName(complete.select(*LEDGER_COLUMNS))


def streams(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as streams of the provider of their nation."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        stream_guid(key).alias("stream_id"),
        F.col("c_nationkey").alias("provider_id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "Stopped").otherwise("Started").alias("status"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "EventStream").otherwise("Sync").alias("mode"),
        (F.col("c_acctbal") > 0).alias("cache_enabled"),
        F.when(key % 4 == 0, "Weekly").when(key % 4 == 1, "daily").when(key % 4 == 2, "Never").otherwise("Hourly").alias("schedule"),
        instant(CREATED).alias("created_at"),
        F.when(key % 3 == 0, instant(CREATED) + F.make_dt_interval(days=(key % 20).cast("int"))).alias("modified_at"),
    )


def providers(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as providers; those of region 3 are disabled."""
    nation = F.col("n_nationkey")
    return table(spark, folder, "nation").select(
        nation.alias("provider_id"),
        (F.col("n_regionkey") != 3).alias("is_enabled"),
        F.when(nation % 2 == 0, instant(CREATED) + F.make_dt_interval(days=nation)).alias("target_created_at"),
    )
