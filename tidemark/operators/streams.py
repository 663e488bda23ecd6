"""Which streams take part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import join_lookup


def eligible_streams(streams: DataFrame, providers: DataFrame) -> DataFrame:
    """Started, synchronised and cached streams of enabled providers."""
    enabled = providers.where("is_enabled").select("provider_id", "target_created_at")
    wanted = streams.where(
        (F.col("status") == "Started") & (F.col("mode") == "Sync") & F.col("cache_enabled")
    )
    return join_lookup(wanted, enabled, ["provider_id"], "inner")


def restrict(log: DataFrame, eligible: DataFrame) -> DataFrame:
    """The changes of eligible streams."""
    return join_lookup(log, eligible.select("stream_id").distinct(), ["stream_id"], "left_semi", few_keys=True)


def obsolete_streams(history: DataFrame, streams: DataFrame) -> DataFrame:
    """Streams the ledger knows that no longer exist."""
    known = history.select(F.col("StreamId").alias("stream_id")).distinct()
    return known.join(streams.select("stream_id"), "stream_id", "left_anti")
