"""Questions about a point in time.

Each question comes in two forms. On a versions table it is a filter on the period
columns. On a change log it is an aggregation over the changes up to that time: each
map task sends one row per entity, and the full history isn't built first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import cols, field, null_safe_join
from tidemark.operators.joins import join_lookup
from tidemark.operators.ordered import SLICE_ROWS, Latest, running, with_slices
from tidemark.operators.patches import SET, patched_changes_since, patched_state
from tidemark.operators.state import STAMPED, current_state, position
from tidemark.sources.change_logs import KEY, LOG_COLUMNS, ORDER, REMOVED, is_removed, payload_columns

PERIOD = ("valid_from", "valid_to")


def visible_at(t: Column) -> Column:
    return (F.col("valid_from") <= t) & (t < F.col("valid_to"))


def as_of(ver: DataFrame, t: Column) -> DataFrame:
    """The versions visible at ``t``, without the period columns."""
    return ver.where(visible_at(t)).drop(*PERIOD)


def delta(ver: DataFrame, t: Column, last: Column) -> DataFrame:
    """The versions visible at ``t`` that began after the last export."""
    return ver.where(visible_at(t) & (F.col("valid_from") > last)).drop(*PERIOD)


def snapshot(log: DataFrame, t: Column, soft: bool = False) -> DataFrame:
    """State of every entity at ``t``, straight from the log, which may hold patches."""
    until = log.where(F.col("ts") <= t)
    return patched_state(until, soft) if SET in log.columns else current_state(until, soft)


def changes_since(log: DataFrame, t: Column, last: Column, soft: bool = False) -> DataFrame:
    """State at ``t`` of the entities that changed after ``last``, straight from the log.

    Only changes in ``(last, t]`` are read, except that a soft delete whose entity was
    not written in that window takes its payload from the older log. The few entities
    concerned are found first, so the older log is filtered before it is shuffled. Patches need
    the older changes of every entity that changed.
    """
    if SET in log.columns:
        return patched_changes_since(log, t, last, soft)
    recent = log.where((F.col("ts") > last) & (F.col("ts") <= t))
    if not soft:
        return current_state(recent)
    payload = payload_columns(log)
    live = ~is_removed()
    body = F.max_by(F.struct(F.lit(1).alias("_"), *cols(payload)), F.when(live, position()))
    window = recent.groupBy(*KEY).agg(
        F.max_by(F.struct(*LOG_COLUMNS[2:], *cols(payload)), position()).alias("last"), body.alias("body")
    )
    bare = window.where(F.col("body").isNull()).select(*KEY)
    older = join_lookup(log.where((F.col("ts") <= last) & live), bare, KEY, "left_semi")
    older = older.groupBy(*KEY).agg(body.alias("old_body"))
    return (
        window.join(older, list(KEY), "left")
        .withColumn("body", F.coalesce("body", "old_body"))
        .where(F.col("body").isNotNull())
        .select(
            *KEY,
            *(f"last.{c}" for c in LOG_COLUMNS[2:]),
            *(field("last" if c in STAMPED else "body", c) for c in payload),
        )
    )


def count_as_of(log: DataFrame, t: Column, soft: bool = False) -> DataFrame:
    """Rows per stream at ``t``; reads no payload."""
    rows = snapshot(log.select(*LOG_COLUMNS), t, soft)
    return rows.groupBy("stream_id").agg(F.count("*").alias("row_count"))


def entity_as_of(log: DataFrame, entity_id: str, t: Column, soft: bool = False) -> DataFrame:
    """One entity at ``t``; no rows if it does not exist then."""
    return snapshot(log.where(F.col("id") == entity_id), t, soft)


def resolve_time(argument: Column, now: Column) -> Column:
    """The requested time, or now: struct of ``data_time`` and ``is_current``."""
    parsed = F.try_to_timestamp(argument.cast("string")).cast("timestamp_ntz")
    return F.struct(
        F.coalesce(parsed, now).alias("data_time"), parsed.isNull().alias("is_current")
    )


def lookup_as_of(
    log: DataFrame, requests: DataFrame, soft: bool = False, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Answer a table of (stream_id, id, t) requests; requests without an answer give no row.

    Changes of entities nobody asks about, or after the latest time asked, leave the log
    before it is shuffled. The others and the requests of an entity are put in one time
    order and each request takes the latest change before it, so no request meets all
    versions of its entity. Null ids match null ids.
    """
    payload = payload_columns(log)
    asked = [c for c in requests.columns if c not in (*KEY, "t")]
    change = F.struct("change_type", *ORDER, *cols(payload))
    changes = log.select(
        *KEY,
        "ts",
        F.lit(0).alias("_kind"),
        "seq",
        F.when(F.lit(True) if not soft else ~is_removed(), change).alias("_body"),
        F.struct("change_type", *ORDER).alias("_last"),
    )
    upto = requests.groupBy(*KEY).agg(F.max("t").alias("_upto"))
    early = F.col("ts").isNull() | (F.col("ts") <= F.col("_upto"))
    changes = null_safe_join(changes, upto, KEY, "inner").where(early).drop("_upto")
    questions = requests.select(
        *KEY,
        F.col("t").alias("ts"),
        F.lit(1).alias("_kind"),
        F.xxhash64(*cols(requests.columns)).alias("seq"),
        F.struct(F.lit(1).alias("_"), *cols(asked)).alias("_asked"),
    )
    rows = changes.unionByName(questions, allowMissingColumns=True)
    order = ("ts", "_kind", "seq")
    specs = {"_found": Latest(F.col("_body")), "_change": Latest(F.col("_last"))}
    answers = running(with_slices(rows, KEY, order, slice_rows), KEY, order, specs)
    answers = answers.where(F.col("_kind") == 1).where(F.col("_found").isNotNull())
    if not soft:
        answers = answers.where(F.col("_change.change_type") != REMOVED)
    return answers.select(
        *(field("_asked", c) for c in asked),
        *KEY,
        F.col("ts").alias("t"),
        "_change.change_type",
        F.col("_change.ts").alias("valid_from"),
        F.col("_change.seq").alias("seq"),
        *(field("_found", c) for c in payload),
    )
