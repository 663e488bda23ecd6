"""Exports of many streams in one run.

The plan is a table with a row per stream: its data time, its last export, the name of its output
and what to do. Rows of all streams are made by one query and written by one job per shape (a
mirror's first file has no marker, so first and later exports differ); the ledger gets one append
before and one after. Only the plan's rows reach the driver, which moves finished directories into
place and runs no job for a stream.
"""

from __future__ import annotations

import datetime as dt
import json
import socket
import time
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.functions.schedule import NEVER
from tidemark.functions.text import instant
from tidemark.operators import ledger, streams
from tidemark.operators.joins import join_lookup
from tidemark.operators.patches import SET, patched_state
from tidemark.operators.state import current_state
from tidemark.plans.export import shaped
from tidemark.plans.profiles import ExportProfile
from tidemark.plans.store import ChangeStore
from tidemark.session import settle
from tidemark.sinks import landing, writers
from tidemark.sinks.publish import DESCRIPTION
from tidemark.sources import files

#: Holds the stream of a row while rows of many are written together.
STREAM = "_stream"
WRITES = ("write", "write_current", "overwrite")


def _literal(time: dt.datetime) -> Column:
    return instant(time.strftime("%Y-%m-%d %H:%M:%S.%f"))


def export_plan(store: ChangeStore, profile: ExportProfile, wanted: DataFrame, providers: DataFrame, now: dt.datetime) -> DataFrame:
    """What a run does, one row per eligible stream.

    ``wanted``: stream_id, container_name, status, mode, cache_enabled, provider_id, schedule and
    scheduled (the instant that is due, null for none). ``providers``: provider_id, is_enabled,
    target_created_at. Gives StreamId, DataTime, TriggerSource, CronSchedule, FilePath, Directory,
    LastTime and action: ``skip`` when the ledger has the output for the same stream and time.
    """
    if not profile.stream_cache:
        wanted = wanted.limit(0)
    rows = streams.eligible_streams(wanted, providers)
    due = F.coalesce(F.col("schedule"), F.lit(NEVER))
    current = F.lit(profile.use_current_time) | F.col("scheduled").isNull() | (F.lower(due) == NEVER.lower())
    at = F.when(current, _literal(now)).otherwise(F.col("scheduled"))
    rows = rows.select(F.col("stream_id").alias("StreamId"), "container_name", at.alias("DataTime"), F.lit(ledger.SCHEDULER).alias("TriggerSource"), due.alias("CronSchedule"))
    history = store.history()
    last = ledger.last_export(history)
    rows = rows.join(last.select("StreamId", F.col("DataTime").alias("LastTime")), "StreamId", "left")
    run = (F.col("StreamId"), F.col("container_name"), F.col("DataTime"), F.lit(profile.format))
    extension = F.lit(profile.extension(profile.format) if profile.extension else profile.format)
    if profile.mirror:
        number = ledger.next_sequence(last)
        rows = rows.join(number, "StreamId", "left")
        rows = rows.withColumn("FilePath", ledger.sequence_name(F.coalesce("sequence", F.lit(1).cast("bigint")), extension)).drop("sequence")
        directory = names.sub_directory(profile.table_name, *run)
    else:
        pattern = profile.name_pattern and profile.name_pattern.strip()
        name = names.expand_pattern(profile.name_pattern, *run) if pattern else names.default_name(run[0], run[2], extension, profile.stream_id_form)
        rows, directory = rows.withColumn("FilePath", name), F.lit("")
    rows = rows.withColumn("Directory", directory).drop("container_name")
    # names of mirrored files repeat from stream to stream, so a mirror asks for its last time alone
    done = history.where(F.col("Status") == ledger.COMPLETE)
    outputs = done.groupBy("FilePath").agg(F.max_by(F.struct("StreamId", "DataTime"), "StartTime").alias("o")).select("FilePath", "o.*")
    if profile.mirror:
        return ledger.decide(rows, outputs.limit(0), rows.select("StreamId", F.col("LastTime").alias("DataTime")).where("DataTime is not null"))
    return ledger.decide(rows, outputs)


def planned_rows(log: DataFrame, plan: DataFrame, soft: bool) -> DataFrame:
    """The rows of all exports of a plan: the state of each stream at its data time, and of a
    stream that was exported before only the entities that changed since.

    A hard delta reads only the changes after the last export, as its result needs no others.
    """
    times = plan.select(F.col("StreamId").alias("stream_id"), "DataTime", "LastTime")
    log_columns = log.columns
    rows = join_lookup(log, times, ["stream_id"], "inner", few_keys=True).where(F.col("ts") <= F.col("DataTime"))
    if not soft and SET not in log_columns:
        rows = rows.where(F.col("LastTime").isNull() | (F.col("ts") > F.col("LastTime")))
    rows = rows.select(*(F.col(f"`{c}`") for c in log_columns))
    state = patched_state(rows, soft) if SET in log_columns else current_state(rows, soft)
    state = join_lookup(state, times.drop("DataTime"), ["stream_id"], "inner")
    return state.where(F.col("LastTime").isNull() | (F.col("ts") > F.col("LastTime")))


def run_exports(store: ChangeStore, root: str, profile: ExportProfile, wanted: DataFrame, providers: DataFrame, now: dt.datetime) -> DataFrame:
    """Export all eligible streams; gives the plan with TotalRows, the rows written per stream.

    A full target gets snapshots, a delta target what changed since each stream's last export.
    The formats are Parquet and CSV with line feeds; the others frame each output, and are
    written by ``run_export``. A run that fails is repeated whole: outputs replace themselves,
    and a stream counts as exported once the entry after its output is in the ledger.
    """
    plain = profile.format == "parquet" or (profile.format == "csv" and profile.csv_line_end == "\n")
    if profile.writer is not None or profile.load_table or not plain:
        raise ValueError("This target frames or loads each output; export its streams one by one")
    root, began = root.rstrip("/"), time.monotonic()
    plan = settle(export_plan(store, profile, wanted, providers, now))
    todo = plan.where(F.col("action").isin(*WRITES))
    if not profile.delta_mode:
        todo = todo.withColumn("LastTime", F.lit(None).cast("timestamp_ntz"))
    entry = todo.select(
        *ledger.RUN_KEY, "FilePath", F.lit(profile.format).alias("FileFormat"),
        _literal(now).alias("StartTime"), F.lit(socket.gethostname()).alias("ExporterHostName"),
    )
    store.record_all(entry.withColumn("Status", F.lit(ledger.STARTING)))
    counts = [
        _write_group(store, root, profile, group, first)
        for first, group in ((True, todo.where("LastTime is null")), (False, todo.where("LastTime is not null")))
        if not group.isEmpty()
    ]
    if not counts:
        return plan.withColumn("TotalRows", F.lit(None).cast("bigint"))
    rows = settle(reduce(DataFrame.unionByName, counts))
    ended = _literal(now + dt.timedelta(seconds=time.monotonic() - began))
    done = entry.join(rows, "StreamId").withColumn("EndTime", ended)
    store.record_all(done.withColumn("Status", F.lit(ledger.COMPLETE)))
    return plan.join(rows, "StreamId", "left")


def _write_group(store: ChangeStore, root: str, profile: ExportProfile, group: DataFrame, first: bool) -> DataFrame:
    """Write first or later exports in one job and put each in its place: StreamId, TotalRows."""
    spark = store.spark
    rows = planned_rows(store.patches(), group, soft=profile.delta_mode)
    rows = rows.withColumn(STREAM, F.col("stream_id")).drop("LastTime")
    own = writers.prepare(shaped(rows, profile, first), profile)
    staged = f"{root}/_staged-{'first' if first else 'later'}"
    nothing = f"{staged}-empty"
    writers.write_by(own, staged, profile, STREAM)
    writers.write(own.drop(STREAM).limit(0), nothing, profile)
    found = writers.written_by(spark, staged, profile, own.schema)
    counts = found.groupBy(F.col(STREAM).alias("StreamId")).agg(F.count("*").alias("TotalRows"))
    counts = settle(group.select("StreamId").join(counts, "StreamId", "left").fillna(0, ["TotalRows"]))
    have = set(files.names(spark, staged))
    for r in group.select("StreamId", "DataTime", "Directory", "FilePath").toLocalIterator():
        target = "/".join(filter(None, (root, r["Directory"], r["FilePath"].replace(":", "-"))))
        if profile.mirror:
            landing.prepare_landing_zone(spark, root, r["Directory"], profile, initial=first)
        source = f"{staged}/{STREAM}={r['StreamId']}"
        if f"{STREAM}={r['StreamId']}" not in have:
            if profile.delta_mode and not profile.allow_empty:
                continue
            files.copy(spark, nothing, source)
        files.write_text(spark, f"{source}/{DESCRIPTION}", json.dumps({"StreamId": r["StreamId"], "DataTime": r["DataTime"].isoformat()}))
        files.delete(spark, target)
        files.rename(spark, source, target)
    for path in (staged, nothing):
        files.delete(spark, path)
    return counts
