"""An export run: decide, read the store, shape, publish, keep the ledger."""

from __future__ import annotations

import datetime as dt
import socket
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.functions.schedule import NEVER
from tidemark.functions.text import instant
from tidemark.operators import ledger, shape, temporal
from tidemark.operators.envelope import CHANGE_TYPE, order_columns
from tidemark.plans.profiles import ExportProfile
from tidemark.plans.store import ChangeStore
from tidemark.sinks import landing, writers
from tidemark.sinks.publish import described, publish
from tidemark.sources import files
from tidemark.streaming.flows import EventStream


@dataclass(frozen=True)
class Stream:
    stream_id: str
    container_name: str
    status: str = "Started"
    mode: str = "Sync"
    provider_enabled: bool = True


@dataclass(frozen=True)
class ExportResult:
    #: ``exported``, ``skipped`` or ``ineligible``.
    outcome: str
    path: str | None = None
    file_name: str | None = None
    rows: int | None = None
    data_time: dt.datetime | None = None


def _literal(time: dt.datetime) -> Column:
    return instant(time.strftime("%Y-%m-%d %H:%M:%S.%f"))


def _evaluate(spark: SparkSession, value: Column) -> str:
    return spark.range(1).select(value).first()[0]


def output_name(
    spark: SparkSession,
    profile: ExportProfile,
    stream: Stream,
    data_time: dt.datetime,
    last: dict | None,
) -> str:
    """File name of a run: sequential for a mirror, else from the pattern or the default."""
    extension = profile.extension(profile.format) if profile.extension else profile.format
    if profile.mirror:
        number = 1
        if last is not None:
            row = spark.createDataFrame(
                [(stream.stream_id, last["FilePath"], last["TotalRows"])],
                "StreamId string, FilePath string, TotalRows bigint",
            )
            number = ledger.next_sequence(row).first()["sequence"]
        return _evaluate(spark, ledger.sequence_name(F.lit(number), F.lit(extension)))
    run = (F.lit(stream.stream_id), _literal(data_time))
    if profile.name_pattern and profile.name_pattern.strip():
        return _evaluate(
            spark,
            names.expand_pattern(
                profile.name_pattern, run[0], F.lit(stream.container_name), run[1], F.lit(profile.format)
            ),
        )
    return _evaluate(spark, names.default_name(*run, F.lit(extension), profile.stream_id_form))


def table_directory(
    spark: SparkSession, profile: ExportProfile, stream: Stream, data_time: dt.datetime
) -> str:
    """Directory of a mirrored table, or name of a loaded one."""
    return _evaluate(
        spark,
        names.sub_directory(
            profile.table_name,
            F.lit(stream.stream_id),
            F.lit(stream.container_name),
            _literal(data_time),
            F.lit(profile.format),
        ),
    )


def export_rows(
    log: DataFrame, profile: ExportProfile, data_time: Column, last_time: Column | None
) -> DataFrame:
    """What an export contains: the snapshot, or the delta after the last export.

    Delta targets keep removed entities, so that the removal itself is exported.
    """
    soft = profile.delta_mode
    if soft and last_time is not None:
        rows = temporal.changes_since(log, data_time, last_time, soft)
    else:
        rows = temporal.snapshot(log, data_time, soft)
    return shaped(rows, profile, initial=last_time is None)


def shaped(rows: DataFrame, profile: ExportProfile, initial: bool) -> DataFrame:
    """The columns of an export: ``Id``, the others by name, and the marker of a mirror last."""
    if profile.delta_mode and CHANGE_TYPE not in rows.columns:
        rows = rows.withColumn(CHANGE_TYPE, F.col("change_type"))
    rows = shape.entity_columns(rows)
    rows = shape.skip_removed(rows, profile.delta_mode, initial)
    rows = order_columns(shape.export_columns(rows, profile.delta_mode))
    if profile.mirror:
        rows = shape.row_marker(rows, first=initial)
    return profile.fields(rows) if profile.fields else rows


def run_export(
    store: ChangeStore,
    root: str,
    profile: ExportProfile,
    stream: Stream,
    now: dt.datetime,
    scheduled: dt.datetime | None = None,
    schedule: str = NEVER,
    manual: bool = False,
    partner: dict | None = None,
) -> ExportResult:
    """Export one stream. Times are UTC. ``manual`` is a run asked for by a person.

    A run whose output exists is skipped when it was written for the same stream and
    time, unless it is manual: then the current time is used, with a new name.
    """
    spark = store.spark
    root = root.rstrip("/")
    eligible = (
        stream.provider_enabled
        and profile.stream_cache
        and stream.status == "Started"
        and stream.mode == "Sync"
    )
    if not eligible:
        return ExportResult("ineligible")

    current = profile.use_current_time or scheduled is None or schedule.lower() == NEVER.lower()
    data_time = now if current else scheduled
    directory = root
    if profile.mirror:
        directory = f"{root}/{table_directory(spark, profile, stream, data_time)}"
    history = store.history()
    last = _last_export(history, stream.stream_id)
    if profile.mirror and not landing.has_metadata(spark, *directory.rsplit("/", 1)):
        last = None
    if profile.mirror and last is not None and last["DataTime"] == data_time:
        return ExportResult("skipped", data_time=data_time)

    name = output_name(spark, profile, stream, data_time, last)
    found = described(spark, _target(directory, name))
    if found is not None:
        if manual:
            data_time = now
            name = output_name(spark, profile, stream, data_time, last)
        elif found == _description(stream, data_time):
            return ExportResult("skipped", _target(directory, name), name, None, data_time)

    if profile.mirror:
        landing.prepare_landing_zone(
            spark, root, directory.rsplit("/", 1)[1], profile, initial=last is None, partner=partner
        )
    entry = {
        "StreamId": stream.stream_id,
        "DataTime": data_time,
        "TriggerSource": ledger.JOB_SERVER if manual else ledger.SCHEDULER,
        "CronSchedule": schedule,
        "FilePath": name,
        "FileFormat": profile.format,
        "StartTime": now,
        "Status": ledger.STARTING,
        "ExporterHostName": socket.gethostname(),
    }
    store.record(entry)
    log = store.patches([stream.stream_id])
    last_time = None if last is None else _literal(last["DataTime"])
    rows = writers.prepare(export_rows(log, profile, _literal(data_time), last_time), profile)
    target = _target(directory, name)
    began = time.monotonic()
    count = publish(
        rows,
        target,
        lambda df, path: writers.write(df, path, profile),
        _description(stream, data_time),
        keep_empty=profile.allow_empty or not profile.delta_mode,
    )
    written = count > 0 or profile.allow_empty or not profile.delta_mode
    if written:
        if profile.load_table:
            load_table(_read_back(spark, target, profile), table_directory(spark, profile, stream, data_time))
        if profile.after is not None:
            profile.after(spark, target, rows)
    ended = now + dt.timedelta(seconds=time.monotonic() - began)
    store.record({**entry, "EndTime": ended, "TotalRows": count, "Status": ledger.COMPLETE})
    return ExportResult("exported", target if written else None, name, count, data_time)


def run_delta(
    store: ChangeStore, root: str, profile: ExportProfile, stream: Stream, now: dt.datetime
) -> ExportResult:
    """What changed since the last export of the stream, up to now."""
    return run_export(store, root, profile.with_options(delta_mode=True), stream, now)


def archive_stream(
    store: ChangeStore,
    root: str,
    profile: ExportProfile,
    stream: Stream,
    now: dt.datetime,
    events: EventStream | None = None,
) -> str:
    """Set a stream aside: flush its waiting events, archive its changes.

    A mirrored target also loses the directory of its table.
    """
    if events is not None:
        events.flush()
    path = store.archive(stream.stream_id, now.strftime("%Y%m%d%H%M%S"))
    if profile.mirror:
        files.delete(store.spark, f"{root.rstrip('/')}/{table_directory(store.spark, profile, stream, now)}")
    return path


def load_table(rows: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a table by the exported rows; its files go to the warehouse unless named."""
    writer = rows.write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name.replace("-", "_"))


def _read_back(spark: SparkSession, path: str, profile: ExportProfile) -> DataFrame:
    if profile.format == "csv":
        return spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(path)
    return spark.read.parquet(path)


def _target(directory: str, name: str) -> str:
    """A colon cannot be part of a path, so it becomes ``-``."""
    return f"{directory}/{name.replace(':', '-')}"


def _description(stream: Stream, data_time: dt.datetime) -> dict[str, str]:
    return {"StreamId": stream.stream_id, "DataTime": data_time.isoformat()}


def _last_export(history: DataFrame, stream_id: str) -> dict | None:
    """The last completed export of a stream: at most one row."""
    rows = ledger.last_export(history.where(F.col("StreamId") == stream_id)).collect()
    return rows[0].asDict() if rows else None
