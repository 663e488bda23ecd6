"""The export ledger: which run of which stream wrote what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.schedule import by_name, next_instant, previous_instant, seconds, step_seconds

LEDGER_SCHEMA = (
    "StreamId string, DataTime timestamp_ntz, TriggerSource string, CronSchedule string, "
    "FilePath string, FileFormat string, StartTime timestamp_ntz, EndTime timestamp_ntz, "
    "TotalRows bigint, Status string, ExporterHostName string"
)
LEDGER_COLUMNS = tuple(part.split()[0] for part in LEDGER_SCHEMA.split(", "))
RUN_KEY = LEDGER_COLUMNS[:4]
STARTING, COMPLETE = "Starting", "Complete"
JOB_SERVER, SCHEDULER = "JobServer", "InternalScheduler"


def ledger_state(entries: DataFrame) -> DataFrame:
    """The state of each run from its appended entries: the last start, completed if it was."""
    rest = [c for c in LEDGER_COLUMNS if c not in RUN_KEY]
    newest = F.struct("StartTime", (F.col("Status") == COMPLETE).alias("done"), "FilePath")
    state = entries.groupBy(*RUN_KEY).agg(F.max_by(F.struct(*rest), newest).alias("s"))
    return state.select(*RUN_KEY, "s.*").select(*LEDGER_COLUMNS)


def last_export(history: DataFrame) -> DataFrame:
    """The completed export with the latest data time, per stream."""
    rest = [c for c in LEDGER_COLUMNS if c != "StreamId"]
    newest = F.struct("DataTime", "StartTime", "TriggerSource", "CronSchedule")
    done = history.where(F.col("Status") == COMPLETE)
    return (
        done.groupBy("StreamId")
        .agg(F.max_by(F.struct(*rest), newest).alias("s"))
        .select("StreamId", "s.*")
    )


def has_exported(history: DataFrame, requests: DataFrame) -> DataFrame:
    """The requested runs that are in the ledger."""
    return requests.join(history.select(*RUN_KEY), list(RUN_KEY), "left_semi")


def export_history(history: DataFrame, n: int = 1000) -> DataFrame:
    """The latest ``n`` runs of each stream; the run key settles equal start times."""
    newest = Window.partitionBy("StreamId").orderBy(F.col("StartTime").desc(), *RUN_KEY)
    return history.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= n).drop("_n")


def decide(requests: DataFrame, outputs: DataFrame, mirror: DataFrame | None = None) -> DataFrame:
    """What a run does, as column ``action``.

    ``requests``: StreamId, DataTime, TriggerSource, FilePath. ``outputs``: FilePath and
    the StreamId and DataTime it was written for. ``mirror``: last data time per stream
    of a mirrored target, where the same data time means there is nothing to do.
    """
    found = outputs.select(
        "FilePath", F.col("StreamId").alias("_stream"), F.col("DataTime").alias("_time"), F.lit(True).alias("_found")
    )
    rows = requests.join(found, "FilePath", "left")
    action = (
        F.when(F.col("_found").isNull(), "write")
        .when(F.col("TriggerSource") == JOB_SERVER, "write_current")
        .when((F.col("_stream") == F.col("StreamId")) & (F.col("_time") == F.col("DataTime")), "skip")
        .otherwise("overwrite")
    )
    if mirror is not None:
        last = mirror.select("StreamId", F.col("DataTime").alias("_last"))
        rows = rows.join(last, "StreamId", "left")
        action = F.when(F.col("_last").eqNullSafe(F.col("DataTime")), "skip").otherwise(action)
    return rows.withColumn("action", action).select(*requests.columns, "action")


def next_sequence(last: DataFrame) -> DataFrame:
    """Number of the next sequential file; it moves on only past a file that had rows."""
    number = F.regexp_extract("FilePath", r"(\d+)\.[^./]*$", 1).cast("bigint")
    step = F.when(F.coalesce("TotalRows", F.lit(0)) > 0, 1).otherwise(0)
    return last.withColumn("sequence", number + step).select("StreamId", "sequence")


def sequence_name(sequence: Column, extension: Column) -> Column:
    """A sequential file name: twenty digits and the lower-case format."""
    return F.concat(F.lpad(sequence.cast("string"), 20, "0"), F.lit("."), F.lower(extension))


def start_from(streams: DataFrame) -> Column:
    """The later of (stream modified, else created) and target created."""
    return F.greatest(F.coalesce("modified_at", "created_at"), F.col("target_created_at"))


def missed_runs(
    streams: DataFrame, history: DataFrame, now: Column, latest_only: bool = False
) -> DataFrame:
    """Scheduled instants of the last month, after the stream began, without a ledger row.

    ``streams``: stream_id, schedule, created_at, modified_at, target_created_at.
    ``latest_only`` looks at the previous instant alone. Schedule names compare in any
    case; one that isn't known is an error.
    """
    schedule = F.col("schedule")
    floor = now - F.expr("INTERVAL '1' MONTH")
    lowest = F.greatest(start_from(streams), floor)
    first = by_name(schedule, lambda name: next_instant(lowest, name))
    last = by_name(schedule, lambda name: previous_instant(now, name))
    step = by_interval(schedule)
    rows = streams.withColumn("_last", last).withColumn("_first", first)
    if latest_only:
        rows = rows.withColumn("_first", F.when(F.col("_first") <= F.col("_last"), F.col("_last")))
    expected = rows.where(F.col("_first") <= F.col("_last")).select(
        F.col("stream_id").alias("StreamId"),
        F.explode(F.sequence("_first", "_last", step)).alias("DataTime"),
        F.lit(SCHEDULER).alias("TriggerSource"),
        schedule.alias("CronSchedule"),
    )
    key = [F.lower(c) if c == "CronSchedule" else F.col(c) for c in RUN_KEY]
    ran = history.where(F.col("DataTime") >= floor).select(*(k.alias(f"_ran_{c}") for k, c in zip(key, RUN_KEY, strict=True)))
    same = [k == F.col(f"_ran_{c}") for k, c in zip(key, RUN_KEY, strict=True)]
    return expected.join(ran, same, "left_anti")


def by_interval(schedule: Column) -> Column:
    """The step between two instants of a schedule column."""
    step = F.lit(None).cast("interval day to second")
    for name in ("Hourly", "Daily", "Weekly"):
        step = F.when(F.lower(schedule) == name.lower(), seconds(step_seconds(name))).otherwise(step)
    return step
