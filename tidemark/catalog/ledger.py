"""Ledger, schedule and stream queries (groups E10, G, H and J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog.sql import LINEITEM, stream
from tidemark.functions import schedule
from tidemark.functions.text import instant
from tidemark.operators import ledger as led
from tidemark.operators import streams as st
from tidemark.sources import control
from tidemark.sources.change_logs import lineitem_log, table

NOW = "1998-08-02 00:30:00"

_ENTRIES = f"""runs AS (
  SELECT {stream('o_custkey')} AS "StreamId", o_orderdate AS "DataTime",
    CASE WHEN o_orderkey % 4 = 0 THEN 'JobServer' ELSE 'InternalScheduler' END AS "TriggerSource",
    'Daily' AS "CronSchedule", lpad(CAST(o_orderkey AS VARCHAR), 20, '0') || '.parquet' AS "FilePath",
    'parquet' AS "FileFormat", o_orderdate + to_seconds(o_orderkey % 86400) AS "StartTime",
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_seconds(o_orderkey % 86400 + 30) END AS "EndTime",
    CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(fmod(o_totalprice, 7)) AS BIGINT) END AS "TotalRows",
    CASE WHEN o_orderstatus <> 'P' THEN 'Complete' ELSE 'Starting' END AS "Status",
    'host-1' AS "ExporterHostName"
  FROM orders),
history AS (
  SELECT * FROM runs QUALIFY row_number() OVER (
    PARTITION BY "StreamId", "DataTime", "TriggerSource", "CronSchedule"
    ORDER BY "StartTime" DESC, "Status" = 'Complete' DESC, "FilePath" DESC) = 1)"""

_LEDGER = ", ".join(f'"{c}"' for c in led.LEDGER_COLUMNS if c != "TotalRows")
_ROWS = 'coalesce("TotalRows", -1) AS "TotalRows"'


def _history(spark, folder):
    return led.ledger_state(control.ledger_entries(spark, folder))


@query("g1_ledger_state", f"WITH {_ENTRIES} SELECT {_LEDGER}, {_ROWS} FROM history")
def g1_ledger_state(spark, folder):
    return _history(spark, folder).fillna({"TotalRows": -1})


_LAST = f"""{_ENTRIES}, last AS (
  SELECT * FROM history WHERE "Status" = 'Complete' QUALIFY row_number() OVER (
    PARTITION BY "StreamId" ORDER BY "DataTime" DESC, "StartTime" DESC, "TriggerSource" DESC) = 1)"""


@query("g2_last_export", f"WITH {_LAST} SELECT {_LEDGER}, {_ROWS} FROM last")
def g2_last_export(spark, folder):
    return led.last_export(_history(spark, folder))


@query("e10_next_sequence", f"""WITH {_LAST} SELECT "StreamId",
    lpad(CAST(CAST(substr("FilePath", 1, 20) AS BIGINT) + CASE WHEN "TotalRows" > 0 THEN 1 ELSE 0 END AS VARCHAR), 20, '0')
      || '.csv' AS name FROM last""")
def e10_next_sequence(spark, folder):
    following = led.next_sequence(led.last_export(_history(spark, folder)))
    return following.select("StreamId", led.sequence_name(F.col("sequence"), F.lit("CSV")).alias("name"))


_REQUESTS = f"""requests AS (
  SELECT o_orderkey, {stream('o_custkey')} AS "StreamId",
    o_orderdate + INTERVAL 1 DAY * (o_orderkey % 2) AS "DataTime",
    CASE WHEN o_orderkey % 4 = 0 THEN 'JobServer' ELSE 'InternalScheduler' END AS "TriggerSource",
    'Daily' AS "CronSchedule",
    lpad(CAST(o_orderkey - o_orderkey % 3 AS VARCHAR), 20, '0') || '.parquet' AS "FilePath"
  FROM orders)"""


def _requests(spark, folder):
    """A run per order; odd ones ask for the day after, some for the file of another."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        control.stream_guid(F.col("o_custkey")).alias("StreamId"),
        (F.col("o_orderdate") + F.make_dt_interval(days=(key % 2).cast("int"))).alias("DataTime"),
        F.when(key % 4 == 0, "JobServer").otherwise("InternalScheduler").alias("TriggerSource"),
        F.lit("Daily").alias("CronSchedule"),
        F.concat(F.lpad((key - key % 3).cast("string"), 20, "0"), F.lit(".parquet")).alias("FilePath"),
    )


@query("g3_has_exported", f"""WITH {_ENTRIES}, {_REQUESTS} SELECT * FROM requests r WHERE EXISTS (
    SELECT 1 FROM history h WHERE h."StreamId" = r."StreamId" AND h."DataTime" = r."DataTime"
      AND h."TriggerSource" = r."TriggerSource" AND h."CronSchedule" = r."CronSchedule")""")
def g3_has_exported(spark, folder):
    return led.has_exported(_history(spark, folder), _requests(spark, folder))


@query("g4_export_history", f"""WITH {_ENTRIES} SELECT {_LEDGER}, {_ROWS} FROM history
    QUALIFY row_number() OVER (PARTITION BY "StreamId"
      ORDER BY "StartTime" DESC, "DataTime", "TriggerSource", "CronSchedule") <= 1000""")
def g4_export_history(spark, folder):
    return led.export_history(_history(spark, folder)).fillna({"TotalRows": -1})


_ACTION = """CASE WHEN h."FilePath" IS NULL THEN 'write'
    WHEN r."TriggerSource" = 'JobServer' THEN 'write_current'
    WHEN h."StreamId" = r."StreamId" AND h."DataTime" = r."DataTime" THEN 'skip' ELSE 'overwrite' END"""
_DONE = """(SELECT * FROM history WHERE "Status" = 'Complete')"""


@query("g5_decide", f"""WITH {_ENTRIES}, {_REQUESTS} SELECT r.*, {_ACTION} AS action
    FROM requests r LEFT JOIN {_DONE} h ON h."FilePath" = r."FilePath" """)
def g5_decide(spark, folder):
    outputs = _history(spark, folder).where("Status = 'Complete'")
    return led.decide(_requests(spark, folder), outputs)


@query("g6_decide_mirror", f"""WITH {_LAST}, {_REQUESTS} SELECT r.*,
    CASE WHEN l."DataTime" = r."DataTime" THEN 'skip' ELSE {_ACTION} END AS action
    FROM requests r LEFT JOIN {_DONE} h ON h."FilePath" = r."FilePath"
    LEFT JOIN last l ON l."StreamId" = r."StreamId" """)
def g6_decide_mirror(spark, folder):
    history = _history(spark, folder)
    outputs = history.where("Status = 'Complete'")
    return led.decide(_requests(spark, folder), outputs, mirror=led.last_export(history))


def _instants_sql(unit: str, step: str) -> str:
    return f"""CASE WHEN date_trunc('{unit}', ts) = ts THEN ts - INTERVAL {step}
      ELSE CAST(date_trunc('{unit}', ts) AS TIMESTAMP) END AS previous_{unit},
    CAST(date_trunc('{unit}', ts) AS TIMESTAMP) + INTERVAL {step} AS next_{unit}"""


@query("h1_schedule_instants", f"""WITH times AS (
    SELECT 'e' || event_id AS id, ts FROM events UNION ALL SELECT 'o' || o_orderkey, o_orderdate FROM orders)
  SELECT id, {_instants_sql('hour', '1 HOUR')}, {_instants_sql('day', '1 DAY')}, {_instants_sql('week', '7 DAY')}
  FROM times""")
def h1_schedule_instants(spark, folder):
    events = table(spark, folder, "events").select(F.concat(F.lit("e"), "event_id").alias("id"), "ts")
    orders = table(spark, folder, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("id"), F.col("o_orderdate").alias("ts")
    )
    ts = F.col("ts")
    columns = []
    for unit, name in (("hour", "Hourly"), ("day", "daily"), ("week", "WEEKLY")):
        columns.append(schedule.previous_instant(ts, name).alias(f"previous_{unit}"))
        columns.append(schedule.next_instant(ts, name).alias(f"next_{unit}"))
    return events.unionAll(orders).select("id", *columns)


@query("h2_as_of_time", f"""SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_custkey % 4 = 2
    THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{control.CREATED}' END AS data_time FROM customer""")
def h2_as_of_time(spark, folder):
    cust = table(spark, folder, "customer")
    kind = F.when(F.col("c_custkey") % 4 == 2, "never").otherwise("Daily")
    time = schedule.as_of_time(F.col("c_acctbal") < 0, kind, instant(control.CREATED), instant(NOW))
    return cust.select("c_custkey", time.alias("data_time"))


_STREAMS = f"""streams AS (SELECT {stream('c_custkey')} AS stream_id, c_nationkey AS provider_id,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'Stopped' ELSE 'Started' END AS status,
    CASE c_mktsegment WHEN 'FURNITURE' THEN 'EventStream' ELSE 'Sync' END AS mode,
    c_acctbal > 0 AS cache_enabled,
    CASE c_custkey % 4 WHEN 0 THEN 'Weekly' WHEN 1 THEN 'daily' WHEN 2 THEN 'Never' ELSE 'Hourly' END AS schedule,
    TIMESTAMP '{control.CREATED}' AS created_at,
    CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '{control.CREATED}' + INTERVAL 1 DAY * (c_custkey % 20) END AS modified_at
  FROM customer),
providers AS (SELECT n_nationkey AS provider_id, n_regionkey <> 3 AS is_enabled,
    CASE WHEN n_nationkey % 2 = 0 THEN TIMESTAMP '{control.CREATED}' + INTERVAL 1 DAY * n_nationkey END AS target_created_at
  FROM nation),
eligible AS (SELECT s.*, p.target_created_at FROM streams s JOIN providers p USING (provider_id)
  WHERE is_enabled AND status = 'Started' AND mode = 'Sync' AND cache_enabled)"""


def _eligible(spark, folder):
    return st.eligible_streams(control.streams(spark, folder), control.providers(spark, folder))


def _missed_sql(latest_only: bool) -> str:
    last_only = """QUALIFY row_number() OVER (PARTITION BY stream_id ORDER BY due DESC) = 1""" if latest_only else ""
    return f"""WITH {_ENTRIES}, {_STREAMS},
    hours AS (SELECT unnest(generate_series(
      TIMESTAMP '1998-06-01', TIMESTAMP '1998-09-01', INTERVAL 1 HOUR)) AS due),
    expected AS (SELECT stream_id, schedule, due FROM eligible, hours
      WHERE due > greatest(coalesce(modified_at, created_at), coalesce(target_created_at, created_at),
          TIMESTAMP '{NOW}' - INTERVAL 1 MONTH)
        AND due < TIMESTAMP '{NOW}'
        AND (schedule = 'Hourly' OR (schedule = 'daily' AND date_trunc('day', due) = due)
          OR (schedule = 'Weekly' AND date_trunc('week', due) = due)) {last_only})
    SELECT stream_id AS "StreamId", due AS "DataTime", 'InternalScheduler' AS "TriggerSource", schedule AS "CronSchedule"
    FROM expected e WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h."StreamId" = e.stream_id
      AND h."DataTime" = e.due AND h."TriggerSource" = 'InternalScheduler' AND lower(h."CronSchedule") = lower(e.schedule))"""


def _missed(spark, folder, latest_only):
    """The ledger spells the schedule Daily, the streams spell it daily."""
    return led.missed_runs(_eligible(spark, folder), _history(spark, folder), instant(NOW), latest_only)


@query("h3_missed_runs", _missed_sql(False))
def h3_missed_runs(spark, folder):
    return _missed(spark, folder, latest_only=False)


@query("h3_missed_latest_run", _missed_sql(True))
def h3_missed_latest_run(spark, folder):
    return _missed(spark, folder, latest_only=True)


@query("h4_start_from", f"""WITH {_STREAMS} SELECT stream_id,
    greatest(coalesce(modified_at, created_at), coalesce(target_created_at, TIMESTAMP '1970-01-01')) AS start_from
    FROM eligible""")
def h4_start_from(spark, folder):
    rows = _eligible(spark, folder)
    return rows.select("stream_id", led.start_from(rows).alias("start_from"))


@query("j1_eligible_streams", f"WITH {_STREAMS} SELECT stream_id, provider_id, schedule FROM eligible")
def j1_eligible_streams(spark, folder):
    return _eligible(spark, folder).select("stream_id", "provider_id", "schedule")


@query("j2_restrict_changes", f"""WITH {LINEITEM}, {_STREAMS} SELECT stream_id, id, change_type, ts, seq
    FROM li WHERE stream_id IN (SELECT stream_id FROM eligible)""")
def j2_restrict_changes(spark, folder):
    log = st.restrict(lineitem_log(spark, folder), _eligible(spark, folder))
    return log.select("stream_id", "id", "change_type", "ts", "seq")


@query("j3_obsolete_streams", f"""WITH {_ENTRIES}, {_STREAMS} SELECT DISTINCT "StreamId" AS stream_id FROM history
    WHERE "StreamId" NOT IN (SELECT stream_id FROM streams WHERE status = 'Started')""")
def j3_obsolete_streams(spark, folder):
    """Streams in the ledger that are no longer running."""
    running = control.streams(spark, folder).where("status = 'Started'")
    return st.obsolete_streams(_history(spark, folder), running)
