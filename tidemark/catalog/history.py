"""State, versions and point-in-time queries (groups B, C and H5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog.sql import (
    EVENTS,
    EVENTS_PAYLOAD,
    LINEITEM,
    LINEITEM_PAYLOAD,
    hard_versions,
    micros,
    soft_versions,
)
from tidemark.functions.text import instant
from tidemark.operators import series, state, temporal
from tidemark.operators.versions import current_versions, patch_versions, versions
from tidemark.sources.change_logs import events_log, lineitem_log, table

EV_T, EV_LAST = "2024-01-20 00:00:00", "2024-01-10 00:00:00"
LI_T, LI_LAST = "1999-01-01 00:00:00", "1998-01-01 00:00:00"
EV_LO, EV_HI = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
LI_LO, LI_HI = "1992-01-06 00:00:00", "1998-12-28 00:00:00"

EV_COLS = ", ".join(EVENTS_PAYLOAD)
LI_COLS = ", ".join(LINEITEM_PAYLOAD)
_LAST = "row_number() OVER (PARTITION BY stream_id, id ORDER BY ts DESC, seq DESC) = 1"


def period_text(ver: DataFrame) -> DataFrame:
    """Periods as text: the open end lies beyond what many readers can hold."""
    text = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return ver.withColumns(
        {c: F.date_format(F.col(c), text) for c in ("valid_from", "valid_to")}
    )


def _li_log_hard(t: str) -> str:
    return f"""WITH {LINEITEM}, last AS (
      SELECT * FROM li WHERE ts <= TIMESTAMP '{t}' QUALIFY {_LAST})
    SELECT stream_id, id, change_type, ts, seq, {LI_COLS} FROM last WHERE change_type <> 'Removed'"""


@query("b1_current_state", f"""WITH {LINEITEM}, last AS (SELECT * FROM li QUALIFY {_LAST})
    SELECT stream_id, id, change_type, ts, seq, {LI_COLS} FROM last WHERE change_type <> 'Removed'""")
def b1_current_state(spark, folder):
    return state.current_state(lineitem_log(spark, folder))


@query("b1_current_state_soft", f"""WITH {EVENTS}, {soft_versions('ev', EVENTS_PAYLOAD)}
    SELECT stream_id, id, change_type, valid_from AS ts, seq, {EV_COLS} FROM ver
    WHERE valid_to = TIMESTAMP '9999-12-31'""")
def b1_current_state_soft(spark, folder):
    return state.current_state(events_log(spark, folder), soft=True)


def property_log(spark, folder):
    """Events as patches: each sets one key named after its type."""
    log = events_log(spark, folder)
    value = F.col("value").cast("decimal(18,2)").cast("string")
    return log.withColumn("properties", F.create_map(F.col("event_type"), value))


_PATCH = """numbered AS (
  SELECT *, sum(CASE WHEN change_type = 'Removed' THEN {reset} ELSE 0 END) OVER (
    PARTITION BY stream_id, id ORDER BY ts, seq) AS life,
    last_value(change_type) OVER (PARTITION BY stream_id, id ORDER BY ts, seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_type
  FROM ev),
latest AS (SELECT *, max(life) OVER (PARTITION BY stream_id, id) AS last_life FROM numbered)
SELECT stream_id, id, last_type AS change_type, event_type AS key,
  CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value
FROM latest WHERE change_type <> 'Removed' AND life = last_life
QUALIFY row_number() OVER (PARTITION BY stream_id, id, event_type ORDER BY ts DESC, seq DESC) = 1"""


def _exploded(patched: DataFrame) -> DataFrame:
    return patched.select("stream_id", "id", "change_type", F.explode("properties"))


@query("b2_patch_state_hard", f"WITH {EVENTS}, {_PATCH.format(reset=1)}")
def b2_patch_state_hard(spark, folder):
    return _exploded(state.patch_state(property_log(spark, folder)))


@query("b2_patch_state_soft", f"WITH {EVENTS}, {_PATCH.format(reset=0)}")
def b2_patch_state_soft(spark, folder):
    return _exploded(state.patch_state(property_log(spark, folder), soft=True))


def _version_sql(payload: str) -> str:
    return f"""SELECT stream_id, id, change_type, {micros('valid_from')} AS valid_from,
      {micros('valid_to')} AS valid_to, seq, {payload} FROM ver"""


@query("b3_versions_hard", f"WITH {LINEITEM}, {hard_versions('li')} {_version_sql(LI_COLS)}")
def b3_versions_hard(spark, folder):
    return period_text(versions(lineitem_log(spark, folder)))


@query("b4_versions_soft", f"WITH {LINEITEM}, {soft_versions('li', LINEITEM_PAYLOAD)} {_version_sql(LI_COLS)}")
def b4_versions_soft(spark, folder):
    return period_text(versions(lineitem_log(spark, folder), soft=True))


@query("b2_patch_cells_hard", f"WITH {EVENTS}, {_PATCH.format(reset=1)}")
def b2_patch_cells_hard(spark, folder):
    return state.patch_cells(property_log(spark, folder))


@query("b2_patch_cells_soft", f"WITH {EVENTS}, {_PATCH.format(reset=0)}")
def b2_patch_cells_soft(spark, folder):
    return state.patch_cells(property_log(spark, folder), soft=True)


_KINDS = ("click", "purchase", "signup", "view")


def _patched_sql(reset: int) -> str:
    cells = ", ".join(
        f"""last_value(CASE WHEN event_type = '{k}' AND change_type <> 'Removed'
          THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END IGNORE NULLS) OVER (
          PARTITION BY stream_id, id, life ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS {k}"""
        for k in _KINDS
    )
    gone = "change_type = 'Removed'" if reset else "writes = 0"
    return f"""WITH {EVENTS}, lives AS (SELECT *,
      sum(CASE WHEN change_type = 'Removed' THEN {reset} ELSE 0 END) OVER w AS life,
      sum(CASE WHEN change_type <> 'Removed' THEN 1 ELSE 0 END) OVER w AS writes,
      coalesce(lead(ts) OVER (PARTITION BY stream_id, id ORDER BY ts, seq), TIMESTAMP '9999-12-31') AS valid_to
    FROM ev WINDOW w AS (PARTITION BY stream_id, id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)),
    cells AS (SELECT *, ts AS valid_from, {cells} FROM lives)
    SELECT stream_id, id, change_type, {micros('valid_from')} AS valid_from, {micros('valid_to')} AS valid_to,
      seq, {", ".join(_KINDS)} FROM cells WHERE NOT ({gone})"""


@query("b2_patch_versions_hard", _patched_sql(1))
def b2_patch_versions_hard(spark, folder):
    return period_text(patch_versions(property_log(spark, folder), _KINDS))


@query("b2_patch_versions_soft", _patched_sql(0))
def b2_patch_versions_soft(spark, folder):
    return period_text(patch_versions(property_log(spark, folder), _KINDS, soft=True))


_REJECTED = """WITH {log}, before AS (SELECT *,
      lag(change_type) OVER (PARTITION BY stream_id, id ORDER BY ts, seq) AS previous,
      sum(CASE WHEN change_type <> 'Removed' THEN 1 ELSE 0 END) OVER (
        PARTITION BY stream_id, id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS writes
    FROM {name})
    SELECT stream_id, id, change_type, ts, seq, {cols} FROM before
    WHERE change_type = 'Removed' AND {orphan}"""
_HARD_ORPHAN = "(previous IS NULL OR previous = 'Removed')"


@query("b5_rejected_hard", _REJECTED.format(log=LINEITEM, name="li", cols=LI_COLS, orphan=_HARD_ORPHAN))
def b5_rejected_hard(spark, folder):
    return state.rejected(lineitem_log(spark, folder))


@query("b5_rejected_soft", _REJECTED.format(log=EVENTS, name="ev", cols=EV_COLS, orphan="writes = 0"))
def b5_rejected_soft(spark, folder):
    return state.rejected(events_log(spark, folder), soft=True)


@query("b6_history_hard", f"WITH {EVENTS}, {hard_versions('ev')} {_version_sql(EV_COLS)}")
def b6_history_hard(spark, folder):
    return period_text(versions(events_log(spark, folder)))


@query("b6_history_soft", f"WITH {EVENTS}, {soft_versions('ev', EVENTS_PAYLOAD)} {_version_sql(EV_COLS)}")
def b6_history_soft(spark, folder):
    return period_text(versions(events_log(spark, folder), soft=True))


@query("b6_current_versions", f"""WITH {EVENTS}, {hard_versions('ev')} {_version_sql(EV_COLS)}
    WHERE valid_to = TIMESTAMP '9999-12-31'""")
def b6_current_versions(spark, folder):
    return period_text(current_versions(versions(events_log(spark, folder))))


def _visible(t: str) -> str:
    return f"valid_from <= TIMESTAMP '{t}' AND TIMESTAMP '{t}' < valid_to"


@query("c1_as_of_soft", f"""WITH {LINEITEM}, {soft_versions('li', LINEITEM_PAYLOAD)}
    SELECT stream_id, id, change_type, seq, {LI_COLS} FROM ver WHERE {_visible(LI_T)}""")
def c1_as_of_soft(spark, folder):
    return temporal.as_of(versions(lineitem_log(spark, folder), soft=True), instant(LI_T))


@query("c1_snapshot", _li_log_hard(LI_T))
def c1_snapshot(spark, folder):
    return temporal.snapshot(lineitem_log(spark, folder), instant(LI_T))


@query("c1_snapshot_soft", f"""WITH {LINEITEM}, {soft_versions('li', LINEITEM_PAYLOAD)}
    SELECT stream_id, id, change_type, valid_from AS ts, seq, {LI_COLS} FROM ver WHERE {_visible(LI_T)}""")
def c1_snapshot_soft(spark, folder):
    return temporal.snapshot(lineitem_log(spark, folder), instant(LI_T), soft=True)


@query("c2_delta_soft", f"""WITH {LINEITEM}, {soft_versions('li', LINEITEM_PAYLOAD)}
    SELECT stream_id, id, change_type, seq, {LI_COLS} FROM ver
    WHERE {_visible(LI_T)} AND valid_from > TIMESTAMP '{LI_LAST}'""")
def c2_delta_soft(spark, folder):
    ver = versions(lineitem_log(spark, folder), soft=True)
    return temporal.delta(ver, instant(LI_T), instant(LI_LAST))


@query("c2_changes_since_hard", f"""WITH {LINEITEM}, {hard_versions('li')}
    SELECT stream_id, id, change_type, valid_from AS ts, seq, {LI_COLS} FROM ver
    WHERE {_visible(LI_T)} AND valid_from > TIMESTAMP '{LI_LAST}'""")
def c2_changes_since_hard(spark, folder):
    return temporal.changes_since(lineitem_log(spark, folder), instant(LI_T), instant(LI_LAST))


@query("c2_changes_since_soft", f"""WITH {LINEITEM}, {soft_versions('li', LINEITEM_PAYLOAD)}
    SELECT stream_id, id, change_type, valid_from AS ts, seq, {LI_COLS} FROM ver
    WHERE {_visible(LI_T)} AND valid_from > TIMESTAMP '{LI_LAST}'""")
def c2_changes_since_soft(spark, folder):
    log = lineitem_log(spark, folder)
    return temporal.changes_since(log, instant(LI_T), instant(LI_LAST), soft=True)


@query("c3_count_as_of", f"""WITH {LINEITEM}, {hard_versions('li')}
    SELECT stream_id, count(*) AS row_count FROM ver WHERE {_visible(LI_T)} GROUP BY stream_id""")
def c3_count_as_of(spark, folder):
    return temporal.count_as_of(lineitem_log(spark, folder), instant(LI_T))


@query("c4_entity_as_of", f"""WITH {EVENTS}, {soft_versions('ev', EVENTS_PAYLOAD)}
    SELECT stream_id, id, change_type, valid_from AS ts, seq, {EV_COLS} FROM ver
    WHERE id = '7' AND {_visible(EV_T)}""")
def c4_entity_as_of(spark, folder):
    return temporal.entity_as_of(events_log(spark, folder), "7", instant(EV_T), soft=True)


_ARGUMENT = """CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
    WHEN 1 THEN strftime(ts, '%Y-%m-%d') WHEN 2 THEN props END"""


@query("c5_resolve_time", f"""SELECT event_id,
      CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN date_trunc('day', ts)
        ELSE TIMESTAMP '2024-02-01' END AS data_time,
      event_id % 4 > 1 AS is_current
    FROM events""")
def c5_resolve_time(spark, folder):
    """Times given as ISO text with an offset, as a date, as junk, or not at all."""
    kind = F.col("event_id") % 4
    argument = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == 2, F.col("props"))
    )
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    time = temporal.resolve_time(argument, instant("2024-02-01 00:00:00"))
    return events.select("event_id", time.alias("time")).select("event_id", "time.*")


_REQUESTS = f"""requests AS (
  SELECT event_id AS request_id, stream_id, id, ts + INTERVAL 2 HOUR AS t
  FROM (SELECT *, seq AS event_id FROM ev))"""


def _requests(log: DataFrame) -> DataFrame:
    """Ask for the state of each changed entity two hours after the change."""
    hours = F.expr("INTERVAL '2' HOUR")
    return log.select(F.col("seq").alias("request_id"), "stream_id", "id", (F.col("ts") + hours).alias("t"))


def _lookup_sql(ver: str) -> str:
    cols = ", ".join(f"v.{c}" for c in EVENTS_PAYLOAD)
    return f"""WITH {EVENTS}, {ver}, {_REQUESTS}
    SELECT r.request_id, r.stream_id, r.id, r.t, v.change_type, v.valid_from, v.seq, {cols}
    FROM requests r JOIN ver v ON r.stream_id = v.stream_id AND r.id = v.id
      AND v.valid_from <= r.t AND r.t < v.valid_to"""


@query("c6_lookup_as_of_hard", _lookup_sql(hard_versions("ev")))
def c6_lookup_as_of_hard(spark, folder):
    log = events_log(spark, folder)
    return temporal.lookup_as_of(log, _requests(log))


@query("c6_lookup_as_of_soft", _lookup_sql(soft_versions("ev", EVENTS_PAYLOAD)))
def c6_lookup_as_of_soft(spark, folder):
    log = events_log(spark, folder)
    return temporal.lookup_as_of(log, _requests(log), soft=True)


def _instants(lo: str, hi: str, step: str) -> str:
    return f"""instants AS (SELECT unnest(generate_series(
      TIMESTAMP '{lo}', TIMESTAMP '{hi}', INTERVAL {step})) AS instant)"""


_SEEN = "valid_from <= instant AND instant < valid_to"


@query("c7_snapshot_series", f"""WITH {EVENTS}, {hard_versions('ev')}, {_instants(EV_LO, EV_HI, '1 DAY')}
    SELECT instant, stream_id, id, change_type, seq, {EV_COLS}
    FROM instants JOIN ver ON {_SEEN}""")
def c7_snapshot_series(spark, folder):
    ver = versions(events_log(spark, folder))
    return series.snapshot_series(ver, 86_400, EV_LO, EV_HI)


@query("c7_weekly_snapshot_counts", f"""WITH {LINEITEM}, {hard_versions('li')}, {_instants(LI_LO, LI_HI, '7 DAY')}
    SELECT instant, stream_id, count(*) AS row_count
    FROM instants JOIN ver ON {_SEEN} GROUP BY instant, stream_id""")
def c7_weekly_snapshot_counts(spark, folder):
    ver = versions(lineitem_log(spark, folder))
    return series.snapshot_counts(ver, 604_800, LI_LO, LI_HI)


def _delta_series_sql(lo: str, step: str) -> str:
    return f"""{_SEEN} AND (instant = TIMESTAMP '{lo}' OR valid_from > instant - INTERVAL {step})"""


@query("c8_delta_series", f"""WITH {EVENTS}, {soft_versions('ev', EVENTS_PAYLOAD)}, {_instants(EV_LO, EV_HI, '1 DAY')}
    SELECT instant, stream_id, id, change_type, seq, {EV_COLS}
    FROM instants JOIN ver ON {_delta_series_sql(EV_LO, '1 DAY')}""")
def c8_delta_series(spark, folder):
    ver = versions(events_log(spark, folder), soft=True)
    return series.delta_series(ver, 86_400, EV_LO, EV_HI)


@query("h5_delta_counts", f"""WITH {LINEITEM}, {hard_versions('li')}, {_instants(LI_LO, LI_HI, '7 DAY')}
    SELECT stream_id, instant, count(*) AS total_rows
    FROM instants JOIN ver ON {_delta_series_sql(LI_LO, '7 DAY')} GROUP BY stream_id, instant""")
def h5_delta_counts(spark, folder):
    ver = versions(lineitem_log(spark, folder))
    return series.delta_counts(ver, 604_800, LI_LO, LI_HI)
