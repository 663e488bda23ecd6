import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.logs import LOG_SCHEMA, START, histories, model_versions, random_log
from tidemark.functions.text import instant
from tidemark.operators import ordered, series, state, temporal
from tidemark.operators.streams import restrict
from tidemark.operators.versions import patch_versions as versions_of
from tidemark.operators.versions import versions
from tidemark.sources.change_logs import KEY, ORDER


def rows(df, columns=None):
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, log):
    return spark.createDataFrame(log, LOG_SCHEMA)


VERSION = ("stream_id", "id", "change_type", "valid_from", "valid_to", "seq", "note", "amount")


@pytest.mark.parametrize("soft", [False, True])
@pytest.mark.parametrize("slice_rows", [10, 1_000_000])
def test_versions_follow_the_model(spark, soft, slice_rows):
    for seed in (1, 2):
        log = random_log(seed)
        want, _ = model_versions(log, soft)
        got = versions(frame(spark, log), soft, slice_rows)
        assert rows(got, VERSION) == sorted(want, key=repr)


@pytest.mark.parametrize("soft", [False, True])
@pytest.mark.parametrize("slice_rows", [10, 1_000_000])
def test_rejected_follow_the_model(spark, soft, slice_rows):
    log = random_log(3)
    _, want = model_versions(log, soft)
    got = state.rejected(frame(spark, log), soft, slice_rows)
    assert rows(got) == sorted(want, key=repr)


def test_hot_keys_are_cut_into_even_slices(spark):
    log = frame(spark, random_log(4, rows=2000, hot_share=0.6))
    sliced = ordered.with_slices(log, KEY, ORDER, 100)
    sizes = [r["count"] for r in sliced.groupBy(*KEY, "_slice").count().where("id = 'e0'").collect()]
    assert len(sizes) >= 10 and max(sizes) <= 100
    order = sliced.where("id = 'e0'").orderBy(*ORDER).select("_slice").collect()
    assert [r[0] for r in order] == sorted(r[0] for r in order)


def test_one_time_for_all_rows_of_a_key_is_still_cut(spark):
    log = [("s", "hot", "Changed", START, seq, None, seq) for seq in range(500)]
    sliced = ordered.with_slices(frame(spark, log), KEY, ORDER, 50)
    assert max(r["count"] for r in sliced.groupBy("_slice").count().collect()) <= 50


def test_sampled_cuts_give_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SAMPLE_ROWS", 200)
    log = random_log(5, rows=2000)
    want, _ = model_versions(log, True)
    assert rows(versions(frame(spark, log), True, 60), VERSION) == sorted(want, key=repr)


@pytest.mark.parametrize("slice_rows", [7, 1_000_000])
def test_running_values(spark, slice_rows):
    log = random_log(6, rows=200)
    specs = {
        "next_amount": ordered.Following(F.col("amount")),
        "last_note": ordered.Latest(F.col("note")),
        "before": ordered.Preceding(F.col("note")),
        "total": ordered.RunningSum(F.col("amount")),
    }
    df = ordered.with_slices(frame(spark, log), KEY, ORDER, slice_rows)
    got = rows(ordered.running(df, KEY, ORDER, specs), ("id", "seq", *specs))
    want = []
    for (_, entity), history in histories(log).items():
        note, before, total = None, None, 0
        for here, after in zip(history, [*history[1:], None], strict=True):
            note = here[5] or note
            total += here[6]
            want.append((entity, here[4], after and after[6], note, before, total))
            before = here[5]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("soft", [False, True])
def test_snapshots_and_deltas_agree_with_versions(spark, soft):
    log = frame(spark, random_log(7))
    ver = versions(log, soft).cache()
    t, last = instant("2024-01-01 01:00:00"), instant("2024-01-01 00:20:00")
    columns = ("stream_id", "id", "change_type", "seq", "note", "amount")
    assert rows(temporal.snapshot(log, t, soft), columns) == rows(temporal.as_of(ver, t), columns)
    assert rows(temporal.changes_since(log, t, last, soft), columns) == rows(
        temporal.delta(ver, t, last), columns
    )


def test_snapshot_at_the_end_is_the_current_state(spark):
    log = frame(spark, random_log(8))
    for soft in (False, True):
        assert rows(temporal.snapshot(log, instant("2030-01-01 00:00:00"), soft)) == rows(
            state.current_state(log, soft)
        )


def test_periods_of_an_entity_do_not_overlap(spark):
    ver = versions(frame(spark, random_log(9)), True)
    a, b = ver.alias("a"), ver.alias("b")
    clash = a.join(b, list(KEY)).where(
        "a.seq <> b.seq and a.valid_from < b.valid_to and b.valid_from < a.valid_to"
        " and a.valid_from < a.valid_to and b.valid_from < b.valid_to"
    )
    assert clash.isEmpty()


def test_replayed_deltas_give_the_later_snapshot(spark):
    """First snapshot plus all deltas, last one wins, is the snapshot at the end."""
    ver = versions(frame(spark, random_log(10)), soft=True).cache()
    lo, hi = "2024-01-01 00:10:00", "2024-01-01 01:30:00"
    deltas = series.delta_series(ver, 600, lo, hi)
    latest = deltas.groupBy(*KEY).agg(F.max_by("seq", "instant").alias("seq"))
    want = temporal.as_of(ver, instant(hi)).select(*KEY, "seq")
    assert rows(latest) == rows(want)


@pytest.mark.parametrize("slice_rows", [10, 1_000_000])
@pytest.mark.parametrize("soft", [False, True])
def test_lookup_agrees_with_one_by_one_questions(spark, soft, slice_rows):
    raw = random_log(11, rows=120)
    want_versions, _ = model_versions(raw, soft)
    asked = [(n, r[0], r[1], r[3] + dt.timedelta(minutes=n % 7 - 3)) for n, r in enumerate(raw)]
    requests = spark.createDataFrame(
        asked, "request_id int, stream_id string, id string, t timestamp_ntz"
    )
    got = temporal.lookup_as_of(frame(spark, raw), requests, soft, slice_rows)
    want = [
        (n, v[5])
        for n, s, e, t in asked
        for v in want_versions
        if (s, e) == v[:2] and v[3] <= t < v[4]
    ]
    assert rows(got, ("request_id", "seq")) == sorted(want, key=repr)


def test_lookup_reduces_the_log_before_its_shuffle(spark):
    log = frame(spark, random_log(12, rows=200))
    asked = log.limit(1).select(F.lit(1).alias("request_id"), "stream_id", "id", F.col("ts").alias("t"))
    plan = temporal.lookup_as_of(log, asked)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Union") < plan.index("Join Inner")


def test_lookup_of_null_ids_and_times(spark):
    schema = "stream_id string, id string, change_type string, ts timestamp_ntz, seq bigint, v int"
    log = spark.createDataFrame([("s", None, "Added", START, 1, 7), ("s", "a", "Added", START, 1, 8)], schema)
    later = START + dt.timedelta(hours=1)
    asked = [(1, "s", None, later), (2, "s", "a", None), (3, "s", "b", later)]
    requests = spark.createDataFrame(asked, "request_id int, stream_id string, id string, t timestamp_ntz")
    assert [(r.request_id, r.v) for r in temporal.lookup_as_of(log, requests).collect()] == [(1, 7)]


PATCHES = [
    ("s", "a", "Added", 1, {"x": "1", "y": "2"}),
    ("s", "a", "Changed", 2, {"x": None}),
    ("s", "a", "Removed", 3, {}),
    ("s", "a", "Added", 4, {"z": "9"}),
    ("s", "b", "Added", 1, {"x": "1"}),
    ("s", "b", "Changed", 2, {"y": None}),
    ("s", "b", "Removed", 3, {}),
    ("s", "c", "Removed", 1, {}),
    ("s", "d", "Added", 1, {}),
]


def patch_log(spark):
    return spark.createDataFrame(
        [(s, i, k, START + dt.timedelta(hours=n), n, m) for s, i, k, n, m in PATCHES],
        "stream_id string, id string, change_type string, ts timestamp_ntz, seq bigint, properties map<string,string>",
    )


def test_patch_state(spark):
    hard = {r["id"]: r["properties"] for r in state.patch_state(patch_log(spark)).collect()}
    assert hard == {"a": {"z": "9"}, "d": {}}
    cells = state.patch_cells(patch_log(spark)).collect()
    assert [(r["id"], r["key"], r["value"]) for r in cells] == [("a", "z", "9")]
    cells = state.patch_cells(patch_log(spark), soft=True).select("id", "change_type", "key", "value")
    assert rows(cells) == [
        ("a", "Added", "x", None), ("a", "Added", "y", "2"), ("a", "Added", "z", "9"),
        ("b", "Removed", "x", "1"), ("b", "Removed", "y", None),
    ]
    soft = {
        r["id"]: (r["change_type"], r["properties"])
        for r in state.patch_state(patch_log(spark), soft=True).collect()
    }
    assert soft == {
        "a": ("Added", {"x": None, "y": "2", "z": "9"}),
        "b": ("Removed", {"x": "1", "y": None}),
        "d": ("Added", {}),
    }


@pytest.mark.parametrize("slice_rows", [3, 1_000_000])
def test_patch_versions(spark, slice_rows):
    def at_end(soft):
        ver = versions_of(patch_log(spark), ("x", "y", "z"), soft, slice_rows=slice_rows)
        open_end = ver.where("valid_to > timestamp_ntz '2030-01-01 00:00:00'")
        return {r["id"]: (r["x"], r["y"], r["z"]) for r in open_end.collect()}

    assert at_end(False) == {"a": (None, None, "9"), "d": (None, None, None)}
    assert at_end(True) == {"a": (None, "2", "9"), "b": ("1", None, None), "d": (None, None, None)}


def test_golden_counts(spark):
    """Counts of versions, rejected deletes, snapshot and delta at sf0.001."""
    from tidemark.sources.change_logs import events_log, lineitem_log

    folder = "/root/testdata/sf0.001"
    events, items = events_log(spark, folder), lineitem_log(spark, folder)
    assert [versions(events).count(), versions(events, True).count()] == [799, 990]
    assert [versions(items).count(), versions(items, True).count()] == [4032, 5303]
    assert [state.rejected(items).count(), state.rejected(items, True).count()] == [963, 697]
    t, last = instant("1999-01-01 00:00:00"), instant("1998-01-01 00:00:00")
    assert temporal.snapshot(items, t).count() == 885
    assert temporal.snapshot(items, t, True).count() == 1167
    assert temporal.changes_since(items, t, last, True).count() == 577


def test_many_eligible_streams_do_not_shuffle_the_log(spark):
    log = spark.range(1000).select(F.concat(F.lit("s"), F.col("id") % 4).alias("stream_id"), F.col("id"))
    eligible = spark.range(2, 120_002).select(F.concat(F.lit("s"), F.col("id")).alias("stream_id"))
    kept = restrict(log, eligible)
    # asked for, not left to the planner's guess of a size
    assert "strategy=broadcast" in kept._jdf.queryExecution().analyzed().toString()
    assert sorted(r[0] for r in kept.groupBy("stream_id").count().collect()) == ["s2", "s3"] and kept.count() == 500
