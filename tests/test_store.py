"""A change store that loses nothing: patches, sources, replays, merged history, runs over many streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.logs import LOG_SCHEMA, START, histories, model_versions, random_log
from tidemark.functions.text import instant
from tidemark.operators import ordered, patches, temporal
from tidemark.operators.state import current_state
from tidemark.operators.versions import versions
from tidemark.plans.exports import export_plan, planned_rows, run_exports
from tidemark.plans.history import VersionHistory
from tidemark.plans.profiles import ExportProfile
from tidemark.plans.store import ChangeStore
from tidemark.session import scratch_path
from tidemark.sinks import landing
from tidemark.sources import files

PATCH_SCHEMA = LOG_SCHEMA + ", set_columns array<string>"
VERSION = ("stream_id", "id", "change_type", "valid_from", "valid_to", "seq", "note", "amount")
CHANGE = ("stream_id", "id", "change_type", "ts", "seq", "note", "amount")


def rows(df, columns=None):
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_patches(seed, n=240):
    pick = random.Random(seed)
    sets = [None, [], ["note"], ["amount"], ["amount", "note"]]
    return [(*r, pick.choice(sets)) for r in random_log(seed, n)]


def whole_model(log, soft):
    """Every change as a whole row, one entity after the other."""
    out = []
    for history in histories(log).values():
        note = amount = None
        for r in history:
            if r[2] == "Removed":
                if not soft:
                    note = amount = None
            else:
                given = ("note", "amount") if r[7] is None else r[7]
                note = r[5] if "note" in given else note
                amount = r[6] if "amount" in given else amount
            out.append((*r[:5], note, amount))
    return out


@pytest.mark.parametrize("soft", [False, True])
@pytest.mark.parametrize("slice_rows", [15, 1_000_000])
def test_patches_become_whole_rows(spark, soft, slice_rows):
    log = random_patches(21)
    whole = patches.completed(spark.createDataFrame(log, PATCH_SCHEMA), soft, slice_rows)
    assert rows(whole, CHANGE) == sorted(whole_model(log, soft), key=repr)
    want, _ = model_versions(whole_model(log, soft), soft)
    assert rows(versions(whole, soft, slice_rows), VERSION) == sorted(want, key=repr)


@pytest.mark.parametrize("soft", [False, True])
def test_patched_questions_agree_with_whole_rows(spark, soft):
    log = random_patches(22)
    given = spark.createDataFrame(log, PATCH_SCHEMA)
    whole = spark.createDataFrame(whole_model(log, soft), LOG_SCHEMA)
    t, last = instant("2024-01-01 01:00:00"), instant("2024-01-01 00:20:00")
    assert rows(patches.patched_state(given, soft), CHANGE) == rows(current_state(whole, soft), CHANGE)
    assert rows(temporal.snapshot(given, t, soft), CHANGE) == rows(temporal.snapshot(whole, t, soft), CHANGE)
    assert rows(temporal.changes_since(given, t, last, soft), CHANGE) == rows(temporal.changes_since(whole, t, last, soft), CHANGE)
    assert patches.patched_state(given.limit(0), soft).isEmpty()


def change(n, kind="Changed", entity="a", stream="s"):
    return (stream, entity, kind, START + dt.timedelta(hours=n), n)


BASE = "stream_id string, id string, change_type string, ts timestamp_ntz, seq bigint"


def test_absent_columns_keep_their_values(spark):
    store = ChangeStore(spark, scratch_path(spark, "store"), mode="evolve")
    store.append(spark.createDataFrame([(*change(1, "Added"), "n", 1)], f"{BASE}, note string, amount int"), 0)
    store.append(spark.createDataFrame([(*change(2), 2)], f"{BASE}, amount int"), 1)
    store.append(spark.createDataFrame([(*change(3), None, 3.5)], f"{BASE}, note string, later double"), 2)
    # written before the store grew, delivered after: it doesn't set the later column
    store.append(spark.createDataFrame([(*change(5), "o", 5)], f"{BASE}, note string, amount int"), 3)
    ver = store.versions()
    assert rows(ver, ("seq", "note", "amount", "later")) == [(1, "n", 1, None), (2, "n", 2, None), (3, None, 2, 3.5), (5, "o", 5, 3.5)]
    assert rows(store.snapshot(instant("2024-01-01 02:30:00")), ("note", "amount", "later")) == [("n", 2, None)]
    late = instant("2024-01-02 00:00:00")
    assert rows(store.changes_since(late, instant("2024-01-01 04:00:00")), ("note", "amount", "later")) == [("o", 5, 3.5)]
    assert rows(store.log(), ("seq", "note")) == [(1, "n"), (2, None), (3, None), (5, "o")]
    store.compact(2)
    assert rows(store.versions(), ("seq", "amount")) == [(1, 1), (2, 2), (3, 2), (5, 5)]


def test_a_row_names_what_it_sets(spark):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    log = random_patches(23)
    for n in range(3):
        store.append(spark.createDataFrame([r for r in log if r[4] % 3 == n], PATCH_SCHEMA), n)
    assert store.log().columns == list(CHANGE)
    for soft in (False, True):
        want, _ = model_versions(whole_model(log, soft), soft)
        assert rows(store.versions(soft), VERSION) == sorted(want, key=repr)


def test_a_whole_log_needs_no_completion(spark):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    store.append(spark.createDataFrame(random_log(24, 30), LOG_SCHEMA), 0)
    assert patches.SET not in store.patches().columns
    plan = store.snapshot(instant("2024-01-01 01:00:00"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_sources_number_their_own_batches(spark):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    one, two = (spark.createDataFrame([(*change(n), str(n))], f"{BASE}, note string") for n in (1, 2))
    store.append(one, 0, "crm/a")
    store.append(two, 0, "erp")
    store.append(one, 0, "crm/a")
    assert sorted(store.sources()) == ["crm/a", "erp"] and store.batches("erp") == [0]
    assert rows(store.log(), ("seq", "note")) == [(1, "1"), (2, "2")]
    with pytest.raises(ValueError, match="other content"):
        store.append(two, 0, "crm/a")
    store.compact(0, "erp")
    with pytest.raises(ValueError, match="compacted"):
        store.append(one.withColumn("seq", F.lit(9).cast("bigint")), 0, "erp")
    store.append(one.withColumn("seq", F.lit(9).cast("bigint")), 1, "crm/a")
    assert store.log().count() == 3


def test_an_interrupted_batch_is_written_anew(spark, monkeypatch):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    batch = spark.createDataFrame([change(n) + (str(n),) for n in range(20)], f"{BASE}, note string")
    written = ChangeStore._write_changes

    def stop_half_way(self, changes, generation):
        written(self, changes.where("seq < 7"), generation)
        raise OSError("lost")

    monkeypatch.setattr(ChangeStore, "_write_changes", stop_half_way)
    with pytest.raises(OSError, match="lost"):
        store.append(batch, 0)
    monkeypatch.setattr(ChangeStore, "_write_changes", written)
    with pytest.raises(ValueError, match="other content"):
        store.append(batch.where("seq < 7"), 0)
    store.append(batch.repartition(3), 0)
    assert store.log().count() == 20 and store.batches() == [0]


def closed_files(spark, path):
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{path}/closed")
    return {(r.path, r.modificationTime, r.length) for r in found.select("path", "modificationTime", "length").collect()}


@pytest.mark.parametrize("soft", [False, True])
@pytest.mark.parametrize("in_order", [False, True])
def test_merged_history_is_the_whole_one(spark, soft, in_order):
    log = random_patches(25 + in_order)
    store = ChangeStore(spark, scratch_path(spark, "store"))
    history = VersionHistory(store, soft, slice_rows=40)
    before = set()
    ordered = sorted(log, key=lambda r: r[3:5])
    for n in range(5):
        part = ordered[n * 48 : n * 48 + 48] if in_order else [r for r in log if r[4] % 5 == n]
        store.append(spark.createDataFrame(part, PATCH_SCHEMA), n, "ab"[n % 2] if in_order else "a")
        assert history.merge() == n + 1 == history.merge()
        now = closed_files(spark, history.path)
        assert before <= now
        before = now
        want, _ = model_versions(whole_model([r for m in range(n + 1) for r in (ordered[m * 48 : m * 48 + 48] if in_order else [x for x in log if x[4] % 5 == m])], soft), soft)
        assert rows(history.versions(), VERSION) == sorted(want, key=repr)
    if in_order:
        assert history._read("rebuilt", history._closed_schema(), 9).isEmpty()
    history.fold()
    assert VersionHistory(store, soft).path == history.path and history.path.endswith("-5")
    assert rows(VersionHistory(store, soft).versions(), VERSION) == sorted(want, key=repr)
    # and it goes on from there
    store.append(spark.createDataFrame([("s0", "e0", "Changed", dt.datetime(2031, 1, 1), 999, "z", 7, None)], PATCH_SCHEMA), 9, "c")
    assert VersionHistory(store, soft).merge() == 6
    assert VersionHistory(store, soft).versions().where("seq = 999 and note = 'z'").count() == 1


def test_history_refuses_what_it_would_lose(spark):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    one = spark.createDataFrame([change(1) + ("x",)], f"{BASE}, note string")
    store.append(one, 4)
    history = VersionHistory(store)
    history.merge()
    store.append(one.withColumn("seq", F.lit(2).cast("bigint")), 3)
    with pytest.raises(ValueError, match="behind"):
        history.merge()


STREAMS = "stream_id string, container_name string, status string, mode string, cache_enabled boolean, provider_id int, schedule string, scheduled timestamp_ntz"
NOW = dt.datetime(2024, 3, 1)


def control(spark, streams, schedule="Never", scheduled=None):
    rows_ = [(s, f"c-{s}", "Started", "Sync", True, 1, schedule, scheduled) for s in streams]
    providers = spark.createDataFrame([(1, True, START)], "provider_id int, is_enabled boolean, target_created_at timestamp_ntz")
    return spark.createDataFrame(rows_, STREAMS), providers


def guid(n):
    return f"00000000-0000-0000-0000-{n:012d}"


@pytest.fixture
def many(spark):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    log = [(guid(n % 4), f"e{n}", "Changed", START + dt.timedelta(hours=n), n, "it's \"q\", é", n) for n in range(20)]
    store.append(spark.createDataFrame(log, LOG_SCHEMA), 0)
    return store


@pytest.mark.parametrize("output_format", ["parquet", "csv"])
def test_one_run_exports_many_streams(spark, many, output_format):
    root = scratch_path(spark, "out")
    profile = ExportProfile.azure(output_format=output_format, name_pattern="{StreamId:N}-{ContainerName}.{OutputFormat}")
    # the last stream has no changes, and the control table has one that can't run
    streams, providers = control(spark, [guid(n) for n in range(5)])
    streams = streams.unionByName(streams.limit(1).withColumns({"stream_id": F.lit(guid(8)), "status": F.lit("Paused")}))
    done = {r.StreamId: (r.action, r.TotalRows, r.FilePath) for r in run_exports(many, root, profile, streams, providers, NOW).collect()}
    assert {s: d[:2] for s, d in done.items()} == {guid(n): ("write", 5 if n < 4 else 0) for n in range(5)}
    for n in range(5):
        path = f"{root}/{done[guid(n)][2]}"
        reader = spark.read.schema("Id string, note string, amount int")
        back = reader.parquet(path) if output_format == "parquet" else reader.options(header=True, quote='"', escape='"').csv(path)
        assert rows(back) == ([(f"e{k}", "it's \"q\", é", k) for k in sorted(range(n, 20, 4), key=str)] if n < 4 else [])
        assert files.read_json(spark, f"{path}/_export.json")["StreamId"] == guid(n)
    assert rows(many.history(), ("StreamId", "Status", "TotalRows")) == [(guid(n), "Complete", 5 if n < 4 else 0) for n in range(5)]
    assert all(not n.startswith("_staged") for n in files.names(spark, root))


def test_a_second_run_of_many_streams(spark, many):
    root, profile = scratch_path(spark, "mirror"), ExportProfile.mirrored()
    streams = control(spark, [guid(0), guid(1)])
    run_exports(many, root, profile, *streams, NOW)
    again = run_exports(many, root, profile, *streams, NOW)
    assert [r.action for r in again.collect()] == ["skip", "skip"]
    later = NOW + dt.timedelta(days=1)
    gone = [(guid(0), "e4", "Removed", NOW + dt.timedelta(hours=1), 50, None, None), (guid(0), "e8", "Changed", NOW + dt.timedelta(hours=1), 51, "new", 1)]
    many.append(spark.createDataFrame(gone, LOG_SCHEMA), 1)
    counts = {r.StreamId: r.TotalRows for r in run_exports(many, root, profile, *streams, later).collect()}
    assert counts == {guid(0): 2, guid(1): 0}
    table = guid(0).replace("-", "")
    back = spark.read.parquet(f"{root}/{table}/{2:020d}.parquet")
    assert rows(back, ("Id", "note", "__rowMarker__")) == [("e4", "it's \"q\", é", "2"), ("e8", "new", "4")]
    assert not files.exists(spark, f"{root}/{guid(1).replace('-', '')}/{2:020d}.parquet")
    assert files.exists(spark, f"{root}/{table}/_metadata.json")


def test_a_run_of_many_streams_has_one_plan(spark, many):
    """Rows of all streams come from one aggregation of the log, with no loop over streams."""
    plan = export_plan(many, ExportProfile.azure(), *control(spark, [guid(n) for n in range(4)]), NOW)
    text = planned_rows(many.patches(), plan, soft=False)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") - text.count("ledger") <= 1
    with pytest.raises(ValueError, match="one by one"):
        run_exports(many, "/nowhere", ExportProfile.azure(), *control(spark, []), NOW)
    none = run_exports(many, scratch_path(spark, "none"), ExportProfile.azure(output_format="csv"), *control(spark, []), NOW)
    assert none.count() == 0 and many.history().count() == 0


def flat(spark, zone):
    return [n for n in files.names(spark, zone) if not n.startswith("_")]


@pytest.mark.parametrize("output_format", ["parquet", "csv"])
def test_landed_files_are_numbered_through(spark, monkeypatch, output_format):
    zone, profile = scratch_path(spark, "zone"), ExportProfile.mirrored(output_format=output_format)
    rows_ = spark.range(40).select(F.col("id").alias("Id"), F.lit("a,\nb").alias("note"))
    first = landing.land_numbered(rows_.where("Id < 10"), zone, profile, "r1")
    moved = files.rename

    def stop(spark, source, target):
        if target.endswith(f".{output_format}"):
            raise OSError("lost")
        moved(spark, source, target)

    # the plan is written, the moves are not
    monkeypatch.setattr(files, "rename", stop)
    with pytest.raises(OSError, match="lost"):
        landing.land_numbered(rows_.where("Id >= 10"), zone, profile, "r2")
    assert flat(spark, zone) == first
    monkeypatch.setattr(files, "rename", moved)
    second = landing.land_numbered(rows_.limit(0), zone, profile, "r2")
    assert landing.land_numbered(rows_, zone, profile, "r2") == second
    assert landing.land_numbered(rows_.limit(0), zone, profile, "r3") == []
    third = landing.land_numbered(rows_.limit(1), zone, profile, "r4")
    names = [*first, *second, *third]
    assert flat(spark, zone) == names == [f"{n:020d}.{output_format}" for n in range(1, len(names) + 1)]
    reader = spark.read.schema("Id long, note string")
    back = reader.parquet(zone) if output_format == "parquet" else reader.options(header=True, quote='"', escape='"', multiLine=True, lineSep="\r\n").csv(zone)
    assert back.count() == 41 and back.where("note = 'a,\nb'").count() == 41


def test_landing_many_files_asks_the_file_system_once_per_move(spark, monkeypatch):
    zone, profile = scratch_path(spark, "zone"), ExportProfile.mirrored(max_records_per_file=1)
    calls = {"names": 0, "exists": 0, "rename": 0, "_path": 0}
    for name in calls:
        def counted(*args, name=name, own=getattr(files, name)):
            calls[name] += 1
            return own(*args)

        monkeypatch.setattr(files, name, counted)
    rows_ = spark.range(60).select(F.col("id").alias("Id"))
    landed = landing.land_numbered(rows_, zone, profile, "r1")
    assert landed == [f"{n:020d}.parquet" for n in range(1, 61)]
    # a file is moved with one call, and none asks for its path's class anew
    assert calls["rename"] == 61 and calls["exists"] + calls["names"] < 20
    assert landing.land_numbered(rows_, zone, profile, "r1") == landed and calls["rename"] == 61
    assert files._path_class(spark._jvm) is files._path_class(spark._jvm)


def test_whole_rows_and_versions_share_one_look_for_cuts(spark, monkeypatch):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    log = spark.createDataFrame(random_log(5), LOG_SCHEMA)
    store.append(log.where("seq % 2 = 0"), 0)
    store.append(log.where("seq % 2 = 1").drop("note"), 1)
    want = rows(store.versions(soft=True).select("id", "valid_from", "valid_to", "seq", "note", "amount"))
    looks, own = [], ordered.cut_points
    monkeypatch.setattr(ordered, "cut_points", lambda df, keys, order, n: looks.append(n) or own(df, keys, order, 10))
    assert rows(store.versions(soft=True).select("id", "valid_from", "valid_to", "seq", "note", "amount")) == want
    assert len(looks) == 1


def test_a_merge_without_late_changes_rebuilds_nothing(spark):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    history = VersionHistory(store, soft=True)
    log = spark.createDataFrame(random_log(6), LOG_SCHEMA)
    middle = "timestamp_ntz '2024-01-01 00:50:00'"
    for batch_id, part in enumerate((f"ts < {middle}", f"ts >= {middle}")):
        store.append(log.where(part), batch_id)
        history.merge()
    assert files.names(spark, f"{history.path}/rebuilt") == []
    columns = ("id", "stream_id", "valid_from", "valid_to", "seq", "note", "amount")
    assert rows(history.versions(), columns) == rows(versions(log, soft=True), columns)
