import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tests import golden
from tidemark.sinks.publish import described, publish
from tidemark.functions.schedule import by_name, next_instant
from tidemark.functions.cells import EDGE_TYPE, edge_text
from tidemark.plans.export import Stream, archive_stream, run_delta, run_export
from tidemark.plans.profiles import ExportProfile
from tidemark.plans.store import ChangeStore
from tidemark.session import scratch_path
from tidemark.sources import files

LATER = golden.NOW + dt.timedelta(hours=1)
STREAM = Stream(golden.STREAM, "test")


@pytest.fixture
def root(spark):
    return scratch_path(spark, "out")


@pytest.fixture
def store(spark):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    store.append(golden.stored(golden.entity(spark)), 0)
    return store


def texts(spark, path, suffix):
    return [spark.read.text(f"{path}/{n}", wholetext=True).first()[0] for n in files.names(spark, path) if n.endswith(suffix)]


PROFILES = {
    "azure": ExportProfile.azure,
    "onelake": ExportProfile.onelake,
    "databricks": ExportProfile.databricks,
    "synapse": ExportProfile.synapse,
    "ai_studio": ExportProfile.ai_studio,
}


@pytest.mark.parametrize("name", PROFILES)
def test_golden_row_as_json(spark, store, root, name):
    result = run_export(store, root, PROFILES[name](output_format="JSON"), STREAM, golden.NOW)
    assert result.outcome == "exported" and result.rows == 1
    parts = [json.loads(t) for t in texts(spark, result.path, ".txt")]
    (row,) = [r for part in parts for r in part]
    edges = {k: row.pop(k) for k in ("OutgoingEdges", "IncomingEdges")}
    assert row == {
        **golden.expected(escaped=False),
        "Codes": [golden.CODE],
        "Epoch": golden.EPOCH,
        "PersistVersion": golden.VERSION,
    }
    assert edges["OutgoingEdges"][0]["EdgeType"] == {"Code": golden.OUT_KIND}
    assert edges["IncomingEdges"][0]["FromReference"]["Code"] == {"Key": golden.CODE}


@pytest.mark.parametrize("name", PROFILES)
@pytest.mark.parametrize("arrays", [False, True])
def test_golden_row_as_parquet(spark, store, root, name, arrays):
    profile = PROFILES[name](output_format="Parquet", array_columns=arrays)
    result = run_export(store, root, profile, STREAM, golden.NOW)
    (row,) = [r.asDict() for r in spark.read.parquet(result.path).collect()]
    edges = [row.pop(k) for k in ("OutgoingEdges", "IncomingEdges")]
    codes = row.pop("Codes")
    assert row == {
        **golden.expected(profile.escape_names), "Epoch": golden.EPOCH, "PersistVersion": golden.VERSION
    }
    if arrays:
        assert codes == [golden.CODE] and edges == [[golden.OUT_EDGE], [golden.IN_EDGE]]
    else:
        assert json.loads(codes) == [golden.CODE]
        assert json.loads(edges[1])[0]["EdgeType"] == {"Code": golden.IN_KIND}


@pytest.mark.parametrize("name", PROFILES)
def test_golden_row_as_csv(spark, store, root, name):
    profile = PROFILES[name](output_format="csv")
    result = run_export(store, root, profile, STREAM, golden.NOW)
    back = spark.read.csv(result.path, header=True, quote='"', escape='"')
    (row,) = [r.asDict() for r in back.collect()]
    assert json.loads(row.pop("Codes")) == [golden.CODE]
    assert len(json.loads(row.pop("OutgoingEdges"))) == len(json.loads(row.pop("IncomingEdges"))) == 1
    assert row == {
        **golden.expected(profile.escape_names), "Epoch": str(golden.EPOCH), "PersistVersion": str(golden.VERSION)
    }


def test_columns_come_by_name(spark, store, root):
    result = run_export(store, root, ExportProfile.azure(output_format="parquet"), STREAM, golden.NOW)
    names = spark.read.parquet(result.path).columns
    assert names == ["Id", *sorted(names[1:])]


def test_default_names(spark, store, root):
    azure = run_export(store, root, ExportProfile.azure(output_format="parquet"), STREAM, golden.NOW)
    assert azure.file_name == f"{golden.STREAM}_20251103140500.parquet"
    lake = run_export(store, root, ExportProfile.onelake(output_format="parquet"), STREAM, golden.NOW)
    assert lake.file_name == f"{golden.STREAM.replace('-', '')}_20251103140500.parquet"


def test_scheduled_run_at_the_same_time_is_skipped(spark, store, root):
    profile = ExportProfile.azure(output_format="parquet")
    run = dict(scheduled=golden.NOW, schedule="Daily")
    first = run_export(store, root, profile, STREAM, golden.NOW, **run)
    again = run_export(store, root, profile, STREAM, LATER, **run)
    assert (first.outcome, again.outcome) == ("exported", "skipped")
    assert store.history().count() == 1


def test_same_name_for_another_time_is_overwritten(spark, store, root):
    profile = ExportProfile.azure(output_format="parquet", name_pattern="{ContainerName}.{OutputFormat}")
    first = run_export(store, root, profile, STREAM, golden.NOW, scheduled=golden.NOW, schedule="Daily")
    second = run_export(store, root, profile, STREAM, LATER, scheduled=LATER, schedule="Daily")
    assert first.path == second.path and second.outcome == "exported"
    assert described(spark, second.path)["DataTime"] == LATER.isoformat()
    assert spark.read.parquet(second.path).count() == 1


def test_manual_run_takes_the_current_time_and_a_new_name(spark, store, root):
    profile = ExportProfile.azure(output_format="parquet")
    run = dict(scheduled=golden.NOW, schedule="Daily")
    first = run_export(store, root, profile, STREAM, golden.NOW, **run)
    manual = run_export(store, root, profile, STREAM, LATER, manual=True, **run)
    assert manual.outcome == "exported" and manual.data_time == LATER
    assert manual.path != first.path
    sources = [r[0] for r in store.history().select("TriggerSource").collect()]
    assert sorted(sources) == ["InternalScheduler", "JobServer"]


def test_ineligible_streams_are_left_alone(spark, store, root):
    profile = ExportProfile.azure(output_format="parquet")
    for stream in (
        Stream(golden.STREAM, "test", status="Stopped"),
        Stream(golden.STREAM, "test", mode="EventStream"),
        Stream(golden.STREAM, "test", provider_enabled=False),
    ):
        assert run_export(store, root, profile, stream, golden.NOW).outcome == "ineligible"
    off = profile.with_options(stream_cache=False)
    assert run_export(store, root, off, STREAM, golden.NOW).outcome == "ineligible"


def mirror_rows(spark, result):
    return [r.asDict() for r in spark.read.parquet(result.path).collect()]


def test_mirror_counts_files_and_marks_rows(spark, store, root):
    profile = ExportProfile.mirrored()
    first = run_delta(store, root, profile, STREAM, golden.NOW)
    assert first.file_name == "00000000000000000001.parquet"
    assert "__rowMarker__" not in mirror_rows(spark, first)[0]
    assert run_delta(store, root, profile, STREAM, golden.NOW).outcome == "skipped"

    change = golden.entity(spark, "Changed", golden.NOW + dt.timedelta(minutes=10), 2)
    store.append(golden.stored(change), 1)
    second = run_delta(store, root, profile, STREAM, LATER)
    assert second.file_name == "00000000000000000002.parquet"
    (row,) = mirror_rows(spark, second)
    assert row["__rowMarker__"] == "4" and list(row)[-1] == "__rowMarker__"

    nothing = run_delta(store, root, profile, STREAM, LATER + dt.timedelta(hours=1))
    assert nothing.rows == 0 and nothing.path is None

    gone = golden.entity(spark, "Removed", LATER + dt.timedelta(hours=2), 3)
    store.append(golden.stored(gone), 2)
    third = run_delta(store, root, profile, STREAM, LATER + dt.timedelta(hours=3))
    (row,) = mirror_rows(spark, third)
    assert row["__rowMarker__"] == "2" and row["Name"] == golden.NAME
    assert third.file_name == "00000000000000000003.parquet"


def test_mirror_landing_zone(spark, store, root):
    profile = ExportProfile.mirrored(output_format="csv", table_name="{ContainerName}_rows")
    result = run_delta(store, root, profile, STREAM, golden.NOW)
    assert result.path == f"{root}/test_rows/00000000000000000001.csv"
    meta = files.read_json(spark, f"{root}/test_rows/_metadata.json")
    assert meta["keyColumns"] == ["Id"]
    assert meta["fileFormatTypeProperties"]["rowSeparator"] == "\r\n"
    run_export(store, root, profile, STREAM, LATER, partner={"partnerName": "someone"})
    assert files.read_json(spark, f"{root}/_partnerEvents.json") == {"partnerName": "someone"}
    text = texts(spark, result.path, ".txt")
    assert text and all(t.startswith("Id,") and t.endswith("\r\n") for t in text)


def test_mirror_without_metadata_starts_over(spark, store, root):
    profile = ExportProfile.mirrored()
    first = run_delta(store, root, profile, STREAM, golden.NOW)
    files.delete(spark, first.path.rsplit("/", 1)[0])
    again = run_delta(store, root, profile, STREAM, LATER)
    assert again.file_name == "00000000000000000001.parquet" and again.rows == 1


def test_table_is_loaded_after_the_export(spark, store, root):
    name = "loaded_" + uuid.uuid4().hex
    profile = ExportProfile.onelake(output_format="parquet", load_table=True, table_name=name)
    run_export(store, root, profile, STREAM, golden.NOW)
    assert spark.table(name).select("vessel_crew").first()[0] == "24"


def test_hooks_change_an_export(spark, store, root):
    seen = []
    profile = ExportProfile.azure(
        output_format="parquet",
        fields=lambda df: df.select("Id", "Name"),
        extension=lambda fmt: fmt.upper(),
        after=lambda spark, path, rows: seen.append(path),
    )
    result = run_export(store, root, profile, STREAM, golden.NOW)
    assert result.path.endswith(".PARQUET") and seen == [result.path]
    assert spark.read.parquet(result.path).columns == ["Id", "Name"]


@pytest.mark.parametrize(
    "wrong",
    [
        dict(output_format="xml"),
        dict(output_format="json", mirror=True),
        dict(output_format="csv", load_table=True),
    ],
)
def test_profiles_refuse_what_does_not_fit(wrong):
    with pytest.raises(ValueError):
        ExportProfile(**wrong)


def test_profile_defaults():
    azure, lake, mirror = ExportProfile.azure(), ExportProfile.onelake(), ExportProfile.mirrored(delta_mode=False)
    assert (azure.guid_as_text, azure.escape_names, azure.stream_id_form) == (False, False, "D")
    assert (lake.guid_as_text, lake.escape_names, lake.stream_id_form) == (True, True, "N")
    assert mirror.delta_mode and not mirror.overwrite and not mirror.allow_empty


def test_store_refuses_or_adopts_new_columns(spark):
    rows = golden.stored(golden.entity(spark))
    path = scratch_path(spark, "store")
    ChangeStore(spark, path).append(rows, 0)
    wider = rows.withColumn("vessel.new", F.lit("x")).withColumn("seq", F.lit(9).cast("bigint"))
    with pytest.raises(ValueError, match="vessel.new"):
        ChangeStore(spark, path).append(wider, 1)
    grown = ChangeStore(spark, path, mode="evolve")
    grown.append(wider, 1)
    values = {r["seq"]: r["vessel.new"] for r in grown.log().collect()}
    assert values == {1: None, 9: "x"}


def test_delivering_a_batch_twice_changes_nothing(spark):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    rows = golden.stored(golden.entity(spark))
    store.append(rows, 0)
    store.append(rows, 0)
    assert store.log().count() == 1
    store.append(rows.withColumn("seq", F.lit(2).cast("bigint")), 1)
    store.compact(1)
    store.append(rows, 0)
    assert store.log().count() == 2
    with pytest.raises(ValueError, match="compacted"):
        store.append(rows.withColumn("seq", F.lit(9).cast("bigint")), 1)


def test_publishing_again_replaces(spark):
    path = scratch_path(spark, "again")
    for n in (3, 2):
        publish(spark.range(n), path, lambda df, to: df.write.parquet(to), {"n": str(n)})
    assert spark.read.parquet(path).count() == 2 and described(spark, path) == {"n": "2"}


def test_unknown_schedule_is_an_error(spark):
    with pytest.raises(Exception, match="not supported"):
        spark.range(1).select(by_name(F.lit("0 5 * * *"), lambda name: next_instant(F.current_timestamp().cast("timestamp_ntz"), name)).alias("t")).collect()


def test_null_parts_of_an_edge_are_empty(spark):
    edge = "from_json('{\"ToReference\":{\"Name\":\"/A\"}}', '" + EDGE_TYPE + "')"
    assert spark.range(1).select(edge_text(F.expr(edge))).first()[0] == "EdgeType: ; From: §C:; To: /A§C:; Properties: 0"


def test_archive_moves_a_stream_aside(spark):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    store.append(golden.stored(golden.entity(spark)), 0)
    path = store.archive(golden.STREAM, "20240821031600")
    assert path.endswith(f"{golden.STREAM}_20240821031600")
    assert store.log().count() == 0
    assert store.archived(golden.STREAM, "20240821031600").count() == 1


def test_an_archived_stream_is_opened_anew(spark):
    store = ChangeStore(spark, scratch_path(spark, "store"))
    first, odd = golden.entity(spark), golden.entity(spark, "Changed", golden.NOW, 2, extra="x")
    other = first.withColumn("stream_id", F.lit("other"))
    for number, batch in enumerate((first.unionByName(other), odd.unionByName(odd.withColumn("stream_id", F.lit("other"))))):
        fits, rejected = store.guard(batch, number)
        store.append(fits, number)
        store.reject(rejected, number)
    assert store.rejected().count() == 2
    store.archive(golden.STREAM, "20240821031600")
    assert [r["stream_id"] for r in store.rejected().collect()] == ["other"]
    again = golden.entity(spark, "Changed", golden.NOW, 3, extra="x")
    fits, rejected = store.guard(again.unionByName(again.withColumn("stream_id", F.lit("other"))), 2)
    assert [r["stream_id"] for r in fits.collect()] == [golden.STREAM]
    assert [r["stream_id"] for r in rejected.collect()] == ["other"]


def test_archiving_a_mirrored_stream_removes_its_directory(spark, store, root):
    profile = ExportProfile.mirrored()
    result = run_delta(store, root, profile, STREAM, golden.NOW)
    assert files.exists(spark, result.path)
    archive_stream(store, root, profile, STREAM, LATER)
    assert not files.exists(spark, result.path) and store.log().count() == 0


def test_listing(spark, store, root):
    result = run_export(store, root, ExportProfile.azure(output_format="parquet"), STREAM, golden.NOW)
    found = files.list_outputs(spark, result.path)
    assert "content" not in found.columns
    assert found.where("name like 'part-%'").count() >= 1


def test_store_scan_prunes_streams_and_columns(spark, store):
    plan = store.log([golden.STREAM]).where("ts > timestamp_ntz '2024-01-01 00:00:00'").select("id", "ts")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stream_id" in text or "PartitionFilters: [(stream_id" in text
    assert "GreaterThan(ts" in text and "ReadSchema: struct<id:string,ts:timestamp_ntz>" in text
