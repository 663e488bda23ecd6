import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from tests import golden
from tests.logs import LOG_SCHEMA, START, histories, model_versions, random_log
from tidemark.operators.batches import event_batches, idle_batches
from tidemark.plans.store import ChangeStore
from tidemark.session import scratch_path
from tidemark.sinks import documents
from tidemark.sources import files
from tidemark.streaming.clock import stream_clocked
from tidemark.streaming.flows import EventStream, stream_docs, stream_sync


def model_batches(log, n, idle):
    """Batches of each stream, by adding one change at a time."""
    out = []
    targets = {}
    for row in sorted(log, key=lambda r: (r[3], r[4])):
        targets.setdefault(row[0], []).append(row)
    for rows in targets.values():
        batch, before = [], None
        for row in rows:
            if batch and (len(batch) == n or row[3] - before >= idle):
                out.append(tuple(r[4] for r in batch))
                batch = []
            batch.append(row)
            before = row[3]
        out.append(tuple(r[4] for r in batch))
    return sorted(out)


def found_batches(df):
    groups = df.groupBy("stream_id", "session", "batch").agg(F.array_sort(F.collect_list(F.struct("ts", "seq"))).alias("a"))
    return sorted(tuple(s["seq"] for s in r["a"]) for r in groups.collect())


@pytest.mark.parametrize("slice_rows", [20, 1_000_000])
@pytest.mark.parametrize("idle_minutes", [2, 5])
def test_idle_batches_follow_the_model(spark, slice_rows, idle_minutes):
    log = random_log(21, rows=400)
    df = spark.createDataFrame(log, LOG_SCHEMA)
    got = idle_batches(df, ["stream_id"], 7, idle_minutes * 60_000, slice_rows)
    assert found_batches(got) == model_batches(log, 7, dt.timedelta(minutes=idle_minutes))


def test_one_long_session_is_cut_by_count(spark):
    log = [("s", "e", "Added", START + dt.timedelta(seconds=n), n, None, n) for n in range(230)]
    df = spark.createDataFrame(log, LOG_SCHEMA)
    sizes = [len(b) for b in found_batches(idle_batches(df, ["stream_id"], 50, 60_000, 40))]
    assert sorted(sizes) == [30, 50, 50, 50, 50]


@pytest.fixture
def arrivals(spark):
    """A log that arrives in four files, in time order, and the stream over them."""
    log = sorted(random_log(22, rows=240), key=lambda r: (r[3], r[4]))
    path = scratch_path(spark, "in")
    for n in range(4):
        part = spark.createDataFrame(log[n * 60 : (n + 1) * 60], LOG_SCHEMA)
        part.coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return log, source


def test_sync_stream_gives_the_batch_history(spark, arrivals):
    log, source = arrivals
    store = ChangeStore(spark, scratch_path(spark, "store"))
    stream_sync(source, store, scratch_path(spark, "offsets")).awaitTermination()
    want, _ = model_versions(log, soft=True)
    columns = ("stream_id", "id", "change_type", "valid_from", "valid_to", "seq", "note", "amount")
    assert sorted(map(tuple, store.versions(soft=True).select(*columns).collect()), key=repr) == sorted(want, key=repr)


def test_document_stream_keeps_the_latest_and_drops_the_removed(spark, arrivals):
    log, source = arrivals
    path = scratch_path(spark, "docs")
    stream_docs(source, path, scratch_path(spark, "offsets")).awaitTermination()
    got = {(r["stream_id"], r["id"]): json.loads(r["doc"])["amount"] for r in documents.read_documents(spark, path).collect()}
    want = {k: rows[-1][6] for k, rows in histories(log).items() if rows[-1][2] != "Removed"}
    assert got == want


@pytest.mark.parametrize("as_files", [False, True])
def test_event_stream_carries_open_batches_over(spark, arrivals, as_files):
    log, source = arrivals
    out = EventStream(
        spark, scratch_path(spark, "out"), ["stream_id"], F.col("stream_id"), 7, 180_000, as_files=as_files
    )
    out.start(source, scratch_path(spark, "offsets")).awaitTermination()
    out.flush()
    out.flush()
    got = sorted(tuple(item["seq"] for item in json.loads(r["content"])) for r in out.batches().collect())
    assert got == model_batches(log, 7, dt.timedelta(minutes=3))


def test_batch_files_hold_json_arrays_with_change_types(spark):
    log = spark.createDataFrame(random_log(23, rows=60), LOG_SCHEMA)
    batches = event_batches(idle_batches(log, ["stream_id"], 7, 180_000), ["stream_id"], F.lit("box"))
    path = scratch_path(spark, "files")
    documents.write_event_batches(batches.drop("stream_id"), f"{path}/batch_id=0", as_files=True)
    rows = documents.read_event_batches(spark, path, as_files=True).collect()
    items = [item for r in rows for item in json.loads(r["content"])]
    assert len(items) == 60 and {i["ChangeType"] for i in items} <= {"Added", "Changed", "Removed"}
    assert all(r["file_name"].startswith("box.2024-01-01 ") and r["file_name"].endswith(".json") for r in rows)


def test_rejected_changes_are_tried_again_with_the_next_batch(spark):
    path = scratch_path(spark, "in")
    first = golden.entity(spark)
    odd = golden.entity(spark, "Changed", golden.NOW + dt.timedelta(minutes=1), 2, extra="x")
    last = golden.entity(spark, "Changed", golden.NOW + dt.timedelta(minutes=2), 3)
    for rows in (first, odd, last):
        rows.coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(path)
    store = ChangeStore(spark, scratch_path(spark, "store"))
    stream_sync(source, store, scratch_path(spark, "offsets")).awaitTermination()
    assert sorted(r["seq"] for r in store.log().collect()) == [1, 3]
    assert [(r["seq"], r["unknown_keys"]) for r in store.rejected().collect()] == [(2, ["extra"])]


def test_documents_are_written_by_shard(spark):
    log = spark.createDataFrame(random_log(24), LOG_SCHEMA).withColumn("id", F.md5("id"))
    docs = documents.entity_docs(log)
    path = scratch_path(spark, "shards")
    documents.write_documents(docs, path)
    back = spark.read.schema("id string, path string, doc string, shard1 string, shard2 string").json(path)
    assert back.count() == docs.count()
    assert back.where("path <> concat(shard1, '/', shard2, '/', id, '.json')").isEmpty()


def arrival_batches(log, n):
    """Batches by count, in the order of arrival."""
    targets = {}
    for row in log:
        targets.setdefault(row[0], []).append(row[4])
    return {t: [tuple(s[k : k + n]) for k in range(0, len(s), n)] for t, s in targets.items()}


def seqs(rows):
    return sorted((r["stream_id"], r["closed_by"], tuple(i["seq"] for i in json.loads(r["content"]))) for r in rows)


def test_a_quiet_source_is_flushed_by_the_clock(spark, arrivals):
    """Full batches come by count; the rest falls idle while nothing at all arrives."""
    log, source = arrivals
    out, offsets = scratch_path(spark, "clocked"), scratch_path(spark, "offsets")
    want = sorted((t, "count" if len(b) == 7 else "idle", b) for t, own in arrival_batches(log, 7).items() for b in own)
    assert sum(w[1] == "idle" for w in want) == 2

    def run(until_idle):
        running = stream_clocked(source, out, offsets, ["stream_id"], F.col("stream_id"), 7, 3_000, interval="500 milliseconds")
        try:
            stop = time.monotonic() + 60
            while time.monotonic() < stop and len(read("closed_by = 'idle'" if until_idle else "true")) < (2 if until_idle else 1):
                time.sleep(0.5)
        finally:
            running.stop()

    def read(condition):
        return spark.read.parquet(out).where(condition).collect() if files.exists(spark, f"{out}/_spark_metadata/0") else []

    run(until_idle=False)
    # a stream that is stopped goes on with what waited
    run(until_idle=True)
    rows = read("true")
    assert seqs(rows) == want
    assert all(r["items"] == len(json.loads(r["content"])) and r["file_name"].startswith(r["stream_id"] + ".2024-01-01 ") for r in rows)


def test_clocked_batches_of_a_null_target(spark):
    path = scratch_path(spark, "in")
    log = [(None, "e", "Added", START, k, None, k) for k in range(5)] + [("s", None, "Removed", START, 9, None, None)]
    spark.createDataFrame(log, LOG_SCHEMA).coalesce(1).write.parquet(path)
    source = spark.readStream.schema(spark.createDataFrame(log, LOG_SCHEMA).schema).parquet(path)
    out = scratch_path(spark, "clocked")
    running = stream_clocked(source, out, scratch_path(spark, "offsets"), ["stream_id"], F.lit("box"), 2, 600_000)
    try:
        stop = time.monotonic() + 60
        while time.monotonic() < stop and not files.exists(spark, f"{out}/_spark_metadata/0"):
            time.sleep(0.5)
    finally:
        running.stop()
    assert [(r["stream_id"], r["items"]) for r in spark.read.parquet(out).collect()] == [(None, 2), (None, 2)]
