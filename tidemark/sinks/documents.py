"""One JSON document per entity, and JSON arrays of event batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import cols
from tidemark.operators.state import current_state
from tidemark.sources.change_logs import KEY, LOG_COLUMNS, ORDER, REMOVED, is_removed, payload_columns


def document_paths(rows: DataFrame) -> DataFrame:
    """Where the document of an entity lives: ``{id[0:2]}/{id[2:4]}/{id}.json``."""
    shard1, shard2 = F.substring("id", 1, 2), F.substring("id", 3, 2)
    return rows.withColumns(
        {
            "shard1": shard1,
            "shard2": shard2,
            "path": F.concat(shard1, F.lit("/"), shard2, F.lit("/"), F.col("id"), F.lit(".json")),
        }
    )


def as_documents(rows: DataFrame) -> DataFrame:
    payload = [c for c in rows.columns if c not in LOG_COLUMNS]
    body = F.struct(F.col("id").alias("Id"), *cols(payload))
    doc = F.to_json(body, {"ignoreNullFields": "false"})
    return rows.select(*LOG_COLUMNS, doc.alias("doc"))


def entity_docs(log: DataFrame) -> DataFrame:
    """The document of every entity that exists."""
    return document_paths(as_documents(current_state(log)))


def write_documents(docs: DataFrame, path: str) -> None:
    """Documents in directories of their shards, as JSON lines with their paths."""
    rows = docs.select("shard1", "shard2", "id", "path", "doc")
    spread = rows.hint("rebalance", "shard1", "shard2")
    spread.write.mode("overwrite").partitionBy("shard1", "shard2").json(path)


def append_documents(batch: DataFrame, path: str, batch_id: int) -> None:
    """The last change of each entity in a batch; a removal is kept as such.

    A batch that is delivered twice replaces itself.
    """
    payload = payload_columns(batch)
    last = F.max_by(F.struct("change_type", *ORDER, *cols(payload)), F.struct(*ORDER))
    newest = batch.groupBy(*KEY).agg(last.alias("last")).select(*KEY, "last.*")
    docs = as_documents(newest).withColumn("doc", F.when(~is_removed(), F.col("doc")))
    docs.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the entities that exist, over all batches."""
    docs = spark.read.parquet(path)
    last = F.max_by(F.struct("change_type", *ORDER, "doc"), F.struct(*ORDER))
    rows = docs.groupBy(*KEY).agg(last.alias("last")).where(F.col("last.change_type") != REMOVED)
    return document_paths(rows.select(*KEY, "last.*"))


def write_event_batches(
    batches: DataFrame, path: str, as_files: bool = False, mode: str = "append"
) -> None:
    """Event batches as a table of file names and JSON arrays, or as files.

    Batches are small and many. The table suits any volume; ``as_files`` gives one
    directory per batch name for targets that must see files.
    """
    if as_files:
        rows = batches.select("file_name", F.col("content").alias("value"))
        rows.write.mode(mode).partitionBy("file_name").text(path)
    else:
        batches.select("file_name", "items", "content").write.mode(mode).parquet(path)


def read_event_batches(spark: SparkSession, path: str, as_files: bool = False) -> DataFrame:
    """File name and JSON array of every batch below ``path``, over all ``batch_id=…`` folders."""
    if not as_files:
        rows = spark.read.schema("file_name string, items bigint, content string").parquet(path)
        return rows.select("file_name", "content")
    schema = "value string, batch_id string, file_name string"
    rows = spark.read.option("basePath", path).schema(schema).text(f"{path}/*")
    return rows.select("file_name", F.col("value").alias("content"))
