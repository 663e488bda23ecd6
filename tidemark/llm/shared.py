"""Help that the operators share: written tables, key filters of a fixed size, white space."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: The white space of all contracts: the blank and U+0009 to U+000D.
BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows for which a task is worth its start.
ROWS = 20_000


def in_few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more tasks than so many ``rows`` are worth, at least two a core.

    Shuffle partitions follow the whole input. A small table takes a task for each of them in every
    step, and their starts cost more than its rows, unless adaptive execution puts them together.
    """
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, rows // ROWS))


def unused(taken: list[str], name: str) -> str:
    """``name``, lengthened until it clashes with no column in ``taken``, whatever the letter case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def n_buckets(spark: SparkSession, factor: int = 4) -> int:
    """Hash buckets for rows that tasks pack themselves: they follow the session's shuffle partitions."""
    return max(16, factor * int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Python workers get at most ``rows`` rows at once, so whole texts don't fill their memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))
    return spark


class KeyFilter:
    """A test of a long column that is true for each of ``keys`` and false for most others.

    The keys become a bit field of ``bits`` bits, built with a partial aggregation, so what
    reaches the driver and the executors is ``bits / 8`` bytes however many keys there are. A
    full field lets more rows through; callers join the rows it lets through, so the result
    doesn't change. Null is never a member.
    """

    def __init__(self, keys: DataFrame, key: str, bits: int = 1 << 25):
        self.bits = bits
        slot = self.slot(F.col(key))
        words = in_few_tasks(
            keys.where(F.col(key).isNotNull())
            .select((slot / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int")).alias("bit"))
            .groupBy("word")
            .agg(F.bit_or("bit").alias("bit")),
            bits // 64,
        ).toArrow()
        field = np.zeros(bits // 64, dtype=np.uint64)
        field[words.column("word").to_numpy()] = words.column("bit").to_numpy().view(np.uint64)
        self.field = keys.sparkSession.sparkContext.broadcast(field)

    def slot(self, column: Column) -> Column:
        """The place of a key in the field; null for null."""
        return F.when(column.isNotNull(), F.pmod(F.xxhash64(column), F.lit(self.bits)))

    def column(self, column: Column) -> Column:
        """The test as a column."""
        field = self.field

        # on Arrow, as pandas would take a worker some 25 MB for nothing else
        @F.arrow_udf("boolean")
        def member(slots: pa.Array) -> pa.Array:
            return pa.array(hits(field.value, slots.fill_null(-1).to_numpy()))

        return member(self.slot(column))


def hits(field: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which slots are set; a negative slot never is."""
    at = np.maximum(slots, 0)
    return (((field[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)) > 0) & (slots >= 0)


def give_back() -> None:
    """Free memory goes back to the system, else a worker keeps what its largest batch took, even when it is idle."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc only
        trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose ``column`` holds ``limit`` bytes at most, or one row."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < batch.num_rows:
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(low, high - low)
        low = high
    give_back()
