"""Exact dedup with an extendible-hash index on shared files.

The index holds one entry per 64-bit key of a normalised text. Its directory starts with one
bucket; an overfull bucket is split on the next bit of the key, and the directory doubles when
that bit is deeper than its own. Every bucket is a range of keys with one owner task, which
chains the entries of its range. Texts that share a key are read once more and compared byte by
byte, so a collision of keys (or of digests) never joins different texts.

Only counts per key range reach the driver. Rows of one text are combined in the map tasks
before any shuffle, so a text that a third of all rows hold costs one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import BLANKS, KeyFilter, n_buckets, unused, written


@dataclass(frozen=True)
class Directory:
    """``depth`` leading bits of a key lead to a bucket; ``buckets`` has (prefix, local depth, entries)."""

    depth: int
    buckets: list[tuple[int, int, int]]

    def slots(self) -> list[tuple[int, int]]:
        """(leading bits, bucket) for all 2 ** depth slots."""
        out = []
        for number, (prefix, local, _) in enumerate(self.buckets):
            free = self.depth - local
            out += [((prefix << free) + k, number) for k in range(1 << free)]
        return out


def grow(counts: dict[int, int], count_bits: int, capacity: int) -> Directory:
    """Split overfull buckets, from entry counts per ``count_bits`` leading bits.

    A bucket at ``count_bits`` isn't split further; its owner chains what it holds.
    """
    depth, full, done = 0, [(0, 0, counts)], []
    while full:
        prefix, local, own = full.pop()
        entries = sum(own.values())
        if entries <= capacity or local == count_bits:
            done.append((prefix, local, entries))
            continue
        depth = max(depth, local + 1)
        shift = count_bits - local - 1
        for side in (0, 1):
            full.append(((prefix << 1) | side, local + 1, {k: n for k, n in own.items() if (k >> shift) & 1 == side}))
    return Directory(depth, sorted(done, key=lambda b: b[0] << (count_bits - b[1])))


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS + "+", "")


def leading(key: Column, bits: int) -> Column:
    """The first ``bits`` bits of a long."""
    return F.shiftrightunsigned(key, 64 - bits).cast("int") if bits else F.lit(0)


def build_index(keys: DataFrame, capacity: int = 1 << 20, count_bits: int = 16) -> tuple[DataFrame, Directory]:
    """The index on shared files, ``(owner, key, n)`` in key order per owner, and its directory."""
    spark = keys.sparkSession
    entries = written(keys.groupBy("key").agg(F.count("*").alias("n")), "entries")
    counts = {r[0]: r[1] for r in entries.groupBy(leading(F.col("key"), count_bits).alias("lead")).count().collect()}
    directory = grow(counts, count_bits, capacity)
    slots = spark.createDataFrame(directory.slots(), "lead int, owner int")
    owned = entries.withColumn("lead", leading(F.col("key"), directory.depth)).join(slots, "lead").drop("lead")
    index = owned.repartition(n_buckets(spark, 1), "owner").sortWithinPartitions("owner", "key")
    return written(index, "index"), directory


def _best(points: str, ident: str) -> Column:
    """Sorts the row that stays first: most code points, then the smallest id, null ids last."""
    return F.struct((-F.col(points)).alias("less"), F.col(ident).isNull().alias("no_id"), F.col(ident).alias("id"))


def _groups(rows: DataFrame, capacity: int) -> tuple[DataFrame, object]:
    """Groups of two rows or more ``(key, sha, size, best)``, compared by bytes, and a test of their keys.

    ``rows`` has id, points, norm and key.
    """
    index, _ = build_index(rows.select("key"), capacity)
    chained = index.where("n > 1")
    member = KeyFilter(chained, "key").column
    suspects = rows.where(member(F.col("key"))).select("key", "norm", "id", "points")
    same_bytes = suspects.groupBy("key", "norm").agg(F.count("*").alias("size"), F.min(_best("points", "id")).alias("best"))
    groups = same_bytes.where("size > 1").select("key", F.sha2(F.encode("norm", "UTF-8"), 256).alias("sha"), "size", "best")
    return written(groups, "groups"), member


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.char_length(F.col(text_col)), F.lit(0)).cast("long").alias("points"),
        normalised(F.col(text_col)).alias("norm"),
    ).withColumn("key", F.xxhash64("norm"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1 << 20) -> DataFrame:
    """One row per row of ``docs``: ``id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical without white space; null counts as empty, and all empty texts
    are one group. Of a group the row with the most code points stays, then the smallest id (null
    ids last); of rows alike in all of that exactly one. An empty table gives no rows.
    """
    rows = _rows(docs, id_col, text_col)
    groups, _ = _groups(rows, capacity)
    digests = written(rows.select("id", "points", "key", F.sha2(F.encode("norm", "UTF-8"), 256).alias("sha")), "digests")
    again = Window.partitionBy("key", "sha", "id").orderBy(F.desc("points"))
    found = digests.withColumn("again", F.row_number().over(again)).join(groups, ["key", "sha"], "left")
    first = (F.col("points") == -F.col("best.less")) & F.col("id").eqNullSafe(F.col("best.id")) & (F.col("again") == 1)
    return found.select(
        "id",
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | first).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1 << 20) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with their columns.

    Rows whose key is alone in the index pass without a shuffle.
    """
    names = docs.columns
    key, points, sha = (unused(names, n) for n in ("_key", "_points", "_sha"))
    groups, member = _groups(_rows(docs, id_col, text_col), capacity)
    keyed = docs.withColumn(key, F.xxhash64(normalised(F.col(text_col))))
    alone = keyed.where(~member(F.col(key)))
    others = keyed.where(member(F.col(key))).withColumns(
        {sha: F.sha2(F.encode(normalised(F.col(text_col)), "UTF-8"), 256), points: F.coalesce(F.char_length(text_col), F.lit(0))}
    )
    g = groups.select(*(F.col(c).alias(unused(names, f"_g_{c}")) for c in groups.columns))
    g_key, g_sha, _, g_best = g.columns
    found = others.join(g, (F.col(key) == F.col(g_key)) & (F.col(sha) == F.col(g_sha)), "left")
    single = found.where(F.col(g_key).isNull())
    first = (F.col(points) == -F.col(f"{g_best}.less")) & F.col(id_col).eqNullSafe(F.col(f"{g_best}.id"))
    rank = unused(names, "_rank")
    leaders = found.where(first).withColumn(rank, F.row_number().over(Window.partitionBy(key, sha, id_col).orderBy(points)))
    kept = leaders.where(F.col(rank) == 1)
    return alone.select(names).unionByName(single.select(names)).unionByName(kept.select(names))
