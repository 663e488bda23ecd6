"""Fixity audit of WARC records with hash trees over offset ranges.

Each record of a file is hashed; the records that start in one range of offsets are hashed in
order into a leaf, and leaves into wider ranges up to one root per file. Replicas are compared
root against root, and only ranges that differ are opened, down to the records. Built-in
functions only; a node gathers at most ``FANOUT`` children or the records of ``WIDTH`` bytes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import written

WIDTH = 1 << 16
FANOUT = 16
PER_FILE = 1000


def record(url: Column, body: Column) -> Column:
    """The bytes of a WARC resource record as text."""
    size = F.octet_length(body).cast("string")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def records(pages: DataFrame, body: Column | None = None, per_file: int = PER_FILE) -> DataFrame:
    """``(file, offset, n_bytes, page_id, hash)``: pages as records of files, in the order of their ids.

    Null HTML is an empty record body, pages without an id are file -1. Offsets are those of the
    original HTML; ``body`` replaces what is hashed, as a replica would hold it.
    """
    original = F.coalesce("html", F.lit(""))
    file = F.coalesce(F.floor(F.col("page_id") / per_file), F.lit(-1)).cast("long")
    own = record(F.col("url"), original if body is None else body)
    rows = pages.select("page_id", file.alias("file"), F.octet_length(record(F.col("url"), original)).cast("long").alias("n_bytes"), F.sha2(F.encode(own, "UTF-8"), 256).alias("hash"))
    before = Window.partitionBy("file").orderBy("page_id", "n_bytes", "hash").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("n_bytes").over(before), F.lit(0))).select("file", "offset", "n_bytes", "page_id", "hash")


def _combined(order: str) -> Column:
    """Hash of the children in order, with their places."""
    child = F.concat_ws(":", F.col(order).cast("string"), "hash")
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), child.alias("child"))))
    return F.sha2(F.array_join(F.transform(ordered, lambda c: c["child"]), ",").cast("binary"), 256)


def tree(own: DataFrame, levels: int, width: int = WIDTH) -> DataFrame:
    """``(file, level, node, hash)`` for all ranges; level 0 has ranges of ``width`` bytes."""
    level = own.groupBy("file", F.floor(F.col("offset") / width).alias("node")).agg(_combined("offset").alias("hash"))
    level = written(level, "tree")
    nodes = level.withColumn("level", F.lit(0))
    for k in range(1, levels):
        level = level.groupBy("file", F.floor(F.col("node") / FANOUT).alias("parent")).agg(_combined("node").alias("hash")).withColumnRenamed("parent", "node")
        nodes = nodes.unionByName(level.withColumn("level", F.lit(k)))
    return written(nodes, "tree")


def audit(primary: DataFrame, replica: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(file, offset, n_bytes, page_id, status)`` of the records that differ.

    Both are ``(file, offset, n_bytes, page_id, hash)``. ``status`` is ``changed``, ``missing``
    from the replica or ``extra`` in it. Several records at one offset are compared as a multiset of
    hashes: those of one side alone are paired in the order of their hashes, and what is left over
    is missing or extra. Equal or empty tables give no rows.
    """
    last = primary.agg(F.max("offset")).unionByName(replica.agg(F.max("offset"))).agg(F.max("max(offset)")).first()[0] or 0
    levels = 1 + max(0, math.ceil(math.log(last // width + 1, FANOUT) - 1e-9))
    trees = [tree(x, levels, width) for x in (primary, replica)]

    def differing(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.withColumnRenamed("hash", "other")
        return a.join(b, ["file", "node"], "full_outer").where(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node")

    wrong = None
    for level in range(levels - 1, -1, -1):
        sides = [t.where(F.col("level") == level).select("file", "node", "hash") for t in trees]
        if wrong is not None:
            above = wrong.withColumnRenamed("node", "parent")
            sides = [s.withColumn("parent", F.floor(F.col("node") / FANOUT)).join(above, ["file", "parent"], "left_semi").drop("parent") for s in sides]
        wrong = written(differing(*sides), "wrong")
    opened = [r.withColumn("node", F.floor(F.col("offset") / width)).join(wrong, ["file", "node"], "left_semi") for r in (primary, replica)]
    alike = Window.partitionBy("file", "offset", "hash").orderBy("n_bytes", "page_id")
    p, r = (x.withColumn("copy", F.row_number().over(alike)) for x in opened)
    place = Window.partitionBy("file", "offset").orderBy("hash", "copy")

    def alone(a: DataFrame, b: DataFrame) -> DataFrame:
        """Records of ``a`` that ``b`` lacks, numbered per offset."""
        own = a.join(b, ["file", "offset", "hash", "copy"], "left_anti")
        return own.select("file", "offset", F.row_number().over(place).alias("place"), F.struct("n_bytes", "page_id").alias("record"))

    both = alone(p, r).join(alone(r, p).withColumnRenamed("record", "other"), ["file", "offset", "place"], "full_outer")
    status = F.when(F.col("other").isNull(), "missing").when(F.col("record").isNull(), "extra").otherwise("changed")
    shown = F.coalesce("record", "other")
    return both.select("file", "offset", shown["n_bytes"].alias("n_bytes"), shown["page_id"].alias("page_id"), status.alias("status"))


def damaged(pages: DataFrame) -> DataFrame:
    """The records of a replica of ``pages`` with known damage.

    Of each 211 ids one has its body cut in half, one has a byte more, and one is missing.
    """
    body = F.coalesce("html", F.lit(""))
    turn = F.pmod("page_id", F.lit(211))
    half = F.substring(body, F.lit(1), F.floor(F.char_length(body) / 2).cast("int"))
    held = records(pages, F.when(turn == 7, half).when(turn == 101, F.concat(body, F.lit("!"))).otherwise(body))
    return held.where("page_id is null or pmod(page_id, 211) <> 50")
