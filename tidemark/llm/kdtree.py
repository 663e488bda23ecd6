"""Exact top-k by inner product over one KD-tree per shard.

A shard's tree halves its points at the median of the widest side and keeps tight boxes. A query
bounds its score in a box by taking, per component, the better end. Each query meets its home
shard first; the k-th score it finds there goes along to all other shards, where the search opens
boxes best first and stops at the first bound below the k-th score so far.

Queries travel in blocks and trees in shards, both of bounded size, joined on the shard.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import written

SHARD_ROWS = 8192
BLOCK_ROWS = 256
LEAF = 64
_EXACT = 2.0**53
_LONG = (1 << 63) - 1


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(id, dim, vector)`` with floor(256 x) as doubles; vectors with a null or non-finite part go."""
    for batch in batches:
        own = batch.column("vector").cast(pa.list_(pa.float64()))
        bounds = own.offsets.to_numpy()
        flat = own.values.to_numpy(zero_copy_only=False)  # null becomes nan
        with np.errstate(over="ignore", invalid="ignore"):
            flat = np.floor(flat * 256.0)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
        dim = np.diff(bounds)
        keep = (bad[bounds[1:]] == bad[bounds[:-1]]) & own.is_valid().to_numpy(zero_copy_only=False) & batch.column("id").is_valid().to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(keep)
        blobs = pa.array([flat[bounds[k] : bounds[k + 1]].tobytes() for k in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), pa.array(dim[rows], pa.int32()), blobs], ["id", "dim", "vector"])


def _matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=np.float64).reshape(len(blobs), dim)


class Tree:
    """Points in leaf order, and per node its box, its children or its range of points."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.order = np.arange(len(points))
        self.low, self.high, self.child, self.range = [], [], [], []
        self._build(points, 0, len(points))
        self.ids, self.points = ids[self.order], points[self.order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _build(self, points: np.ndarray, first: int, last: int) -> int:
        own = points[self.order[first:last]]
        node = len(self.range)
        self.low.append(own.min(axis=0))
        self.high.append(own.max(axis=0))
        self.range.append((first, last))
        self.child.append(None)
        sides = self.high[node] - self.low[node]
        if last - first > LEAF and sides.size and sides.max() > 0:
            half = (last - first) // 2
            part = np.argpartition(own[:, int(sides.argmax())], half)
            self.order[first:last] = self.order[first:last][part]
            self.child[node] = (self._build(points, first, first + half), self._build(points, first + half, last))
        return node

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floors: np.ndarray) -> Iterator[list[tuple[int, int]]]:
        """For each query, at most k (score, id) of points that score ``floors`` or more; the own id is left out."""
        bounds = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        for q in range(len(queries)):
            best: list[tuple[float, int]] = []  # heap of (score, -id), the worst first
            least = floors[q]
            open_boxes = [(-bounds[q, 0], 0)]
            while open_boxes:
                bound, node = heapq.heappop(open_boxes)
                if -bound < least:
                    break
                if self.child[node] is not None:
                    for c in self.child[node]:
                        if bounds[q, c] >= least:
                            heapq.heappush(open_boxes, (-bounds[q, c], c))
                    continue
                first, last = self.range[node]
                scores = self.points[first:last] @ queries[q]
                for at in np.flatnonzero(scores >= least):
                    ident = int(self.ids[first + at])
                    if ident == own[q]:
                        continue
                    heapq.heappush(best, (float(scores[at]), -ident))
                    if len(best) > k:
                        heapq.heappop(best)
                    if len(best) == k:
                        least = max(least, best[0][0])
            yield [(int(s), -i) for s, i in best]


def _plain(ids: np.ndarray, points: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[list[tuple[int, int]]]:
    """The same in whole numbers of any size, for components too large for exact doubles."""
    exact = [[int(x) for x in row] for row in points]
    for q, ident in zip(queries, own, strict=True):
        theirs = [int(x) for x in q]
        scores = ((max(-_LONG - 1, min(_LONG, sum(a * b for a, b in zip(theirs, row, strict=True)))), int(i)) for row, i in zip(exact, ids, strict=True) if i != ident)
        yield heapq.nsmallest(k, scores, key=lambda s: (-s[0], s[1]))


def _grouped(rows: pa.Table) -> pa.Table:
    """One row for all vectors of a shard or block."""
    dim = rows.column("dim")[0].as_py()
    order = np.argsort(rows.column("id").to_numpy(), kind="stable")
    ids = rows.column("id").to_numpy()[order]
    points = _matrix(rows.column("vector").to_pylist(), dim)[order]
    return pa.table({"dim": pa.array([dim], pa.int32()), "part": rows.column("part").slice(0, 1), "ids": pa.array([ids.tobytes()], pa.binary()), "points": pa.array([points.tobytes()], pa.binary())})


def _search(k: int, carried: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree, points, ids = None, None, None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                dim = row["dim"]
                if shard != (dim, row["part"]):
                    shard = (dim, row["part"])
                    ids = np.frombuffer(row["ids"], dtype=np.int64)
                    points = np.frombuffer(row["points"], dtype=np.float64).reshape(len(ids), dim)
                    tree = None
                own = np.frombuffer(row["q_ids"], dtype=np.int64)
                queries = np.frombuffer(row["q_points"], dtype=np.float64).reshape(len(own), dim)
                floors = np.frombuffer(row["q_floors"], dtype=np.float64) if carried else np.full(len(own), -np.inf)
                if dim * max(1.0, np.abs(points).max(initial=0)) * max(1.0, np.abs(queries).max(initial=0)) < _EXACT:
                    tree = tree or Tree(ids, points)
                    found = tree.search(queries, own, k, floors)
                else:
                    found = _plain(ids, points, queries, own, k)
                out += [(int(q), i, s) for q, hits in zip(own, found, strict=True) for s, i in hits]
            cols = list(zip(*out, strict=True)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])

    return run


def _with_floors(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of queries with the k-th score each query has so far (``held`` is query_id, score)."""
        for batch in batches:
            floors = []
            for ids, held in zip(batch.column("q_ids").to_pylist(), batch.column("held").to_pylist(), strict=True):
                scores: dict[int, list[int]] = {}
                for h in held or ():
                    scores.setdefault(h["query_id"], []).append(h["score"])
                kth = [sorted(scores.get(q, ()), reverse=True)[k - 1 : k] for q in np.frombuffer(ids, dtype=np.int64).tolist()]
                floors.append(np.array([x[0] if x and abs(x[0]) < _EXACT else -np.inf for x in kth], dtype=np.float64).tobytes())
            yield batch.select(["dim", "block", "home", "q_ids", "q_points"]).append_column("q_floors", pa.array(floors, pa.binary()))

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k best by inner product of floor(256 x).

    Ties go to the smaller id. Candidates are all rows of ``vectors`` but those with the query's
    id. A vector that is null or holds a null or non-finite component takes no part, nor does a
    row with a null id; vectors are compared with those of as many components. Repeated rows are
    candidates each, and a repeated query answers once. Scores beyond a long become its nearest
    end. No vectors or no queries: no rows.
    """
    schema = "id long, dim int, vector binary"
    points, asked = (written(df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).mapInArrow(_vectors, schema), "vectors") for df in (vectors, queries))
    shards = max(1, math.ceil(points.count() / shard_rows))
    blocks = max(1, math.ceil(asked.count() / BLOCK_ROWS))
    blob = "dim int, part int, ids binary, points binary"
    trees = points.withColumn("part", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int"))
    trees = written(trees.groupBy("dim", "part").applyInArrow(_grouped, blob), "shards")
    packed = asked.dropDuplicates(["id", "dim"]).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    packed = packed.groupBy("dim", "part").applyInArrow(_grouped, blob)
    packed = packed.select("dim", F.col("part").alias("block"), F.pmod("part", F.lit(shards)).alias("home"), F.col("ids").alias("q_ids"), F.col("points").alias("q_points"))
    packed = written(packed, "blocks")

    out = "query_id long, vec_id long, score long"
    met = packed.withColumn("part", F.col("home")).join(trees, ["dim", "part"])
    home = written(met.mapInArrow(_search(k, False), out), "home")

    # a block holds at most a few hundred queries, and each query k scores
    of_block = asked.select(F.col("id").alias("query_id"), "dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")).distinct()
    held = of_block.join(home, "query_id").groupBy("dim", "block").agg(F.collect_list(F.struct("query_id", "score")).alias("held"))
    floored = packed.join(held, ["dim", "block"], "left")
    floored = floored.mapInArrow(_with_floors(k), "dim int, block int, home int, q_ids binary, q_points binary, q_floors binary")
    others = floored.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("part <> home")
    met = others.join(trees, ["dim", "part"]).sortWithinPartitions("dim", "part")
    rest = met.mapInArrow(_search(k, True), out)
    ranked = home.unionByName(rest).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
