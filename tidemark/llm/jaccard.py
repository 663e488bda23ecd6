"""Near-duplicate documents: an exact self-join on the Jaccard similarity of word shingles.

Grouped prefix join. All shingles have one order, rare ones first. If two sets are as similar as
asked, they share a shingle among the first ``n - ceil(t * n) + 1`` of each. So:

1. documents with the same set become one class (its smallest id), classes with the same prefix
   and size one group;
2. groups are listed under each shingle of their prefix. Lists of one group go, and members
   whose size rules out all others of the list. Of lists of the same groups one stays;
3. lists are expanded to their members, and pairs are verified on whole sets. In each round a
   member meets one leader per list and size band, so a list of n members makes n pairs, not n².
   Classes that the links found so far connect need no further pair among themselves. Pairs
   that the parities of their sets rule out, for long texts parities as long as the set, send
   no set. The last round pairs whatever a list still holds in different components, so no link that matters to
   a component is missed, whatever the lists look like.

The order of the shingles follows counts over all documents. It steers only the cost: any order
gives the same links. What is broadcast is the list of the most frequent shingles, at most
``FREQUENT`` of them, and key filters of a fixed size.

Shingles are compared as 64-bit hashes; see ``shingles``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import KeyFilter, hits, in_few_tasks, n_buckets, slices, small_batches, unused, written
from tidemark.llm.shingles import mixed, pack, pack_sorted, parity, sets, unpack, unpack_sorted

PERCENT = 75
#: Bits of a shingle's hash under which it is counted and listed. Shingles that share them make
#: pairs that the whole sets then refuse.
KEY_BITS = 40
#: Most shingles that are broadcast as frequent: 9 bytes each.
FREQUENT = 1 << 19
#: A shingle that fewer documents hold isn't called frequent.
COMMON = 4
STAR_ROUNDS = 2
#: Entries of a document, about, by which tasks are counted.
LISTED = 16
PARITY = 1024  # slots of a set's parity
_FLUSH = 1 << 19  # keys that a task holds before it packs them
_SHIFT = np.uint64(64 - KEY_BITS)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of keys, so that sorted keys are sorted buckets."""
    return ((keys >> np.uint64(8)) * np.uint64(buckets)) >> np.uint64(KEY_BITS - 8)


def _cuts(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    owner = _bucket(keys, buckets)
    at = np.flatnonzero(np.diff(owner, prepend=np.uint64(buckets + 1)))
    for a, b in zip(at, [*at[1:], len(keys)], strict=True):
        yield int(owner[a]), a, b


def _count_blobs(buckets: int):
    """Per task, sorted keys with their numbers of documents, packed per bucket."""

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(parts), return_counts=True)
        rows = [(b, pack_sorted(keys[i:j]), pack(n[i:j])) for b, i, j in _cuts(keys, buckets)]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["bucket", "keys", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for own in sets(batch.column("text")):
                if len(own):
                    parts.append(own >> _SHIFT)
                    held += len(own)
                if held >= _FLUSH:
                    yield flush(parts)
                    parts, held = [], 0
        if parts:
            yield flush(parts)

    return run


def _frequent(rows: pa.Table) -> pa.Table:
    keys = np.concatenate([unpack_sorted(x) for x in rows.column("keys").to_pylist()])
    n = np.concatenate([unpack(x) for x in rows.column("n").to_pylist()])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] + np.uint64(1)))
    total = np.add.reduceat(n, first)
    often = total >= COMMON
    return pa.table({"key": keys[first][often].astype(np.int64), "n": total[often].astype(np.int64)})


def frequent_shingles(texts: DataFrame, held: int) -> DataFrame:
    """``(key, n)`` of the shingles that ``COMMON`` documents or more hold; ``texts`` has text in ``held`` rows."""
    blobs = texts.select("text").mapInArrow(_count_blobs(n_buckets(texts.sparkSession)), "bucket int, keys binary, n binary")
    return written(in_few_tasks(blobs.groupBy("bucket").applyInArrow(_frequent, "key long, n long"), LISTED * held), "frequent")


def _levels(frequent: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent keys, sorted, with the power of two of their counts; at most FREQUENT."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r[0]: r[1] for r in in_few_tasks(frequent.groupBy(power).count(), 64).collect()}
    least, held = 64, 0
    for p in sorted(sizes, reverse=True):
        held += sizes[p]
        if held > FREQUENT:
            break
        least = p
    # as Arrow: rows of objects would take the driver some twenty times as much
    rows = frequent.where(power >= least).select("key", power.alias("p")).toArrow()
    keys, powers = rows.column("key").to_numpy(), rows.column("p").to_numpy()
    order = np.argsort(keys)
    return keys[order].astype(np.uint64), powers[order].astype(np.int8)


def _sketches(shared, percent: int):
    """Per document its id, size, digest, parities of its set and the packed keys of its prefix, in order.

    ``finer`` is a parity with a slot or more for each shingle, null where ``signs`` is one already.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, power = shared.value
        for batch in batches:
            size, digest, signs, finer, prefix = [], [], [], [], []
            for own in sets(batch.column("text")):
                keys = own >> _SHIFT
                if len(often):
                    at = np.minimum(np.searchsorted(often, keys), len(often) - 1)
                    rank = np.where(often[at] == keys, power[at], 0)
                    keys = keys[np.argsort(rank, kind="stable")]
                n = len(own)
                keep = n - -(-percent * n // 100) + 1 if n else 0
                size.append(n)
                digest.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                signs.append(parity(own, PARITY))
                finer.append(parity(own, 1 << (n - 1).bit_length()).tobytes() if n > PARITY else None)
                prefix.append(pack(keys[:keep]))
            own = [pa.array(digest, pa.binary()), pa.array(signs, pa.list_(pa.int64())), pa.array(finer, pa.binary()), pa.array(prefix, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size, pa.int64()), *own], ["id", "n", "digest", "signs", "finer", "prefix"])

    return run


def _list_blobs(buckets: int, doubtful):
    """Per task, list entries sorted by key and packed per bucket, without rows in ``doubtful`` slots."""

    def flush(parts: list[tuple]) -> pa.RecordBatch:
        keys = np.concatenate([p[0] for p in parts])
        times = np.array([len(p[0]) for p in parts])
        order = np.argsort(keys, kind="stable")
        place = np.concatenate([np.arange(t, dtype=np.uint64) for t in times])[order]
        group, n = (np.repeat(np.array([p[k] for p in parts], dtype=np.int64), times)[order] for k in (1, 2))
        keys = keys[order]
        rows = [(b, pack_sorted(keys[i:j]), pack(group[i:j].view(np.uint64)), pack(n[i:j]), pack(place[i:j])) for b, i, j in _cuts(keys, buckets)]
        types = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["bucket", "keys", "gid", "n", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            batch = batch.filter(pa.array(~hits(doubtful.value, batch.column("slot").fill_null(-1).to_numpy())))
            for gid, n, prefix in zip(*(batch.column(c).to_pylist() for c in ("gid", "n", "prefix")), strict=True):
                parts.append((unpack(prefix), gid, n))
                held += len(parts[-1][0])
                if held >= _FLUSH:
                    yield flush(parts)
                    parts, held = [], 0
        if parts:
            yield flush(parts)

    return run


def _lists(percent: int):
    """Lists of two groups or more, without entries that fit neither neighbour in size."""

    def run(rows: pa.Table) -> pa.Table:
        keys = np.concatenate([unpack_sorted(x) for x in rows.column("keys").to_pylist()])
        gid, n, place = (np.concatenate([unpack(x) for x in rows.column(c).to_pylist()]) for c in ("gid", "n", "place"))
        order = np.lexsort((n, keys))
        keys, gid, n, place = keys[order], gid[order], n[order].astype(np.int64), place[order].astype(np.int64)
        same = (keys[1:] == keys[:-1]) & (100 * n[:-1] >= percent * n[1:])
        keep = np.zeros(len(keys), dtype=bool)
        keep[1:] |= same
        keep[:-1] |= same
        keys, gid, n, place = keys[keep], gid[keep], n[keep], place[keep]
        # two sums over the groups of each list, by which lists of the same groups are told
        first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))
        held = np.diff(first, append=len(keys))
        marks = [np.repeat(fold(mixed(gid + np.uint64(k)), first), held).view(np.int64) if len(keys) else gid.view(np.int64) for k, fold in enumerate((np.add.reduceat, np.bitwise_xor.reduceat))]
        return pa.table({"key": keys.astype(np.int64), "gid": gid.view(np.int64), "n": n, "place": place, "total": marks[0], "odd": marks[1]})

    return run


def _one_of_each(entries: DataFrame) -> DataFrame:
    """One list of each collection of groups: another list of the same groups holds the same pairs.

    What a shared shingle's places rule out isn't similar, so a similar pair passes in each of its lists.
    """
    rows = entries.count()
    lead = entries.groupBy("total", "odd").agg(F.min("key").alias("key")).select("key")
    lead = written(in_few_tasks(lead, rows), "leads")
    return in_few_tasks(entries.drop("total", "odd").join(lead, "key", "left_semi"), rows)


def _set_rows(first, second):
    """Packed sets of the rows in a slot of either field, and in which field."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").fill_null(-1).to_numpy()
            is_a, is_b = hits(first.value, slot), hits(second.value, slot)
            wanted = is_a | is_b
            batch = batch.filter(pa.array(wanted))
            own = pa.array([pack_sorted(s) if len(s) else None for s in sets(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), own, pa.array(is_a[wanted]), pa.array(is_b[wanted])], ["id", "shingles", "is_a", "is_b"])

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "x", 4 << 20)):
            linked = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                p, q = unpack_sorted(x), unpack_sorted(y)
                both = len(np.intersect1d(p, q, assume_unique=True))
                linked.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _alike(percent: int):
    """Pairs whose parities differ in no more slots than similar sets of their sizes can."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (batch.column(c).flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1) for c in ("x", "y"))
                apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                sizes = batch.column("sizes").to_numpy()
                batch = batch.filter(pa.array((100 + percent) * apart <= (100 - percent) * sizes))
            yield batch.select(["a", "b"])

    return run


def _hopeful(pairs: DataFrame, rows: int, signs: DataFrame, percent: int) -> DataFrame:
    """``pairs``, some ``rows``, that their parities (``signs``: id, n, signs; an id may repeat) don't rule out."""
    x = signs.select(F.col("id").alias("a"), F.col("n").alias("x_n"), F.col("signs").alias("x"))
    y = signs.select(F.col("id").alias("b"), F.col("n").alias("y_n"), F.col("signs").alias("y"))
    both = in_few_tasks(in_few_tasks(pairs.join(x, "a"), rows).join(y, "b"), rows).select("a", "b", "x", "y", (F.col("x_n") + F.col("y_n")).alias("sizes"))
    return written(in_few_tasks(both.mapInArrow(_alike(percent), "a long, b long").distinct(), rows), "hopeful")


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    """A parity with fewer slots, a power of two of them."""
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def _still_alike(percent: int):
    """Like ``_alike`` for parities of any length; a pair without both of them passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, sizes in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "sizes")), strict=True):
                apart = 0
                if x is not None and y is not None:
                    size = min(len(x), len(y))
                    p, q = (_folded(np.frombuffer(z, dtype=np.uint8), size) for z in (x, y))
                    apart = int(np.bitwise_count(p ^ q).sum(dtype=np.int64))
                keep.append((100 + percent) * apart <= (100 - percent) * sizes)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _not_ruled_out(pairs: DataFrame, finer: DataFrame, percent: int) -> DataFrame:
    """``pairs`` that their finer parities (``finer``: id, n, finer; an id may repeat) don't rule out.

    Long texts fill the slots of ``signs``, and their sets are the ones that cost most to send.
    """
    x = finer.select(F.col("id").alias("a"), F.col("n").alias("x_n"), F.col("finer").alias("x"))
    y = finer.select(F.col("id").alias("b"), F.col("n").alias("y_n"), F.col("finer").alias("y"))
    rows = pairs.count()
    both = in_few_tasks(in_few_tasks(pairs.join(x, "a"), rows).join(y, "b"), rows).select("a", "b", "x", "y", (F.col("x_n") + F.col("y_n")).alias("sizes"))
    return written(in_few_tasks(both.mapInArrow(_still_alike(percent), "a long, b long").distinct(), rows), "alike")


def _links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The ``pairs(a, b)`` whose sets are similar, from the whole texts of their ends."""
    first, second = KeyFilter(pairs, "a"), KeyFilter(pairs, "b")
    rows = texts.withColumn("slot", first.slot(F.col("id"))).mapInArrow(_set_rows(first.field, second.field), "id long, shingles binary, is_a boolean, is_b boolean")
    sets_of = written(rows.where("shingles is not null"), "sets")
    x = sets_of.where("is_a").select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    y = sets_of.where("is_b").select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    rows = pairs.count()
    both = in_few_tasks(in_few_tasks(pairs.join(x, "a"), rows).join(y, "b"), rows).select("a", "b", "x", "y")
    return written(both.mapInArrow(_verify(percent), "a long, b long"), "links")


def _fits(percent: int):
    """Size and place of a shared shingle allow the similarity, for sides ``l_`` and ``r_``."""
    n, m, i, j = (F.col(c) for c in ("l_n", "r_n", "l_place", "r_place"))
    most = 1 + F.least(i, j) + F.least(n - i, m - j) - 1  # the shared one, those before it, those after it
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m))


def _side(df: DataFrame, side: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{side}_{c}") for c in df.columns))


def _star(lists: DataFrame, rows: int, turn: int, percent: int) -> DataFrame:
    """Each member with the leader of its list in its own size band and in the next lower one.

    First the leader is the member with the fewest rarer shingles, which the others of a group of
    near copies are most similar to; later it is chosen by a hash.
    """
    first = F.col("place") if turn == 0 else F.lit(0).cast("long")
    spot = F.struct(first.alias("first"), F.xxhash64("id", F.lit(turn)).alias("h"), "id", "n", "place", "component")
    leaders = lists.groupBy("key", "band").agg(F.min(spot).alias("s"), F.count("*").alias("held"))
    leaders = leaders.select("key", "band", "s.id", "s.n", "s.place", "s.component")
    r = _side(leaders, "r")
    near = lists.withColumn("to", F.explode(F.array("band", F.col("band") - 1)))
    met = _side(near, "l").join(r, (F.col("l_key") == F.col("r_key")) & (F.col("l_to") == F.col("r_band")))
    return _pairs(met, rows, percent)


def _pairs(met: DataFrame, rows: int, percent: int) -> DataFrame:
    met = met.where((F.col("l_id") != F.col("r_id")) & (F.col("l_component") != F.col("r_component")) & _fits(percent))
    met = in_few_tasks(met.select(F.greatest("l_id", "r_id").alias("a"), F.least("l_id", "r_id").alias("b")), rows)
    return in_few_tasks(met.distinct(), rows)


def _rest(lists: DataFrame, rows: int, signs: DataFrame, percent: int) -> DataFrame:
    """All pairs of a list in different components: members outside its largest one with all.

    The parities are compared in the join itself, so pairs that they rule out are never rows.
    """
    parts = in_few_tasks(lists.groupBy("key", "component").agg(F.count("*").alias("held")), rows)
    most = parts.groupBy("key").agg(F.max_by("component", F.struct("held", "component")).alias("main"), F.count("*").alias("parts"))
    mixed = in_few_tasks(in_few_tasks(lists.join(most.where("parts > 1").drop("parts"), "key"), rows).join(signs, ["id", "n"]), rows)
    few = _side(mixed.where("component <> main"), "l").withColumn("l_to", F.explode(F.sequence(F.col("l_band") - 1, F.col("l_band") + 1)))
    met = few.join(_side(mixed, "r"), (F.col("l_key") == F.col("r_key")) & (F.col("l_to") == F.col("r_band")))
    words = (F.bit_count(F.get("l_signs", F.lit(k)).bitwiseXOR(F.get("r_signs", F.lit(k)))) for k in range(PARITY // 64))
    apart = reduce(lambda x, y: x + y, words)
    return _pairs(met.where((100 + percent) * apart <= (100 - percent) * (F.col("l_n") + F.col("r_n"))), rows, percent)


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``id, n_shingles, component_id``.

    Two documents link when ``100 * intersection >= percent * union`` of their shingle sets; a
    document without words links with nothing. Rows that share an id are one node. A null id is
    never a node: its row gets its size and a null component. An empty table gives no rows.
    """
    spark = small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    held = texts.count()
    shared = spark.sparkContext.broadcast(_levels(frequent_shingles(texts, held)))
    sketches = written(texts.mapInArrow(_sketches(shared, percent), "id long, n long, digest binary, signs array<long>, finer binary, prefix binary"), "sketches")

    nodes = sketches.where("n > 0 and id is not null").withColumn("mark", F.md5("prefix"))
    classes = nodes.groupBy("digest", "n", "mark").agg(F.min("id").alias("rep"), F.count("*").alias("rows"))
    classes = in_few_tasks(classes, held)
    groups = classes.groupBy("n", "mark").agg(F.min("rep").alias("gid"), F.sum("rows").alias("held"), F.count("*").alias("members"))
    classes = written(in_few_tasks(classes.join(groups, ["n", "mark"]), held), "classes")
    several = classes.where("held > 1")
    crowd = nodes.select("id", "digest", "n").join(several.select("digest", "n", "rep"), ["digest", "n"])
    crowd = in_few_tasks(crowd.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")), held)
    copies = written(in_few_tasks(crowd.distinct(), held), "copies")

    # one head stands for each group; rows alone in their group pass without a shuffle
    place = F.xxhash64("mark", "n")
    shared_prefix = KeyFilter(several.withColumn("at", place), "at")
    doubtful = nodes.where(shared_prefix.column(place)).select("id", "n", "mark", "prefix").join(classes.select("n", "mark", F.col("gid").alias("id")).distinct(), ["n", "mark", "id"], "left_semi")
    doubtful = written(in_few_tasks(doubtful.groupBy("n", "mark", "id").agg(F.first("prefix").alias("prefix")), held), "doubtful")
    alone = nodes.select(F.col("id").alias("gid"), "n", "prefix", shared_prefix.slot(place).alias("slot"))
    heads = alone.unionByName(doubtful.select(F.col("id").alias("gid"), "n", "prefix", F.lit(None).cast("long").alias("slot")))
    blobs = heads.mapInArrow(_list_blobs(n_buckets(spark), shared_prefix.field), "bucket int, keys binary, gid binary, n binary, place binary")
    entries = "key long, gid long, n long, place long, total long, odd long"
    group_lists = _one_of_each(written(in_few_tasks(blobs.groupBy("bucket").applyInArrow(_lists(percent), entries), LISTED * held), "entries"))
    members = classes.where("members > 1").select("gid", F.col("rep").alias("id"), "n")
    # members of one group share their whole prefix: a list of their own, under a key no shingle has
    inside = members.select((-F.col("gid") - 1).alias("key"), "id", "n", F.lit(0).cast("long").alias("place"))
    others = group_lists.join(members.where("id <> gid"), ["gid", "n"]).select("key", "id", "n", "place")
    lists = group_lists.withColumnRenamed("gid", "id").unionByName(others).unionByName(inside)
    band = F.floor(F.log("n") / F.log(F.lit(100.0 / percent))).cast("int")
    lists = written(lists.withColumn("band", band), "lists")
    rows = lists.count()
    listed = nodes.join(lists.select("id").distinct(), "id", "left_semi").select("id", "n", "signs", "finer")
    parities = written(in_few_tasks(in_few_tasks(listed, held).distinct(), held), "parities")
    signs, finer = parities.select("id", "n", "signs"), parities.select("id", "n", "finer")

    edges, labels, tested = copies, None, None
    for turn in range(STAR_ROUNDS + 1):
        if turn and labels is None:
            labels = written(components(edges), "labels")
        own = lists.join(labels, "id", "left") if labels else lists.withColumn("component", F.lit(None).cast("long"))
        own = in_few_tasks(own.withColumn("component", F.coalesce("component", "id")), rows)
        pairs = _star(own, rows, turn, percent) if turn < STAR_ROUNDS else _rest(own, rows, signs, percent)
        if tested is not None:
            pairs = in_few_tasks(pairs.join(tested, ["a", "b"], "left_anti"), rows)
        pairs = _hopeful(pairs, rows, signs, percent) if turn < STAR_ROUNDS else written(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        if not pairs.isEmpty():
            edges, labels = edges.unionByName(_links(_not_ruled_out(pairs, finer, percent), texts, percent)), None
    labels = labels or written(components(edges), "labels")
    return (
        sketches.select("id", F.col("n").alias("n_shingles"))
        .join(labels, "id", "left")
        .select("id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that lead their component (or have no id), one row each, with all columns."""
    names = docs.columns
    found = near_components(docs, id_col, text_col, percent).where("id is not null")
    extra = written(found.where("id <> component_id").select("id").distinct(), "followers")
    member = KeyFilter(extra, "id")
    near = unused(names, "_near")
    marked = docs.withColumn(near, member.column(F.col(id_col).cast("long")))
    clear = marked.where(~F.col(near)).select(names)
    follower = unused(names, "_follower")
    unsure = marked.where(near).join(extra.withColumnRenamed("id", follower), F.col(id_col).cast("long") == F.col(follower), "left_anti")
    return clear.unionByName(unsure.select(names))
