"""Mixing sources to target weights over output shards, with exact quotas.

A source's documents fall into blocks by a hash of their id; the blocks are permuted by another
hash. A source gives as many draws as its target needs: whole passes over its blocks, then the
first blocks of the permutation, the last of them in part, so the words taken are the rounded
target. A splitting tree deals those draws to the output shards: at each node the draws of all
sources go to the two halves by a multivariate hypergeometric draw, source by source, so every
shard gets its exact number of draws and a random mix of sources. A shard takes the next range of
each source's permuted blocks, disjoint from all others, and orders its documents by a hash.

Documents are only counted and hashed; the tree and the quotas work on blocks, of which there are
at most ``BLOCKS``, or four a shard if that is more, and one per source. All of it is built-in
functions. The same input gives the same mix, in any order and partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import WORD, n_buckets, unused, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 1 << 14
BLOCKS = 1 << 14
SHARD_WORDS = 1 << 24
#: Words that a task of the final order gets: a shard is cut at quantiles of its order.
PART_WORDS = 1 << 20


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash32(*parts: Column) -> Column:
    """32 bits of an md5, the same in any engine."""
    text = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, place, source_size, target)`` from ``sizes(source, size)``.

    Sources by code point, null last, take the weights in turn. All targets are weight times one
    level, or ``most`` times the source's size if that is less; the level makes their sum
    ``share`` of all sizes. That is what handing on the excess again and again ends in.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    own = own.withColumn("place", place).withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    own = own.withColumn("level", level)
    # the first source that its level doesn't fill, in the order of filling, sets the level
    level = F.min(F.when(F.col("level") * 1.0 <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(everything)
    target = F.least(F.col("cap").cast("double"), F.coalesce(level["level"] * F.col("weight"), F.col("cap").cast("double")))
    return own.select("source", "place", "source_size", target.alias("target"))


def _ln_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, shifted by 7 for small n."""
    z = n.cast("double") + 8
    product = F.lit(1.0)
    for k in range(1, 8):
        product = product * (n + k)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - F.log(product)


def _hypergeometric(total: Column, own: Column, drawn: Column, u: Column) -> Column:
    """How many of ``own`` among ``total`` are in a random ``drawn``: the quantile at ``u``.

    The probabilities are summed over twelve standard deviations around the mode.
    """
    low, high = F.greatest(F.lit(0), drawn + own - total), F.least(own, drawn)
    mode = F.least(high, F.greatest(low, F.floor((drawn + 1) * (own + 1) / (total + 2)))).cast("long")
    share = own / F.greatest(total, F.lit(1))
    reach = (F.ceil(12 * F.sqrt(drawn * share * (1 - share))) + 12).cast("long")
    first, last = F.greatest(low, mode - reach).cast("long"), F.least(high, mode + reach).cast("long")

    def log_p(x: Column) -> Column:
        return -(_ln_factorial(x) + _ln_factorial(own - x) + _ln_factorial(drawn - x) + _ln_factorial(total - own - drawn + x))

    weights = F.transform(F.sequence(first, last), lambda x: F.struct(x.alias("x"), F.exp(log_p(x) - log_p(mode)).alias("w")))

    def pick(weighed: Column) -> Column:
        whole = F.aggregate(weighed, F.lit(0.0), lambda s, y: s + y["w"])
        start = F.struct(F.lit(0.0).alias("s"), last.alias("x"), F.lit(False).alias("found"))
        step = lambda s, y: F.struct(
            (s["s"] + y["w"]).alias("s"),
            F.when(~s["found"] & (s["s"] + y["w"] >= u * whole), y["x"]).otherwise(s["x"]).alias("x"),
            (s["found"] | (s["s"] + y["w"] >= u * whole)).alias("found"),
        )
        return F.aggregate(weighed, start, step, lambda s: s["x"])

    return F.transform(F.array(weights), pick)[0]


def _unit(*parts: Column) -> Column:
    return (_hash32(*parts) + 0.5) / float(1 << 32)


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(shard, place, first, n)``: how many draws of each source a shard gets, and from which on.

    ``quotas`` is ``(place, n)``. All shards get the same number of draws, give or take one.
    """
    quota = F.sort_array(F.collect_list(F.struct("place", F.col("n").cast("long").alias("n"))))
    nodes = quotas.agg(quota.alias("own")).select(F.lit(0).alias("low"), F.lit(shards).alias("high"), "own")
    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        if level in (6, 12):  # enough nodes for many tasks
            nodes = nodes.repartition("low")
        mid = F.ceil((F.col("low") + F.col("high")) / 2).cast("int")
        total = F.aggregate("own", F.lit(0).cast("long"), lambda s, x: s + x["n"])
        half = F.floor(total * (mid - F.col("low")) / (F.col("high") - F.col("low")) + F.lit(0.5)).cast("long")
        start = F.struct(total.alias("total"), half.alias("left"), F.array().cast("array<bigint>").alias("out"))

        def deal(s: Column, x: Column) -> Column:
            drawn = _hypergeometric(s["total"], x["n"], s["left"], _unit(F.lit(seed), F.col("low"), F.col("high"), x["place"]))
            after = lambda d: F.struct((s["total"] - x["n"]).alias("total"), (s["left"] - d).alias("left"), F.concat(s["out"], F.array(d)).alias("out"))
            return F.transform(F.array(drawn.cast("long")), after)[0]

        left = F.when(F.col("high") - F.col("low") > 1, F.aggregate("own", start, deal, lambda s: s["out"]))
        nodes = nodes.withColumn("mid", mid).withColumn("left", left)
        first = F.zip_with("own", "left", lambda q, d: F.struct(q["place"].alias("place"), d.alias("n")))
        second = F.zip_with("own", "left", lambda q, d: F.struct(q["place"].alias("place"), (q["n"] - d).alias("n")))
        halves = F.array(
            F.struct(F.col("low").alias("low"), F.col("mid").alias("high"), first.alias("own")),
            F.struct(F.col("mid").alias("low"), F.col("high").alias("high"), second.alias("own")),
        )
        whole = F.array(F.struct("low", "high", "own"))
        nodes = nodes.select(F.explode(F.when(F.col("left").isNull(), whole).otherwise(halves)).alias("node")).select("node.*")
    leaves = nodes.select(F.col("low").alias("shard"), F.explode("own").alias("q")).select("shard", "q.place", "q.n")
    before = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _plan(sizes: DataFrame, weights, share, most, shard_words: int, seed: int) -> DataFrame:
    """What each block gives: ``(source, n_blocks, block, whole, part, shards, source_size, target)``.

    ``whole`` copies of all its documents and ``part`` words of one more; ``shards`` has the shard
    of each copy, the one in part last. ``sizes`` is ``(id, source, size)``.
    """
    sources = written(source_targets(sizes, weights, share, most), "sources")
    everything = sources.agg(F.sum("source_size"), F.sum("target")).first()
    shards = max(1, math.ceil((everything[1] or 0) / shard_words))
    # blocks stay well below shards however many there are
    block_words = max(BLOCK_WORDS, -(-(everything[0] or 0) // max(BLOCKS, 4 * shards)))
    sources = sources.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long"))
    sources = sources.withColumn("taking", F.round("target").cast("long"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("taking") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("passes", passes).withColumn("rest", F.col("taking") - F.col("passes") * F.col("source_size"))

    sized = sizes.join(sources.select(F.col("source").alias("s"), "n_blocks"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    blocks = sized.groupBy("source", _block(F.lit(seed), F.col("id"), F.col("n_blocks")).alias("block")).agg(F.sum("size").alias("held"))
    blocks = blocks.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    permuted = Window.partitionBy("place").orderBy(_hash32(F.lit(seed), F.lit("block"), F.col("place"), F.col("block")), "block")
    before = F.coalesce(F.sum("held").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("rank", F.row_number().over(permuted) - 1).withColumn("before", before)
    blocks = blocks.withColumn("existing", F.count("*").over(Window.partitionBy("place")))
    room = F.col("rest") - F.col("before")
    blocks = blocks.withColumn("whole", F.col("passes") + F.when((room > 0) & (room >= F.col("held")), 1).otherwise(0))
    blocks = written(blocks.withColumn("part", F.when((room > 0) & (room < F.col("held")), room).otherwise(0)), "blocks")

    draws = blocks.groupBy("place").agg(F.sum(F.col("whole") + F.signum("part").cast("long")).alias("n"))
    dealt = split_quotas(draws.where("n > 0"), shards, seed)
    dealt = dealt.where("n > 0").select("place", "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("draw"))
    turns = blocks.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("whole") + F.signum("part").cast("long"))))
    turns = turns.where(F.col("turn") < F.col("whole") + F.signum("part")).select("place", "block", "turn", (F.col("turn") * F.col("existing") + F.col("rank")).alias("draw"))
    shard_of = turns.join(dealt, ["place", "draw"]).groupBy("place", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "shard"))).alias("dealt"))
    plan = blocks.join(shard_of, ["place", "block"], "left").select(
        "source", "n_blocks", "block", "whole", "part", F.coalesce(F.transform("dealt", lambda d: d["shard"]), F.array().cast("array<int>")).alias("shards"), "source_size", "target"
    )
    return written(plan, "plan")


def _block(seed: Column, ident: Column, n_blocks: Column) -> Column:
    return F.pmod(_hash32(seed, F.lit("document"), ident), n_blocks)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, shard_words: int = SHARD_WORDS, seed: int = 0) -> DataFrame:
    """``docs`` with ``size, source_size, target, draws``, one row per row.

    ``draws`` is an array of ``(shard, words)``, one for each time the mix takes the document, all
    its words or, for at most one document a source, the first ``words`` of them. A null text has
    size 0 and, like every empty text, is never taken in part; a null source is a source. Rows
    that share an id share a block and are taken each. New columns get longer names if theirs
    clash. An empty table gives no rows.
    """
    names = docs.columns
    size, source_size, target, draws = (unused(names, n) for n in ("size", "source_size", "target", "draws"))
    sized = docs.withColumn(size, words_in(F.col(text_col)))
    sizes = written(sized.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(size).alias("size")), "sizes")
    plan = _plan(sizes, weights, share, most, shard_words, seed)
    return _apply(sized, plan, names, id_col, source_col, (size, source_size, target, draws), seed)


def _apply(sized: DataFrame, plan: DataFrame, names: list[str], id_col: str, source_col: str, new: tuple[str, ...], seed: int) -> DataFrame:
    size, source_size, target, draws = new
    taken = [*names, size]
    p = plan.select(*(F.col(c).alias(unused(taken, f"_p_{c}")) for c in plan.columns))
    p_source, p_n, p_block, p_whole, p_part, p_shards, p_size, p_target = (F.col(c) for c in p.columns)
    n_blocks = p.select(p_source.alias("_s"), p_n.alias("_n")).distinct()
    s, n, hashed = unused(taken, "_s"), unused(taken, "_n"), unused(taken, "_block")
    n_blocks = n_blocks.select(F.col("_s").alias(s), F.col("_n").alias(n))
    found = sized.join(n_blocks, F.col(source_col).eqNullSafe(F.col(s)))
    found = found.withColumn(hashed, _block(F.lit(seed), F.col(id_col), F.col(n)))
    found = found.join(p.drop(p_n), F.col(source_col).eqNullSafe(p_source) & (F.col(hashed) == p_block))
    whole = F.transform(F.slice(p_shards, F.lit(1), p_whole.cast("int")), lambda x: F.struct(x.alias("shard"), F.col(size).alias("words")))
    keep = [*names, size, p_size.alias(source_size), p_target.alias(target)]

    plain = found.where(p_part == 0).select(*keep, whole.alias(draws))
    # the block taken in part, one a source: its documents in the order of a hash until it is full
    order = Window.partitionBy(p_source, p_block).orderBy(_hash32(F.lit(seed), F.lit("part"), F.col(id_col)), F.col(id_col), F.desc(size))
    before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    words = F.least(F.col(size), F.greatest(F.lit(0), p_part - F.col(unused(taken, "_before")))).cast("long")
    more = F.struct(F.element_at(p_shards, -1).alias("shard"), words.alias("words"))
    edge = found.where(p_part > 0).withColumn(unused(taken, "_before"), before)
    edge = edge.select(*keep, F.when(words > 0, F.concat(whole, F.array(more))).otherwise(whole).alias(draws))
    return plain.unionByName(edge)


def drawn(mixed: DataFrame, names: list[str], text_col: str = "text", id_col: str = "doc_id", draws: str = "draws", size: str = "size", shard_words: int = SHARD_WORDS, seed: int = 0) -> DataFrame:
    """The mix itself: a row of ``names`` per draw, shard by shard, each in the order of a hash.

    A shard's order is cut into equal ranges of its hash, so a task sorts about ``PART_WORDS``
    words and no whole shard. A draw in part keeps the first words of the text with the white space around them.
    """
    taken = mixed.columns
    one, at, key = (unused(taken, n) for n in ("_draw", "_at", "_key"))
    rows = mixed.select("*", F.posexplode(draws).alias(at, one))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), F.col(one)["words"].cast("int")), "")
    text = F.when(F.col(one)["words"] < F.col(size), cut).otherwise(F.col(text_col))
    rows = rows.withColumn(text_col, text).withColumn(key, _hash32(F.lit(seed), F.lit("order"), F.col(one)["shard"], F.col(id_col), F.col(at)))
    shard, part = unused([*taken, one, at, key], "_shard"), unused([*taken, one, at, key], "_part")
    parts = max(1, shard_words // PART_WORDS)
    rows = rows.withColumn(shard, F.col(one)["shard"]).withColumn(part, F.floor(F.col(key) * parts / float(1 << 32)))
    rows = rows.repartition(n_buckets(rows.sparkSession), shard, part).sortWithinPartitions(shard, key)
    return rows.select(*names)
