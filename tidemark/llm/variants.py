"""Spelling variants: words one edit apart, by dynamic programming along the sorted vocabulary.

The rows of an edit matrix depend on the letters read so far, so words that share a prefix share
its rows. A query word walks down the sorted vocabulary letter by letter: the words between two
places form a range with one prefix, adjacent common prefixes cut it into ranges one letter longer,
each range takes one more row of the matrix, and a range whose row has no entry up to one edit is
skipped with all its words. Only the three entries around the diagonal can be that small, so a row
is three numbers. All queries of a block take each step together.

Blocks keep that walk short and local. Words of ``c`` and ``c + 1`` letters that are one edit apart
share their first ``c // 2`` letters or their last ``c - c // 2``, so a word is looked up among
those with its first letters, and from the other end among those with its last ones. A block over
``limit`` words is cut by its next letter; its pairs that differ in just that letter meet in blocks
that leave it out. Every pair belongs to one block, and a task reads its blocks one after another.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, small_batches, written

#: U+00C0 to U+00FF beside the letters of ASCII.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_TIMES = 2
RATIO = 10
LIMIT = 4096
_CELLS = 1 << 21  # letters of the words that are walked at once
_WORDS = 1 << 14


def runs_of_letters(texts: pa.Array, least: int) -> tuple[pa.Array, np.ndarray]:
    """Maximal runs of at least ``least`` letters, A-Z in lower case, and the text of each."""
    bare = pc.replace_substring_regex(texts.cast(pa.large_string()).fill_null(""), f"[^{LETTERS}]+", " ")
    split = pc.ascii_split_whitespace(pc.ascii_lower(bare))
    bounds = split.offsets.to_numpy(zero_copy_only=False)
    values = split.values.slice(bounds[0], bounds[-1] - bounds[0])
    long = pc.greater_equal(pc.utf8_length(values), least)
    home = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return values.filter(long), home[long.to_numpy(zero_copy_only=False)]


def misspelt(run: str, crc: int, modulus: int) -> str:
    """``run`` without one letter if ``modulus`` divides ``crc``."""
    if crc % modulus:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_modulus: int = 0, least: int = LEAST_LETTERS) -> DataFrame:
    """``word, n``: runs of at least ``least`` letters in all texts, A-Z in lower case.

    With ``drop_modulus``, runs whose crc32 of ``<id>:<run>`` it divides lose one letter first.
    Null texts have no words; a null id counts as an empty one.
    """
    small_batches(docs.sparkSession, 2000)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words, home = runs_of_letters(batch.column("text"), least)
                coded = words.dictionary_encode()
                names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
                code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                times = np.bincount(code, minlength=len(names))
                changed: dict[str, int] = {}
                if drop_modulus and len(names):
                    pairs, n = np.unique(home * len(names) + code, return_counts=True)
                    own, which = pairs // len(names), pairs % len(names)
                    prefix = [zlib.crc32(f"{k}:".encode()) for k in batch.column("id").to_pylist()]
                    raw = [w.encode() for w in names]
                    crc = np.fromiter((zlib.crc32(raw[w], prefix[t]) for w, t in zip(which.tolist(), own.tolist(), strict=True)), dtype=np.int64, count=len(pairs))
                    hit = np.flatnonzero(crc % drop_modulus == 0)
                    np.subtract.at(times, which[hit], n[hit])
                    for w, h, m in zip(which[hit].tolist(), crc[hit].tolist(), n[hit].tolist(), strict=True):
                        word = misspelt(names[w], h, drop_modulus)
                        changed[word] = changed.get(word, 0) + m
                on = times > 0
                yield pa.RecordBatch.from_arrays([coded.dictionary.filter(pa.array(on)).cast(pa.string()), pa.array(times[on], pa.int64())], ["word", "n"])
                if changed:
                    yield pa.RecordBatch.from_arrays([pa.array(list(changed), pa.string()), pa.array(changed.values(), pa.int64())], ["word", "n"])

    counts = rows.mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.char_length("word") >= least)


def _blocks(words: DataFrame, limit: int, least: int) -> DataFrame:
    """``way, size, head, gap, word, n``: each word in each block it belongs to.

    ``way`` 0 reads words forwards, 1 backwards; ``head`` are the letters all words of the block
    share. ``gap`` null: the block has pairs that share the head. Otherwise it has pairs that
    differ first at letter ``gap``, and ``head`` is what all have but for that letter.
    """
    n = F.char_length("word")
    size = F.explode(F.filter(F.array(n, n - 1), lambda c: c >= least)).alias("size")
    rows = words.select("word", "n", F.reverse("word").alias("back"), size)
    ways = F.array(
        F.struct(F.lit(0).alias("way"), F.col("word").alias("text"), F.expr("substring(word, 1, size div 2)").alias("head")),
        F.struct(F.lit(1).alias("way"), F.col("back").alias("text"), F.expr("substring(back, 1, size - size div 2)").alias("head")),
    )
    rows = rows.select("size", "word", "n", F.explode(ways).alias("b")).select("b.way", "size", "b.head", F.lit(None).cast("int").alias("gap"), "b.text", "word", "n")
    key = ["way", "size", "head"]
    done, plain = [], ["way", "size", "head", "gap", "text", "word", "n"]
    while True:
        over = written(rows.groupBy(key).count().where(F.col("count") > limit).select(key), "over")
        if over.isEmpty():
            break
        rows = written(rows.join(over.withColumn("hot", F.lit(True)), key, "left"), "rows")
        done.append(rows.where("hot is null").select(plain))
        hot = rows.where("hot").withColumn("gap", F.char_length("head"))
        without = hot.withColumn("head", F.expr("concat(substring(text, 1, gap), substring(text, gap + 2))"))
        # equal but for that letter, or equal to a longer word without it
        done.append(without.select(plain))
        done.append(hot.where(F.char_length("text") == F.col("size")).withColumn("head", F.col("text")).select(plain))
        rows = hot.where(F.char_length("text") > F.col("gap")).withColumn("head", F.expr("substring(text, 1, gap + 1)")).withColumn("gap", F.lit(None).cast("int")).select(plain)
    for part in done:
        rows = rows.unionByName(part)
    return rows


def walk(codes: np.ndarray, lengths: np.ndarray, blocks: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word) of rows in one block that are one edit apart.

    ``codes`` are the letters of sorted words of ``c`` and ``c + 1`` letters, 0 behind the end;
    words of a block share their first ``start`` letters and stand together.
    """
    n, width = codes.shape
    same = np.cumprod(codes[1:] == codes[:-1], axis=1).sum(axis=1) if n > 1 else np.zeros(0, dtype=np.int64)
    shared = np.where(blocks[1:] == blocks[:-1], np.minimum(same, lengths[1:]), -1)
    shared = np.concatenate([[-1], shared])[:n]
    padded = np.column_stack([codes, np.zeros(n, dtype=codes.dtype)])
    query = np.arange(n)
    low = np.searchsorted(blocks, blocks, "left")
    high = np.searchsorted(blocks, blocks, "right")
    # edits between the first d letters of a range and the first d - 1, d and d + 1 of the query
    rows = np.tile(np.array([1, 0, 1], dtype=np.int8), (n, 1))
    found_q, found_w = [], []
    for d in range(start, width + 1):
        # words that end here stand first in their range
        ends = lengths[low] == d
        edits = np.take_along_axis(rows, np.clip(lengths[query] - d + 1, 0, 2)[:, None].astype(np.int64), axis=1)[:, 0]
        near = ends & (edits == 1) & (np.abs(lengths[query] - d) <= 1)
        found_q.append(query[near])
        found_w.append(low[near])
        if d == width:
            break
        low = low + ends
        cuts = np.flatnonzero(shared <= d)
        first, stop = np.searchsorted(cuts, low), np.searchsorted(cuts, high)
        # a range that starts behind a word that ended starts at a cut too
        times = np.maximum(stop - first, 0)
        times[low >= high] = 0
        which = np.repeat(np.arange(len(query)), times)
        at = np.repeat(first - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(len(which)) if len(which) else which
        query, old, limit = query[which], rows[which], high[which]
        low = cuts[at]
        high = np.minimum(np.append(cuts, n)[at + 1], limit)
        letter = codes[low, d]
        same_0 = letter != (padded[query, d - 1] if d else 0)
        same_1, same_2 = letter != padded[query, d], letter != padded[query, d + 1]
        rows = np.empty((len(query), 3), dtype=np.int8)
        rows[:, 0] = np.minimum(old[:, 0] + same_0, old[:, 1] + 1)
        rows[:, 1] = np.minimum(np.minimum(old[:, 1] + same_1, old[:, 2] + 1), rows[:, 0] + 1)
        rows[:, 2] = np.minimum(old[:, 2] + same_2, rows[:, 1] + 1)
        on = rows.min(axis=1) <= 1
        query, low, high, rows = query[on], low[on], high[on], np.minimum(rows[on], 2)
    return np.concatenate(found_q), np.concatenate(found_w)


def _near_in(part: pa.Table) -> pa.RecordBatch:
    """Near words of the words of whole blocks with one way, size and length of head."""
    texts, words = part.column("text").combine_chunks(), part.column("word").to_pylist()
    way, size = part.column("way")[0].as_py(), part.column("size")[0].as_py()
    gap = part.column("gap")[0].as_py()
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
    codes = np.zeros((len(texts), size + 1), dtype=np.uint32)
    codes[np.arange(size + 1) < lengths[:, None]] = flat
    head = part.column("head").combine_chunks()
    blocks = np.cumsum(np.concatenate([[0], pc.not_equal(head[1:], head[:-1]).to_numpy(zero_copy_only=False)]))
    query, other = walk(codes, lengths, blocks, len(head[0].as_py()) if gap is None else gap)
    first = (codes[query] == codes[other]).cumprod(axis=1).sum(axis=1)  # letters both begin with
    on = (lengths[query] == size) | (lengths[other] == size)
    if gap is not None:
        on &= first == gap
    if way:  # pairs that share their first letters are found forwards
        front = size // 2
        ahead = np.zeros((len(texts), front), dtype=np.uint32)
        for k in range(front):
            ahead[:, k] = codes[np.arange(len(texts)), lengths - 1 - k]
        on &= (ahead[query] != ahead[other]).any(axis=1)
    query, other = query[on], other[on]
    n = part.column("n").to_numpy()
    place = np.empty(len(words), dtype=np.int64)
    place[np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)] = np.arange(len(words))
    order = np.lexsort((place[other], -n[other], query))
    query, other = query[order], other[order]
    who, at, times = np.unique(query, return_index=True, return_counts=True)
    best = other[at]
    columns = [pa.array([words[k] for k in who.tolist()], pa.string()), pa.array(times, pa.int64()), pa.array([words[k] for k in best.tolist()], pa.string()), pa.array(n[best], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best", "best_n"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads sorted rows; whole blocks that are alike in way, size and head's length are walked together."""
    kept: list[pa.Table] = []
    kind, cells, last = None, 0, None

    def alike(table: pa.Table) -> pa.Array:
        parts = [table.column("way"), table.column("size"), pc.utf8_length(table.column("head")), pc.fill_null(table.column("gap"), -1)]
        return pc.binary_join_element_wise(*(p.cast(pa.string()) for p in parts), "|")

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        kinds = alike(table).to_pylist()
        heads = table.column("head").to_pylist()
        sizes = table.column("size").to_pylist()
        low = 0
        for k, (own, head, size) in enumerate(zip(kinds, heads, sizes, strict=True)):
            new_block = own != kind or head != last
            if new_block and (own != kind or cells >= _CELLS):
                kept.append(table.slice(low, k - low))
                joined = pa.concat_tables(kept)
                if joined.num_rows > 1:
                    yield _near_in(joined)
                kept, low, cells = [], k, 0
            kind, last = own, head
            cells += max(size, _CELLS // _WORDS)
        kept.append(table.slice(low))
    if kept and (joined := pa.concat_tables(kept)).num_rows > 1:
        yield _near_in(joined)


def near_words(words: DataFrame, limit: int = LIMIT, least: int = LEAST_LETTERS) -> DataFrame:
    """``word, n, n_near, best, best_n`` for distinct ``word, n``: how many words are one edit away,
    and of those the one with the largest ``n``, then the smallest by code point; 0 and nulls if none.
    """
    small_batches(words.sparkSession, 2000)
    rows = _blocks(words, limit, least)
    keys = ["way", "size", "head", "gap"]
    ordered = rows.repartition(*keys).sortWithinPartitions("way", "size", F.char_length("head"), "gap", "head", "text")
    found = ordered.select("way", "size", "head", "gap", "text", "word", "n").mapInArrow(_near, "word string, n_near long, best string, best_n long")
    own = words.select("word", F.col("n").cast("long").alias("n"), F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("best"), F.lit(None).cast("long").alias("best_n"))
    both = own.unionByName(found, allowMissingColumns=True)
    first = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))))
    joined = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), first.alias("first"))
    return joined.select("word", "n", "n_near", F.col("first.word").alias("best"), (-F.col("first.less")).alias("best_n"))


def variants(words: DataFrame, ratio: int = RATIO, limit: int = LIMIT, least: int = LEAST_LETTERS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for distinct ``word, n`` of ``least`` letters or more.

    A word's form is its most frequent near word (ties: the first by code point) if that is at
    least ``ratio`` times as frequent, else null; its root is where forms lead, itself without one.
    An empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words")
    found = near_words(words, limit, least)
    is_form = F.col("best_n") >= ratio * F.col("n")
    found = written(found.select("word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    # each step multiplies the count by the ratio, so a chain is as long as its logarithm; steps double
    least_n, most_n = found.agg(F.min("n"), F.max("n")).first()
    steps = math.floor(math.log(max(1.0, (most_n or 1) / max(1, least_n or 1)), ratio)) + 1
    links = found.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = written(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "links")
    rooted = found.join(links, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
