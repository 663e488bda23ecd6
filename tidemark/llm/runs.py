"""Periodic runs of words by maximal pairs of an LCP-interval tree.

A run with period q is a stretch of words that repeats itself q words on, holds at least
``TIMES`` periods and ``LEAST`` words, and can't be extended. Its first words and the words q on
are a maximal pair: the same words, with different words before them and after them. Conversely a
maximal pair of l words at distance d, with l + d >= max(LEAST, TIMES * d), spans a run, so no
pair is extended.

The suffixes of a batch of texts are sorted by doubling; only those whose first four words repeat
within their text are sorted further, since no shorter pair can span a run. The tree of LCP
intervals is walked from below. An interval holds its positions in text order, with the class of
their left word: positions of one class have no left-maximal pair and join without comparison. Two
occurrences that span a run with smallest period d have no third one between them, so where classes
differ a position meets its neighbours only, and the smaller interval joins the larger one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import WORD, slices, small_batches

TIMES = 4
LEAST = 6
_MIXED = -2  # the class of an interval whose positions have different left words


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in turn, and the bounds of each text in them. Null counts as empty."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    bounds = split.offsets.to_numpy(zero_copy_only=False)
    values = split.values.slice(bounds[0], bounds[-1] - bounds[0])
    filled = pc.greater(pc.binary_length(values), 0)
    upto = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    return values.filter(filled), upto[bounds - bounds[0]]


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorting order, and for each place in it the first place of its equals."""
    order = np.argsort(keys, kind="stable")
    own = keys[order]
    first = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, dtype=bool)
    return order, np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))


def suffix_order(codes: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose first ``least`` words (a power of two at most) repeat in their text, in the
    order of their suffixes, and the words each shares with the one before it (0: another text).
    """
    n = len(codes)
    home = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    end = bounds[1:][home]
    order, first = _groups(home * (int(codes.max(initial=0)) + 1) + codes)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[order], rank[n] = first, -1
    ranks, length, places, live = [rank], 1, np.zeros(0, dtype=np.int64), np.arange(n)
    while True:
        times = np.bincount(rank[live], minlength=1)
        live = live[times[rank[live]] > 1]
        if length == least:
            places = live
        if not len(live):
            break
        # suffixes of one group differ in their next words; one that has ended comes first
        after = live + length
        following = np.where(after < end[live], rank[np.minimum(after, n)] + 1, 0)
        order, first = _groups(rank[live] * (n + 1) + following)
        own = live[order]
        start = np.maximum.accumulate(np.where(np.concatenate([[True], rank[own][1:] != rank[own][:-1]]), np.arange(len(own)), 0))
        anew = rank[own] + first - start
        rank = rank.copy()
        rank[own] = anew
        ranks.append(rank)
        length *= 2
    places = places[np.argsort(rank[places])]
    left, right = places[:-1], places[1:]
    shared = np.zeros(len(left), dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        own = ranks[level]
        shared += np.where(own[np.minimum(left + shared, n)] == own[np.minimum(right + shared, n)], 1 << level, 0)
    return places, np.concatenate([[0], shared])[: len(places)]


def maximal_pairs(places: np.ndarray, shared: np.ndarray, left: np.ndarray, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Maximal pairs that span a run, as (start, length of the run, distance).

    ``places`` are suffixes in order, ``shared`` the words each shares with the one before it;
    ``left`` is the class of the word before each place, -1 for none.
    """
    found: list[tuple[int, int, int]] = []

    def join(a, b, n: int):
        """Two children of an interval of ``n`` words: the smaller joins the larger."""
        if len(a[0]) < len(b[0]):
            a, b = b, a
        own, kind = a
        if kind != b[1] or kind < 0:
            for x in b[0]:
                at = bisect_left(own, x)
                for y in own[max(0, at - 1) : at + 1]:
                    d = abs(x - y)
                    if n + d >= least and n >= (times - 1) * d and (left[x] != left[y] or left[x] < 0):
                        found.append((min(x, y), n + d, d))
            kind = _MIXED
        for x in b[0]:
            own.insert(bisect_left(own, x), x)
        return own, kind

    left = left.tolist()
    stack: list[list] = []  # open intervals: [words, what their closed children hold]
    node = None
    for place, n in zip([*places.tolist(), -1], [*shared.tolist(), 0], strict=True):
        while stack and stack[-1][0] > n:
            words, closed = stack.pop()
            node = join(closed, node, words)
        if n and node is not None:
            if stack and stack[-1][0] == n:
                stack[-1][1] = join(stack[-1][1], node, n)
            else:
                stack.append([n, node])
        if place >= 0:
            node = ([place], left[place])
    return found


def runs_of(codes: np.ndarray, bounds: np.ndarray, times: int = TIMES, least: int = LEAST) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period.

    ``codes`` are the words of all texts in turn, ``bounds`` those of the texts.
    """
    # a pair has ``least - d`` words and ``(times - 1) * d`` at least
    shortest = min(max(least - d, (times - 1) * d) for d in range(1, least + 1))
    prefix = 1 << (shortest.bit_length() - 1)
    places, shared = suffix_order(codes, bounds, prefix)
    shared = np.where(shared >= shortest, shared, 0)
    near = shared > 0
    near[:-1] |= shared[1:] > 0
    places, shared = places[near], shared[near]
    left = np.concatenate([[-1], codes[:-1]]).astype(np.int64) if len(codes) else np.zeros(0, dtype=np.int64)
    left[bounds[:-1][bounds[:-1] < len(codes)]] = -1
    # of one stretch the smallest distance is its period
    best: dict[tuple[int, int], int] = {}
    for start, length, d in maximal_pairs(places, shared, left, times, least):
        best[start, length] = min(d, best.get((start, length), d))
    rows = np.array([(s, n, d) for (s, n), d in best.items()], dtype=np.int64).reshape(-1, 3)
    text = np.searchsorted(bounds, rows[:, 0], "right") - 1
    rows = np.column_stack([text, rows[:, 0] - bounds[text], rows[:, 1:]])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = TIMES, least: int = LEAST) -> DataFrame:
    """``id, runs, collapsed``: the runs of each whole text, and the text without their repeats.

    ``runs`` is an array of ``(start, length, period)`` in words from 0, by start and period;
    ``collapsed`` the words that are in no run after its first period, joined by one blank. Texts
    that are null, empty or blank have no run and collapse to an empty text. Repeated rows are
    read each, a null id stays null, and an empty table gives no rows.
    """
    if times < 2 or least < 2:
        raise ValueError("a run repeats its period")
    small_batches(docs.sparkSession, 2000)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    run_type = "array<struct<start:bigint,length:bigint,period:bigint>>"
    schema = rows.select("id", F.array().cast(run_type).alias("runs"), F.lit("").alias("collapsed")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words, bounds = words_of(batch.column("text"))
                found = runs_of(words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds, times, least)
                depth = np.zeros(len(words) + 1, dtype=np.int64)
                start = bounds[found[:, 0]] + found[:, 1]
                np.add.at(depth, start + found[:, 3], 1)
                np.add.at(depth, start + found[:, 2], -1)
                kept = np.cumsum(depth[:-1]) == 0
                upto = np.concatenate([[0], np.cumsum(kept)])
                lists = pa.LargeListArray.from_arrays(pa.array(upto[bounds], pa.int64()), words.filter(pa.array(kept)))
                texts = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
                items = pa.StructArray.from_arrays([pa.array(found[:, k], pa.int64()) for k in (1, 2, 3)], ["start", "length", "period"])
                offsets = np.searchsorted(found[:, 0], np.arange(len(bounds)))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items), texts], ["id", "runs", "collapsed"])

    return rows.mapInArrow(run, schema)


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the tails of a tenth of its texts made periodic, as a test of the search.

    With h the crc32 of the id in decimals and n words, texts with h % 10 = 0 repeat their words
    from a = (h / 10) % n on with period 1 + (n - a) / (3 + (h / 10) % 8). A null id changes nothing.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))

    def tail(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        cycle = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda k: F.element_at(w, (a + k % p + 1).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), cycle), " "))

    # through an array of one, so the words are extracted once
    changed = F.transform(F.array(words), tail)[0]
    return docs.withColumn(text_col, F.when(h % 10 == 0, changed).otherwise(F.col(text_col)))
