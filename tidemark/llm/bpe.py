"""Byte-pair encoding of whole texts with an index of pair occurrences, and decoding.

The pre-tokens of a batch lie in one linked list of symbols. An index maps every pair of
neighbours that the vocabulary merges to all its positions. Ranks are taken in ascending order:
all occurrences of the pair are merged at once, and only the lists of the pairs that the merged
symbols now form change. Pre-tokens are told apart first, so a word costs its merges once a batch.

The vocabulary is a tokenizer file of merges over bytes with a mark at the end of a pre-token. Its
normalisation and its cutting into pre-tokens are the library's own; printable ASCII words without
a special token take a shortcut with the same cuts.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, small_batches

#: Bytes of text that a task encodes at once; its arrays take some thirty times as much.
BYTES = 4 << 20
#: Pre-tokens whose ids a task remembers before it starts afresh.
KNOWN = 400_000
_NONE = np.iinfo(np.int32).max  # the rank of a pair that is not merged
_LOOK = 1 << 16  # pairs whose ranks are looked up at once
_LINES = 1 << 13  # words that are Python strings at once


def _slot(key: np.ndarray) -> np.ndarray:
    return (key * 0x9E3779B1) >> 7 & ((1 << 21) - 1)


class Vocabulary:
    """Merges, symbols and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        ids, mark = data["model"]["vocab"], data["model"].get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in data["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        made = {a + b: rank for rank, (a, b) in enumerate(merges)}
        if len(made) < len(merges) or any(made.get(x, -1) > rank for rank, pair in enumerate(merges) for x in pair):
            raise ValueError("a symbol is made by two merges, or merged before it is made")
        keys = np.array([ids[a] * self.size + ids[b] for a, b in merges], dtype=np.int64)
        self.ranks = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.ranks]
        self.hashed = np.zeros(1 << 21, dtype=bool)
        self.hashed[_slot(self.keys)] = True
        self.twins = np.array([a == b for a, b in merges], dtype=bool)
        self.products = np.array([ids[a + b] for a, b in merges], dtype=np.int32)
        #: Symbols of each byte, inside a pre-token and at its end; a byte that can't be shown has a code point from 256.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        names = {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(sorted(set(range(0x100)) - set(shown)))}
        self.inner = np.array([ids.get(names[b], -1) for b in range(0x100)], dtype=np.int32)
        self.last = np.array([ids.get(names[b] + mark, -1) for b in range(0x100)], dtype=np.int32)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        # the library normalises and cuts only, so it gets no vocabulary of its own
        cutting = data | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": [], "post_processor": None}
        self.tokenizer = Tokenizer.from_str(json.dumps(cutting))

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols."""
        key = left.astype(np.int64) * self.size + right
        # a table of hashes rules out most pairs; the sorted keys decide the rest
        out = np.full(len(key), _NONE, dtype=np.int32)
        maybe = np.flatnonzero(self.hashed[_slot(key)])
        if len(maybe):
            key = key[maybe]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[maybe] = np.where(self.keys[at] == key, self.ranks[at], _NONE)
        return out

    def pre_tokens(self, word: str) -> list[str | int]:
        """Pre-tokens of a text; a special token is its number."""
        out: list[str | int] = []
        for part in self.cut.split(word) if self.cut else [word]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part) if self.tokenizer.normalizer else part
                out += [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        return out


class PairIndex:
    """Positions of every pair that merges, over the symbols of many pre-tokens."""

    def __init__(self, vocabulary: Vocabulary, symbols: np.ndarray, ends: np.ndarray):
        """``ends`` are the places after the last symbol of each pre-token."""
        n = len(symbols)
        self.vocabulary, self.symbols = vocabulary, symbols.copy()
        self.next, self.before = np.arange(1, n + 1), np.arange(-1, n - 1)
        self.next[ends - 1] = -1
        self.before[ends[ends < n]] = -1
        self.alive = np.ones(n, dtype=bool)
        self.rank = np.full(n, _NONE, dtype=np.int32)
        for low in range(0, n, _LOOK):
            self._look(np.arange(low, min(n, low + _LOOK)))
        # positions by rank; what merging adds goes to ``more``
        known = np.flatnonzero(self.rank != _NONE)
        self.order = known[np.argsort(self.rank[known], kind="stable")]
        ranks = self.rank[self.order]
        starts = np.flatnonzero(np.diff(ranks, prepend=np.int32(-1)))
        active = ranks[starts]
        stops = np.append(starts, len(self.order))[1:]
        self.slot = {k: (a, b) for k, a, b in zip(active.tolist(), starts.tolist(), stops.tolist(), strict=True)}
        self.more: dict[int, list[np.ndarray]] = defaultdict(list)
        self.heap = active.tolist()  # sorted, so a heap

    def _look(self, at: np.ndarray) -> np.ndarray:
        after = self.next[at]
        found = np.where(after >= 0, self.vocabulary.ranks_of(self.symbols[at], self.symbols[np.maximum(after, 0)]), _NONE)
        self.rank[at] = found
        return found

    def _occurrences(self, rank: int) -> np.ndarray:
        low, high = self.slot.pop(rank, (0, 0))
        added = self.more.pop(rank, ())
        at = np.concatenate([self.order[low:high], *added]) if len(added) else self.order[low:high]
        at = at[self.rank[at] == rank]
        if len(at) < 2 or not self.vocabulary.twins[rank]:
            return at
        # in x x x only every other pair of a chain merges
        at = np.unique(at)
        chained = self.next[at[:-1]] == at[1:]
        place = np.arange(len(at))
        first = np.maximum.accumulate(np.where(np.concatenate([[True], ~chained]), place, 0))
        return at[(place - first) % 2 == 0]

    def _add(self, at: np.ndarray) -> None:
        """Put positions whose pair has changed into the lists of their pairs."""
        ranks = self._look(at)
        on = ranks != _NONE
        at, ranks = at[on], ranks[on]
        if not len(at):
            return
        order = np.argsort(ranks)
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(at)]
        for low, high, k in zip(bounds[:-1], bounds[1:], ranks[bounds[:-1]].tolist(), strict=True):
            if k not in self.slot and k not in self.more:
                heapq.heappush(self.heap, k)
            self.more[k].append(at[low:high])

    def merge(self) -> None:
        """Apply all merges, lowest rank first."""
        while self.heap:
            rank = heapq.heappop(self.heap)
            at = self._occurrences(rank)
            if not len(at):
                continue
            second = self.next[at]
            self.symbols[at] = self.vocabulary.products[rank]
            self.alive[second] = False
            self.rank[second] = _NONE
            after = self.next[second]
            self.next[at] = after
            self.before[after[after >= 0]] = at[after >= 0]
            left = self.before[at]
            self._add(np.concatenate([at, left[left >= 0]]))


class Encoder:
    """Ids of many texts at once."""

    #: Printable ASCII and letters of Latin-1: composed, and each lower case is one letter.
    PLAIN = r"^[\x21-\x7EÀ-ÖØ-öø-ÿ]*$"
    #: The pre-tokens of such words in lower case, one word a line.
    TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|\n|[^a-z0-9ß-öø-ÿ\n]+")

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        probe = "it's a1b22 we'll!? x'y ''d #$% i'm_don't É'sß- ÿöø".split(" ")
        plain = [t for w in probe for t in self.TOKENS.findall(w.lower())]
        self.quick = plain == [t for w in probe for t in self.vocabulary.pre_tokens(w)]
        self._forget()

    def _forget(self) -> None:
        """Known pre-tokens, their ids in turn, and the bounds of each in them."""
        self.seen = pa.array([], pa.string())
        self.ids, self.own = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _words(self, words: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, list[int]]:
        """All pre-tokens of ``words`` in turn, the bounds of each word in them, and the numbers of special tokens.

        A special token is null among the pre-tokens.
        """
        plain = pc.match_substring_regex(words, self.PLAIN).to_numpy(zero_copy_only=False) & self.quick
        for text in self.vocabulary.special:
            plain &= ~pc.match_substring(words, text).to_numpy(zero_copy_only=False)
        lines, found = pc.utf8_lower(words.filter(pa.array(plain))), [pa.array([], pa.string())]
        for low in range(0, len(lines), _LINES):
            some = lines.slice(low, _LINES).to_numpy(zero_copy_only=False).tolist()
            found.append(pa.array(self.TOKENS.findall("\n".join([*some, ""])), pa.string()))
        tokens = pa.concat_arrays(found)
        # the words outside the plain alphabet follow, then both are put in the order of ``words``
        rest, special, ends = [], [], []
        for word in words.filter(pa.array(~plain)).to_numpy(zero_copy_only=False).tolist():
            own = self.vocabulary.pre_tokens(word)
            rest += [t if isinstance(t, str) else None for t in own]
            special += [t for t in own if not isinstance(t, str)]
            ends.append(len(rest))
        line_ends = np.flatnonzero(pc.equal(tokens, "\n").to_numpy(zero_copy_only=False))
        first, stop = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        first[plain], stop[plain] = np.concatenate([[0], line_ends + 1])[: len(line_ends)], line_ends
        ends = len(tokens) + np.array(ends, dtype=np.int64)
        first[~plain], stop[~plain] = np.concatenate([[len(tokens)], ends])[: len(ends)], ends
        coded = pa.concat_arrays([tokens, pa.array(rest, pa.string())]).dictionary_encode()
        size = stop - first
        bounds = np.concatenate([[0], np.cumsum(size)])
        return coded.take(pa.array(np.repeat(first - bounds[:-1], size) + np.arange(bounds[-1]))), bounds, special

    def _places(self, tokens: pa.Array) -> np.ndarray:
        """The place of each distinct pre-token among the known ones; new ones are merged and added."""
        if len(self.seen) > KNOWN:
            self._forget()
        at = pc.index_in(tokens, value_set=self.seen)
        new = at.is_null()
        added = tokens.filter(new)
        place = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        place[new.to_numpy(zero_copy_only=False)] = len(self.seen) + np.arange(len(added))
        if len(added):
            ids, bounds = self._ids(added)
            self.seen = pa.concat_arrays([self.seen, added])
            self.own = np.concatenate([self.own, len(self.ids) + bounds[1:]])
            self.ids = np.concatenate([self.ids, ids])
        return place

    def _ids(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens in turn, and their bounds."""
        data, bounds = bytes_of(tokens)
        symbols, ends = self.vocabulary.inner[data], bounds[1:]
        symbols[ends - 1] = self.vocabulary.last[data[ends - 1]]
        if (symbols < 0).any():
            raise ValueError("the vocabulary lacks a byte")
        index = PairIndex(self.vocabulary, symbols, ends)
        index.merge()
        upto = np.concatenate([[0], np.cumsum(index.alive)])
        return index.symbols[index.alive], upto[bounds]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the bounds of each text in them. Null counts as empty."""
        # blanks of ASCII stand in no pre-token, and neither lower case nor composition reaches across them
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        bounds = split.offsets.to_numpy(zero_copy_only=False)
        words = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        tokens, per_word, special = self._words(words.dictionary)
        place_of = self._places(tokens.dictionary)
        ids, own = self.ids, self.own
        which = tokens.indices.fill_null(0).to_numpy(zero_copy_only=False)
        which = place_of[which] if len(place_of) else which.astype(np.int64)
        at = np.flatnonzero(tokens.indices.is_null().to_numpy(zero_copy_only=False))
        numbers = sorted(set(special))  # special tokens are numbered after the others
        place = {k: len(own) - 1 + i for i, k in enumerate(numbers)}
        which[at] = [place[k] for k in special]
        ids, own = np.concatenate([ids, np.array(numbers, dtype=np.int32)]), np.concatenate([own, own[-1] + 1 + np.arange(len(numbers))])
        flat, per_word = spread(which, per_word, ids, own)
        del tokens, place_of, which, ids, own
        return spread(words.indices.to_numpy(zero_copy_only=False), bounds - bounds[0], flat, per_word)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of ``texts`` without nulls, and the bounds of each text in them."""
    lists = texts.cast(pa.large_string())
    bounds = np.frombuffer(lists.buffers()[1], dtype=np.int64)[lists.offset : lists.offset + len(lists) + 1] if len(lists) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(lists.buffers()[2] or b"", dtype=np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def spread(which: np.ndarray, bounds: np.ndarray, values: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace each item of ``which`` by its run ``values[own[k]:own[k + 1]]``; ``bounds`` are kept in step."""
    size = np.diff(own)[which] if len(which) else np.zeros(0, dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    if not len(which):
        return values[:0], at[bounds]
    # places take half the room where 32 bits hold them
    kind = np.int32 if max(at[-1], len(values)) <= np.iinfo(np.int32).max else np.int64
    source = np.repeat((own[:-1][which] - at[:-1]).astype(kind), size)
    source += np.arange(at[-1], dtype=kind)
    return values[source], at[bounds]


def token_texts(path: str) -> list[str | None]:
    """The text of each id of a tokenizer file; null for none."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    known = {k: text for text, k in data["model"]["vocab"].items()} | {t["id"]: t["content"] for t in data["added_tokens"]}
    return [known.get(k) for k in range(max(known) + 1)]


def _lists(encoder: Encoder, texts: pa.Array) -> pa.ListArray:
    ids, bounds = encoder.encode(texts)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))


def _joined(lists: pa.ListArray, names: pa.StringArray) -> pa.Array:
    """The text of each list of ids."""
    lists = pc.fill_null(lists, pa.scalar([], lists.type))
    bounds = lists.offsets.to_numpy(zero_copy_only=False)
    flat = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).cast(pa.int64())
    inside = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(names)))
    tokens = names.take(pc.if_else(pc.fill_null(inside, False), flat, None))
    known = pc.is_valid(tokens).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(known)])
    words = pa.LargeListArray.from_arrays(pa.array(upto[bounds - bounds[0]], pa.int64()), tokens.drop_null().cast(pa.large_string()))
    return pc.binary_join(words, pa.scalar(" ", pa.large_string())).cast(pa.string())


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession, 2000)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids``: the token ids of each whole text.

    ``vocabulary`` is the path of a tokenizer file that every executor has. A null or empty text,
    or one of blanks, has no ids. A special token's text in a text is that token. Repeated rows
    are encoded each, a null id stays null, and an empty table gives no rows.
    """
    rows = _rows(docs, id_col, text_col)
    schema = rows.select("id", F.array().cast("array<int>").alias("ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for whole in batches:
            for batch in slices(whole, "text", BYTES):
                yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(encoder, batch.column("text"))], ["id", "ids"])

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``id, ids, text`` from ``id, ids``: the tokens as the vocabulary writes them, joined by one space.

    That is what the library returns for a file without a decoder; a file with one is refused. An
    id outside the vocabulary and a null id give nothing; null for a list counts as an empty one.
    """
    refuse_decoder(vocabulary)
    schema = encoded.select("id", "ids", F.lit("").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(token_texts(vocabulary), pa.string())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("ids"), _joined(batch.column("ids"), names)], ["id", "ids", "text"])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids, text``: :func:`decode` of :func:`encode`, in one step of a task."""
    refuse_decoder(vocabulary)
    rows = _rows(docs, id_col, text_col)
    schema = rows.select("id", F.array().cast("array<int>").alias("ids"), F.lit("").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, names = Encoder(vocabulary), pa.array(token_texts(vocabulary), pa.string())
        for whole in batches:
            for batch in slices(whole, "text", BYTES):
                lists = _lists(encoder, batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("id"), lists, _joined(lists, names)], ["id", "ids", "text"])

    return rows.mapInArrow(run, schema)


def refuse_decoder(vocabulary: str) -> None:
    with open(vocabulary, encoding="utf-8") as file:
        if json.load(file).get("decoder"):
            raise ValueError("the vocabulary has a decoder of its own")
