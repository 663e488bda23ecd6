"""Language identification by unigram pieces, summed over all segmentations of each word.

A language gives each piece of a fixed public vocabulary a probability. A word's probability is
the sum, over all ways to cut it into pieces, of the products of their probabilities: a forward
pass. Expectation maximisation learns the probabilities from labelled words with the same pass
and its backward twin. Words are what white space leaves, reduced to letters and marks in lower
case; the pass runs once per distinct word of a batch, for all languages and for all words of one
length together.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, small_batches, unused, written

UNDETERMINED = "und"
#: Labelled documents per language that the model is fitted on, by a hash of their id.
SAMPLE = 2000
ROUNDS = 3
PART = 48  # a longer word teaches in parts of so many letters; it is scored whole
_CELLS = 1 << 18  # letters of the words that are scored at once
_SHORT = 4  # pieces of more letters are rare at any one place
_SMALL = 1e-100  # sums below this are scaled up
_MARK = "▁"  # begins a word in the vocabulary
_UNKNOWN = 1e-9  # probability of a letter that no piece covers
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _extend(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ codes) * _BASE
    return hashes ^ (hashes >> np.uint64(29))


class Pieces:
    """The vocabulary's pieces of letters as sorted hashes; a piece's number is its place."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = {model.id_to_piece(k) for k in range(model.get_piece_size())}
        texts = {t for t in texts if t.removeprefix(_MARK) and all(unicodedata.category(c)[0] in "LM" for c in t.removeprefix(_MARK))} | {_MARK}
        self.longest = max(map(len, texts))  # letters of a piece, its word mark included
        hashes = []
        for t in sorted(texts):
            h = np.zeros(1, dtype=np.uint64)
            for c in t:
                h = _extend(h, np.array([ord(c)], dtype=np.uint64))
            hashes.append(h[0])
        self.hashes = np.unique(np.array(hashes, dtype=np.uint64))
        self.some = np.zeros(1 << 21, dtype=bool)
        self.some[self.hashes >> np.uint64(43)] = True

    def __len__(self) -> int:
        return len(self.hashes)

    def numbers(self, codes: np.ndarray) -> list[np.ndarray]:
        """For k = 1, 2, …: the piece at each start of each row that has k letters.

        No piece is ``len(self) + 1``; a single letter that is no piece is ``len(self)``.
        """
        out, h = [], np.zeros(codes.shape, dtype=np.uint64)
        for k in range(1, min(self.longest, codes.shape[1]) + 1):
            h = _extend(h[:, : codes.shape[1] - k + 1], codes[:, k - 1 :])
            # the first bits rule out most; the sorted hashes decide the rest
            own = np.full(h.shape, len(self) + (k > 1), dtype=np.int32)
            maybe = np.nonzero(self.some[h >> np.uint64(43)])
            found = h[maybe]
            at = np.minimum(np.searchsorted(self.hashes, found), len(self) - 1)
            own[maybe] = np.where(self.hashes[at] == found, at, len(self) + (k > 1))
            out.append(own)
        return out


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of code points for words of one length, with their places in ``words``."""
    places: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        if w:
            places.setdefault(len(w) + 1, []).append(k)
    for n, own in places.items():
        step = max(1, _CELLS // n)
        for low in range(0, len(own), step):
            some = own[low : low + step]
            text = "".join(_MARK + words[k] for k in some)
            yield np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).reshape(len(some), n).astype(np.uint64), np.array(some)


class Places:
    """Which words have a piece of k letters at place i: all for short pieces, few for long ones."""

    def __init__(self, numbers: list[np.ndarray], none: int):
        self.few = []
        for own in numbers[_SHORT:]:
            place, word = np.nonzero(own.T != none)
            self.few.append((np.searchsorted(place, np.arange(own.shape[1] + 1)), word))

    def words(self, k: int, i: int) -> slice | np.ndarray:
        if k <= _SHORT:
            return slice(None)
        bounds, word = self.few[k - _SHORT - 1]
        return word[bounds[i] : bounds[i + 1]]


def forward(numbers: list[np.ndarray], p: np.ndarray) -> np.ndarray:
    """``[j, word, language]``: the summed probability of the first j letters."""
    rows, n = numbers[0].shape
    places = Places(numbers, len(p) - 1)
    a = np.zeros((n + 1, rows, p.shape[1]))
    a[0] = 1
    for j in range(1, n + 1):
        for k in range(1, min(j, len(numbers)) + 1):
            at = places.words(k, j - k)
            a[j][at] += a[j - k][at] * p[numbers[k - 1][at, j - k]]
    return a


def log_forward(numbers: list[np.ndarray], p: np.ndarray) -> np.ndarray:
    """``[word, language]``: the log of the summed probability of whole words, however long.

    Only the sums that the longest piece reaches back to are kept, and scaled up when they get small.
    """
    rows, n = numbers[0].shape
    reach, places = len(numbers), Places(numbers, len(p) - 1)
    a = np.zeros((reach + 1, rows, p.shape[1]))
    a[0] = 1
    scaled = np.zeros((rows, p.shape[1]))
    for j in range(1, n + 1):
        now = np.zeros((rows, p.shape[1]))
        for k in range(1, min(j, reach) + 1):
            at = places.words(k, j - k)
            now[at] += a[(j - k) % (reach + 1)][at] * p[numbers[k - 1][at, j - k]]
        a[j % (reach + 1)] = now
        small = now < _SMALL
        if small.any():
            a[:, small] /= _SMALL
            scaled[small] += np.log(_SMALL)
    return np.log(a[n % (reach + 1)]) + scaled


def expected(numbers: list[np.ndarray], p: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How often each language uses each piece, over ``weights[word, language]`` words."""
    a = forward(numbers, p)
    places = Places(numbers, len(p) - 1)
    n, languages = a.shape[0] - 1, a.shape[2]
    b = np.zeros_like(a)
    b[n] = weights / np.maximum(a[n], 1e-300)
    for i in range(n - 1, -1, -1):
        for k in range(1, min(n - i, len(numbers)) + 1):
            at = places.words(k, i)
            b[i][at] += b[i + k][at] * p[numbers[k - 1][at, i]]
    out = np.zeros_like(p)
    for k, own in enumerate(numbers, 1):
        for i in range(n - k + 1):
            at = places.words(k, i)
            piece = own[at, i]
            use = a[i][at] * p[piece] * b[i + k][at]
            if k > _SHORT:
                np.add.at(out, piece, use)
                continue
            for m in range(languages):
                out[:, m] += np.bincount(piece, use[:, m], minlength=len(p))
    return out


def parts_of(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Words of at most PART letters, and the word each comes from."""
    if all(len(w) <= PART for w in words):
        return words, np.arange(len(words))
    cut = [(w[i : i + PART], k) for k, w in enumerate(words) for i in range(0, max(1, len(w)), PART)]
    return [c[0] for c in cut], np.array([c[1] for c in cut])


def word_codes(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the word at each place, and the bounds of each text."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    bounds = split.offsets.to_numpy(zero_copy_only=False)
    raw = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    letters = pc.replace_substring_regex(pc.utf8_lower(raw.dictionary), r"[^\p{L}\p{M}]+", "").dictionary_encode()
    which = letters.indices.to_numpy(zero_copy_only=False)[raw.indices.to_numpy(zero_copy_only=False)]
    return letters.dictionary.to_numpy(zero_copy_only=False).tolist(), which, bounds - bounds[0]


@dataclass
class Model:
    vocabulary: str
    languages: list[str]
    prior: np.ndarray  # log share of each language
    p: np.ndarray  # [piece, language], a letter without a piece and no piece last

    def pieces(self) -> Pieces:
        return Pieces(self.vocabulary)

    def score_words(self, pieces: Pieces, words: list[str]) -> np.ndarray:
        """Log probability ``[word, language]``; 0 for an empty word."""
        out = np.zeros((len(words), len(self.languages)))
        for codes, places in by_length(words):
            out[places] = log_forward(pieces.numbers(codes), self.p)
        return out

    def predict(self, pieces: Pieces, texts: pa.Array) -> tuple[list[str], list[float]]:
        """Language and its share of the summed probability, for each text."""
        words, which, bounds = word_codes(texts)
        n, languages = len(bounds) - 1, len(self.languages)
        filled = pc.match_substring_regex(pa.array(words, pa.string()), r"\p{L}").to_numpy(zero_copy_only=False)
        home = np.repeat(np.arange(n), np.diff(bounds))
        letters = np.bincount(home, filled[which] if len(words) else None, minlength=n) > 0 if len(which) else np.zeros(n, dtype=bool)
        if not languages or not len(which):
            return [UNDETERMINED] * n, [0.0] * n
        own = self.score_words(pieces, words)
        total = np.stack([np.bincount(home, own[which, m], minlength=n) for m in range(languages)], axis=1) + self.prior
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)]
        return names, np.where(letters, share, 0.0).tolist()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            words, which, bounds = word_codes(batch.column("text"))
            lang = batch.column("lang").dictionary_encode()
            names = lang.dictionary.to_pylist()
            home = np.repeat(lang.indices.to_numpy(zero_copy_only=False), np.diff(bounds)).astype(np.int64)
            keys, n = np.unique(home * max(1, len(words)) + which, return_counts=True)
            rows = [(names[k // len(words)], words[k % len(words)], c) for k, c in zip(keys.tolist(), n.tolist(), strict=True)]
            rows = [r for r in rows if r[1]]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])


def train(docs: DataFrame, vocabulary: str, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Learn each language of ``docs`` from about ``sample`` of its documents, chosen by hash of id.

    Rows without text or language teach nothing. The pieces' expected counts of a round are summed
    in Spark; what reaches the driver is one number per piece and language.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    sizes = sorted((r[0], r[1]) for r in rows.groupBy("lang").count().collect())
    languages, total = [x[0] for x in sizes], sum(x[1] for x in sizes)
    share = spark.createDataFrame([(k, min(1.0, sample / n)) for k, n in sizes], "lang string, share double")
    chosen = rows.join(share, "lang").where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    counts = chosen.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long")
    counts = written(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")

    pieces, m = Pieces(vocabulary), len(languages)
    p = np.full((len(pieces) + 2, m), 1.0 / len(pieces))
    p[-2:] = [[_UNKNOWN], [0.0]]
    for _ in range(rounds if m else 0):
        shared = spark.sparkContext.broadcast(Model(vocabulary, languages, np.zeros(m), p))
        sums = counts.mapInArrow(_expected_rows(shared), "language int, piece int, n double").groupBy("language", "piece").agg(F.sum("n").alias("n"))
        found = sums.toArrow()
        used = np.full((len(pieces), m), 0.05)  # a piece not seen is rare, not impossible
        np.add.at(used, (found.column("piece").to_numpy(), found.column("language").to_numpy()), found.column("n").to_numpy())
        p = np.vstack([used / used.sum(axis=0), p[-2:]])
    prior = np.log(np.array([n / total for _, n in sizes])) if m else np.zeros(0)
    return Model(vocabulary, languages, prior, p)


def _expected_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        pieces, at = model.pieces(), {k: i for i, k in enumerate(model.languages)}
        out = np.zeros_like(model.p)
        for batch in batches:
            words, home = parts_of(batch.column("word").to_pylist())
            language = np.array([at[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)[home] if words else home
            n = batch.column("n").to_numpy()[home] if words else home
            for codes, places in by_length(words):
                weights = np.zeros((len(places), len(at)))
                weights[np.arange(len(places)), language[places]] = n[places]
                out += expected(pieces.numbers(codes), model.p, weights)
        piece, lang = np.nonzero(out[: len(pieces)])
        arrays = [pa.array(lang, pa.int32()), pa.array(piece, pa.int32()), pa.array(out[piece, lang])]
        yield pa.RecordBatch.from_arrays(arrays, ["language", "piece", "n"])

    return run


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """``docs`` with the language of each whole text and its probability among the learned ones.

    A text that is null or has no letter is ``und`` with score 0, as is every text when nothing
    was learned. Only the text is an input. Ties go to the language that sorts first. Row order,
    repeated rows and other columns don't matter; an empty table gives no rows.
    """
    small_batches(docs.sparkSession, 2000)
    lang_name, score_name = unused(docs.columns, lang_name), unused(docs.columns, score_name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.withColumns({lang_name: F.lit(""), score_name: F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value.pieces()
        for whole in batches:
            for batch in slices(whole, text_col):
                names, scores = shared.value.predict(pieces, batch.column(text_col))
                arrays = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, lang_name, score_name])

    return docs.mapInArrow(run, schema)


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that aren't held out: crc32 of the id as text, mod 3, is not 1. A null id teaches nothing."""
    return docs.where(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
