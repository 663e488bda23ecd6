"""Runs of words, spelling variants and byte-pair encoding against brute force and the library."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, queries, runs, variants

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " \n", "a", "x " * 40_000, "a b " * 9, "né" * 50_000, "one two"]


def runs_by_hand(words):
    best = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                best.setdefault((start, i - start + q), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in best.items())


def test_runs_are_all_maximal_repetitions():
    random.seed(7)
    found = 0
    for _ in range(250):
        texts = []
        for _ in range(random.randint(0, 5)):
            letters = random.choice([1, 2, 2, 3, 5])
            words = [random.randrange(letters) for _ in range(random.randint(0, 60))]
            cycle = [random.randrange(letters) for _ in range(random.randint(1, 7))]
            at = random.randint(0, len(words))
            words[at:at] = cycle * random.randint(1, 8) + cycle[: random.randrange(len(cycle))]
            texts.append(words)
        bounds = np.cumsum([0] + [len(t) for t in texts])
        got = runs.runs_of(np.array([w for t in texts for w in t], dtype=np.int64), bounds)
        want = [(k, *r) for k, t in enumerate(texts) for r in sorted(runs_by_hand(t), key=lambda r: (r[0], r[2]))]
        assert [tuple(r) for r in got.tolist()] == want
        found += len(want)
    assert found > 500


def test_collapse_whole_table(spark):
    random.seed(8)
    texts = ODD + [" ".join(random.choice("ab") for _ in range(60)) for _ in range(30)] + ["p q r s t u v\t" * 12 + "end", "p q"]
    rows = list(enumerate(texts)) + [(None, "z z z z z z"), (3, "a"), (3, "a")]
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, RUNS int, collapsed string").repartition(4)
    got = collections.Counter((r.id, tuple(tuple(x) for x in r.runs), r.collapsed) for r in runs.collapse(docs).collect())
    want = collections.Counter()
    for i, text in rows:
        words = WORD.findall(text or "")
        # only the long texts have one run each, known beforehand
        own = [(0, len(words), {40_000: 1}[len(words)])] if len(words) > 1000 else runs_by_hand(words)
        own.sort(key=lambda r: (r[0], r[2]))
        kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in own)]
        want[(i, tuple(own), " ".join(kept))] += 1
    assert got == want
    assert runs.collapse(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.collapse(docs, times=1)


def test_planted_tails(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 23))) for i in range(60)] + [(None, "a b c"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    changed = 0
    for before, after in zip(docs.collect(), runs.repeated(docs).collect(), strict=True):
        words = WORD.findall(before.text or "")
        h = zlib.crc32(str(before.doc_id).encode())
        if before.doc_id is None or h % 10 or not words:
            assert after.text == before.text or not words
            continue
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert after.text == " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))
        changed += 1
    assert changed > 2


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def vocabulary_with_variants():
    random.seed(3)
    words = {"".join(random.choice("abé") for _ in range(random.randint(7, 9))): random.choice([2, 3, 20, 30, 300, 3000]) for _ in range(400)}
    for w in list(words)[:150]:
        for _ in range(2):
            i = random.randrange(len(w) + 1)
            new = random.choice([w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + "q" + w[i + 1 :]])
            if len(new) >= 7:
                words[new] = random.choice([2, 5, 50])
    return words | {"x" * 50_000: 9, "x" * 50_001: 90}


@pytest.mark.parametrize("limit", [4096, 6])
def test_variants(spark, limit):
    words = vocabulary_with_variants()
    found = {}
    for a in words:
        near = [b for b in words if abs(len(a) - len(b)) < 2 and (a[0] * len(a) != a or b[0] * len(b) == b) and one_edit(a, b)]
        best = min(near, key=lambda b: (-words[b], b), default=None)
        found[a] = (len(near), best if best and words[best] >= 10 * words[a] else None)

    def root(w):
        return root(found[w][1]) if found[w][1] else w

    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.variants(table, limit=limit).collect()}
    assert got == {w: (f, root(w), words[w], n, words.get(f)) for w, (n, f) in found.items()}
    assert sum(f is not None for _, f in found.values()) > 20
    assert variants.variants(table.limit(0)).count() == 0
    with pytest.raises(ValueError):
        variants.variants(table, ratio=1)


def test_word_counts(spark):
    random.seed(4)
    pool = ["Straßen", "übermut", "ÉCLAIRS", "abcdefgh", "Abcdefgh", "short", "naïveté", "a×b÷cdefg", "łódźłódź"]
    rows = [(i, " ".join(random.choice(pool) + random.choice(",;1 ") for _ in range(30))) for i in range(60)] + list(enumerate(ODD)) + [(None, "abcdefgh")] * 2
    want = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            at = h % len(low)
            want[low if h % 31 else low[:at] + low[at + 1 :]] += 1
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = {r.word: r.n for r in variants.count_words(docs, drop_modulus=31).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 7}
    assert variants.count_words(docs.limit(0)).count() == 0


TEXTS = ODD + [
    "aaaaaaaaaa aaaaaaa abababab",
    "<|endoftext|>x<|startoftext|> <|EndOfText|>",
    "İΑΣ é́ H̱ y a\x1cb \x85 ’s it's we'LL",
    "ﬁ Ǆ ß ẞ K Å 한글 中文字 🤗🤗 ''s a×b ÷ a b　c",
    "12 345 --- __ it's#$",
    "́",
]


def test_bpe_is_the_librarys(spark):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    random.seed(6)
    marks = "aàÉz'’.9 ́ ßΣ🤗<|>"
    texts = TEXTS + ["".join(random.choice(marks) for _ in range(random.randint(0, 40))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "x", 2), (3, "a", 3)], "doc_id long, text string, IDS int").repartition(3)
    encoded = bpe.encode(docs, VOCABULARY)
    got = collections.Counter((r.id, tuple(r.ids), r.text) for r in bpe.decode(encoded, VOCABULARY).collect())
    want = collections.Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        want[(r.doc_id, tuple(ids), tokenizer.decode(ids, skip_special_tokens=False))] += 1
    assert got == want
    assert collections.Counter((r.id, tuple(r.ids), r.text) for r in bpe.round_trip(docs, VOCABULARY).collect()) == want
    assert bpe.decode(bpe.encode(docs.limit(0), VOCABULARY), VOCABULARY).count() == 0 == bpe.round_trip(docs.limit(0), VOCABULARY).count()
    odd = spark.createDataFrame([(1, None), (2, [49407, -1, None, 10**6, 320])], "id long, ids array<int>")
    assert {r.id: r.text for r in bpe.decode(odd, VOCABULARY).collect()} == {1: "", 2: tokenizer.decode([49407, 320], skip_special_tokens=False)}


def test_chained_pairs_merge_from_the_left():
    encoder = bpe.Encoder(VOCABULARY)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = ["".join(random.choice("ab") for _ in range(n)) for n in range(1, 80)] + ["a" * n for n in range(1, 40)]
    ids, bounds = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_registered_queries(spark, sf):
    import hashlib

    import pyarrow.parquet as pq

    texts = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op13(spark, sf).collect()}
    for row in texts:
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False))]
        assert got.pop(row["doc_id"]) == (len(ids), *digests)
    assert not got
