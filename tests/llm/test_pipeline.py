"""The stages of the pipeline one by one and together, against brute force."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = re.compile(r"[\x20\x09-\x0D]")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, score double, draws int, SIZE int, id long, prompt int"
STAGE = dict(corpus_pipeline.STAGES)


def texts():
    random.seed(11)
    english = "the quick brown fox jumps over the lazy dog and runs into the deep green forest where no one ever goes".split()
    german = "der schnelle braune Fuchs springt über den faulen Hund und läuft in den tiefen grünen Wald wo niemand hingeht".split()
    out = []
    for k in range(60):
        words = [random.choice(german if k % 3 else english) for _ in range(random.randint(12, 60))]
        out.append((" ".join(words), "de" if k % 3 else "en"))
    base = [random.choice(english) + str(k) for k in range(80)]
    for k in range(12):  # near copies
        own = list(base)
        own[k * 5] = "changed"
        out.append((" ".join(own), "en"))
    out += [(out[0][0].replace(" ", "  "), "en"), (out[0][0], None), (out[3][0] + "\n", "de")]
    return out + [(None, "en"), ("", None), ("12 34 !", "de"), (" \t", None), ("é", None), ("wort " * 4000, "de")]


@pytest.fixture(scope="module")
def docs(spark):
    sources = ["web", "books", None, "news"]
    rows = [(k, t, lang, sources[k % 7 % 4], len(t or ""), "k", 0.5, 1, 2, 3, 4) for k, (t, lang) in enumerate(texts())]
    rows += [rows[5], (None, "ohne Nummer im Wald", "de", "web", 1, "k", 0.5, 1, 2, 3, 4)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.collect())


def with_letters(rows):
    return [r for r in rows if re.search(r"[^\W\d_]", r.text or "")]


def one_of_each(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[BLANKS.sub("", r.text or "")].append(r)
    return [min(own, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0)) for own in groups.values()]


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def no_near_copies(rows):
    sets = [shingles(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k, r in enumerate(rows):
        groups[find(k)].append(r)
    return [min(own, key=lambda r: (r.doc_id is None, r.doc_id or 0)) for own in groups.values()]


def as_counter(rows):
    return collections.Counter(map(tuple, rows))


@pytest.mark.parametrize(
    "name, by_hand",
    [("language ID", with_letters), ("exact dedup", one_of_each), ("near-duplicate join", no_near_copies)],
)
def test_filtering_stages(spark, docs, name, by_hand):
    # the join needs ids of its own rows
    given = docs if name != "near-duplicate join" else docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    kept = STAGE[name](spark, given, "")
    assert kept.columns == docs.columns
    assert rows_of(kept) == as_counter(by_hand(given.collect()))
    assert STAGE[name](spark, docs.limit(0), "").count() == 0


def test_nothing_learned_rejects_nothing(spark, docs):
    from pyspark.sql import functions as F

    blank = docs.withColumn("lang", F.lit(None).cast("string"))
    assert STAGE["language ID"](spark, blank, "").count() == docs.count()


def words_by_source(rows):
    out = collections.Counter()
    for r in rows:
        out[r.source] += len(WORD.findall(r.text or ""))
    return out


def check_mix(given, out):
    own, taken = words_by_source(given), words_by_source(out)
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sorted(own, key=lambda s: (s is None, s or "")))}
    goal, open_sources, target = 1.5 * sum(own.values()), set(own), {}
    while open_sources:
        level = (goal - sum(target.values())) / sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if level * weight[s] > 2 * own[s]}
        for s in full or open_sources:
            target[s] = 2 * own[s] if full else level * weight[s]
        open_sources -= full or open_sources
    for s in own:
        assert abs(taken[s] - target[s]) <= 1, s
    texts = collections.defaultdict(set)
    for r in given:
        texts[r.doc_id].add(r.text)
    cut = 0
    for r in out:
        if r.text not in texts[r.doc_id]:
            cut += 1
            assert any((t or "").startswith(r.text) for t in texts[r.doc_id])
    assert cut <= len(own)


def check_pieces(given, pieces):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for r in given:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        want[r.doc_id] += len(ids)
    got, sequences = collections.Counter(), collections.defaultdict(list)
    for p in pieces:
        got[p.doc_id] += p.length
        sequences[p.sequence_id].append(p)
    assert got == want
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert sum(p.length for p in own) <= 2048
    lone = {r.doc_id: r for r in given if sum(q.doc_id == r.doc_id for q in given) == 1}
    for ident, r in lone.items():
        ids, at = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], 0
        for p in sorted((p for p in pieces if p.doc_id == ident), key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], dtype="<u4").tobytes())
            at += p.length


def test_mixing_and_packing_stages(spark, docs):
    out = STAGE["mixing"](spark, docs, "")
    assert out.columns == docs.columns
    check_mix(docs.collect(), out.collect())
    check_pieces(docs.collect(), STAGE["packing"](spark, docs, "").collect())
    for name in ("mixing", "packing"):
        assert STAGE[name](spark, docs.limit(0), "").count() == 0


def test_run_is_its_stages(spark, docs, tmp_path, monkeypatch):
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    unique.write.parquet(f"{tmp_path}/documents.parquet")
    kept = no_near_copies(one_of_each(with_letters(unique.collect())))
    mixes = []
    packed = corpus_pipeline.packed

    def watched(spark, rows, sf_dir):
        mixes.append(rows.collect())
        return packed(spark, rows, sf_dir)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, watched if f is packed else f) for n, f in corpus_pipeline.STAGES])
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_mix(kept, mixes[0])
    check_pieces(mixes[0], pieces)
