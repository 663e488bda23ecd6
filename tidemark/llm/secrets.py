"""Secret scan over an inverted index of trigrams.

Each rule's regular expression gives a Boolean query of mandatory trigrams. The index holds, for
the trigrams that any query names, the texts that contain them; it is written to the shared
folder in the order of the trigrams. A rule's candidates are the intersections of postings that
its query asks for, and only they are scanned with its expression. A rule without a mandatory
trigram scans all texts. Built-in functions only.

Texts are known to the index by a hash, so copies are indexed once; a collision costs a scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import n_buckets, unused, written
from tidemark.llm.trigrams import query


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` count when ``group`` has ``least`` code points or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    def ignoring_case(self) -> bool:
        return self.pattern.startswith("(?i)")


#: The first three are the base kinds. A run of ``[0-9a-f]`` of 32 or more is a maximal run either way.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
BASE = 3


def build_index(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Postings ``(trigram, key)`` of the trigrams in the rules' queries, sorted, on shared files."""
    wanted = sorted({t for r in rules for clause in query(r.pattern) for option in clause for t in option})
    low = texts.where("text is not null").select(F.xxhash64("text").alias("key"), F.lower("text").alias("low"))
    places = {t: (f"held_{k // 62}", 1 << (k % 62)) for k, t in enumerate(wanted)}
    masks = sorted({m for m, _ in places.values()})
    bits = {m: [F.when(F.contains("low", F.lit(t)), F.lit(bit)).otherwise(F.lit(0)).cast("long") for t, (own, bit) in places.items() if own == m] for m in masks}
    held = low.select("key", *(reduce(lambda x, y: x.bitwiseOR(y), own).alias(m) for m, own in bits.items()))
    # a text that a third of all rows hold is one row per map task; texts whose keys collide join their trigrams
    some = reduce(lambda x, y: x | y, (F.col(m) != 0 for m in masks), F.lit(False))
    rows = held.where(some).groupBy("key").agg(*(F.bit_or(m).alias(m) for m in masks))
    present = F.array_compact(F.array(*(F.when(F.col(m).bitwiseAND(F.lit(bit)) != 0, F.lit(t)) for t, (m, bit) in places.items()), F.lit(None).cast("string")))
    postings = rows.select(F.explode(present).alias("trigram"), "key")
    spread = n_buckets(texts.sparkSession, 1)
    return written(postings.repartition(spread, "trigram", F.pmod("key", F.lit(spread))).sortWithinPartitions("trigram", "key"), "postings")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(key, kinds)``: the rules whose query a text meets."""
    terms = []
    clauses = {}
    for r in rules:
        own = query(r.pattern)
        clauses[r.kind] = len(own)
        for c, clause in enumerate(own):
            for o, option in enumerate(clause):
                terms += [(r.kind, c, o, t, len(option)) for t in sorted(option)]
    terms = index.sparkSession.createDataFrame(terms, "kind string, clause int, option int, trigram string, needed long")
    met = index.join(F.broadcast(terms), "trigram")  # as large as the rules, not the data
    options = met.groupBy("key", "kind", "clause", "option").agg(F.count("*").alias("n"), F.first("needed").alias("needed")).where("n = needed")
    needed = F.create_map(*(F.lit(x) for kind, n in clauses.items() for x in (kind, n)))
    found = options.groupBy("key", "kind").agg(F.count_distinct("clause").alias("n")).where(F.col("n") == needed[F.col("kind")])
    return written(found.groupBy("key").agg(F.sort_array(F.collect_list("kind")).alias("kinds")), "candidates")


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """Array of ``(start, number, end)`` of the rule's matches, in code points.

    Leftmost matches that don't overlap; the pieces between them tell where they start.
    """
    pattern = F.lit(rule.pattern)
    found, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern, -1)
    empty = F.array().cast("array<struct<start:bigint,number:int,end:bigint>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))

    def step(s: Column, m: Column) -> Column:
        begin = s["at"] + F.char_length(m["gap"])
        end = begin + F.char_length(m["match"])
        span = F.struct(begin.alias("start"), F.lit(number).alias("number"), end.alias("end"))
        kept = F.when(F.char_length(m["part"]) >= rule.least, F.concat(s["spans"], F.array(span))).otherwise(s["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    matches = F.transform(found, lambda m, i: F.struct(m.alias("match"), F.get(gaps, i).alias("gap"), F.get(part, i).alias("part")))
    spans = F.aggregate(matches, start, step, lambda s: s["spans"])
    return F.when(F.regexp_like(text, pattern), spans).otherwise(empty)


def scan(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "secrets") -> DataFrame:
    """``docs`` with ``secrets``: all spans ``(start, number, end)`` by start, then rule.

    ``number`` is the rule's place in ``rules``. Null text counts as empty. Every row is scanned
    for itself, so repeated rows, null ids and order don't matter; an empty table gives no rows.
    """
    names = docs.columns
    out, key, kinds, other = (unused(names, n) for n in (out, "_key", "_kinds", "_other"))
    index = build_index(docs.select(F.col(text_col).alias("text")), rules)
    found = candidates(index, rules).select(F.col("key").alias(other), F.col("kinds").alias(kinds))
    rows = docs.withColumn(key, F.xxhash64(text_col)).join(found, F.col(key) == F.col(other), "left")
    text = F.coalesce(F.col(text_col), F.lit(""))
    empty = F.array().cast("array<struct<start:bigint,number:int,end:bigint>>")
    parts = []
    for number, rule in enumerate(rules):
        own = spans_of(text, rule, number)
        parts.append(F.when(F.array_contains(kinds, rule.kind), own).otherwise(empty) if query(rule.pattern) else own)
    return rows.select(*names, F.array_sort(F.concat(*parts)).alias(out))


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["number"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
