"""The registered queries of the operators, and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, exact, fixity, html, jaccard, kdtree, language, licences, mixing, packing, runs, secrets, variants
from tidemark.llm.shared import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


@query(
    "op2_exact_dedup",
    r"""
    WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                      sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents),
    w AS (SELECT doc_id, text_sha256, first_value(doc_id) OVER g AS keep_id, row_number() OVER g AS n,
                 count(*) OVER (PARTITION BY text_sha256) AS group_size
          FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST))
    SELECT doc_id, keep_id, group_size, n = 1 AS kept, text_sha256 FROM w
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return exact.exact_groups(docs).withColumnRenamed("id", "doc_id")


@query("op8_near_components")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return jaccard.near_components(docs).withColumnRenamed("id", "doc_id")


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    model = learned_languages(spark, folder)
    docs = table(spark, folder, "documents", "doc_id", "text")
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def learned_languages(spark: SparkSession, folder: str) -> language.Model:
    labelled = language.training_rows(table(spark, folder, "documents", "doc_id", "text", "lang"))
    return language.train(labelled, public_tokenizers.path("piece_bpe_32k.model"))


@query("op10_pack_vectors")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


#: The mix as SQL, for ``documents``: ``mixed`` has a row per document.
MIXED_SQL = r"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM {documents}),
    own AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM own),
    weighed AS (SELECT *, [3, 1, 2][place % 3 + 1] AS weight, 2 * source_size AS cap FROM placed),
    filled AS (
        SELECT *, cap / weight AS fill,
               (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
    one AS (SELECT level FROM filled WHERE level <= fill ORDER BY fill, place LIMIT 1),
    targets AS (
        SELECT source, place, source_size, least(cap::DOUBLE, coalesce((SELECT level FROM one) * weight, cap::DOUBLE)) AS target,
               (SELECT greatest(16384, ceil(sum(source_size) / 16384.0))::BIGINT FROM own) AS block_words FROM filled),
    quotas AS (
        SELECT *, greatest(1, ceil(source_size / block_words))::BIGINT AS n_blocks,
               CASE WHEN source_size > 0 THEN floor(round(target) / source_size) ELSE 0 END::BIGINT AS passes FROM targets),
    asked AS (SELECT *, round(target)::BIGINT - passes * source_size AS rest FROM quotas),
    hashed AS (
        SELECT d.*, place, source_size, target, passes, rest,
               ('0x' || substr(md5('0|document|' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT % n_blocks AS block
        FROM sized d JOIN asked a ON d.source IS NOT DISTINCT FROM a.source),
    blocks AS (SELECT place, block, sum(size) AS held, any_value(rest) AS rest FROM hashed GROUP BY place, block),
    ranked AS (
        SELECT *, rest - coalesce(sum(held) OVER (PARTITION BY place ORDER BY ('0x' || substr(md5('0|block|' || place || '|' || block), 1, 8))::BIGINT, block
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM blocks),
    mixed AS (
        SELECT doc_id, size, source_size, target,
               (passes * size + CASE WHEN room <= 0 THEN 0 WHEN room >= held THEN size ELSE least(size, greatest(0, room - coalesce(sum(size) OVER (
                    PARTITION BY h.place, h.block ORDER BY ('0x' || substr(md5('0|part|' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT, doc_id, size DESC
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) END)::BIGINT AS taken
        FROM hashed h JOIN ranked r ON h.place = r.place AND h.block = r.block)
"""


@query("op6_mix_quotas", MIXED_SQL.format(documents="documents") + "SELECT doc_id, size, source_size, target, taken FROM mixed")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents", "doc_id", "text", "source"))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda s, d: s + d["words"])
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def _spans_sql(number: int, rule: secrets.Rule) -> str:
    """A list of (start, number, length) in DuckDB: matches, and the pieces between them."""
    return f"""list_filter(list_transform(range(1, len(m{number}) + 1), lambda i: struct_pack(
        s := coalesce(list_sum(list_transform(g{number}[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m{number}[1:i - 1], lambda x: length(x))), 0),
        k := {number}, n := length(m{number}[i]), p := length(p{number}[i]))), lambda z: z.p >= {rule.least})"""


def _secrets_sql() -> str:
    parts = []
    for k, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"regexp_extract_all(t, '{pattern}', 0) AS m{k}, string_split_regex(t, '{pattern}') AS g{k}, regexp_extract_all(t, '{pattern}', {rule.group}) AS p{k}")
    kinds = "[" + ", ".join(f"'{r.kind}'" for r in secrets.RULES) + "]"
    joined = "coalesce(array_to_string(list_transform({spans}, lambda z: {kinds}[z.k + 1] || ':' || z.s || ':' || (z.s + z.n)), ','), '')"
    base = joined.format(spans="list_filter(spans, lambda z: z.k < 3)", kinds=kinds)
    count = "len(list_filter(spans, lambda z: z.k = {k}))::BIGINT AS n_{kind}"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    m AS (SELECT doc_id, {", ".join(parts)} FROM d),
    f AS (SELECT doc_id, list_sort(flatten([{", ".join(_spans_sql(k, r) for k, r in enumerate(secrets.RULES))}])) AS spans FROM m)
    SELECT doc_id, {", ".join(count.format(k=k, kind=secrets.RULES[k].kind) for k in range(3))}, sha256({base}) AS base_sha256, {joined.format(spans="spans", kinds=kinds)} AS spans FROM f
    """


@query("op9_secret_scan", _secrets_sql())
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents", "doc_id", "text"))
    base = F.filter("secrets", lambda s: s["number"] < secrets.BASE)
    kinds = F.transform("secrets", lambda s: s["number"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(secrets.RULES[: secrets.BASE])
    ]
    return found.select("doc_id", *counts, F.sha2(F.encode(secrets.listed(base), "UTF-8"), 256).alias("base_sha256"), secrets.listed(F.col("secrets")).alias("spans"))


def _licences_sql() -> str:
    rows = ", ".join(f"('{name}', ['" + "', '".join(bigrams) + "'])" for name, bigrams in licences.template_bigrams(licences.TEMPLATES).items())
    return f"""
    WITH t(licence, theirs) AS (VALUES {rows}),
    l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
    u AS (SELECT doc_id, i AS line, lines[i] AS unit FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM l)
          UNION ALL SELECT doc_id, 0, text FROM l WHERE len(lines) > 1),
    w AS (SELECT doc_id, line, regexp_extract_all(lower(unit), '[a-z0-9]+') AS words FROM u),
    b AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS own FROM w WHERE len(words) > 1),
    s AS (SELECT doc_id, line, licence, 2.0::DOUBLE * len(list_intersect(own, theirs)) / (len(own) + len(theirs)) AS dice FROM b, t
          WHERE 2 * least(len(own), len(theirs)) >= {licences.LEAST} * (len(own) + len(theirs)))
    SELECT doc_id, line::INT AS line, licence, dice FROM s WHERE dice >= {licences.LEAST}
    QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, licence) = 1
    """


@query("op4_licence_scan", _licences_sql())
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents", "doc_id", "text")).drop("last").withColumnRenamed("id", "doc_id")


@query("op7_host_paths")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = html.extract(table(spark, folder, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query(
    "op1_kdtree_top_k",
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x))
    SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM s
    WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
    """,
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    return kdtree.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query(
    "op3_fixity_audit",
    r"""
    WITH p AS (SELECT page_id, floor(page_id / 1000)::BIGINT AS file, coalesce(html, '') AS body,
                      'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
                      || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) AS head FROM pages),
    r AS (SELECT *, (strlen(head) + strlen(body) + 4)::BIGINT AS n_bytes FROM p),
    o AS (SELECT *, coalesce(sum(n_bytes) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM r)
    SELECT file, "offset", n_bytes, page_id, CASE WHEN page_id % 211 = 50 THEN 'missing' ELSE 'changed' END AS status
    FROM o WHERE page_id % 211 IN (50, 101) OR (page_id % 211 = 7 AND body <> '')
    """,
)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id", "url", "html")
    return fixity.audit(written(fixity.records(pages), "primary"), written(fixity.damaged(pages), "replica"))


#: crc32 in SQL: the table of its bytes, and the sum over the UTF-8 bytes of a text.
_CRC_TABLE = """crc_table AS (SELECT list(list_reduce(range(8)::BIGINT[], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS tbl
                              FROM (SELECT unnest(range(256))::BIGINT AS i))"""


def _crc(text: str) -> str:
    digits = f"hex(encode({text}))"
    data = f"list_transform(range(0, len({digits}) // 2), lambda k: ('0x' || substr({digits}, 2 * k + 1, 2))::BIGINT)"
    return f"xor(list_reduce({data}, lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"


@query(
    "op11_periodic_runs",
    rf"""
    WITH {_CRC_TABLE},
    h AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS own, {_crc("doc_id::VARCHAR")} AS h FROM documents, crc_table),
    a AS (SELECT *, len(own) AS n, h // 10 AS g, CASE WHEN len(own) > 0 THEN (h // 10) % len(own) ELSE 0 END AS a FROM h),
    p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
    w AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: own[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1]) ELSE own END AS w FROM p),
    x AS (SELECT doc_id, n, i, w[i + 1] AS word, array_to_string(w[i + 1:i + 5], ' ') AS gram FROM (SELECT *, unnest(range(0, n)) AS i FROM w)),
    pairs AS (SELECT l.doc_id, l.i, r.i - l.i AS d FROM x l JOIN x r ON l.doc_id = r.doc_id AND l.gram = r.gram AND r.i > l.i AND 4 * (r.i - l.i) <= l.n
              WHERE r.i + 5 <= r.n),
    marked AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM pairs),
    stretches AS (SELECT doc_id, d, min(i) AS start, count(*) + 4 + d AS length FROM marked GROUP BY doc_id, d, island),
    runs AS (SELECT doc_id, start, length, min(d) AS period FROM stretches WHERE length >= greatest(6, 4 * d) GROUP BY doc_id, start, length),
    best AS (SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(start := start, length := length, period := period), row(-length, start, period)) AS b,
                    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY doc_id),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM x
             WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = x.doc_id AND x.i >= r.start + r.period AND x.i < r.start + r.length) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length, b.period::BIGINT AS period,
           (1000 * b.length // b.period)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
    FROM documents d LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.collapse(runs.repeated(table(spark, folder, "documents", "doc_id", "text")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", longest).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.less") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query(
    "op12_spelling_variants",
    rf"""
    WITH RECURSIVE {_CRC_TABLE},
    r AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
    c AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY doc_id, run),
    s AS (SELECT run, n, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM c, crc_table),
    t AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM s),
    words AS (SELECT word, sum(n)::BIGINT AS n FROM t WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    gaps AS (SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS rest FROM (SELECT *, unnest(range(0, length(word))) AS k FROM words)),
    pairs AS (SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
              UNION SELECT w.word, g.word, g.n FROM words w JOIN gaps g ON w.word = g.rest
              UNION SELECT g.word, w.word, w.n FROM words w JOIN gaps g ON w.word = g.rest),
    best AS (SELECT word, count(*) AS n_near, arg_min(struct_pack(w := other, n := other_n), row(-other_n, other)) AS b FROM pairs GROUP BY word),
    forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 10 * w.n THEN b.w END AS form, CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n FROM words w LEFT JOIN best USING (word)),
    steps AS (SELECT word, word AS root FROM forms UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NOT NULL),
    roots AS (SELECT s.word, s.root FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NULL)
    SELECT f.word, form, root, n::BIGINT AS n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM forms f JOIN roots USING (word)
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    counts = variants.count_words(table(spark, folder, "documents", "doc_id", "text"), drop_modulus=31)
    words = written(counts.where(F.col("n") >= variants.LEAST_TIMES), "vocabulary")
    return variants.variants(words)


@query("op13_bpe_round_trip")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    both = bpe.round_trip(table(spark, folder, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return both.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
