"""Registered queries of the corpus operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import bpe, main_text, quality, toxicity
from gridspark.llm.common import cut, table
from gridspark.llm.divergence import audit_sources
from gridspark.llm.fixity import audit, lay_out
from gridspark.llm.histogram_sort import shard_by_bytes
from gridspark.llm.lexical import best_documents
from gridspark.llm.mixing import mix
from gridspark.llm.packing import pack
from gridspark.llm.text_dups import text_classes
from gridspark.llm.url_filter import url_verdicts
from gridspark.llm.vector_dups import link_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


# The rules of the URL filter query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query("op4_url_filter", r"""
WITH rules(rule_host, rule_path, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
       ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
 cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
 parts AS (SELECT row_number() OVER () AS n, page_id,
       translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
       regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
 met AS (SELECT p.*, rule_host || rule_path AS rule, v, row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC) AS k
       FROM parts p LEFT JOIN rules r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM met WHERE k = 1
""")
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, folder, "pages"), rules)


@query("op8_histogram_sort")
def op8_histogram_sort(spark: SparkSession, folder: str) -> DataFrame:
    slim = table(spark, folder, "documents").select("doc_id", "text")
    placed = shard_by_bytes(slim, shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op5_mixing", r"""
WITH sized AS (SELECT row_number() OVER () AS n, doc_id, source, md5(coalesce(text, '')) AS mark,
       CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
 src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
       CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sized GROUP BY source),
 ranked AS (SELECT *, sum(2 * source_size) OVER r - 2 * source_size AS filled, sum(w) OVER () - sum(w) OVER r + w AS open_w,
       sum(source_size) OVER () AS whole, 2 * source_size / w AS ratio
       FROM src WINDOW r AS (ORDER BY 2 * source_size / w, source NULLS LAST)),
 level AS (SELECT min_by((1.5::DOUBLE * whole - filled) / open_w, ratio) AS lv FROM ranked
       WHERE 2 * source_size > w * ((1.5::DOUBLE * whole - filled) / open_w)),
 goal AS (SELECT source, source_size, CAST(least(CAST(2 * source_size AS DOUBLE), w * coalesce(lv, 'infinity'::DOUBLE)) AS DOUBLE) AS target FROM src, level),
 streams AS (SELECT s.*, source_size, target, floor(target) AS stop,
       sum(size) OVER (PARTITION BY s.source ORDER BY md5('0|' || coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || mark), doc_id, n ROWS UNBOUNDED PRECEDING) AS end0,
       source_size + sum(size) OVER (PARTITION BY s.source ORDER BY md5('1|' || coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || mark), doc_id, n ROWS UNBOUNDED PRECEDING) AS end1
       FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(greatest(0, least(end0, stop) - (end0 - size)) + greatest(0, least(end1, stop) - (end1 - size)) AS BIGINT) AS taken
FROM streams
""")
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed, docs = mix(table(spark, folder, "documents"))
    taken = mixed.groupBy("row").agg(F.sum("tokens").alias("taken"))
    return docs.join(taken, "row", "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


@query("op6_fixity", r"""
WITH rec AS (SELECT page_id, CAST(floor(page_id / 512) AS BIGINT) AS file, coalesce(html, '') AS body,
       'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
       || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' AS head FROM pages),
 made AS (SELECT page_id, file, head || strlen(body) || repeat(chr(13) || chr(10), 2) || body || repeat(chr(13) || chr(10), 2) AS record,
       head || strlen('#' || substr(body, 2)) || repeat(chr(13) || chr(10), 2) || '#' || substr(body, 2) || repeat(chr(13) || chr(10), 2) AS hurt FROM rec),
 laid AS (SELECT *, row_number() OVER f - 1 AS nth, coalesce(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id, sha256(record) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
       FROM made WINDOW f AS (PARTITION BY file ORDER BY page_id, sha256(record))),
 told AS (SELECT *, page_id % 97 = 11 OR (file % 13 = 5 AND nth >= 400) AS gone, page_id % 97 = 3 AS changed FROM laid)
SELECT file, CAST(pos AS BIGINT) AS "offset", CASE WHEN gone THEN 'missing' ELSE 'altered' END AS kind, sha256(record) AS want,
       CASE WHEN NOT gone THEN sha256(hurt) END AS have FROM told WHERE gone OR (changed AND record <> hurt)
""")
def op6_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """The archive of all pages against a replica with altered and lost records and files cut short."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    archive = cut(lay_out(pages))
    hurt = F.when(F.col("page_id") % 97 == 3, F.concat(F.lit("#"), F.substring("html", 2, 1 << 30))).otherwise(F.col("html"))
    copies = lay_out(pages.withColumn("html", hurt)).select("id", "file", "nth", F.col("length").alias("held"), F.col("digest").alias("hash"))
    lost = (F.col("id") % 97 == 11) | ((F.col("file") % 13 == 5) & (F.col("nth") >= 400))
    replica = cut(
        archive.join(copies.drop("id"), ["file", "nth"]).filter(~F.coalesce(lost, F.lit(False)))
        .select("file", "offset", F.col("held").alias("length"), F.col("hash").alias("digest"))
    )
    return audit(archive.select("file", "offset", "length", "digest"), replica)


@query("op9_packing")
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.train(docs, table(spark, folder, "labels"))
    judged = docs.select("doc_id", quality.judge(F.col("text"), model).alias("q"))
    return judged.select(
        "doc_id", *[f"q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_words", "n_lines")]
    )


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@query("op10_html_extraction")
def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return main_text.extract(pages, main_text.train(pages))


@query("op3_embedding_dups")
def op3_embedding_dups(spark: SparkSession, folder: str) -> DataFrame:
    return link_vectors(table(spark, folder, "embeddings"))


@query("op2_minhash_dups")
def op2_minhash_dups(spark: SparkSession, folder: str) -> DataFrame:
    return text_classes(table(spark, folder, "documents")).select("doc_id", "class_id", "kept")


@query("op11_lexical_search", r"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
 q AS (SELECT row_number() OVER () AS item, item_id,
       unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
 asked AS (SELECT item, item_id, term, count(*) AS times FROM q GROUP BY ALL),
 total AS (SELECT count(*) FILTER (len(words) > 0) AS n, CAST(sum(len(words)) AS BIGINT) AS l FROM d),
 t AS (SELECT doc, doc_id, len(words) AS n, unnest(words) AS term FROM d),
 tf AS (SELECT doc, doc_id, n, term, count(*) AS tf FROM t SEMI JOIN asked USING (term) GROUP BY ALL),
 w AS (SELECT term, CAST(floor(1000 * ln((2 * max(total.n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, total GROUP BY term),
 worth AS (SELECT doc, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * tf.n * total.n) // total.l))) AS worth FROM tf JOIN w USING (term), total),
 s AS (SELECT item, item_id, doc, doc_id, CAST(sum(times * worth) AS BIGINT) AS score FROM asked JOIN worth USING (term) GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10
""")
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return best_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_divergence_audit", r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
 t AS (SELECT doc, lang, source, unnest(words) AS term FROM d),
 tf AS (SELECT doc, lang, source, term, count(*) AS n FROM t GROUP BY ALL),
 kept AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS whole FROM tf GROUP BY ALL HAVING count(*) >= 3),
 l AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(whole) AS n FROM kept GROUP BY lang),
 cnt AS (SELECT lang, source, term, CAST(sum(n) AS HUGEINT) AS c FROM tf SEMI JOIN kept USING (lang, term) GROUP BY ALL),
 gn AS (SELECT lang, source, sum(c) AS n FROM cnt GROUP BY ALL),
 g AS (SELECT x.lang, x.source, coalesce(gn.n, 0) AS n, coalesce(l.v, 0) AS v, l.n AS ln FROM (SELECT DISTINCT lang, source FROM d) x
       LEFT JOIN gn USING (lang, source) LEFT JOIN l ON x.lang = l.lang),
 p AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, 1 + (1000000000 * (coalesce(c, 0) + 1)) // (g.n + g.v) AS p, 1 + (1000000000 * (k.whole + 1)) // (g.ln + g.v) AS q
       FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source AND cnt.term = k.term),
 gaps AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
 pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(gaps.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN gaps ON gaps.lang = a.lang AND gaps.source = a.source AND gaps.item = b.source),
 term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE c > 0 AND p > q),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM (FROM pair UNION ALL FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INT) AS rank FROM ranked WHERE part = 'pair' OR r <= 200
""")
def op12_divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_sources(table(spark, folder, "documents"))


@query("op13_bpe_codec")
def op13_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.token_digests(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


QUERIES["pipeline"] = corpus_pipeline.run
