"""Named queries of the operators over the driver's tables, and their DuckDB
texts where SQL can express them. Each query runs its operator over the whole
intended table and derives the contract's columns from the operator's rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.sources.tables import read_table

from . import bpa, cotrain, hpylm, jaccard, langid, licenses, linededup, merkle, mixing, packing, spotsigs, topk, variants
from .ship import ready

VOCABULARY = "word_bpe_49k.json"


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    e = e.select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return topk.top_k(e, F.col("vec_id") % 20 == 0)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(read_table(spark, sf_dir, "documents"))


def op4_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return hpylm.score(docs, "doc_id", "text", langid.held_out(F.col("doc_id"), part=1))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_with_next(read_table(spark, sf_dir, "documents"))


def decayed_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Record tables of ``pages`` as WARC archives and of a replica that has
    decayed: of every 97 ids one record has a byte changed in place, and of
    every 1009 one is lost."""
    pages = read_table(spark, sf_dir, "pages")
    decayed = pages.filter(~F.coalesce(F.col("page_id") % 1009 == 500, F.lit(False))).withColumn(
        "html", F.when(F.col("page_id") % 97 == 13, F.concat(F.lit("?"), F.substring("html", 2, 2**31 - 1)))
        .otherwise(F.col("html")))

    def recs(p):
        return merkle.records(p, F.col("page_id"), merkle.warc_record(F.col("url"), F.col("html")),
                              merkle.archives_by_id(F.col("page_id")))
    return recs(pages), recs(decayed)


def near_duplicates_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6's near duplicates: all pairs of different fingerprints with a
    likeness of 0.8 or more, by the smallest ids that have them."""
    return spotsigs.near_duplicates(spotsigs.fingerprints(read_table(spark, sf_dir, "documents")))


def op7_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fixity_audit(*decayed_pages(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select(
        "page_id", linededup.page_host(F.col("url")).alias("host"), linededup.html_lines(F.col("html")).alias("text"))
    # parsed once: the operator reads the texts several times
    pages = pages.checkpoint(eager=True)
    return linededup.drop_boilerplate(pages, counts=True)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    apart = langid.held_out(F.col("doc_id"))
    model = langid.learn(docs.filter(~apart))
    found = langid.predict(docs.select("doc_id", "text", apart.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "lang_mix")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_path(), with_ids=False)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(read_table(spark, sf_dir, "documents"), typos=97)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["exact"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["first_word"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["similarity"])), F.lit(0.0)).alias("score"), "spans")


def op13_bpa_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpa.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _ready(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ready(spark), sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _ready(f) for f in (op1_cotrain, op2_topk_search, op3_jaccard_join, op4_hpylm, op5_mixing, op6_spotsigs, op7_merkle_audit, op8_line_dedup, op9_langid, op10_packing,
        op11_spelling_variants, near_duplicates_spotsigs, op12_license_scan, op13_bpa_search)}

ORACLE: dict[str, str] = {
    "op2_topk_search": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.r <> b.r AND a.vec_id % 20 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scored QUALIFY rank <= 20
    """,
    "op7_merkle_audit": r"""
        WITH copies AS (
            SELECT 'a' AS side, page_id, url, html FROM pages
            UNION ALL
            SELECT 'b', page_id, url, CASE WHEN page_id % 97 = 13 THEN '?' || html[2:] ELSE html END
            FROM pages WHERE coalesce(page_id % 1009 <> 500, true)
        ), record AS (
            SELECT side, page_id, CASE WHEN html IS NOT NULL THEN 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response'
                || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
                || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html
                || chr(13) || chr(10) || chr(13) || chr(10) END AS bytes
            FROM copies
        ), leaf AS (
            SELECT side, CAST(floor(page_id / 1024) AS BIGINT) AS archive, page_id AS record_id,
                   coalesce(strlen(bytes), 0) AS length, sha256(coalesce(bytes, 'null record')) AS digest
            FROM record
        ), placed AS (
            SELECT *, row_number() OVER w - 1 AS n, CAST(sum(length) OVER w - length AS BIGINT) AS start
            FROM leaf WINDOW w AS (PARTITION BY side, archive ORDER BY record_id, digest ROWS UNBOUNDED PRECEDING)
        ), copies_of AS (
            SELECT *, row_number() OVER (PARTITION BY side, archive, record_id, length, digest ORDER BY n) AS copy FROM placed
        ), alone AS (
            SELECT any_value(side) AS side, archive, record_id, length, digest, any_value(n) AS n, any_value(start) AS start
            FROM copies_of GROUP BY archive, record_id, length, digest, copy HAVING count(*) = 1
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY side, archive, record_id ORDER BY n) AS r FROM alone
        ), a AS (SELECT * FROM ranked WHERE side = 'a'), b AS (SELECT * FROM ranked WHERE side = 'b')
        SELECT coalesce(a.archive, b.archive) AS archive, coalesce(a.n, b.n) AS n, coalesce(a.start, b.start) AS start,
               coalesce(a.start + a.length, b.start + b.length) AS "end", coalesce(a.record_id, b.record_id) AS record_id,
               CASE WHEN b.digest IS NULL THEN 'missing' WHEN a.digest IS NULL THEN 'extra' ELSE 'corrupt' END AS status,
               a.digest AS digest, b.digest AS replica_digest
        FROM a FULL JOIN b ON a.archive IS NOT DISTINCT FROM b.archive AND a.r = b.r
                          AND a.record_id IS NOT DISTINCT FROM b.record_id
    """,
    "op8_line_dedup": r"""
        WITH p AS (
            SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
                   regexp_replace(regexp_replace(html, '<[^>]*>', chr(10), 'g'),
                                  '[ \t\r\n]*\n[ \t\r\n]*', chr(10), 'g') AS text,
                   row_number() OVER () AS r
            FROM pages
        ), l AS (
            SELECT r, host, text, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS n
            FROM p
        ), sites AS (
            SELECT host, count(DISTINCT text) AS host_pages FROM p GROUP BY host
        ), lines AS (
            SELECT host, trim(line, ' ') AS key, count(DISTINCT text) AS n_pages FROM l
            WHERE trim(line, ' ') <> '' GROUP BY ALL
        ), bad AS (
            SELECT lines.host, key FROM lines JOIN sites ON lines.host IS NOT DISTINCT FROM sites.host
            WHERE n_pages >= 2 AND n_pages > 0.1 * host_pages
        ), kept AS (
            SELECT r, string_agg(line, chr(10) ORDER BY n) FILTER (WHERE key IS NULL) AS text,
                   count(*) AS n_lines, count(key) AS n_dropped
            FROM l LEFT JOIN bad ON bad.host IS NOT DISTINCT FROM l.host AND bad.key = trim(line, ' ')
            GROUP BY r
        )
        SELECT page_id, host, CASE WHEN p.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
               coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
        FROM p LEFT JOIN kept USING (r)
    """,
    "op13_bpa_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), i AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), total AS (
            SELECT count(DISTINCT r) AS n_docs, count(*) AS n_terms FROM d
        ), doc AS (
            SELECT r, 100 - 50 + (50 * count(*) * (SELECT n_docs FROM total)) // (SELECT n_terms FROM total) AS m
            FROM d GROUP BY r
        ), tf AS (
            SELECT r, doc_id, term, count(*) AS tf FROM d SEMI JOIN i USING (term) GROUP BY ALL
        ), weight AS (
            SELECT term, CAST(floor(1000 * ln((2 * (SELECT n_docs FROM total) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))
                              AS BIGINT) AS w
            FROM tf GROUP BY term
        ), scored AS (
            SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM i JOIN tf USING (term) JOIN weight USING (term) JOIN doc USING (r) GROUP BY ALL
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 50
    """,
}
