"""Queries and oracle SQL of this subpackage: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    ann,
    bpe_fst,
    fingerprint,
    line_dedup,
    ngram_join,
    packing,
    periodic_runs,
    quality,
    secret_scan,
    token_alignment,
    token_count,
    toxicity,
    warc_bundles,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cut=0.7)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"), end_id=1, size=2048)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), threshold=0.8, n=5)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op6_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_digests(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cut=0.3)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_fst.encode_documents(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                    public_tokenizers.PATTERN)


def op11_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles.archive_pages(table(spark, sf_dir, "pages"), min_bytes=1000).drop("url")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                           public_tokenizers.path("piece_bpe_32k.model"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.plant(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Query]:
    found = [f for name, f in globals().items() if name.startswith("op") and callable(f)]
    return {f.__name__: f for f in sorted(found, key=lambda f: int(f.__name__[2:].split("_")[0]))}


LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
frequent AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.*, coalesce(keyed.doc_id <> frequent.keeper, false) AS gone
  FROM keyed LEFT JOIN frequent ON keyed.k = frequent.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


NGRAM_JOIN_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '\S+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE
           WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
  FROM words),
kinds AS (SELECT s, count(*) AS copies, min(doc_id) AS rep FROM sets GROUP BY s),
grams AS (SELECT rep, len(s) AS n, unnest(s) AS gram FROM kinds),
shared AS (
  SELECT a.rep AS x, b.rep AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS n
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.rep <> b.rep GROUP BY 1, 2),
links AS (SELECT x, y FROM shared WHERE n >= 0.8 * (nx + ny - n)),
reach AS (
  SELECT rep AS x, rep AS y FROM kinds
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
named AS (SELECT x, min(y) AS class_id FROM reach GROUP BY x),
counted AS (SELECT l.x, sum(k.copies) AS n FROM links l JOIN kinds k ON k.rep = l.y GROUP BY l.x)
SELECT sets.doc_id, named.class_id, CAST(coalesce(counted.n, 0) + kinds.copies - 1 AS BIGINT) AS n_links,
       kinds.copies - 1 AS n_copies
FROM sets JOIN kinds ON sets.s = kinds.s JOIN named ON named.x = kinds.rep LEFT JOIN counted ON counted.x = kinds.rep
"""


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
sized AS (SELECT *, strlen(html) AS n FROM p),
kept AS (SELECT html, max(page_id) AS keeper FROM sized WHERE n >= 1000 GROUP BY html),
marked AS (
  SELECT s.*, k.keeper, (k.keeper IS NOT NULL AND s.page_id IS DISTINCT FROM k.keeper) AS again
  FROM sized s LEFT JOIN kept k ON s.html = k.html)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN keeper END AS refers_to
FROM marked
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_ngram_join": NGRAM_JOIN_SQL, "op7_line_dedup": LINE_DEDUP_SQL, "op11_warc_bundles": WARC_SQL}
