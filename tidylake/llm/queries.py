"""Registered queries of this subpackage: each applies its operator to its whole
table; SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tidylake.llm import (bpe, hard_negatives, html_text, lexical_search, mixing, quality,
                          sentence_pieces, sharding, token_groups, token_output, topk, toxicity,
                          url_filter)
from tidylake.llm.common import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_style_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.compression_bands(docs).drop("text")


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_groups.clusters(token_groups.jaccard_join(_table(spark, sf_dir, "documents")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.toxicity(docs, model).drop("text")


TOKEN_FILE = "byte_bpe_50k.json"
END_ID = 2


def op7_token_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "tokens")
    token_output.write_tokens(_table(spark, sf_dir, "documents"), out,
                              public_tokenizers.path(TOKEN_FILE), END_ID)
    rows = token_output.id_crc32(token_output.read_tokens(spark, out))
    return token_output.placed(rows, out).select("doc_id", "start", "n_tokens", "ids_crc32")


WORD_FILE = "word_bpe_49k.json"


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_FILE))


SHARDS = 24


def op8_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = _table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.interleave(digest, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


TOP_K = 5
QUERY_EVERY = 50


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0), TOP_K)


# The rules (verdict, host, path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"),
             ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# Words of host labels whose pages make up the list of blocked URLs.
LISTED_WORDS = ["spam", "pills", "casino", "phish", "malware"]


def listed_urls(pages: DataFrame) -> DataFrame:
    """The blocked URLs: canonical URLs of pages on hosts that hold a listed word."""
    host = url_filter.host_of(F.col("url"))
    return pages.where(host.rlike("|".join(LISTED_WORDS))).select(
        url_filter.canonical(F.col("url")).alias("url"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.url_verdicts(pages, listed_urls(pages), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


RANKED = 10


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"),
                                 _table(spark, sf_dir, "benchmark"), RANKED)


ANCHOR_EVERY = 100


def op12_rtree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = _table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
        .alias("label"))
    return hard_negatives.mine(rows, rows.where(F.col("vec_id") % ANCHOR_EVERY == 0))


PIECE_FILE = "piece_bpe_32k.model"


def op13_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digests(_table(spark, sf_dir, "documents"),
                                   public_tokenizers.path(PIECE_FILE))


QUERIES = {
    "op1_style_tree_text": op1_style_tree_text,
    "op2_compression_bands": op2_compression_bands,
    "op3_mixture": op3_mixture,
    "op4_token_groups": op4_token_groups,
    "op5_toxicity": op5_toxicity,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_token_lists": op7_token_lists,
    "op8_interleaved_shards": op8_interleaved_shards,
    "op9_bpe": op9_bpe,
    "op10_url_filter": op10_url_filter,
    "op11_ranked_search": op11_ranked_search,
    "op12_rtree_negatives": op12_rtree_negatives,
    "op13_merge_rounds": op13_merge_rounds,
}

ORACLE_SQL = {}

ORACLE_SQL["op3_mixture"] = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, '~')), 1, 15))::BIGINT AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::HUGEINT AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS place, sum(source_size) OVER () AS total
  FROM s),
l AS (
  SELECT *, (150 * total - coalesce(sum(200::HUGEINT * source_size) OVER (
               ORDER BY source_size * (6 // weight), place
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
            >= 200::HUGEINT * source_size * sum(weight) OVER (
               ORDER BY source_size * (6 // weight), place
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped
  FROM w),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN source_size::DOUBLE * 2
              ELSE ((150 * total - sum(CASE WHEN capped THEN 200::HUGEINT * source_size ELSE 0 END) OVER ()) * weight)::DOUBLE
                   / (100 * sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
r AS (
  SELECT d.doc_id, d.size, d.key, e.source_size, e.target, e.epochs, target - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST)::DOUBLE AS upto,
         sum(size) OVER (PARTITION BY d.source, d.key, d.doc_id)::DOUBLE AS own
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN rest > 0 AND upto - own / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""

ORACLE_SQL["op6_exact_top_k"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE_SQL["op11_ranked_search"] = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS place, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
q AS (
  SELECT item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
a AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
t AS (
  SELECT place, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*)::BIGINT AS tf
  FROM (SELECT place, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY place, term),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT term, count(*)::BIGINT AS df FROM t GROUP BY term), a),
s AS (
  SELECT item_id, place, any_value(doc_id) AS doc_id,
         sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN w USING (term), a GROUP BY item_id, place),
r AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

ORACLE_SQL["op12_rtree_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
         s.score AS negative_score, row_number() OVER (
           PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND p.place <= 5
   AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

_RULE_SQL = "CASE " + " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{}}'".replace(
        "{}", f"{h}{p}|{v}")
    for v, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))) + " END"

ORACLE_SQL["op10_url_filter"] = rf"""
WITH a AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
b AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
  FROM a),
c AS (
  SELECT *, regexp_replace(regexp_replace(host, '^(www|m)\.', ''), ':(80|443)\z', '')
            || regexp_replace(path, '/+\z', '') AS bare,
         array_to_string(list_sort(list_filter(string_split(query, '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)(=|\z)'))), '&') AS kept,
         {_RULE_SQL} AS fit
  FROM b),
k AS (
  SELECT *, bare || CASE WHEN coalesce(kept, '') <> '' THEN '?' || kept ELSE '' END AS canonical FROM c),
l AS (
  SELECT DISTINCT canonical FROM k WHERE regexp_matches(host, '{"|".join(LISTED_WORDS)}'))
SELECT page_id, host, path, split_part(fit, '|', 1) AS rule,
       CASE WHEN fit IS NOT NULL THEN split_part(fit, '|', 2)
            WHEN canonical IN (SELECT canonical FROM l) THEN 'block' ELSE 'allow' END AS verdict
FROM k
"""
