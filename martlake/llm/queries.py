"""Registered queries of this package: thin digests over the operators, each
over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import decontam, fingerprints, jaccard, langid, licenses, lm, packing, quality, sharding, toxicity, trie, variants, warc
from martlake.llm.text import table

def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer's vocabulary file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE_SQL[key] = sql
        return fn
    return deco


@query("op1_order_minhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_likeness(table(spark, sf_dir, "documents"))


@query("op4_jump_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=24)


OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
reps AS (SELECT s, min(doc_id) AS rep FROM (SELECT doc_id, list_sort(s) AS s FROM sets WHERE len(s) > 0) GROUP BY s),
rep_grams AS (SELECT g.* FROM grams g JOIN reps r ON g.doc_id = r.rep),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k FROM rep_grams a
  JOIN rep_grams b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY ALL HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM common UNION SELECT b, a FROM common),
reach AS (SELECT rep AS a, rep AS b FROM reps UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
  CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE c.component_id END AS component_id
FROM sets s LEFT JOIN reps r ON list_sort(s.s) = r.s LEFT JOIN comp c ON c.rep = r.rep
"""


@query("op5_ngram_jaccard", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), n=3, percent=90)


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT item_id, least(len(w), 13) AS n,
    unnest(list_transform(range(1, greatest(len(w) - 13, 0) + 2), lambda i: array_to_string(w[i:i + 12], ' '))) AS g
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, p, grams.n, item_id FROM grams JOIN windows ON grams.n = windows.n AND grams.g = windows.g),
spots AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op7_winnowing", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("fp")


@query("op8_best_fit")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op9_cross_parsing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).drop("fp")


@query("op10_suffix_tree")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


@query("op2_warc_index")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_empirical_bayes")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("fp")


@query("op3_ordinal_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_template_licenses", licenses.license_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(table(spark, sf_dir, "documents"))


@query("op12_gram_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


@query("op13_prefix_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))
