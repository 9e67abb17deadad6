"""The registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (align, decontaminate, licenses, lm, phrases, pieces, prefixhash, sharding, simhash, token_tree, toxicity,
               url_rules, warc)
from .common import table


def simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.simhash_components(docs, shingle=4, max_bits=4)


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def sharding_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return sharding.shard_documents(docs, shards=40)


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    rules = spark.createDataFrame(url_rules.RULES, "verdict string, host string, path string")
    return url_rules.judge_pages(pages, rules)


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.score_documents(docs, labels)


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(licenses.TEMPLATES, "license string, text string")
    return licenses.scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"), templates)


def prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixhash.fingerprint_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_tree.edited_counts(table(spark, sf_dir, "documents", "doc_id", "text"))


def tokenizer_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.linked_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages", "page_id", "url", "html")).drop("target_uri")


def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


QUERIES = {
    "op1_simhash": simhash_neardup,
    "op2_lm_scores": lm_scores,
    "op3_sharding": sharding_slots,
    "op4_decontamination": benchmark_leaks,
    "op5_sentencepiece": sentencepiece_dropout,
    "op6_licenses": license_scan,
    "op7_fingerprints": prefix_fingerprints,
    "op8_url_filter": url_filter,
    "op9_toxicity": toxicity_scores,
    "op10_token_counts": token_counts,
    "op11_alignment": tokenizer_links,
    "op12_warc": warc_records,
    "op13_collocations": collocations,
}

ORACLES = {
    "op8_url_filter": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
parts AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM hosts),
rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT page_id, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS nth
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND f.nth = 1
""",
    "op12_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         coalesce(html, '') AS payload
  FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS last_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM w
""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
counted AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM lists, (VALUES (1), (2), (3), (4)) AS t(k) WHERE len(w) >= k))
  GROUP BY lang, k, phrase),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang),
often AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counted WHERE f >= 30),
cuts AS (SELECT lang, k, phrase, f AS a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:k], ' ') AS tail
         FROM (SELECT *, unnest(range(1, k)) AS c FROM often WHERE k > 1)),
scores AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.c, x.f AS l, y.f AS r,
         CAST((CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cuts c JOIN often x ON x.lang = c.lang AND x.phrase = c.head JOIN often y ON y.lang = c.lang AND y.phrase = c.tail),
low AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_spans AS (
  SELECT lang, f, array_to_string(w[i:i + s - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM often WHERE k > 2))),
cover AS (SELECT lang, phrase, max(f) AS most FROM inner_spans GROUP BY lang, phrase),
kept AS (
  SELECT low.* FROM low LEFT JOIN cover USING (lang, phrase)
  WHERE most IS NULL OR CAST(100 AS HUGEINT) * most < CAST(80 AS HUGEINT) * a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""",
}
