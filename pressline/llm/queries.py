"""The registered queries of this subpackage, with DuckDB twins where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressline.llm import (decontamination, exact_dedup, html_text, jaccard_join, language_id, packing,
                           periodic_runs, quality, sharding, spelling, suffix_dedup, toxicity, url_filters)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The visible text of every page."""
    return html_text.page_texts(table(spark, folder, "pages"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its toxicity score."""
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its component of near copies."""
    return jaccard_join.similar_groups(table(spark, folder, "documents"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one of its copies that stays."""
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its hits by test items."""
    return decontamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("items", "spans")


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.packed_documents(table(spark, folder, "documents"))


def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page with the verdict on its URL."""
    return url_filters.filtered(table(spark, folder, "pages"))


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with what is left after its repeated strings are removed."""
    return suffix_dedup.repeated_strings(table(spark, folder, "documents")).drop("spans")


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its quality score."""
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its shard."""
    docs = table(spark, folder, "documents").select("doc_id", F.octet_length("text").alias("n_bytes"))
    return sharding.place(docs, "doc_id")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the documents with its usual form; 31 is the rule by which runs lose a letter."""
    words = spelling.word_counts(table(spark, folder, "documents"), drop_every=31)
    return spelling.spelling_variants(words.where(F.col("n") >= spelling.LEAST_COUNT))


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its language."""
    return language_id.language_id(table(spark, folder, "documents"), reject=False)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its longest run and digests of all runs and of the collapsed text."""
    found = periodic_runs.periodic_runs(table(spark, folder, "documents"), source=periodic_runs.planted_periods)
    return periodic_runs.run_digests(found)


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_toxicity, op3_ngram_jaccard_join, op4_exact_dedup,
    op5_benchmark_decontamination, op6_best_fit_packing, op7_url_filters, op8_suffix_array_dedup,
    op9_quality_classifier, op10_sharding, op11_spelling_variants, op12_language_id, op13_periodic_runs)}

LOWERED = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

ORACLES = {
    "op3_ngram_jaccard_join": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
                               ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)""",
    "op4_exact_dedup": f"""
WITH d AS (SELECT doc_id, {LOWERED} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d""",
    "op5_benchmark_decontamination": f"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
places AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size),
found AS (
  SELECT p.doc_id, p.i, p.size, v.item FROM
  (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS s FROM places) p
  JOIN windows v ON v.s = p.s AND v.size = p.size),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS k FROM found),
n_hits AS (SELECT doc_id, count(*) AS n_hit FROM hit GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words d LEFT JOIN n_hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op8_suffix_array_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
firsts AS (SELECT s, min(doc_id) AS first_doc FROM strings GROUP BY s),
starts AS (SELECT doc_id, i FROM strings JOIN firsts USING (s) WHERE first_doc < doc_id),
marked AS (
  SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM starts),
numbered AS (
  SELECT doc_id, i, sum(CASE WHEN step <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM marked),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY ALL),
pieces AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a)
                 || substr(any_value(h), 2 * max(b) + 1) AS k, sum(b - a) AS n_removed, count(*) AS n_spans
  FROM pieces JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
}
