"""Publishing datasets, snapshots, audits and listings with their oracles."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from pressline.catalog.helpers import IW, LANGS, iso_sql, joined, rounded, text_times
from pressline.catalog.registry import query
from pressline.functions import content as K
from pressline.functions import display as Y
from pressline.functions import times as M
from pressline.functions import titles as N
from pressline.operators import audits as A
from pressline.operators import dedup as D
from pressline.operators import fetch as X
from pressline.operators import listings as L
from pressline.operators import publish as B
from pressline.operators import slugs as G
from pressline.operators.cohort import classify_by_source
from pressline.plans import publish as PP
from pressline.session import cut_lineage, ensure_checkpoint_dir
from pressline.sources import exports as E
from pressline.sources import tables as ST
from pressline.sources.bucketed import BucketedTable, replaced

RUN = "2002-01-01T00:00:00Z"
RUN_TS = "2002-01-01 00:00:00"

CANDIDATE_SQL = """
SELECT a.source_item_id, a.parent_content_id, a.content_fingerprint, tr.language_code,
       tr.display_title, p.slug, s.publish_status, s.source_fingerprint AS published_fingerprint
FROM b_approved a JOIN b_decision d ON d.source_item_id = a.source_item_id
JOIN b_translation tr ON tr.parent_content_id = a.parent_content_id
 AND tr.source_fingerprint = a.content_fingerprint AND tr.translation_status = 'completed'
LEFT JOIN b_publish p ON p.source_item_id = a.source_item_id
LEFT JOIN b_publish_status s ON s.publish_record_id = p.publish_record_id
 AND s.language_code = tr.language_code
WHERE d.curate_status = 'approved'"""
ELIGIBLE_SQL = f"""SELECT source_item_id FROM ({CANDIDATE_SQL}) c GROUP BY source_item_id
HAVING count(DISTINCT language_code) = 3"""


def candidates(t):
    return B.candidates(t.b_approved, t.b_decision, t.b_translation, t.b_item, t.b_publish,
                        t.b_publish_status)


@query("reconciliation_candidates", "JOIN-10", f"""
SELECT source_item_id, language_code, display_title, slug, publish_status FROM ({CANDIDATE_SQL}) c""")
def _(t):
    return candidates(t).select("source_item_id", "language_code", "display_title", "slug",
                                "publish_status")


@query("published_pairs", "JOIN-16", """
SELECT p.source_item_id, p.slug, s.language_code, s.publish_status, s.source_fingerprint
FROM b_publish p JOIN b_publish_status s ON s.publish_record_id = p.publish_record_id""")
def _(t):
    return B.published_pairs(t.b_publish, t.b_publish_status).select(
        "source_item_id", "slug", "language_code", "publish_status", "source_fingerprint")


ACTIVE_ROWS_SQL = """
SELECT p.source_item_id, s.language_code, p.slug, s.published_at FROM b_publish p
JOIN b_publish_status s ON s.publish_record_id = p.publish_record_id
WHERE s.publish_status = 'published'"""


@query("active_published_rows", "JOIN-17", f"""
SELECT source_item_id, language_code, slug, {iso_sql('published_at')} AS published_at
FROM ({ACTIVE_ROWS_SQL}) q""")
def _(t):
    return text_times(B.active_rows(t.b_publish, t.b_publish_status))


@query("strict_match_items", "SET-2", ELIGIBLE_SQL)
def _(t):
    return B.eligible_items(candidates(t), LANGS)


PUBLISH_SQL = f"""
SELECT source_item_id, language_code, content_fingerprint, display_title, slug
FROM ({CANDIDATE_SQL}) c WHERE source_item_id IN ({ELIGIBLE_SQL})
AND (publish_status IS NULL OR publish_status <> 'published'
     OR published_fingerprint <> content_fingerprint)"""


@query("publish_or_update_set", "SET-3", f"""
SELECT source_item_id, language_code, content_fingerprint FROM ({PUBLISH_SQL}) q""")
def _(t):
    return B.to_publish(candidates(t), LANGS).select("source_item_id", "language_code",
                                                     "content_fingerprint")


@query("withdraw_set", "SET-4", f"""
SELECT source_item_id, language_code, slug FROM ({ACTIVE_ROWS_SQL}) a
WHERE source_item_id NOT IN ({ELIGIBLE_SQL})""")
def _(t):
    return B.to_withdraw(candidates(t), t.b_publish, t.b_publish_status, LANGS).select(
        "source_item_id", "language_code", "slug")


@query("publish_state_counts", "AGG-47", """
SELECT (SELECT count(*) FROM b_publish_status WHERE publish_status = 'published')
         AS published_artifacts,
       (SELECT count(*) FROM b_publish_status WHERE publish_status = 'withdrawn')
         AS withdrawn_artifacts,
       (SELECT count(*) FROM b_publish) AS frozen_slugs,
       count(*) FILTER (n = 3) AS eligible_items, count(*) FILTER (n < 3) AS blocked_items
FROM (SELECT d.source_item_id, count(DISTINCT tr.language_code) AS n FROM b_decision d
      LEFT JOIN b_approved a ON a.source_item_id = d.source_item_id
      LEFT JOIN b_translation tr ON tr.parent_content_id = a.parent_content_id
       AND tr.source_fingerprint = a.content_fingerprint AND tr.translation_status = 'completed'
      WHERE d.curate_status = 'approved' GROUP BY d.source_item_id) q""")
def _(t):
    return B.status_counts_by_policy(t.b_decision, t.b_approved, t.b_translation, t.b_publish,
                                     t.b_publish_status, LANGS)


@query("status_rows_after_run", "STA-10", f"""
SELECT coalesce(s.publish_record_id, c.publish_record_id) AS publish_record_id,
       coalesce(s.language_code, c.language_code) AS language_code,
       coalesce(c.new_status, s.publish_status) AS publish_status,
       {iso_sql("CASE WHEN c.new_status = 'published' THEN TIMESTAMP '2002-01-01' ELSE s.published_at END")} AS published_at,
       {iso_sql("CASE WHEN c.new_status = 'withdrawn' THEN TIMESTAMP '2002-01-01' ELSE s.withdrawn_at END")} AS withdrawn_at
FROM b_publish_status s FULL JOIN (
  SELECT p.publish_record_id, q.language_code, q.new_status FROM b_publish p JOIN (
    SELECT source_item_id, language_code, 'published' AS new_status FROM ({PUBLISH_SQL}) x
    UNION ALL SELECT source_item_id, language_code, 'withdrawn' FROM ({ACTIVE_ROWS_SQL}) a
    WHERE source_item_id NOT IN ({ELIGIBLE_SQL})) q ON q.source_item_id = p.source_item_id) c
  ON c.publish_record_id = s.publish_record_id AND c.language_code = s.language_code""")
def _(t):
    t.keep("b_translation", f"{folder(t)}/translation")
    rows = cut_lineage(candidates(t))
    out = B.to_withdraw(rows, t.b_publish, t.b_publish_status, LANGS)
    changes = (B.to_publish(rows, LANGS).select("source_item_id", "language_code",
                                                F.lit("published").alias("publish_status"),
                                                F.col("content_fingerprint")
                                                .alias("source_fingerprint"))
               .unionByName(out.select("source_item_id", "language_code",
                                       F.lit("withdrawn").alias("publish_status"),
                                       "source_fingerprint"))
               .join(t.b_publish.select("source_item_id", "publish_record_id"), "source_item_id")
               .withColumn("moment", F.lit(RUN_TS).cast("timestamp")))
    # The stored table is merged bucket by bucket: only buckets with a change are rewritten.
    stored = BucketedTable(t.spark, folder(t), t.b_publish_status.schema, ["publish_record_id"])
    stored.create(t.b_publish_status)
    stored.merge(changes, B.upsert_status)
    return text_times(stored.read().drop("source_fingerprint"))


SLUG_TITLE_SQL = f"""
SELECT source_item_id, coalesce(max(display_title) FILTER (language_code = 'en'),
       arg_min(display_title, language_code)) AS title
FROM ({PUBLISH_SQL}) q WHERE slug IS NULL GROUP BY source_item_id"""
SLUGIFY = ("trim(regexp_replace(regexp_replace(lower(strip_accents({})), '[^a-z0-9-]+', '-', 'g'), "
           "'-+', '-', 'g'), '-')")


@query("new_publish_records", "STA-11 WIN-4", f"""
SELECT source_item_id, CASE WHEN n = 1 THEN base ELSE base || '-' || n END AS slug,
       '2002-01-01T00:00:00Z' AS first_published_at
FROM (SELECT source_item_id, base, row_number() OVER (PARTITION BY base ORDER BY source_item_id) AS n
      FROM (SELECT source_item_id, {SLUGIFY.format('title')} AS base FROM ({SLUG_TITLE_SQL}) s) b) r""")
def _(t):
    return text_times(B.new_records(B.to_publish(candidates(t), LANGS), t.b_publish, RUN_TS))


@query("hot_title_slugs", "WIN-4", f"""
SELECT source_item_id, CASE WHEN n = 1 THEN base ELSE base || '-' || n END AS slug
FROM (SELECT source_item_id, base, row_number() OVER (PARTITION BY base ORDER BY source_item_id) AS n
      FROM (SELECT source_item_id, {SLUGIFY.format('display_title')} AS base
            FROM b_approved) b) r""")
def _(t):
    # Five titles for all articles: every base is hot.
    return G.assign_slugs(t.b_approved, t.b_publish.select("slug"), "source_item_id",
                          "display_title")


EPISODE_SQL = """
SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'Episode ' || (CAST(floor(o_orderkey / 7) AS BIGINT) + 2)
         WHEN 1 THEN 'Episode ' || (o_custkey % 500 + 2) ELSE 'Episode' END AS title FROM orders"""
FROZEN_SQL = "SELECT 'episode-' || (c_custkey * 3) AS slug, c_custkey * 3 AS slot FROM customer WHERE c_custkey % 5 = 0"


@query("numbered_title_slugs", "WIN-4 STA-11", f"""
WITH RECURSIVE items AS MATERIALIZED (
  SELECT id, title, CASE WHEN title = 'Episode' THEN 1 ELSE CAST(substr(title, 9) AS BIGINT) END AS n
  FROM ({EPISODE_SQL}) e),
frozen AS MATERIALIZED ({FROZEN_SQL}),
bare AS MATERIALIZED (SELECT id, row_number() OVER (ORDER BY id) AS b FROM items WHERE title = 'Episode'),
claims AS MATERIALIZED (
  SELECT n, first_id, (SELECT count(*) FROM bare WHERE bare.id < first_id) AS before
  FROM (SELECT n, min(id) AS first_id FROM items WHERE title <> 'Episode' GROUP BY n) c
  WHERE n NOT IN (SELECT slot FROM frozen)),
slots AS MATERIALIZED (
  SELECT s, CASE WHEN s IN (SELECT slot FROM frozen) THEN -1 ELSE coalesce(before, 1000000000) END AS taken_at
  FROM (SELECT unnest(range(1, (SELECT count(*) FROM items) * 2 + 2)) AS s) r LEFT JOIN claims ON n = s
  ORDER BY s LIMIT (SELECT count(*) FROM items) * 2),
-- Slot by slot: it goes to the next bare title unless it was frozen or claimed before that title came.
walk AS (
  SELECT CAST(0 AS BIGINT) AS s, CAST(0 AS BIGINT) AS b, FALSE AS used
  UNION ALL
  SELECT t.s, CASE WHEN t.taken_at >= w.b AND t.taken_at <> -1 THEN w.b + 1 ELSE w.b END,
         t.taken_at >= w.b AND t.taken_at <> -1
  FROM walk w JOIN slots t ON t.s = w.s + 1 WHERE w.b < (SELECT count(*) FROM bare)),
bare_slots AS (SELECT s, b FROM walk WHERE used),
child AS (
  SELECT i.id, i.n, row_number() OVER (PARTITION BY i.n ORDER BY i.id)
         + CASE WHEN i.n IN (SELECT slot FROM frozen) OR i.n IN (SELECT s FROM bare_slots) THEN 1 ELSE 0 END AS k
  FROM items i WHERE title <> 'Episode')
SELECT id, CASE WHEN s = 1 THEN 'episode' ELSE 'episode-' || s END AS slug
FROM bare JOIN bare_slots USING (b)
UNION ALL SELECT id, 'episode-' || n || CASE WHEN k = 1 THEN '' ELSE '-' || k END FROM child""")
def _(t):
    items = t.sql(EPISODE_SQL)
    return G.assign_slugs(items, t.sql(FROZEN_SQL).select("slug"), "id", "title")


@query("slugified_titles", "FN-18", rf"""
SELECT doc_id, coalesce(NULLIF({SLUGIFY.format("replace(split_part(text, chr(10), 1), 'ß', '')")}, ''),
       'item') AS slug FROM documents""")
def _(t):
    return t.documents.select("doc_id", N.slugify(F.split("text", "\n")[0]).alias("slug"))


# --- payloads and documents ----------------------------------------------------------------------------------

PAYLOAD_SQL = f"""
SELECT a.source_item_id, act.language_code, act.slug, tr.display_title, tr.summary_short,
       tr.bullet_1, tr.bullet_2, tr.bullet_3, i.canonical_url, i.published_at AS source_published_at,
       a.approved_at, act.published_at, d.downstream_action, a.author_metadata
FROM ({ACTIVE_ROWS_SQL}) act JOIN b_approved a ON a.source_item_id = act.source_item_id
JOIN b_decision d ON d.source_item_id = a.source_item_id
JOIN b_item i ON i.source_item_id = a.source_item_id
JOIN b_translation tr ON tr.parent_content_id = a.parent_content_id
 AND tr.language_code = act.language_code AND tr.source_fingerprint = a.content_fingerprint"""


def payloads(t):
    return B.payload_rows(t.b_approved, t.b_decision, t.b_translation, t.b_item, t.b_publish,
                          t.b_publish_status)


@query("published_payloads", "JOIN-11 SORT-3", f"""
SELECT source_item_id, language_code, slug, display_title, bullet_2, downstream_action,
       {iso_sql('source_published_at')} AS source_published_at FROM ({PAYLOAD_SQL}) p""")
def _(t):
    return text_times(payloads(t).select("source_item_id", "language_code", "slug",
                                         "display_title", "bullet_2", "downstream_action",
                                         "source_published_at").orderBy("language_code", "slug"))


@query("payload_lookup_by_slug", "JOIN-12", f"""
SELECT language_code, slug, display_title FROM ({PAYLOAD_SQL}) p
WHERE language_code = 'zh' AND slug IN (SELECT 'order-' || l_orderkey FROM lineitem
                                        WHERE l_returnflag = 'N')""")
def _(t):
    wanted = t.lineitem.filter("l_returnflag = 'N'").select(
        F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("slug"),
        F.lit("zh").alias("language_code"))
    return B.find_payloads(payloads(t), wanted, ["language_code", "slug"]).select(
        "language_code", "slug", "display_title")


@query("canonical_payload_lookup", "JOIN-12", """
SELECT a.source_item_id, tr.language_code, tr.display_title, d.downstream_action
FROM b_approved a JOIN b_decision d ON d.source_item_id = a.source_item_id
JOIN b_translation tr ON tr.parent_content_id = a.parent_content_id
 AND tr.source_fingerprint = a.content_fingerprint
WHERE tr.language_code = 'ja' AND a.source_item_id IN (SELECT l_orderkey FROM lineitem
                                                       WHERE l_returnflag = 'N')""")
def _(t):
    wanted = t.lineitem.filter("l_returnflag = 'N'").select(
        F.col("l_orderkey").alias("source_item_id"), F.lit("ja").alias("language_code"))
    rows = B.canonical_payloads(t.b_approved, t.b_decision, t.b_translation, t.b_item)
    return B.find_payloads(rows, wanted, ["source_item_id", "language_code"]).select(
        "source_item_id", "language_code", "display_title", "downstream_action")


NOTE_SQL = """CASE WHEN json_extract_string(author_metadata, '$.writer_type') IN ('human', 'hybrid')
  THEN 'This item is AI-assisted and human-curated.' ELSE 'This item is AI-generated.' END"""


def q(c: str) -> str:
    return f"coalesce(CAST(to_json({c}) AS VARCHAR), 'null')"


def entry_sql(extra: str = "") -> str:
    return (f"""'{{"slug":' || {q('slug')} || ',"display_title":' || {q('display_title')}
 || ',"summary_short":' || {q('summary_short')} || ',"canonical_url":' || {q('canonical_url')}
 || ',"source_published_at":' || {q(iso_sql('source_published_at'))} || ',"approved_at":'
 || {q(iso_sql('approved_at'))} || ',"published_at":' || {q(iso_sql('published_at'))} || '}}'""")


DOC_SQL = f"""
SELECT language_code, slug, '{{"source_item_id":' || source_item_id || ',"language_code":'
 || {q('language_code')} || ',"slug":' || {q('slug')} || ',"display_title":' || {q('display_title')}
 || ',"summary_short":' || {q('summary_short')} || ',"bullets":'
 || CASE WHEN downstream_action = 'publish_summary' THEN '{{"key_claim":' || {q('bullet_1')}
    || ',"evidence_level":' || {q('bullet_2')} || ',"objective_impact":' || {q('bullet_3')} || '}}'
    ELSE 'null' END || ',"canonical_url":' || {q('canonical_url')} || ',"source_published_at":'
 || {q(iso_sql('source_published_at'))} || ',"approved_at":' || {q(iso_sql('approved_at'))}
 || ',"published_at":' || {q(iso_sql('published_at'))} || ',"downstream_action":'
 || {q('downstream_action')} || ',"disclosure_note":' || {q(NOTE_SQL)} || ',"author_metadata":'
 || author_metadata || '}}' AS document FROM ({PAYLOAD_SQL}) p"""


@query("item_documents", "PRJ-2 PRJ-3 FN-33", DOC_SQL)
def _(t):
    return B.item_documents(payloads(t)).select("language_code", "slug", "document")


CATALOGUE_SQL = f"""
SELECT language_code, slug, display_title, summary_short, canonical_url, source_published_at,
       approved_at, published_at, strftime(source_published_at, '%Y-%m') AS archive_month
FROM ({PAYLOAD_SQL}) p"""


def catalogue(t):
    return B.catalogue_rows(payloads(t))


@query("catalogue_entries", "PRJ-1 FN-23", f"""
SELECT language_code, slug, canonical_url, archive_month,
       'archive_' || replace(archive_month, '-', '_') || '.json' AS file_name
FROM ({CATALOGUE_SQL}) c""")
def _(t):
    return catalogue(t).select("language_code", "slug", "canonical_url", "archive_month",
                               M.archive_file(F.col("archive_month")).alias("file_name"))


INDEX_SQL = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY language_code
    ORDER BY source_published_at DESC NULLS LAST, slug) AS position FROM ({CATALOGUE_SQL}) c) r
WHERE position <= 1000"""


@query("latest_index", "SORT-1", f"""
SELECT language_code, position, slug, {iso_sql('source_published_at')} AS source_published_at
FROM ({INDEX_SQL}) i""")
def _(t):
    return text_times(B.latest_index(catalogue(t)).select("language_code", "position", "slug",
                                                          "source_published_at"))


@query("home_page", "SORT-4", f"""
SELECT language_code, position, slug FROM ({INDEX_SQL}) i WHERE position <= 300""")
def _(t):
    return B.home_page(B.latest_index(catalogue(t))).select("language_code", "position", "slug")


@query("archive_order", "SORT-2", f"""
SELECT language_code, archive_month, slug FROM ({CATALOGUE_SQL}) c WHERE archive_month IS NOT NULL""")
def _(t):
    return B.archive_sorted(catalogue(t)).select("language_code", "archive_month", "slug")


COUNTS_SQL = f"""
SELECT a.language_code, strftime(i.published_at, '%Y-%m') AS archive_month, count(*) AS item_count
FROM ({ACTIVE_ROWS_SQL}) a JOIN b_item i ON i.source_item_id = a.source_item_id GROUP BY ALL"""


def counts(t):
    return B.month_counts(t.b_publish, t.b_publish_status, t.b_item)


@query("archive_month_counts", "AGG-37", COUNTS_SQL)
def _(t):
    return counts(t)


@query("active_archive_months", "AGG-36", f"""
SELECT language_code, archive_month FROM ({COUNTS_SQL}) c WHERE archive_month IS NOT NULL""")
def _(t):
    return B.active_months(counts(t))


STATS_SQL = f"""
SELECT l.language_code, count(*) FILTER (s.publish_status = 'published') AS published,
       count(*) FILTER (s.publish_status = 'withdrawn') AS withdrawn,
       least(count(*) FILTER (s.publish_status = 'published'), 1000) AS latest_index_count,
       (SELECT count(archive_month) FROM ({COUNTS_SQL}) c WHERE c.language_code = l.language_code)
       AS archive_month_count,
       (SELECT min(archive_month) FROM ({COUNTS_SQL}) c WHERE c.language_code = l.language_code)
       AS oldest_archive_month
FROM b_lang l LEFT JOIN b_publish_status s ON s.language_code = l.language_code
GROUP BY l.language_code"""


@query("export_stats", "AGG-38 AGG-39 AGG-40", STATS_SQL)
def _(t):
    return B.export_stats(t.b_publish, t.b_publish_status, t.b_item, t.b_lang)


# --- digests and snapshots --------------------------------------------------------------------------------------

def set_digest_sql(digest: str) -> str:
    lanes = " || '|' || ".join(
        f"CAST(coalesce(sum(CAST('0x' || substr({digest}, {1 + 15 * i}, 15) AS BIGINT)), 0) AS VARCHAR)"
        for i in range(4))
    return f"sha256(CAST(count(*) AS VARCHAR) || '|' || {lanes})"


ARCHIVE_DIGEST_SQL = f"""
SELECT language_code, archive_month, {set_digest_sql('d')} AS digest, count(*) AS item_count
FROM (SELECT language_code, archive_month, sha256({entry_sql()}) AS d FROM ({CATALOGUE_SQL}) c
      WHERE archive_month IS NOT NULL) e GROUP BY ALL"""


@query("archive_digests", "AGG-41", ARCHIVE_DIGEST_SQL)
def _(t):
    return B.archive_digests(catalogue(t))


PRIOR_SQL = f"""
SELECT language_code, archive_month, CASE WHEN substr(archive_month, 6, 2) = '03' THEN 'old'
       ELSE digest END AS digest FROM ({ARCHIVE_DIGEST_SQL}) d WHERE substr(archive_month, 6, 2) <> '07'"""
STAMP_SQL = f"""
SELECT d.language_code, d.archive_month, 'archive_' || replace(d.archive_month, '-', '_') || '.json'
         AS file_name, d.item_count, d.digest,
       CASE WHEN m.updated_at IS NOT NULL AND p.digest = d.digest THEN m.updated_at
            ELSE TIMESTAMP '2002-01-01' END AS updated_at
FROM ({ARCHIVE_DIGEST_SQL}) d LEFT JOIN b_archive_meta m
  ON m.language_code = d.language_code AND m.archive_month = d.archive_month
LEFT JOIN ({PRIOR_SQL}) p ON p.language_code = d.language_code AND p.archive_month = d.archive_month"""


def stamps(t, entries: DataFrame | None = None):
    # One row per month and language, read as the new digests and as the prior ones.
    digests = cut_lineage(B.archive_digests(catalogue(t) if entries is None else entries))
    month = F.substring("archive_month", 6, 2)
    prior = digests.filter(month != "07").withColumn(
        "digest", F.when(month == "03", "old").otherwise(F.col("digest")))
    return B.archive_stamps(digests, t.b_archive_meta, prior, RUN_TS)


@query("archive_stamps", "STA-12", f"""
SELECT language_code, archive_month, file_name, item_count, {iso_sql('updated_at')} AS updated_at
FROM ({STAMP_SQL}) s""")
def _(t):
    return text_times(stamps(t).drop("digest"))


@query("synced_archive_metadata", "STA-12", f"""
SELECT language_code, archive_month, {iso_sql('updated_at')} AS updated_at FROM ({STAMP_SQL}) s""")
def _(t):
    stored = BucketedTable(t.spark, folder(t), t.b_archive_meta.schema, ["language_code", "archive_month"])
    stored.create(t.b_archive_meta)
    stored.merge(B.metadata_changes(t.b_archive_meta, stamps(t)), replaced(stored.keys))
    return text_times(stored.read())


@query("shrunk_language_metadata", "SET-5", """
SELECT language_code, archive_month FROM b_archive_meta WHERE language_code = 'fr'""")
def _(t):
    return B.shrunk_metadata(t.b_archive_meta, t.b_lang).select("language_code", "archive_month")


@query("retired_archive_months", "SET-6", f"""
SELECT m.language_code, m.archive_month FROM b_archive_meta m
WHERE m.language_code IN ('en', 'zh', 'ja') AND NOT EXISTS (SELECT 1 FROM ({COUNTS_SQL}) c
  WHERE c.language_code = m.language_code AND c.archive_month = m.archive_month)""")
def _(t):
    return B.retired_months(t.b_archive_meta, B.active_months(counts(t)), t.b_lang).select(
        "language_code", "archive_month")


def digests(t):
    stats = B.stats_document(B.export_stats(t.b_publish, t.b_publish_status, t.b_item, t.b_lang),
                             RUN_TS)
    # Four artifacts start from the payloads and most readers read the digests several times (a sort by
    # range reads its input twice), so both are stored once.
    rows = cut_lineage(payloads(t))
    entries = B.catalogue_rows(rows)
    return cut_lineage(B.artifact_digests(B.item_documents(rows), B.latest_index(entries),
                                          stamps(t, entries), stats))


def map_sql(column: str) -> str:
    return (f"'{{' || string_agg('\"' || language_code || '\":' || coalesce(CAST({column} AS VARCHAR),"
            f" 'null'), ',' ORDER BY language_code) || '}}'")


def text_map_sql(column: str) -> str:
    return (f"'{{' || string_agg('\"' || language_code || '\":' || {q(column)}, ',' "
            f"ORDER BY language_code) || '}}'")


DIGEST_SQL = f"""
SELECT language_code || '/items/' || slug || '.json' AS path, sha256(document) AS digest
FROM ({DOC_SQL}) d
UNION ALL SELECT language_code || '/index.json', {set_digest_sql('d')} FROM (
  SELECT language_code, sha256(position || '|' || {entry_sql()}) AS d FROM ({INDEX_SQL}) i) x
  GROUP BY language_code
UNION ALL SELECT language_code || '/archives/' || file_name, digest FROM ({STAMP_SQL}) s
UNION ALL SELECT language_code || '/archives/index.json', {set_digest_sql('d')} FROM (
  SELECT language_code, sha256('{{"archive_month":"' || archive_month || '","file_name":"' || file_name
         || '","item_count":' || item_count || ',"updated_at":"' || {iso_sql('updated_at')} || '"}}') AS d
  FROM ({STAMP_SQL}) s) x GROUP BY language_code
UNION ALL SELECT 'stats.json', sha256('{{"total_active_published_items_by_language":' || {map_sql('published')}
  || ',"total_withdrawn_items_by_language":' || {map_sql('withdrawn')}
  || ',"latest_index_count_by_language":' || {map_sql('latest_index_count')}
  || ',"archive_month_count_by_language":' || {map_sql('archive_month_count')}
  || ',"oldest_archive_month_by_language":' || {text_map_sql('oldest_archive_month')} || '}}')
  FROM ({STATS_SQL}) s"""


@query("artifact_digests", "AGG-41 SNK-8",
       f"SELECT path, 'sha256:' || digest AS digest FROM ({DIGEST_SQL}) d")
def _(t):
    return digests(t).select("path", "digest")


@query("export_state_fingerprint", "AGG-42", f"""
SELECT 'setdigest-v1:' || sha256('setdigest-v1|strict_match|1000|month|en,zh,ja|' || {set_digest_sql('d')})
       AS content_fingerprint
FROM (SELECT sha256(path || '|' || 'sha256:' || digest) AS d FROM ({DIGEST_SQL}) x) y""")
def _(t):
    return B.state_fingerprint(digests(t), LANGS)


@query("snapshot_diff", "SET-8", f"""
SELECT path, CASE WHEN path LIKE 'zh/%' THEN 'added' WHEN path LIKE '%/archive_1997%' THEN 'changed'
       ELSE 'unchanged' END AS change FROM ({DIGEST_SQL}) d
UNION ALL SELECT 'fr/' || slug, 'removed' FROM ({ACTIVE_ROWS_SQL}) a WHERE language_code = 'en'""")
def _(t):
    new = digests(t).select("path", "digest")
    gone = B.active_rows(t.b_publish, t.b_publish_status).filter("language_code = 'en'").select(
        F.concat(F.lit("fr/"), F.col("slug")).alias("path"), F.lit("x").alias("digest"))
    old = new.filter(~F.col("path").startswith("zh/")).withColumn("digest", F.when(
        F.col("path").contains("/archive_1997"), "other").otherwise(F.col("digest")))
    return B.snapshot_diff(old.unionByName(gone), new)


@query("snapshots_to_retire", "WIN-7", """
SELECT generation_id FROM (SELECT generation_id, row_number() OVER (ORDER BY base DESC, n DESC) AS r
  FROM (SELECT DISTINCT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H-%M-%SZ') AS base,
               event_id % 12 AS n, CASE WHEN event_id % 12 = 0 THEN '' ELSE '-r' || (event_id % 12) END
               AS suffix, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H-%M-%SZ')
               || CASE WHEN event_id % 12 = 0 THEN '' ELSE '-r' || (event_id % 12) END AS generation_id
        FROM events) g) x WHERE r > 5""")
def _(t):
    k = F.col("event_id") % 12
    ids = t.events.select(F.concat(
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH-mm-ss'Z'"),
        F.when(k == 0, "").otherwise(F.concat(F.lit("-r"), k.cast("string"))))
        .alias("generation_id")).distinct()
    return B.snapshots_to_retire(ids, None)


# --- sinks and readers -------------------------------------------------------------------------------------------

def folder(t) -> str:
    return f"{ensure_checkpoint_dir(t.spark)}/exports/{uuid.uuid4().hex}"


@query("written_items", "SNK-1", f"SELECT language_code, md5(document) AS document_md5 FROM ({DOC_SQL}) d")
def _(t):
    path = folder(t)
    E.write_items(B.item_documents(payloads(t)), path)
    return t.spark.read.schema("value string, language_code string").text(path).select(
        "language_code", F.md5("value").alias("document_md5"))


@query("written_index", "SNK-2 SRC-6", f"""
SELECT language_code, position, slug, {iso_sql('source_published_at')} AS source_published_at
FROM ({INDEX_SQL}) i""")
def _(t):
    # Undated entries break the reader's contract: they come back beside the valid ones, not at all mixed up.
    path = folder(t)
    E.write_index(B.latest_index(catalogue(t)), path)
    valid, invalid = E.split_index(t.spark, path)
    return valid.unionByName(invalid).select("language_code", "position", "slug", "source_published_at")


@query("whole_written_index", "SNK-2 SRC-6", f"""
SELECT language_code, position, slug, {iso_sql('source_published_at')} AS source_published_at,
  source_published_at IS NOT NULL AS is_valid
FROM ({INDEX_SQL}) i""")
def _(t):
    path = folder(t)
    E.write_index(B.latest_index(catalogue(t)), path)
    valid, invalid = E.split_index(t.spark, path)
    return valid.unionByName(invalid).select("language_code", "position", "slug", "source_published_at",
                                             "is_valid")


@query("written_archives", "SNK-3 SRC-6", f"""
SELECT language_code, archive_month, slug, {iso_sql('published_at')} AS published_at
FROM ({CATALOGUE_SQL}) c WHERE archive_month IS NOT NULL""")
def _(t):
    path = folder(t)
    E.write_archives(catalogue(t), path)
    return E.read_archives(t.spark, path).select("language_code", "archive_month", "slug",
                                                 "published_at")


@query("written_manifest", "SNK-4 SRC-6", f"""
SELECT language_code, archive_month, file_name, item_count, {iso_sql('updated_at')} AS updated_at
FROM ({STAMP_SQL}) s""")
def _(t):
    path = folder(t)
    E.write_manifest(stamps(t), path)
    return E.read_manifest(t.spark, path)


@query("written_stats", "SNK-5 SRC-6", f"""
SELECT language_code, published, oldest_archive_month, '{RUN}' AS run_timestamp FROM ({STATS_SQL}) s""")
def _(t):
    path = folder(t)
    E.write_stats(B.stats_document(B.export_stats(t.b_publish, t.b_publish_status, t.b_item,
                                                  t.b_lang), RUN_TS), path)
    rows = E.read_stats(t.spark, path, LANGS)
    return rows.select(F.explode("total_active_published_items_by_language")
                       .alias("language_code", "published"),
                       "oldest_archive_month_by_language", "last_export_run_timestamp").select(
        "language_code", "published", F.try_element_at("oldest_archive_month_by_language",
                                                       F.col("language_code"))
        .alias("oldest_archive_month"), F.col("last_export_run_timestamp").alias("run_timestamp"))


LABEL_SQL = ("(SELECT 'en' AS language_code, 'Key Claim' AS l1, 'Evidence Level' AS l2, "
             "'Objective Impact' AS l3 UNION ALL SELECT 'zh', '關鍵主張', '證據等級', '客觀影響' "
             "UNION ALL SELECT 'ja', '主要主張', '証拠レベル', '客観的影響')")
POST_SQL = f"""
SELECT p.language_code, slug, concat_ws(chr(10), '---', 'title: ' || {q('display_title')},
  'publishDate: ' || {q(iso_sql('source_published_at'))}, 'description: ' || {q('summary_short')},
  'canonicalUrl: ' || {q('canonical_url')}, 'disclosureNote: ' || {q(NOTE_SQL)},
  'authorMetadata: ' || author_metadata, '---', '', summary_short || CASE WHEN downstream_action
  = 'publish_summary' THEN chr(10) || chr(10) || concat_ws(chr(10), '* **' || l1 || '**: ' || bullet_1,
  '* **' || l2 || '**: ' || bullet_2, '* **' || l3 || '**: ' || bullet_3) ELSE '' END) AS post
FROM ({PAYLOAD_SQL}) p JOIN {LABEL_SQL} l ON l.language_code = p.language_code"""


@query("post_documents", "SNK-6", POST_SQL)
def _(t):
    path = folder(t)
    E.write_posts(B.post_documents(payloads(t), B.post_labels(t.spark)), path)
    return t.spark.read.schema("slug string, post string, language_code string").json(path)


@query("translation_map", "SNK-7", f"""
SELECT slug, string_agg(language_code, ',' ORDER BY language_code) AS languages
FROM ({PAYLOAD_SQL}) p GROUP BY slug""")
def _(t):
    path = folder(t)
    E.write_translation_map(payloads(t).select("language_code", "slug"), path)
    return joined(t.spark.read.schema("slug string, languages array<string>").json(path),
                  "languages")


@query("post_routes", "PRJ-4", f"SELECT language_code AS lang, slug FROM ({PAYLOAD_SQL}) p")
def _(t):
    return B.post_routes(B.translation_map(payloads(t)))


@query("month_pages", "PRJ-5", f"""
SELECT language_code AS lang, archive_month AS month, file_name FROM ({STAMP_SQL}) s""")
def _(t):
    return B.month_pages(stamps(t))


@query("digest_manifest", "SNK-8 SRC-7",
       f"SELECT path, 'sha256:' || digest AS digest FROM ({DIGEST_SQL}) d")
def _(t):
    path = folder(t)
    E.write_digests(digests(t), path)
    return E.read_digests(t.spark, path).select("path", "digest")


@query("digest_manifest_problems", "SRC-7", f"""
SELECT 'invalid record' AS problem, '../' || slug AS path FROM ({ACTIVE_ROWS_SQL}) a
WHERE language_code = 'en' UNION ALL SELECT 'repeated path', path FROM ({DIGEST_SQL}) d
WHERE path LIKE 'zh/%' UNION ALL SELECT 'cut short', 'zz'""")
def _(t):
    rows = digests(t)
    bad = B.active_rows(t.b_publish, t.b_publish_status).filter("language_code = 'en'").select(
        F.concat(F.lit("../"), F.col("slug")).alias("path"), F.lit("x").alias("digest"),
        F.lit("0").alias("ordinal"))
    last = rows.filter("path = 'stats.json'").select(
        F.lit("zz").alias("path"), "digest", F.lit("9").alias("ordinal"))
    twice = rows.filter(F.col("path").startswith("zh/"))
    return E.digest_problems(rows.unionByName(twice).unionByName(bad).unionByName(last))


def kept_status(text: str) -> str:
    """A query over the state after every 97th record has lost its status rows."""
    return text.replace("JOIN b_publish_status s", "JOIN (SELECT * FROM b_publish_status WHERE publish_record_id % 97 <> 0) s")


def snapshot_sql(run: int, changed: int, docs: str, rows: str, rewritten: str) -> str:
    return f"""
SELECT {run} AS run, {changed} AS changed, 'items' AS kind, language_code, slug AS name,
       md5(document) AS content, CAST(NULL AS INTEGER) AS rewritten FROM ({docs}) d
UNION ALL SELECT {run}, {changed}, 'archives', language_code, archive_month,
       {set_digest_sql('d')}, {rewritten}
FROM (SELECT language_code, archive_month, sha256({entry_sql()}) AS d FROM ({rows}) c
      WHERE archive_month IS NOT NULL) e GROUP BY language_code, archive_month"""


@query("snapshot_publish", "SNK-9 SET-8", " UNION ALL ".join([
    snapshot_sql(1, 1, DOC_SQL, CATALOGUE_SQL, "1"), snapshot_sql(2, 0, DOC_SQL, CATALOGUE_SQL, "0"),
    snapshot_sql(3, 1, kept_status(DOC_SQL), kept_status(CATALOGUE_SQL), f"""max(CASE WHEN (language_code, archive_month) IN (
      SELECT (language_code, archive_month) FROM ({CATALOGUE_SQL}) w WHERE (language_code, slug) NOT IN (
        SELECT (language_code, slug) FROM ({kept_status(CATALOGUE_SQL)}) k)) THEN 1 ELSE 0 END)""")]))
def _(t):
    # Everything, the same again, and then without some status rows: the live snapshot is read after each run.
    path = folder(t)
    # Every run reads the outputs and, derived from them, the status rows several times.
    t.keep("b_translation", f"{folder(t)}/translation")
    whole = {"approved": t.b_approved, "decision": t.b_decision, "translation": t.b_translation,
             "item": t.b_item, "publish": t.b_publish, "publish_status": t.b_publish_status}
    less = {**whole, "publish_status": t.b_publish_status.filter("publish_record_id % 97 <> 0")}
    prior = B.archive_digests(catalogue(t)).filter("false")
    out = []
    for run, tables in ((1, whole), (2, whole), (3, less)):
        plan = PP.export_plan(tables, t.b_lang, t.b_archive_meta, prior, RUN_TS)
        live = E.publish_snapshot(t.spark, path, plan, f"2002-01-0{run}T00:00:00Z", LANGS)
        home = live["generation"] if live["changed"] else ""
        items = E.read_lines(t.spark, path, live, "items").select(
            "language_code", F.get_json_object("line", "$.slug").alias("name"), F.md5("line").alias("content"),
            F.lit(None).cast("int").alias("rewritten"), F.lit("items").alias("kind"))
        entries = E.read_lines(t.spark, path, live, "archives").select(
            "language_code", F.col("part").alias("archive_month"), F.from_json("line", E.CATALOGUE_SCHEMA).alias("e")).select(
            "language_code", "archive_month", "e.*")
        parts = E.read_parts(t.spark, path, live).filter("kind = 'archives'").select(
            "language_code", F.col("part").alias("archive_month"), (F.col("home") == home).cast("int").alias("rewritten"))
        stamps = ["source_published_at", "approved_at", "published_at"]
        months = B.archive_digests(entries.withColumns({c: F.col(c).cast("timestamp") for c in stamps})).join(
            parts, ["language_code", "archive_month"]).select(
            "language_code", F.col("archive_month").alias("name"), F.col("digest").alias("content"), "rewritten",
            F.lit("archives").alias("kind"))
        out.append(items.unionByName(months).select(
            F.lit(run).alias("run"), F.lit(int(live["changed"])).alias("changed"), "kind", "language_code", "name",
            "content", "rewritten"))
    return out[0].unionByName(out[1]).unionByName(out[2])


REJECTED_SQL = f"""
SELECT x.source_item_id FROM ({PUBLISH_SQL}) x
JOIN b_decision d ON d.source_item_id = x.source_item_id
JOIN b_translation tr ON tr.source_item_id = x.source_item_id AND tr.language_code = x.language_code
WHERE d.downstream_action = 'publish_summary' AND tr.bullet_2 IS NULL"""
ACCEPTED_SQL = f"SELECT * FROM ({PUBLISH_SQL}) w WHERE source_item_id NOT IN ({REJECTED_SQL})"


@query("publish_run", "STA-10 STA-11 SET-3 SET-4", f"""
WITH accepted AS ({ACCEPTED_SQL}),
fresh AS (SELECT source_item_id, CASE WHEN n = 1 THEN base ELSE base || '-' || n END AS slug
          FROM (SELECT source_item_id, base, row_number() OVER (PARTITION BY base ORDER BY source_item_id) AS n
                FROM (SELECT source_item_id, {SLUGIFY.format('title')} AS base
                      FROM ({SLUG_TITLE_SQL.replace(f"({PUBLISH_SQL}) q", "accepted")}) s) b) r),
changes AS (SELECT source_item_id, language_code, 'published' AS new_status FROM accepted
            UNION ALL SELECT source_item_id, language_code, 'withdrawn' FROM ({ACTIVE_ROWS_SQL}) a
            WHERE source_item_id NOT IN ({ELIGIBLE_SQL})),
rows AS (SELECT coalesce(c.source_item_id, o.source_item_id) AS source_item_id,
                coalesce(c.language_code, o.language_code) AS language_code,
                coalesce(c.new_status, o.publish_status) AS publish_status
         FROM changes c FULL JOIN (
           SELECT p.source_item_id, s.language_code, s.publish_status FROM b_publish p
           JOIN b_publish_status s ON s.publish_record_id = p.publish_record_id) o
           ON o.source_item_id = c.source_item_id AND o.language_code = c.language_code)
SELECT r.source_item_id, r.language_code, r.publish_status, coalesce(p.slug, f.slug) AS slug
FROM rows r LEFT JOIN b_publish p ON p.source_item_id = r.source_item_id
LEFT JOIN fresh f ON f.source_item_id = r.source_item_id""")
def _(t):
    tables = {"approved": t.b_approved, "decision": t.b_decision, "translation": t.b_translation,
              "item": t.b_item, "publish": t.b_publish, "publish_status": t.b_publish_status}
    out = PP.reconcile(tables, LANGS, RUN_TS)
    records = out["publish_record"].select("publish_record_id", "source_item_id", "slug")
    return out["publish_language_status"].join(records, "publish_record_id").select(
        "source_item_id", "language_code", "publish_status", "slug")


# --- audits -----------------------------------------------------------------------------------------------------------

@query("payload_audit", "VAL-5", f"""
SELECT source_item_id, language_code, CASE WHEN downstream_action = 'publish_summary'
  AND bullet_2 IS NULL THEN 'bullets.evidence_level is blank' END AS reason FROM ({PAYLOAD_SQL}) p""")
def _(t):
    return A.payload_audit(payloads(t)).select("source_item_id", "language_code", "reason")


def as_text(t):
    return text_times(catalogue(t))


@query("catalogue_audit", "VAL-6", f"""
SELECT language_code, slug, CASE WHEN source_published_at IS NULL THEN 'source_published_at' END
       AS reason FROM ({CATALOGUE_SQL}) c""")
def _(t):
    return A.catalogue_audit(as_text(t)).select("language_code", "slug", "reason")


@query("archive_manifest_audit", "VAL-7", f"""
SELECT language_code, archive_month, CASE substr(archive_month, 6, 2) WHEN '01' THEN 'file_name'
  WHEN '02' THEN 'item_count' WHEN '03' THEN 'updated_at' END AS reason FROM ({STAMP_SQL}) s""")
def _(t):
    m = F.substring("archive_month", 6, 2)
    rows = text_times(stamps(t)).withColumn(
        "file_name", F.when(m == "01", F.concat(F.lit("../"), F.col("file_name")))
        .otherwise(F.col("file_name"))).withColumn(
        "item_count", F.when(m != "02", F.col("item_count")).otherwise(-F.col("item_count"))
    ).withColumn("updated_at", F.when(m == "03", "soon").otherwise(F.col("updated_at")))
    return A.archive_entries_audit(rows).select("language_code", "archive_month", "reason")


@query("stats_audit", "VAL-8", """
SELECT DISTINCT lang AS locale, CASE WHEN lang NOT IN (SELECT language_code FROM b_lang)
       THEN 'total_active_published_items_by_language.' || lang END AS reason
FROM (SELECT lang FROM documents WHERE lang IS NOT NULL UNION SELECT language_code FROM b_lang) l
UNION ALL SELECT 'broken', 'latest_index_count_by_language.' || min(language_code) FROM b_publish_status
UNION ALL SELECT 'undated', 'oldest_archive_month_by_language.' || max(language_code) FROM b_publish_status""")
def _(t):
    doc = B.stats_document(B.export_stats(t.b_publish, t.b_publish_status, t.b_item, t.b_lang), RUN_TS)
    # The locales of the desk and of all documents: a handful of names.
    locales = sorted({r[0] for r in t.documents.filter("lang IS NOT NULL").select("lang").union(
        t.b_lang.select("language_code")).distinct().collect()})
    ends = t.b_publish_status.agg(F.min("language_code"), F.max("language_code")).first()
    count, oldest = "latest_index_count_by_language", "oldest_archive_month_by_language"
    negative = doc.withColumn(count, F.transform_values(count, lambda k, v: F.when(k == ends[0], F.lit(-1)).otherwise(v)))
    odd = doc.withColumn(oldest, F.transform_values(oldest, lambda k, v: F.when(k == ends[1], F.lit("1995")).otherwise(v)))
    cases = [(name, doc, [name]) for name in locales] + [("broken", negative, LANGS), ("undated", odd, LANGS)]
    return reduce(DataFrame.unionByName, [A.stats_audit(rows, wanted).select(F.lit(name).alias("locale"), "reason")
                                          for name, rows, wanted in cases])


@query("table_check_violations", "VAL-9", """
SELECT 'curation_decision' AS table_name, 'check curate_status' AS rule,
       CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'curation_decision', 'check retry_count', 0
UNION ALL SELECT 'curation_decision', 'check status_action', count(*) FILTER (
  NOT CASE curate_status WHEN 'failed' THEN downstream_action IS NULL
      WHEN 'rejected' THEN coalesce(downstream_action, '') IN ('edit_rewrite', 'reject_discard')
      ELSE coalesce(downstream_action, '') IN ('publish_link', 'publish_summary') END) FROM b_decision
UNION ALL SELECT 'source_item_text', 'check text_processing_status', 0
UNION ALL SELECT 'source_item_text', 'check text_processing_reason', 0""")
def _(t):
    return A.check_violations(t.b_decision, "curation_decision").unionByName(
        A.check_violations(t.b_text, "source_item_text"))


@query("table_key_violations", "VAL-9", """
SELECT 'source_item' AS table_name, 'unique source_item_id' AS rule, count(*) AS violations
FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) q
UNION ALL SELECT 'source_item', 'unique ingest_dedup_key', count(*)
FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) q
UNION ALL SELECT 'translation_output', 'unique parent_content_id,language_code', count(*)
FROM (SELECT 1 FROM b_translation GROUP BY parent_content_id, language_code HAVING count(*) > 1) q""")
def _(t):
    return A.key_violations(t.b_item, "source_item").unionByName(
        A.key_violations(t.b_translation, "translation_output"))


@query("table_parent_violations", "VAL-9", """
SELECT 'curation_decision' AS table_name, 'parent source_item' AS rule, count(*) AS violations
FROM b_decision d WHERE NOT EXISTS (SELECT 1 FROM b_item i WHERE i.source_item_id = d.source_item_id
                                    AND i.source_id <= 90)
UNION ALL SELECT 'publish_language_status', 'parent publish_record', count(*) FROM b_publish_status s
WHERE NOT EXISTS (SELECT 1 FROM b_publish p WHERE p.publish_record_id = s.publish_record_id)
UNION ALL SELECT 'publish_record', 'parent source_item', count(*) FROM b_publish d
WHERE NOT EXISTS (SELECT 1 FROM b_item i WHERE i.source_item_id = d.source_item_id
                  AND i.source_id <= 90)""")
def _(t):
    return A.parent_violations({
        "source_item": t.b_item.filter("source_id <= 90"), "curation_decision": t.b_decision,
        "publish_record": t.b_publish, "publish_language_status": t.b_publish_status})


@query("post_audit", "VAL-12", f"""
SELECT language_code, slug, CASE WHEN source_published_at IS NULL THEN 'source_published_at'
  WHEN bullet_1 IS NOT NULL AND bullet_2 IS NULL THEN 'bullets are incomplete'
  WHEN language_code <> 'en' THEN 'locale mismatch' END AS reason FROM ({PAYLOAD_SQL}) p""")
def _(t):
    rows = text_times(payloads(t)).withColumn("wanted", F.lit("en"))
    return A.post_audit(rows, expected="wanted").select("language_code", "slug", "reason")


@query("label_table_audit", "VAL-13", """
SELECT lang AS locale, CASE lang WHEN 'de' THEN 'label keys' WHEN 'es' THEN 'blank label' END AS reason
FROM (SELECT DISTINCT lang FROM documents) q""")
def _(t):
    langs = t.documents.select(F.col("lang").alias("locale")).distinct()
    labels = langs.withColumn("key", F.explode(F.array(*map(F.lit, [
        "key_claim", "evidence_level", "objective_impact"])))).withColumn(
        "label", F.when((F.col("locale") == "es") & (F.col("key") == "key_claim"), " ")
        .otherwise(F.col("key"))).filter("NOT (locale = 'de' AND key = 'key_claim')")
    return A.label_table_audit(labels).select("locale", "reason")


@query("absent_locales", "VAL-14", """
SELECT language_code FROM b_lang WHERE language_code NOT IN
  (SELECT language_code FROM b_publish_status WHERE language_code <> 'ja')""")
def _(t):
    return A.absent_locales(t.b_lang, t.b_publish_status.filter("language_code <> 'ja'"))


def labelled_documents(t):
    prefix = F.when(F.col("doc_id") % 50 == 0, "- **關鍵主張**：").when(
        F.col("doc_id") % 50 == 1, "Key Claim : ").when(
        F.col("doc_id") % 50 == 2, "Our Key Claim: ").otherwise("")
    return t.documents.select("doc_id", "lang", F.concat(prefix, F.col("text")).alias("body"),
                              "source")


@query("label_prefixes", "FN-19", """
SELECT doc_id, CASE WHEN doc_id % 50 < 2 THEN 1 ELSE 0 END AS has_label FROM documents""")
def _(t):
    return labelled_documents(t).select("doc_id", K.has_label_prefix(F.col("body")).cast("int")
                                        .alias("has_label"))


@query("guarded_labels", "FN-20", """
SELECT doc_id, CASE WHEN doc_id % 50 < 2 THEN 1 ELSE 0 END AS has_label FROM documents""")
def _(t):
    return labelled_documents(t).select("doc_id", K.has_guarded_label(F.col("body")).cast("int")
                                        .alias("has_label"))


@query("label_leaks", "VAL-15", """
SELECT lang, 'body' AS field, count(*) AS scanned, count(*) FILTER (doc_id % 50 < 2) AS leaks
FROM documents GROUP BY lang UNION ALL SELECT lang, 'source', count(*), 0 FROM documents GROUP BY lang""")
def _(t):
    return A.label_leaks(labelled_documents(t), ["lang"], ["body", "source"])


@query("structure_audit", "VAL-16", f"""
SELECT 'fingerprint format' AS "check", count(*) AS rows, CAST(0 AS BIGINT) AS violations FROM b_approved
UNION ALL SELECT 'none or three bullets', count(*), count(*) FILTER (
  (d.downstream_action = 'publish_summary') <> (a.bullet_1 IS NOT NULL)) FROM b_approved a
  JOIN b_decision d ON d.source_item_id = a.source_item_id
UNION ALL SELECT 'no partial bullets', count(*), count(*) FILTER (bullet_1 IS NOT NULL
  AND bullet_2 IS NULL) FROM b_translation
UNION ALL SELECT 'same bullets as the master', count(*), count(*) FILTER (bullet_1 IS NOT NULL
  AND bullet_2 IS NULL) FROM b_translation WHERE translation_status = 'completed'
UNION ALL SELECT 'export equals table', count(*), 0 FROM ({PAYLOAD_SQL}) p""")
def _(t):
    return A.structure_audit(t.b_approved, t.b_decision, t.b_translation, payloads(t), 32)


def schedules(t):
    return X.schedule_dim(t.spark)


@query("source_config_audit", "VAL-17", """
SELECT source_id, unnest(list_filter([CASE WHEN category_id = 0 THEN 'disabled category' END,
   CASE WHEN category_id = 5 THEN 'unknown category' END,
   CASE WHEN sanitization_profile = 'missing_profile' THEN 'unknown profile' END,
   CASE WHEN html_url IS NULL THEN 'missing html_url' END], lambda x: x IS NOT NULL)) AS message
FROM b_source""")
def _(t):
    categories = t.nation.select((F.col("n_nationkey") % 6).cast("int").alias("category_id")) \
        .distinct().filter("category_id < 5").withColumn("enabled", F.col("category_id") != 0)
    profiles = t.b_source.select("sanitization_profile").distinct().filter(
        "sanitization_profile = 'default_html_article'")
    return A.source_config_audit(t.b_source, categories, schedules(t), profiles).select(
        "source_id", "message")


@query("shared_feed_urls", "AGG-51", """
SELECT xml_url, string_agg(CAST(source_id AS VARCHAR), ',' ORDER BY source_id) AS source_ids
FROM b_source GROUP BY xml_url HAVING count(*) > 1""")
def _(t):
    return joined(A.repeated_values(t.b_source, "xml_url"), "source_ids")


@query("error_class_audit", "VAL-18", """
SELECT verdict, count(*) AS attempts FROM (SELECT CASE WHEN event_type = 'click' THEN 'storable'
  WHEN event_type = 'view' THEN 'unknown' ELSE 'writable' END AS verdict FROM events) q GROUP BY ALL""")
def _(t):
    rows = t.events.select(F.when(F.col("event_type") == "click", "persistence_error").when(
        F.col("event_type") == "view", "weird").when(F.col("event_type") == "error", "parse_error")
        .alias("error_class"))
    return A.error_class_audit(rows).groupBy("verdict").agg(F.count(F.lit(1)).alias("attempts"))


@query("snapshot_name_audit", "VAL-19", """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END AS valid_id,
       CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS valid_time FROM events""")
def _(t):
    moment = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = t.events.select(
        "event_id", F.when(F.col("event_id") % 4 == 0, moment).otherwise(
            F.replace(moment, F.lit(":"), F.lit("-"))).alias("name"),
        F.when(F.col("event_id") % 3 == 0, "2024-02-30T00:00:00Z").otherwise(moment).alias("moment"))
    return A.snapshot_names_audit(rows, "name", "moment").select(
        "event_id", F.col("valid_id").cast("int").alias("valid_id"),
        F.col("valid_time").cast("int").alias("valid_time"))


# --- listings -----------------------------------------------------------------------------------------------------------

@query("recent_runs", "SORT-7", f"""
SELECT {iso_sql('started_at')} AS started_at, attempted_source_count FROM b_run
ORDER BY b_run.started_at DESC LIMIT 15""")
def _(t):
    return text_times(L.newest(t.b_run, [F.desc("started_at")], 15).select(
        "started_at", "attempted_source_count"))


@query("recent_items", "SORT-7", """
SELECT source_item_id, title FROM b_item ORDER BY fetched_at DESC, source_item_id LIMIT 50""")
def _(t):
    return L.newest(t.b_item, [F.desc("fetched_at"), F.col("source_item_id")], 50).select(
        "source_item_id", "title")


@query("recent_classified", "SORT-8", f"""
SELECT c.source_item_id, i.title, c.topic_class, {iso_sql('c.classified_at')} AS classified_at
FROM b_class c JOIN b_item i ON i.source_item_id = c.source_item_id
ORDER BY c.classified_at DESC, c.source_item_id LIMIT 100""")
def _(t):
    return text_times(L.recent_classified(t.b_item, t.b_class).drop("classification_confidence"))


@query("lifetime_classification", "AGG-50", """
SELECT count(*) AS total, count(*) FILTER (topic_class = 'core') AS core,
       count(*) FILTER (topic_class = 'adjacent') AS adjacent,
       count(*) FILTER (topic_class = 'irrelevant') AS irrelevant,
       count(*) FILTER (topic_class = 'unknown') AS unknown,
       ROUND(avg(classification_confidence), 6) AS average_confidence FROM b_class""")
def _(t):
    return rounded(L.lifetime_summary(t.b_class))


PER_SOURCE_SQL = """
SELECT i.source_id, count(*) AS classify_volume,
       avg(CASE WHEN topic_class = 'core' THEN 1.0 ELSE 0.0 END) AS prop_core,
       row_number() OVER (ORDER BY count(*) DESC, i.source_id) AS rank
FROM b_class c JOIN b_item i ON i.source_item_id = c.source_item_id
WHERE i.fetched_at >= TIMESTAMP '1995-03-01' AND i.fetched_at < TIMESTAMP '2001-06-01'
GROUP BY i.source_id"""


@query("source_volume_rank", "WIN-6",
       f"SELECT source_id, classify_volume, rank FROM ({PER_SOURCE_SQL}) p")
def _(t):
    return L.volume_rank(classify_by_source(t.b_item, t.b_class, IW).select(
        "source_id", "classify_volume"))


@query("top_sources_and_others", "AGG-52", f"""
SELECT CAST(source_id AS VARCHAR) AS source, classify_volume, ROUND(prop_core, 6) AS prop_core
FROM ({PER_SOURCE_SQL}) p WHERE rank <= 15
UNION ALL SELECT 'Others (' || count(*) || ' sources)', CAST(sum(classify_volume) AS BIGINT),
  ROUND(avg(prop_core), 6) FROM ({PER_SOURCE_SQL}) p WHERE rank > 15""")
def _(t):
    return rounded(L.top_and_others(classify_by_source(t.b_item, t.b_class, IW), ["prop_core"]))


RAW_SQL = """
SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'investigation' WHEN 1 THEN 'operator_frozen'
       ELSE 'default' END AS retention_class,
  CASE WHEN doc_id % 11 <> 0 THEN TIMESTAMP '2024-01-15' + (doc_id % 400) * INTERVAL '1' HOUR END
       AS expires_at FROM documents"""


def raw(t):
    return t.sql(RAW_SQL)


@query("raw_cleanup_plan", "DOC-8", f"""
SELECT doc_id, CASE WHEN expires_at < TIMESTAMP '2024-01-20' AND retention_class = 'default'
  THEN 'delete' ELSE 'keep' END AS decision FROM ({RAW_SQL}) r""")
def _(t):
    return L.cleanup_plan(raw(t), "2024-01-20 00:00:00").select("doc_id", "decision")


@query("raw_cleanup_counts", "DOC-8", f"""
SELECT retention_class, count(*) AS records,
  count(*) FILTER (expires_at < TIMESTAMP '2024-01-20') AS expired,
  count(*) FILTER (expires_at < TIMESTAMP '2024-01-20' AND retention_class = 'default') AS to_delete
FROM ({RAW_SQL}) r GROUP BY ALL""")
def _(t):
    return L.cleanup_counts(L.cleanup_plan(raw(t), "2024-01-20 00:00:00"), "2024-01-20 00:00:00")


PAGE_SQL = f"""
SELECT slug, {iso_sql('source_published_at')} AS source_published_at FROM ({CATALOGUE_SQL}) c
WHERE language_code = 'en' AND source_published_at >= TIMESTAMP '1996-01-01'
  AND source_published_at < TIMESTAMP '2000-01-01'"""


@query("article_page", "DOC-9", PAGE_SQL + """
  AND (source_published_at < TIMESTAMP '1999-06-01'
       OR (source_published_at = TIMESTAMP '1999-06-01' AND slug < 'order-5'))
ORDER BY c.source_published_at DESC, slug DESC LIMIT 100""")
def _(t):
    return text_times(L.article_page(
        catalogue(t), "en", "1996-01-01 00:00:00", "1999-12-31 00:00:00", 100,
        ("1999-06-01 00:00:00", "order-5")).select("slug", "source_published_at"))


@query("article_coverage", "DOC-9", f"""
SELECT {iso_sql('min(source_published_at)')} AS window_from,
       {iso_sql('max(source_published_at)')} AS window_to,
       count(*) FILTER (source_published_at >= TIMESTAMP '1996-01-01'
                        AND source_published_at < TIMESTAMP '2000-01-01') AS total_count,
       count(*) FILTER (source_published_at IS NULL) AS items_without_event_time,
       0 AS request_exceeds_window_to, 1 AS data_may_be_stale
FROM ({CATALOGUE_SQL}) c WHERE language_code = 'en'""")
def _(t):
    rows = L.article_coverage(catalogue(t), "en", "1996-01-01 00:00:00", "1999-12-31 00:00:00",
                              "2002-01-10 00:00:00", "2002-01-01 00:00:00")
    return text_times(rows.withColumn("request_exceeds_window_to",
                                      F.col("request_exceeds_window_to").cast("int"))
                      .withColumn("data_may_be_stale", F.col("data_may_be_stale").cast("int")))


@query("archive_over_live", "DOC-10", f"""
SELECT language_code, slug, canonical_url, CASE WHEN archive_month < '1998-01' THEN 'archive'
       ELSE 'live' END AS origin FROM ({CATALOGUE_SQL}) c
WHERE language_code = 'en' AND archive_month IS NOT NULL""")
def _(t):
    rows = catalogue(t).filter("language_code = 'en' AND archive_month IS NOT NULL")
    old = rows.filter("archive_month < '1998-01'")
    return D.archive_over_live(old, rows).select("language_code", "slug", "canonical_url", "origin")


# --- display ------------------------------------------------------------------------------------------------------------

@query("minute_texts", "FN-27", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d %H:%M UTC') END
       AS shown FROM events""")
def _(t):
    raw_text = F.when(F.col("event_id") % 5 == 0, "unknown").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return t.events.select("event_id", M.minute_text(raw_text).alias("shown"))


@query("shown_rates", "FN-28", """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN '[INSUFFICIENT_DATA]'
       ELSE printf('%.2f%%', CAST(event_id % 1000 AS DOUBLE) / 8 * 100) END AS rate,
       CASE WHEN event_id % 4 = 0 THEN '[INSUFFICIENT_DATA]'
       ELSE printf('%.2fs', CAST(event_id % 1000 AS DOUBLE) / 8) END AS seconds,
       CASE WHEN event_id % 4 = 0 THEN 'N/A' ELSE printf('%,d', event_id) END AS n FROM events""")
def _(t):
    known = F.col("event_id") % 4 != 0
    x = F.when(known, (F.col("event_id") % 1000).cast("double") / 8)
    return t.events.select("event_id", Y.percent(x).alias("rate"), Y.seconds(x).alias("seconds"),
                           Y.number(F.when(known, F.col("event_id"))).alias("n"))


@query("shown_durations", "FN-29", """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'N/A' WHEN x < 120 THEN printf('%.1f s', x)
  WHEN x < 7200 THEN printf('%.1f min', x / 60) ELSE printf('%.1f h', x / 3600) END AS shown
FROM (SELECT event_id, CAST(event_id % 20000 AS DOUBLE) AS x FROM events) e""")
def _(t):
    x = F.when(F.col("event_id") % 7 != 0, (F.col("event_id") % 20000).cast("double"))
    return t.events.select("event_id", Y.duration(x).alias("shown"))


@query("markdown_rows", "REP-8", """
SELECT source_id, '| ' || source_id || ' | Feed \\| ' || title || ' | ' || schedule_class || ' |' AS line
FROM b_source""".replace("\\\\", "\\"))
def _(t):
    rows = t.b_source.withColumn("title", F.concat(F.lit("Feed | "), F.col("title")))
    return Y.markdown_rows(rows, ["source_id", "title", "schedule_class"], ["title"],
                           "line").select("source_id", "line")


# --- configuration and table scans ---------------------------------------------------------------------------------------

@query("valid_source_entries", "SRC-5", """
SELECT s_suppkey AS source_id, s_name AS title, s_nationkey AS category_id FROM supplier
WHERE s_suppkey % 6 <> 1 AND s_suppkey % 6 <> 2""")
def _(t):
    k = F.col("s_suppkey") % 6
    entries = t.supplier.select(
        F.when(k != 1, F.col("s_suppkey").cast("string")).otherwise("x1").alias("id"),
        F.when(k != 2, F.col("s_name")).alias("title"),
        F.col("s_nationkey").cast("string").alias("category_id"))
    return ST.valid_sources(entries)
