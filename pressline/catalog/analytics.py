"""Cohort and event-time analytics with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressline.catalog.helpers import (EW, ITEM_SQL, IW, LANGS, READY_SQL, START_SQL, TOPIC_SQL,
                                       joined, rounded, sql_window)
from pressline.catalog.registry import query
from pressline.functions import sources as S
from pressline.operators import cohort as C
from pressline.operators import fetch as X
from pressline.operators import translate as T

SHARES = ", ".join(
    f"ROUND(CAST(count(CASE WHEN topic_class = '{t}' THEN 1 END) AS DOUBLE) "
    f"/ NULLIF(count(topic_class), 0), 6) AS prop_{t}"
    for t in ("core", "adjacent", "irrelevant", "unknown"))
REL = (f"ROUND(CAST(count(CASE WHEN {TOPIC_SQL} THEN 1 END) AS DOUBLE) "
       "/ NULLIF(count(topic_class), 0), 6) AS relevance_rate")
WIDE_SQL = f"""
SELECT i.source_item_id, i.source_id, i.title, i.fetched_at, i.published_at,
       t.text_processing_status, t.text_processing_reason, t.sanitized_text_length,
       t.source_item_id AS text_id, c.source_item_id AS class_id, c.topic_class,
       c.content_density, c.classification_confidence, d.source_item_id AS decision_id,
       d.curate_status, d.downstream_action, a.source_item_id AS approved_id,
       a.parent_content_id, a.content_fingerprint, a.content_language_code
FROM b_item i LEFT JOIN b_text t ON t.source_item_id = i.source_item_id
LEFT JOIN b_class c ON c.source_item_id = i.source_item_id
LEFT JOIN b_decision d ON d.source_item_id = i.source_item_id
LEFT JOIN b_approved a ON a.source_item_id = i.source_item_id"""


# --- fetch ---------------------------------------------------------------------------------------

@query("fetch_success_rate", "AGG-1 FLT-2", f"""
SELECT ROUND(avg(CASE WHEN outcome = 'success' THEN 1.0 ELSE 0.0 END), 6) AS fetch_success_rate
FROM b_attempt WHERE {START_SQL}""")
def _(t):
    return rounded(X.success_rate(t.b_attempt, EW))


@query("fetch_success_by_source", "AGG-2", f"""
SELECT source_id, ROUND(avg(CASE WHEN outcome = 'success' THEN 1.0 ELSE 0.0 END), 6)
       AS fetch_success_rate
FROM b_attempt WHERE {START_SQL} GROUP BY source_id""")
def _(t):
    return rounded(X.success_rate(t.b_attempt, EW, ["source_id"]))


@query("run_success_rate", "AGG-3", f"""
SELECT ROUND(CAST(sum(succeeded_source_count) AS DOUBLE) / sum(attempted_source_count), 6)
       AS run_success_rate FROM b_run WHERE {START_SQL}""")
def _(t):
    return rounded(X.run_success_rate(t.b_run, EW))


@query("fetch_error_categories", "AGG-4", f"""
SELECT error_class, http_status, count(*) AS error_count FROM b_attempt
WHERE {START_SQL} AND outcome = 'failed' GROUP BY ALL""")
def _(t):
    return X.error_categories(t.b_attempt, EW)


@query("source_health_snapshot", "AGG-5", """
SELECT source_id, health_status, consecutive_failures, last_http_status, last_error_class
FROM b_state""")
def _(t):
    return X.health_snapshot(t.b_state)


# --- ingest ----------------------------------------------------------------------------------------

@query("ingest_volume", "AGG-6 FLT-1",
       f"SELECT count(*) AS ingest_volume FROM b_item WHERE {ITEM_SQL}")
def _(t):
    return C.ingest_volume(t.b_item, IW)


@query("low_context_rate", "AGG-7", f"""
SELECT count(*) AS total_ingested_items,
       ROUND(avg(CASE WHEN text_processing_status = 'low_context' THEN 1.0 ELSE 0.0 END), 6)
       AS low_context_observation_rate
FROM ({WIDE_SQL}) w WHERE {ITEM_SQL}""")
def _(t):
    return rounded(C.ingest_quality(t.b_item, t.b_text, IW))


@query("low_context_reasons", "AGG-8", f"""
SELECT text_processing_reason, count(*) AS reason_count FROM ({WIDE_SQL}) w
WHERE {ITEM_SQL} AND text_processing_status = 'low_context' AND text_processing_reason IS NOT NULL
GROUP BY ALL""")
def _(t):
    return C.low_context_reasons(t.b_item, t.b_text, IW)


@query("reasons_by_source", "AGG-9", f"""
SELECT source_id, text_processing_reason, count(*) AS reason_count FROM ({WIDE_SQL}) w
WHERE {ITEM_SQL} AND text_processing_reason IS NOT NULL GROUP BY ALL""")
def _(t):
    return C.reasons_by_source(t.b_item, t.b_text, IW)


@query("reason_map_by_source", "AGG-9", f"""
SELECT source_id, string_agg(text_processing_reason || '=' || n, ',' ORDER BY text_processing_reason)
       AS reasons
FROM (SELECT source_id, text_processing_reason, count(*) AS n FROM ({WIDE_SQL}) w
      WHERE {ITEM_SQL} AND text_processing_reason IS NOT NULL GROUP BY ALL) g GROUP BY source_id""")
def _(t):
    maps = C.reason_maps(C.reasons_by_source(t.b_item, t.b_text, IW))
    entry = F.transform(F.map_entries("text_processing_reason_distribution"),
                        lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return maps.select("source_id", F.array_join(entry, ",").alias("reasons"))


SCORECARD_SQL = f"""
SELECT source_id, count(*) AS ingest_volume, count(class_id) AS classified_count, {REL},
       ROUND(CAST(count(CASE WHEN curate_status = 'approved' THEN 1 END) AS DOUBLE)
             / NULLIF(count(decision_id), 0), 6) AS curation_approval_rate,
       count(CASE WHEN curate_status = 'approved' THEN 1 END) AS curate_approved_count,
       ROUND(CAST(count(approved_id) AS DOUBLE) / count(*), 6) AS overall_yield,
       CAST(sum(CASE WHEN {READY_SQL} THEN length(title) + sanitized_text_length ELSE 0 END)
            AS BIGINT) AS classification_char_volume_proxy,
       CAST(sum(CASE WHEN decision_id IS NOT NULL THEN length(title) + sanitized_text_length
                ELSE 0 END) AS BIGINT) AS curation_char_volume_proxy, {SHARES}
FROM ({WIDE_SQL}) w WHERE {ITEM_SQL} GROUP BY source_id"""


def wide(t):
    return C.wide_items(C.cohort_items(t.b_item, IW), t.b_text, t.b_class, t.b_decision,
                        t.b_approved)


@query("source_scorecard", "AGG-10 JOIN-2", SCORECARD_SQL)
def _(t):
    return rounded(C.source_scorecard(wide(t)))


@query("filtering_overhead", "AGG-35", f"""
SELECT source_id, ROUND(CAST(classified_count AS DOUBLE) / NULLIF(curate_approved_count, 0), 6)
       AS classification_filtering_overhead FROM ({SCORECARD_SQL}) s""")
def _(t):
    return rounded(C.filtering_overhead(C.source_scorecard(wide(t)))
                   .select("source_id", "classification_filtering_overhead"))


# --- classification ----------------------------------------------------------------------------------

@query("classify_kpis", "AGG-11", f"""
SELECT count(class_id) AS total_classified, {REL},
       ROUND(avg(classification_confidence), 6) AS average_confidence, {SHARES}
FROM ({WIDE_SQL}) w WHERE {ITEM_SQL}""")
def _(t):
    return rounded(C.classify_kpis(t.b_item, t.b_class, IW))


DENSITY = ", ".join(
    f"ROUND(CAST(count(CASE WHEN content_density = '{d}' THEN 1 END) AS DOUBLE) "
    f"/ count(class_id), 6) AS density_{d}_rate" for d in ("low", "medium", "high"))


@query("classify_by_source", "AGG-12", f"""
SELECT source_id, count(class_id) AS classify_volume, {REL},
       ROUND(avg(classification_confidence), 6) AS average_confidence, {DENSITY}, {SHARES}
FROM ({WIDE_SQL}) w WHERE {ITEM_SQL} AND class_id IS NOT NULL GROUP BY source_id""")
def _(t):
    return rounded(C.classify_by_source(t.b_item, t.b_class, IW))


@query("classify_chars_by_source", "AGG-13 FLT-5", f"""
SELECT source_id, CAST(sum(length(title) + sanitized_text_length) AS BIGINT) AS char_volume
FROM ({WIDE_SQL}) w WHERE {ITEM_SQL} AND {READY_SQL} GROUP BY source_id""")
def _(t):
    return C.char_volume_by_source(t.b_item, t.b_text, IW)


# --- curation ------------------------------------------------------------------------------------------

@query("curation_approval_rate", "AGG-14", f"""
SELECT ROUND(avg(CASE WHEN curate_status = 'approved' THEN 1.0 ELSE 0.0 END), 6) AS approval_rate
FROM ({WIDE_SQL}) w WHERE {ITEM_SQL} AND decision_id IS NOT NULL""")
def _(t):
    return rounded(C.approval_rate(t.b_item, t.b_decision, IW))


@query("curation_rejection_mix", "AGG-15", f"""
SELECT downstream_action, count(*) AS rejected_count FROM ({WIDE_SQL}) w
WHERE {ITEM_SQL} AND curate_status = 'rejected' GROUP BY downstream_action""")
def _(t):
    return C.rejection_mix(t.b_item, t.b_decision, IW)


@query("curation_chars", "AGG-16", f"""
SELECT CAST(coalesce(sum(length(title) + sanitized_text_length), 0) AS BIGINT) AS char_volume
FROM ({WIDE_SQL}) w WHERE {ITEM_SQL} AND decision_id IS NOT NULL AND text_id IS NOT NULL""")
def _(t):
    return C.curation_chars(t.b_item, t.b_text, t.b_decision, IW)


@query("low_context_outcome", "AGG-34 FLT-9", f"""
SELECT count(*) AS cohort_size,
       count(CASE WHEN topic_class = 'core' THEN 1 END) AS topic_core,
       count(CASE WHEN topic_class = 'adjacent' THEN 1 END) AS topic_adjacent,
       count(CASE WHEN topic_class = 'irrelevant' THEN 1 END) AS topic_irrelevant,
       count(CASE WHEN topic_class = 'unknown' THEN 1 END) AS topic_unknown,
       count(decision_id) AS curated_count,
       count(CASE WHEN curate_status = 'approved' THEN 1 END) AS curation_approved_count,
       ROUND(CAST(count(CASE WHEN curate_status = 'approved' THEN 1 END) AS DOUBLE)
             / NULLIF(count(decision_id), 0), 6) AS curation_approval_rate,
       count(CASE WHEN downstream_action = 'publish_link' THEN 1 END) AS action_publish_link,
       count(CASE WHEN downstream_action = 'publish_summary' THEN 1 END) AS action_publish_summary,
       count(CASE WHEN downstream_action = 'edit_rewrite' THEN 1 END) AS action_edit_rewrite,
       count(CASE WHEN downstream_action = 'reject_discard' THEN 1 END) AS action_reject_discard
FROM ({WIDE_SQL}) w WHERE {ITEM_SQL} AND text_processing_status = 'low_context' AND {READY_SQL}
  AND class_id IS NOT NULL""")
def _(t):
    return rounded(C.low_context_outcome(t.b_item, t.b_text, t.b_class, t.b_decision, IW))


@query("approval_by_density", "DOC-2", f"""
SELECT content_density, count(*) AS items,
       count(CASE WHEN curate_status = 'approved' THEN 1 END) AS approved_items,
       ROUND(avg(CASE WHEN curate_status = 'approved' THEN 1.0 ELSE 0.0 END), 6) AS approval_rate
FROM ({WIDE_SQL}) w WHERE {ITEM_SQL} AND class_id IS NOT NULL GROUP BY content_density""")
def _(t):
    return rounded(C.approval_by_density(t.b_item, t.b_class, t.b_decision, IW))


@query("signal_outcomes", "DOC-7", f"""
SELECT signal, value, count(*) AS items, count(curate_status) AS decided_items,
       count(CASE WHEN curate_status = 'approved' THEN 1 END) AS approved_items,
       ROUND(CAST(count(CASE WHEN curate_status = 'approved' THEN 1 END) AS DOUBLE)
             / NULLIF(count(curate_status), 0), 6) AS approval_rate
FROM (SELECT k.signal, json_extract_string(c.additional_signals, '$.' || k.signal) AS value,
             d.curate_status
      FROM b_class c JOIN b_item i ON i.source_item_id = c.source_item_id
      LEFT JOIN b_decision d ON d.source_item_id = c.source_item_id
      CROSS JOIN (SELECT unnest(['content_timeliness', 'primary_evidence_type']) AS signal) k
      WHERE {ITEM_SQL}) s WHERE value IS NOT NULL GROUP BY ALL""")
def _(t):
    return rounded(C.signal_outcomes(t.b_item, t.b_class, t.b_decision, IW))


# --- funnel --------------------------------------------------------------------------------------------

def funnel_sql(where: str, lead: str = "", group: str = "") -> str:
    app = (f"{READY_SQL} AND class_id IS NOT NULL AND {TOPIC_SQL} AND decision_id IS NOT NULL "
           "AND curate_status = 'approved' AND approved_id IS NOT NULL")
    stage = {
        "ingested": "TRUE",
        "low_context_observation_count": "text_processing_status = 'low_context'",
        "classified": f"{READY_SQL} AND class_id IS NOT NULL",
        "classified_relevant": f"{READY_SQL} AND {TOPIC_SQL}",
        "curated": f"{READY_SQL} AND {TOPIC_SQL} AND decision_id IS NOT NULL",
        "approved": app,
        "translated": f"""{app} AND EXISTS (SELECT 1 FROM b_translation tr
            WHERE tr.parent_content_id = w.parent_content_id
              AND tr.translation_status = 'completed'
              AND tr.source_fingerprint = w.content_fingerprint)""",
        "published": f"""{app} AND EXISTS (SELECT 1 FROM b_publish p JOIN b_publish_status s
            ON s.publish_record_id = p.publish_record_id
            WHERE p.source_item_id = w.source_item_id AND s.publish_status = 'published'
              AND s.source_fingerprint = w.content_fingerprint)""",
    }
    cols = ", ".join(f"count(DISTINCT CASE WHEN {c} THEN source_item_id END) AS {n}"
                     for n, c in stage.items())
    return f"SELECT {lead}{cols} FROM ({WIDE_SQL}) w WHERE {where} {group}"


FUNNEL_SQL = funnel_sql(ITEM_SQL)


def flagged(t, base):
    return C.with_flags(base, t.b_approved, t.b_translation, t.b_publish, t.b_publish_status)


@query("funnel_counts", "AGG-17 JOIN-1 FLT-6 FLT-7", FUNNEL_SQL)
def _(t):
    return C.funnel_counts(flagged(t, wide(t)))


@query("cumulative_yield", "DOC-1", f"""
SELECT stage, items, ROUND(CAST(items AS DOUBLE) / NULLIF(ingested, 0), 6) AS yield
FROM (SELECT ingested, unnest(['ingested', 'classified', 'curated', 'approved', 'translated',
                               'published']) AS stage,
             unnest([ingested, classified, curated, approved, translated, published]) AS items
      FROM ({FUNNEL_SQL}) f) s""")
def _(t):
    return rounded(C.cumulative_yield(C.funnel_counts(flagged(t, wide(t)))))


READINESS_COLS = f"""count(*) AS total_ingested,
       count(CASE WHEN text_processing_status = 'low_context' THEN 1 END)
           AS low_context_observation_count,
       count(CASE WHEN {READY_SQL} AND class_id IS NOT NULL THEN 1 END) AS total_classified,
       count(CASE WHEN {READY_SQL} AND class_id IS NULL THEN 1 END) AS pending_classification,
       count(CASE WHEN text_processing_status = 'failed' THEN 1 END) AS failed_text_processing,
       count(CASE WHEN text_id IS NULL THEN 1 END) AS missing_text_processing"""


@query("readiness_breakdown", "AGG-18",
       f"SELECT {READINESS_COLS} FROM ({WIDE_SQL}) w WHERE {ITEM_SQL}")
def _(t):
    return C.readiness(t.b_item, t.b_text, t.b_class, IW)


@query("live_items_by_language", "AGG-20", f"""
SELECT s.language_code, count(DISTINCT w.source_item_id) AS published_count
FROM ({WIDE_SQL}) w JOIN b_publish p ON p.source_item_id = w.source_item_id
JOIN b_publish_status s ON s.publish_record_id = p.publish_record_id
WHERE {ITEM_SQL} AND {READY_SQL} AND {TOPIC_SQL} AND curate_status = 'approved'
  AND approved_id IS NOT NULL AND s.publish_status = 'published'
  AND s.source_fingerprint = w.content_fingerprint GROUP BY s.language_code""")
def _(t):
    return C.live_by_language(eligible(t), t.b_publish, t.b_publish_status)


def eligible(t):
    return C.eligible_approved(t.b_item, t.b_text, t.b_class, t.b_decision, t.b_approved, IW)


ELIGIBLE_SQL = f"""SELECT source_item_id, content_fingerprint FROM ({WIDE_SQL}) w
WHERE {ITEM_SQL} AND {READY_SQL} AND {TOPIC_SQL} AND curate_status = 'approved'
  AND approved_id IS NOT NULL"""


@query("approved_for_coverage", "AGG-21",
       f"SELECT count(DISTINCT source_item_id) AS total_approved FROM ({ELIGIBLE_SQL}) e")
def _(t):
    return eligible(t).agg(F.countDistinct("source_item_id").alias("total_approved"))


def coverage_sql(population: str, count_col: bool) -> str:
    counted = "count(DISTINCT live.source_item_id) AS published_count, " if count_col else ""
    return f"""
SELECT l.language_code, {counted}ROUND(CAST(count(DISTINCT live.source_item_id) AS DOUBLE)
       / NULLIF(count(DISTINCT e.source_item_id), 0), 6) AS coverage_rate
FROM b_lang l CROSS JOIN ({population}) e
LEFT JOIN (SELECT p.source_item_id, s.language_code, s.source_fingerprint FROM b_publish p
           JOIN b_publish_status s ON s.publish_record_id = p.publish_record_id
           WHERE s.publish_status = 'published') live
  ON live.source_item_id = e.source_item_id AND live.language_code = l.language_code
 AND live.source_fingerprint = e.content_fingerprint
GROUP BY l.language_code"""


@query("funnel_language_coverage", "AGG-22", coverage_sql(ELIGIBLE_SQL, True))
def _(t):
    e = eligible(t)
    return rounded(C.coverage_by_language(
        t.b_lang, C.live_by_language(e, t.b_publish, t.b_publish_status), e))


ACTIVE_SQL = f"""SELECT w.source_item_id, w.parent_content_id, w.content_fingerprint,
       w.content_language_code FROM ({WIDE_SQL}) w
WHERE {ITEM_SQL} AND w.curate_status = 'approved' AND w.approved_id IS NOT NULL"""


@query("publishing_language_coverage", "AGG-23 JOIN-8", coverage_sql(ACTIVE_SQL, False))
def _(t):
    return rounded(C.publishing_coverage(t.b_lang, t.b_item, t.b_decision, t.b_approved,
                                         t.b_publish, t.b_publish_status, IW))


@query("publish_count", "AGG-24", f"""
SELECT count(*) AS publish_count FROM b_publish
WHERE {sql_window('first_published_at', IW)}""")
def _(t):
    return C.event_rows(t.b_publish, "first_published_at", IW).agg(
        F.count(F.lit(1)).alias("publish_count"))


# --- translation -----------------------------------------------------------------------------------------

UPDATED_SQL = sql_window("updated_at", IW)
OK_SQL = ("ROUND(CAST(count(CASE WHEN translation_status = 'completed' THEN 1 END) AS DOUBLE) / "
          "NULLIF(count(CASE WHEN translation_status IN ('completed', 'failed') THEN 1 END), 0), 6)"
          " AS success_rate")


@query("translation_success_rate", "AGG-25",
       f"SELECT {OK_SQL} FROM b_translation WHERE {UPDATED_SQL}")
def _(t):
    return rounded(T.success_rates(t.b_translation, IW))


STALE_SQL = ("ROUND(CAST(count(CASE WHEN translation_status = 'stale' THEN 1 END) AS DOUBLE) / "
             "NULLIF(count(CASE WHEN translation_status IN ('completed', 'failed', 'stale') "
             "THEN 1 END), 0), 6) AS stale_rate")


@query("translation_rates_by_language", "AGG-26", f"""
SELECT language_code, {OK_SQL}, {STALE_SQL} FROM b_translation WHERE {UPDATED_SQL}
GROUP BY language_code""")
def _(t):
    return rounded(T.success_rates(t.b_translation, IW, by_language=True))


ARTICLE_DONE_SQL = f"""
SELECT ROUND(avg(CASE WHEN done = required THEN 1.0 ELSE 0.0 END), 6)
       AS translation_completion_rate
FROM (SELECT a.parent_content_id, count(DISTINCT tr.language_code) AS done,
             (SELECT count(*) FROM b_lang l WHERE l.language_code <> a.content_language_code)
             AS required
      FROM ({ACTIVE_SQL}) a LEFT JOIN b_translation tr
        ON tr.parent_content_id = a.parent_content_id
       AND tr.source_fingerprint = a.content_fingerprint
       AND tr.language_code <> a.content_language_code AND tr.translation_status = 'completed'
       AND tr.model_name <> 'bypass'
      GROUP BY a.parent_content_id, a.content_language_code) g"""


@query("article_translation_completion", "AGG-27 JOIN-7", ARTICLE_DONE_SQL)
def _(t):
    return rounded(T.article_completion(t.b_item, t.b_decision, t.b_approved, t.b_translation,
                                        LANGS, IW))


LANG_DONE_SQL = f"""
SELECT l.language_code, ROUND(CAST(count(DISTINCT CASE WHEN tr.translation_status = 'completed'
       AND tr.source_fingerprint = a.content_fingerprint THEN a.parent_content_id END) AS DOUBLE)
       / NULLIF(count(DISTINCT CASE WHEN a.content_language_code <> l.language_code
                THEN a.parent_content_id END), 0), 6) AS completion_rate
FROM b_lang l CROSS JOIN ({ACTIVE_SQL}) a LEFT JOIN b_translation tr
  ON tr.parent_content_id = a.parent_content_id AND tr.language_code = l.language_code
GROUP BY l.language_code"""


@query("language_translation_completion", "AGG-28", LANG_DONE_SQL)
def _(t):
    return rounded(T.language_completion(t.b_item, t.b_decision, t.b_approved, t.b_translation,
                                         t.b_lang, IW))


OUTPUTS_SQL = f"""b_translation tr JOIN b_approved a ON a.parent_content_id = tr.parent_content_id
JOIN b_item i ON i.source_item_id = a.source_item_id
WHERE {ITEM_SQL} AND tr.model_name <> 'bypass'"""
LAT_SQL = "ROUND(avg(epoch(tr.translated_at) - epoch(a.approved_at)), 6) AS avg_latency"


@query("translation_latency", "AGG-29 FLT-8", f"SELECT {LAT_SQL} FROM {OUTPUTS_SQL}")
def _(t):
    return rounded(T.average_latency(t.b_item, t.b_approved, t.b_translation, IW))


@query("translation_latency_by_language", "AGG-29",
       f"SELECT tr.language_code, {LAT_SQL} FROM {OUTPUTS_SQL} GROUP BY tr.language_code")
def _(t):
    return rounded(T.average_latency(t.b_item, t.b_approved, t.b_translation, IW, True))


FIVE_SQL = ("length({0}display_title) + length({0}summary_short) + coalesce(length({0}bullet_1), 0)"
            " + coalesce(length({0}bullet_2), 0) + coalesce(length({0}bullet_3), 0)")


@query("translation_chars_by_language", "AGG-30", f"""
SELECT tr.language_code, CAST(sum({FIVE_SQL.format('a.')}) AS BIGINT) AS char_volume
FROM {OUTPUTS_SQL} GROUP BY tr.language_code""")
def _(t):
    return T.recorded_chars(t.b_item, t.b_approved, t.b_translation, IW)


@query("intended_translation_chars", "DOC-4", f"""
SELECT CAST(coalesce(sum({FIVE_SQL.format('a.')}) * 2, 0) AS BIGINT) AS intended_char_volume
FROM b_approved a JOIN b_item i ON i.source_item_id = a.source_item_id WHERE {ITEM_SQL}""")
def _(t):
    return T.intended_chars(t.b_item, t.b_approved, LANGS, IW)


@query("translation_char_share", "DOC-5", f"""
SELECT language_code, char_volume,
       ROUND(CAST(char_volume AS DOUBLE) / sum(char_volume) OVER (), 6) AS char_share
FROM (SELECT language_code, CAST(sum({FIVE_SQL.format('')}) AS BIGINT) AS char_volume
      FROM b_translation WHERE {UPDATED_SQL} AND translation_status = 'completed'
      GROUP BY language_code) g""")
def _(t):
    return rounded(T.completed_char_share(t.b_translation, IW))


# --- latency -----------------------------------------------------------------------------------------------

def _gap(stage, later, earlier, source, lang="CAST(NULL AS VARCHAR)"):
    return (f"SELECT '{stage}' AS stage, CAST(floor(epoch({later})) - floor(epoch({earlier})) "
            f"AS BIGINT) AS seconds, {lang} AS language_code FROM {source}")


SERIES_SQL = " UNION ALL ".join([
    _gap("pipeline_lead_time", "p.first_published_at", "i.fetched_at",
         f"b_item i JOIN b_publish p ON p.source_item_id = i.source_item_id WHERE {ITEM_SQL}"),
    _gap("feed_freshness_delay", "fetched_at", "published_at",
         f"b_item WHERE {ITEM_SQL} AND published_at IS NOT NULL"),
    _gap("fetch_execution_latency", "ended_at", "started_at", f"b_attempt WHERE {START_SQL}"),
    _gap("classification_delay", "c.classified_at", "i.fetched_at",
         f"b_item i JOIN b_class c ON c.source_item_id = i.source_item_id WHERE {ITEM_SQL}"),
    _gap("curation_delay", "d.curated_at", "c.classified_at",
         "b_item i JOIN b_class c ON c.source_item_id = i.source_item_id "
         f"JOIN b_decision d ON d.source_item_id = i.source_item_id WHERE {ITEM_SQL}"),
    _gap("translation_delay", "tr.translated_at", "a.approved_at", OUTPUTS_SQL,
         "tr.language_code"),
    _gap("publish_delay", "s.published_at", "tr.translated_at",
         "b_publish_status s JOIN b_publish p ON p.publish_record_id = s.publish_record_id "
         "JOIN b_approved a ON a.source_item_id = p.source_item_id JOIN b_translation tr "
         "ON tr.parent_content_id = a.parent_content_id AND tr.language_code = s.language_code "
         f"JOIN b_item i ON i.source_item_id = p.source_item_id WHERE {ITEM_SQL} "
         "AND s.published_at IS NOT NULL", "s.language_code"),
])


def series(t):
    return C.latency_series(t.b_item, t.b_class, t.b_decision, t.b_approved, t.b_translation,
                            t.b_publish, t.b_publish_status, t.b_attempt, IW, EW)


@query("latency_series_totals", "AGG-31 FN-24", f"""
SELECT stage, count(*) AS n, CAST(sum(seconds) AS BIGINT) AS total_seconds,
       min(seconds) AS shortest, max(seconds) AS longest FROM ({SERIES_SQL}) s GROUP BY stage""")
def _(t):
    return series(t).groupBy("stage").agg(
        F.count(F.lit(1)).alias("n"), F.sum("seconds").alias("total_seconds"),
        F.min("seconds").alias("shortest"), F.max("seconds").alias("longest"))


PCT_SQL = ("ROUND(avg(seconds), 6) AS average, ROUND(quantile_cont(seconds, 0.5), 6) AS median, "
           "ROUND(quantile_cont(seconds, 0.9), 6) AS p90")


@query("latency_percentiles", "AGG-32",
       f"SELECT stage, {PCT_SQL} FROM ({SERIES_SQL}) s GROUP BY stage")
def _(t):
    return rounded(C.latency_summary(series(t)))


@query("publish_delay_by_language", "AGG-33 JOIN-6", f"""
SELECT language_code, {PCT_SQL} FROM ({SERIES_SQL}) s WHERE stage = 'publish_delay'
GROUP BY language_code""")
def _(t):
    outputs = C.cohort_outputs(t.b_item, t.b_approved, t.b_translation, IW)
    rows = C.publish_gaps(outputs, t.b_publish, t.b_publish_status)
    return rounded(C.latency_summary(rows, ["language_code"]))


# --- data quality --------------------------------------------------------------------------------------------

ANOMALY_SQL = f"""
SELECT 'ORPHANED_CLASSIFICATION' AS code, source_item_id FROM ({WIDE_SQL}) w WHERE {ITEM_SQL}
  AND class_id IS NOT NULL AND (text_id IS NULL OR text_processing_status = 'failed'
                                OR text_processing_reason = 'post_cleanup_empty')
UNION ALL SELECT 'ORPHANED_CURATION', source_item_id FROM ({WIDE_SQL}) w WHERE {ITEM_SQL}
  AND decision_id IS NOT NULL AND (class_id IS NULL OR NOT {TOPIC_SQL})
UNION ALL SELECT 'MISSING_TEXT_RECORD', source_item_id FROM ({WIDE_SQL}) w WHERE {ITEM_SQL}
  AND text_id IS NULL
UNION ALL SELECT 'UNKNOWN_TEXT_PROCESSING_STATUS', source_item_id FROM ({WIDE_SQL}) w
  WHERE {ITEM_SQL} AND text_processing_status NOT IN ('completed', 'low_context', 'failed')"""


@query("data_quality_anomalies", "VAL-11 SET-7 SORT-6", f"""
SELECT code, count(*) AS count,
       array_to_string(list_slice(list(source_item_id ORDER BY source_item_id), 1, 10), ',')
       AS item_samples FROM ({ANOMALY_SQL}) a GROUP BY code""")
def _(t):
    rows = C.anomaly_rows(t.b_item, t.b_text, t.b_class, t.b_decision, IW)
    return joined(C.anomalies(rows), "item_samples")


# --- sources -------------------------------------------------------------------------------------------------

SOURCE_REPORT_SQL = f"""
SELECT ids.source_id, f.fetch_success_rate, coalesce(s.ingest_volume, 0) AS ingest_volume,
       s.relevance_rate, s.curation_approval_rate, s.overall_yield,
       coalesce(s.classification_char_volume_proxy, 0) AS classification_char_volume_proxy,
       coalesce(s.curation_char_volume_proxy, 0) AS curation_char_volume_proxy,
       ROUND(CAST(s.classified_count AS DOUBLE) / NULLIF(s.curate_approved_count, 0), 6)
       AS classification_filtering_overhead,
       s.prop_core, s.prop_adjacent, s.prop_irrelevant, s.prop_unknown,
       coalesce(m.title, concat('Unknown Source (ID: ', CAST(ids.source_id AS VARCHAR),
                                ') [INSUFFICIENT_DATA]')) AS source_title,
       m.category_id, m.source_id IS NULL AS unknown
FROM (SELECT source_id FROM b_source UNION SELECT source_id FROM b_attempt WHERE {START_SQL}
      UNION SELECT source_id FROM b_item WHERE {ITEM_SQL}) ids
LEFT JOIN (SELECT source_id, ROUND(avg(CASE WHEN outcome = 'success' THEN 1.0 ELSE 0.0 END), 6)
           AS fetch_success_rate FROM b_attempt WHERE {START_SQL} GROUP BY source_id) f
  ON f.source_id = ids.source_id
LEFT JOIN ({SCORECARD_SQL}) s ON s.source_id = ids.source_id
LEFT JOIN b_source m ON m.source_id = ids.source_id"""
# Thresholds lifted for this data so that all four quadrants and both flags occur.
QUAD = {"yield_floor": 0.21, "relevance": 0.6, "isolation": 0.55}
QUADRANT_SQL = f"""
SELECT * EXCLUDE (unknown),
  CASE WHEN fetch_success_rate < 0.55 OR ingest_volume = 0 OR relevance_rate IS NULL
            OR overall_yield IS NULL THEN NULL
       WHEN overall_yield >= 0.21 AND relevance_rate >= 0.6 THEN 'golden_source'
       WHEN overall_yield >= 0.21 THEN 'needle_in_a_haystack'
       WHEN relevance_rate >= 0.6 THEN 'filtering_burden' ELSE 'dead_weight' END AS quadrant,
  array_to_string(list_filter([CASE WHEN category_id IN (1, 3) THEN 'AUTHORITY' END,
      CASE WHEN unknown OR (coalesce(fetch_success_rate, 1) >= 0.55 AND (ingest_volume = 0
           OR relevance_rate IS NULL OR overall_yield IS NULL)) THEN 'INSUFFICIENT_DATA' END,
      CASE WHEN fetch_success_rate < 0.55 THEN 'CONNECTION_DIAGNOSTICS' END],
      lambda x: x IS NOT NULL), ',') AS analysis_flags
FROM ({SOURCE_REPORT_SQL}) r"""


def source_report(t):
    from pressline.plans.reports import source_breakdown
    return source_breakdown(t.b_source, t.b_attempt, wide(t), EW, **QUAD)


def quadrant_rows(t):
    return joined(rounded(source_report(t)).drop("is_unknown_source"), "analysis_flags")


@query("source_report", "REP-2 SET-1 JOIN-13 FN-25", QUADRANT_SQL)
def _(t):
    return quadrant_rows(t)


@query("flagged_sources", "FLT-15", f"""
SELECT source_id, quadrant, analysis_flags FROM ({QUADRANT_SQL}) q
WHERE analysis_flags LIKE '%AUTHORITY%' OR analysis_flags LIKE '%CONNECTION_DIAGNOSTICS%'""")
def _(t):
    rows = S.with_any_flag(source_report(t), ["AUTHORITY", "CONNECTION_DIAGNOSTICS"])
    return joined(rows.select("source_id", "quadrant", "analysis_flags"), "analysis_flags")


@query("plottable_sources", "FLT-16", f"""
SELECT source_id, relevance_rate, overall_yield FROM ({QUADRANT_SQL}) q
WHERE relevance_rate IS NOT NULL AND overall_yield IS NOT NULL""")
def _(t):
    rows = S.with_both_axes(source_report(t))
    return rounded(rows.select("source_id", "relevance_rate", "overall_yield"))


@query("disable_suggestions", "DOC-12", f"""
SELECT source_id, source_title, overall_yield, analysis_flags FROM ({QUADRANT_SQL}) q
WHERE overall_yield < 0.2""")
def _(t):
    from pressline.plans.reports import disable_suggestions
    rows = disable_suggestions(source_report(t), 0.2)
    return joined(rounded(rows), "analysis_flags")


@query("slices_by_category", "DOC-6", f"""
SELECT coalesce(CAST(m.category_id AS VARCHAR), 'unknown') AS category,
       coalesce(m.schedule_class, 'unknown') AS schedule_class, count(*) AS ingest_volume,
       count(CASE WHEN curate_status = 'approved' THEN 1 END) AS approved_items,
       ROUND(CAST(count(approved_id) AS DOUBLE) / count(*), 6) AS overall_yield
FROM ({WIDE_SQL}) w LEFT JOIN b_source m ON m.source_id = w.source_id WHERE {ITEM_SQL}
GROUP BY ALL""")
def _(t):
    from pressline.plans.reports import slices
    return rounded(slices(wide(t), t.b_source))
