"""Composite reports with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from pressline.bindings import ITEM_WINDOW
from pressline.catalog import analytics as AN
from pressline.catalog.helpers import EW, ITEM_SQL, IW, LANGS, READY_SQL, rounded
from pressline.catalog.publishing import folder
from pressline.catalog.registry import query
from pressline.operators import cohort as C
from pressline.plans import reports as P
from pressline.sources import exports as E

DAYS = 2284          # 1995-03-01 to 2001-06-01
OFFSET = 48
MATURED = "(fetched_at >= TIMESTAMP '1995-02-27' AND fetched_at < TIMESTAMP '2001-05-30')"


def frames(t):
    return {"item": t.b_item, "text": t.b_text, "cls": t.b_class, "decision": t.b_decision,
            "approved": t.b_approved, "translation": t.b_translation, "publish": t.b_publish,
            "publish_status": t.b_publish_status, "attempt": t.b_attempt}


def half(name: str, where: str) -> str:
    return f"""
SELECT '{name}' AS window_name, r.*, f.classified_relevant, f.curated, f.approved, f.translated,
       f.published,
       ROUND(CAST(r.total_classified AS DOUBLE) / NULLIF(r.total_ingested, 0), 6) AS classification_rate,
       ROUND(CAST(f.curated AS DOUBLE) / NULLIF(r.total_classified, 0), 6) AS curation_rate,
       ROUND(CAST(f.approved AS DOUBLE) / NULLIF(f.curated, 0), 6) AS curation_approval_rate,
       ROUND(CAST(f.translated AS DOUBLE) / NULLIF(f.approved, 0), 6) AS translation_rate,
       ROUND(CAST(f.published AS DOUBLE) / NULLIF(f.approved, 0), 6) AS publish_rate
FROM (SELECT {AN.READINESS_COLS} FROM ({AN.WIDE_SQL}) w WHERE {where}) r
CROSS JOIN ({AN.funnel_sql(where)}) f"""


FUNNEL = half("raw", ITEM_SQL) + " UNION ALL " + half("matured", MATURED)


@query("funnel_report", "REP-1 FLT-3 FLT-4", FUNNEL)
def _(t):
    windows = C.window_pair(ITEM_WINDOW[1], DAYS, OFFSET)
    return rounded(P.funnel_windows(frames(t), windows))


@query("stage_conversion_rates", "AGG-19", f"""
SELECT window_name, classification_rate, curation_rate, curation_approval_rate, translation_rate,
       publish_rate FROM ({FUNNEL}) f""")
def _(t):
    windows = C.window_pair(ITEM_WINDOW[1], DAYS, OFFSET)
    return rounded(P.funnel_windows(frames(t), windows).select(
        "window_name", "classification_rate", "curation_rate", "curation_approval_rate",
        "translation_rate", "publish_rate"))


COUNTED = {"total_ingested": "total_ingested", "low_context_observation_count": "low_context_observation_count",
           "total_classified": "total_classified", "relevant_classified": "classified_relevant",
           "total_curated": "curated", "curation_approved": "approved", "total_translated": "translated",
           "total_published": "published"}
RATES = ["classification_rate", "curation_rate", "curation_approval_rate", "translation_rate", "publish_rate"]
STATES = ["low_context_observation_count", "total_classified", "pending_classification", "failed_text_processing",
          "missing_text_processing"]


def leaf_sql(path: str, number: str, source: str, text: str = "NULL") -> str:
    return f"SELECT {path} AS leaf, CAST({number} AS DOUBLE) AS number, CAST({text} AS VARCHAR) AS shown FROM {source}"


def document_sql() -> str:
    """Every leaf of the funnel document, from the queries of its parts."""
    parts = [leaf_sql(f"'{k}'", "NULL", "(SELECT 1) x", f"'{v}'") for k, v in {
        "report_type": "funnel", "schema_version": "3.0.0", "generated_at": "2001-06-01T00:00:00Z",
        "raw_window.start": "1995-03-01T00:00:00Z", "raw_window.end": "2001-06-01T00:00:00Z",
        "matured_window.start": "1995-02-27T00:00:00Z", "matured_window.end": "2001-05-30T00:00:00Z"}.items()]
    parts += [leaf_sql("'lookback_days'", str(DAYS), "(SELECT 1) x"), leaf_sql("'maturation_offset_hours'", str(OFFSET), "(SELECT 1) x")]
    for window in ("raw", "matured"):
        leaves = {**COUNTED, **{f"classification_readiness_breakdown.{c}": c for c in STATES},
                  **({r: r for r in RATES} if window == "matured" else {})}
        parts += [leaf_sql(f"'{window}_metrics.{k}'", c, f"(SELECT * FROM funnel WHERE window_name = '{window}') f{n}")
                  for n, (k, c) in enumerate(leaves.items())]
    for n, stage in enumerate(C.LATENCY_STAGES):
        place = "pipeline_lead_time_seconds" if n == 0 else f"stage_latency_breakdown_seconds.{stage}"
        parts += [leaf_sql(f"'raw_latency_metrics.{place}.{c}'", f"(SELECT {c} FROM latency WHERE stage = '{stage}')", "(SELECT 1) x")
                  for c in ("average", "median", "p90")]
    parts += [leaf_sql(f"'published_by_language.' || language_code || '.{c}'", c, "coverage") for c in ("published_count", "coverage_rate")]
    parts.append(leaf_sql("'data_quality_anomalies.' || code", "count", "anomaly", "item_samples"))
    series = AN.SERIES_SQL.replace(AN.START_SQL, f"(started_at >= TIMESTAMP '{ITEM_WINDOW[0]}' AND started_at < TIMESTAMP '{ITEM_WINDOW[1]}')")
    coverage = AN.coverage_sql(AN.ELIGIBLE_SQL.replace(ITEM_SQL, MATURED), True)
    samples = "array_to_string(list_slice(list(source_item_id ORDER BY source_item_id), 1, 10), ',')"
    return f"""
WITH funnel AS MATERIALIZED ({FUNNEL}),
latency AS MATERIALIZED (SELECT stage, {AN.PCT_SQL} FROM ({series}) s GROUP BY stage),
coverage AS MATERIALIZED ({coverage}),
anomaly AS MATERIALIZED (SELECT code, count(*) AS count, {samples} AS item_samples FROM ({AN.ANOMALY_SQL}) a GROUP BY code)
""" + " UNION ALL ".join(parts)


def leaves_of(column: str, kind) -> list:
    """(path, number, text) structs of all leaves of a struct column."""
    if isinstance(kind, T.StructType):
        return [x for f in kind for x in leaves_of(f"{column}.{f.name}", f.dataType)]
    text = isinstance(kind, T.StringType)
    return [F.struct(F.lit(column).alias("leaf"), (F.lit(None) if text else F.col(column)).cast("double").alias("number"),
                     (F.col(column) if text else F.lit(None)).cast("string").alias("shown"))]


@query("funnel_document", "REP-1 SNK-10", document_sql())
def _(t):
    path = folder(t)
    # Flags, coverage and latencies all start from the outputs, so their aggregate over the lines is stored once.
    t.keep("b_translation", f"{folder(t)}/translation", "parent_content_id", "source_item_id", "language_code",
           "translation_status", "model_name", "prompt_version", "source_fingerprint", "translated_at", "line_status")
    document = P.funnel_document(frames(t), t.b_lang, ITEM_WINDOW[1], DAYS, "2001-06-01T00:00:00Z", OFFSET)
    E.emit_report(document, path)
    doc = t.spark.read.schema(document.schema).json(path)
    plain = [f for f in doc.schema if not isinstance(f.dataType, T.ArrayType)]
    def of_language(c):
        return F.transform("published_by_language", lambda x: F.struct(
            F.concat(F.lit("published_by_language."), x["language_code"], F.lit(f".{c}")).alias("leaf"),
            x[c].cast("double").alias("number"), F.lit(None).cast("string").alias("shown")))
    anomalies = F.transform("data_quality_anomalies", lambda x: F.struct(
        F.concat(F.lit("data_quality_anomalies."), x["code"]).alias("leaf"), x["count"].cast("double").alias("number"),
        F.array_join(x["item_samples"].cast("array<string>"), ",").alias("shown")))
    listed = F.concat(of_language("published_count"), of_language("coverage_rate"), anomalies)
    every = F.concat(F.array(*[x for f in plain for x in leaves_of(f.name, f.dataType)]), listed)
    return rounded(doc.select(F.inline(every)))


@query("classify_report", "REP-3", f"""
SELECT source_id, count(class_id) AS classify_volume, {AN.REL},
       ROUND(avg(classification_confidence), 6) AS average_confidence, {AN.DENSITY}, {AN.SHARES},
       (SELECT CAST(coalesce(sum(length(title) + sanitized_text_length), 0) AS BIGINT)
        FROM ({AN.WIDE_SQL}) v WHERE v.source_id = w.source_id AND {ITEM_SQL} AND {READY_SQL})
       AS classification_character_volume_proxy
FROM ({AN.WIDE_SQL}) w WHERE {ITEM_SQL} AND class_id IS NOT NULL GROUP BY source_id""")
def _(t):
    return rounded(P.classify_breakdown(t.b_item, t.b_text, t.b_class, IW))


@query("translation_report", "REP-4", f"""
SELECT l.language_code, s.success_rate AS translation_success_rate,
       d.completion_rate AS translation_completion_rate, w.avg_latency AS average_latency_seconds,
       s.stale_rate, coalesce(w.chars, 0) AS translation_character_volume_proxy
FROM b_lang l LEFT JOIN (SELECT language_code, {AN.OK_SQL}, {AN.STALE_SQL} FROM b_translation
    WHERE {AN.UPDATED_SQL} GROUP BY language_code) s ON s.language_code = l.language_code
LEFT JOIN ({AN.LANG_DONE_SQL}) d ON d.language_code = l.language_code
LEFT JOIN (SELECT tr.language_code, {AN.LAT_SQL}, CAST(sum({AN.FIVE_SQL.format('a.')}) AS BIGINT)
    AS chars FROM {AN.OUTPUTS_SQL} GROUP BY tr.language_code) w ON w.language_code = l.language_code""")
def _(t):
    return rounded(P.translation_breakdown(t.b_item, t.b_decision, t.b_approved, t.b_translation,
                                           t.b_lang, IW))


@query("translation_report_totals", "REP-4", f"""
SELECT (SELECT {AN.OK_SQL} FROM b_translation WHERE {AN.UPDATED_SQL}) AS success_rate,
       ({AN.ARTICLE_DONE_SQL}) AS translation_completion_rate,
       (SELECT {AN.LAT_SQL} FROM {AN.OUTPUTS_SQL}) AS avg_latency""")
def _(t):
    return rounded(P.translation_metrics(t.b_item, t.b_decision, t.b_approved, t.b_translation,
                                         LANGS, IW))


@query("curation_report", "REP-5", f"""
SELECT q.approval_rate, q.char_volume, d.average, d.median, d.p90 FROM (
  SELECT ROUND(avg(CASE WHEN curate_status = 'approved' THEN 1.0 ELSE 0.0 END), 6) AS approval_rate,
         CAST(coalesce(sum(CASE WHEN text_id IS NOT NULL THEN length(title) + sanitized_text_length END),
              0) AS BIGINT) AS char_volume
  FROM ({AN.WIDE_SQL}) w WHERE {ITEM_SQL} AND decision_id IS NOT NULL) q
CROSS JOIN (SELECT {AN.PCT_SQL} FROM ({AN.SERIES_SQL}) s WHERE stage = 'curation_delay') d""")
def _(t):
    return rounded(P.curation_metrics(t.b_item, t.b_text, t.b_class, t.b_decision, IW))


@query("ingest_report", "REP-6", f"""
SELECT (SELECT ROUND(avg(CASE WHEN outcome = 'success' THEN 1.0 ELSE 0.0 END), 6) FROM b_attempt
        WHERE {AN.START_SQL}) AS fetch_success_rate,
       (SELECT ROUND(CAST(sum(succeeded_source_count) AS DOUBLE) / sum(attempted_source_count), 6)
        FROM b_run WHERE {AN.START_SQL}) AS run_success_rate,
       count(*) AS total_ingested_items,
       ROUND(avg(CASE WHEN text_processing_status = 'low_context' THEN 1.0 ELSE 0.0 END), 6)
       AS low_context_observation_rate FROM ({AN.WIDE_SQL}) w WHERE {ITEM_SQL}""")
def _(t):
    return rounded(P.ingest_metrics(t.b_item, t.b_text, t.b_attempt, t.b_run, IW, EW))


@query("publishing_report", "REP-7", f"""
SELECT c.language_code, c.coverage_rate, d.average, d.median, d.p90
FROM ({AN.coverage_sql(AN.ACTIVE_SQL, False)}) c LEFT JOIN (
  SELECT language_code, {AN.PCT_SQL} FROM ({AN.SERIES_SQL}) s WHERE stage = 'publish_delay'
  GROUP BY language_code) d ON d.language_code = c.language_code""")
def _(t):
    return rounded(P.publishing_breakdown(t.b_lang, t.b_item, t.b_decision, t.b_approved,
                                          t.b_translation, t.b_publish, t.b_publish_status, IW))


@query("emitted_reports", "SNK-10", f"""
SELECT 'classify' AS report_type, '2.0.0' AS schema_version, count(DISTINCT source_id) AS breakdowns
FROM ({AN.WIDE_SQL}) w WHERE {ITEM_SQL} AND class_id IS NOT NULL
UNION ALL SELECT 'sources', '2.0.0', count(*) FROM ({AN.SOURCE_REPORT_SQL}) s
UNION ALL SELECT 'translation', '1.0.0', count(*) FROM b_lang
UNION ALL SELECT 'curation_diagnostics', '2.0.0', NULL""")
def _(t):
    path, now = folder(t), "2001-06-01T00:00:00Z"
    # Rates, completion, volume and latency read the outputs, so their aggregate over the lines is stored once.
    t.keep("b_translation", f"{folder(t)}/translation")
    docs = {
        "classify": P.document("classify", "2.0.0", now, IW, P.classify_metrics(
            t.b_item, t.b_text, t.b_class, IW), P.classify_breakdown(t.b_item, t.b_text, t.b_class,
                                                                     IW)),
        "sources": P.document("sources", "2.0.0", now, IW, C.ingest_quality(t.b_item, t.b_text, IW),
                              AN.source_report(t)),
        "translation": P.document("translation", "1.0.0", now, IW, P.translation_metrics(
            t.b_item, t.b_decision, t.b_approved, t.b_translation, LANGS, IW),
            P.translation_breakdown(t.b_item, t.b_decision, t.b_approved, t.b_translation, t.b_lang,
                                    IW)),
        "curation": P.document("curation_diagnostics", "2.0.0", now, IW, P.curation_metrics(
            t.b_item, t.b_text, t.b_class, t.b_decision, IW))}
    for name, doc in docs.items():
        E.emit_report(doc, f"{path}/{name}")
    rows = t.spark.read.schema("report_type string, schema_version string, "
                               "breakdowns array<struct<source_id: long>>").json(
        [f"{path}/{name}" for name in docs])
    return rows.select("report_type", "schema_version", F.when(
        F.col("breakdowns").isNotNull(), F.size("breakdowns")).alias("breakdowns"))
