"""Declared schemas of the canonical tables and their check rules."""

from __future__ import annotations

from pyspark.sql import types as T

from pressline import fixed_values as V

_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
    "timestamp": T.TimestampType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "strings": T.ArrayType(T.StringType()),
}


def _table(text: str) -> T.StructType:
    """``name type`` per line; a trailing ``?`` marks a nullable column."""
    fields = []
    for line in text.split(","):
        name, kind = line.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("?")], kind.endswith("?")))
    return T.StructType(fields)


TABLES: dict[str, T.StructType] = {
    "source_state": _table(
        "source_id long, last_fetch_at timestamp?, last_success_at timestamp?, last_http_status int?,"
        "consecutive_failures int, last_error_class string?, last_error_at timestamp?,"
        "health_status string, quarantine_until timestamp?"),
    "fetch_run": _table(
        "fetch_run_id long, started_at timestamp, ended_at timestamp?, run_scope string,"
        "trigger_type string, run_status string, due_source_count int, attempted_source_count int,"
        "succeeded_source_count int, failed_source_count int, error_summary string?"),
    "fetch_attempt": _table(
        "fetch_attempt_id long, fetch_run_id long, source_id long, started_at timestamp,"
        "ended_at timestamp?, http_status int?, error_class string?, outcome string,"
        "new_item_count int, dedup_matched_count int, low_context_count int,"
        "sanitization_failure_count int, normalization_failure_count int"),
    "source_item": _table(
        "source_item_id long, source_id long, source_item_guid string?, canonical_url string?,"
        "title string, published_at timestamp?, fetched_at timestamp, ingest_dedup_key string,"
        "dedup_rule string"),
    "source_item_text": _table(
        "source_item_id long, sanitized_text string, sanitization_method string,"
        "html_detected boolean, was_truncated boolean, text_processing_status string,"
        "text_processing_reason string?, raw_text_length long?, sanitized_text_length long,"
        "reduction_ratio double?"),
    "source_item_raw": _table(
        "source_item_id long, raw_payload string, retention_class string, expires_at timestamp?,"
        "created_at timestamp"),
    "ingest_dedup_marker": _table(
        "dedup_key string, dedup_rule string, source_item_id long, created_at timestamp"),
    "classification_result": _table(
        "source_item_id long, topic_class string, classification_reason string?,"
        "classification_confidence double?, content_density string?, source_text_quality string?,"
        "primary_language_code string?, governmental_involvement int?, additional_signals string?,"
        "model_name string, prompt_version string, classified_at timestamp, created_at timestamp"),
    "curation_decision": _table(
        "source_item_id long, curate_status string, downstream_action string?,"
        "decision_reason string?, decision_actor string, retry_count int, model_name string,"
        "prompt_version string, curated_at timestamp, created_at timestamp, updated_at timestamp"),
    "editor_brief": _table(
        "source_item_id long, brief_goal string, target_format string, key_claim string?,"
        "key_evidence string?, required_context string?, risk_flags strings?, tone_guidance string,"
        "created_at timestamp, updated_at timestamp"),
    "curation_output": _table(
        "source_item_id long, display_title string, summary_short string, bullet_1 string?,"
        "bullet_2 string?, bullet_3 string?, created_at timestamp, updated_at timestamp"),
    "approved_content_record": _table(
        "parent_content_id long, source_item_id long, display_title string, summary_short string,"
        "bullet_1 string?, bullet_2 string?, bullet_3 string?, content_fingerprint string,"
        "content_language_code string, approved_at timestamp, author_metadata string?,"
        "created_at timestamp, updated_at timestamp"),
    "translation_output": _table(
        "parent_content_id long, source_item_id long, language_code string, display_title string?,"
        "summary_short string?, bullet_1 string?, bullet_2 string?, bullet_3 string?,"
        "source_fingerprint string, translation_status string, retry_count int, model_name string,"
        "prompt_version string, translated_at timestamp?, updated_at timestamp"),
    "publish_record": _table(
        "publish_record_id long, source_item_id long, slug string, first_published_at timestamp,"
        "updated_at timestamp"),
    "publish_language_status": _table(
        "publish_record_id long, language_code string, publish_status string,"
        "published_at timestamp?, withdrawn_at timestamp?, source_fingerprint string"),
    "publish_archive_metadata": _table(
        "language_code string, archive_month string, updated_at timestamp"),
}

KEYS: dict[str, list[list[str]]] = {
    "source_state": [["source_id"]],
    "fetch_run": [["fetch_run_id"]],
    "fetch_attempt": [["fetch_attempt_id"], ["fetch_run_id", "source_id"]],
    "source_item": [["source_item_id"], ["ingest_dedup_key"]],
    "source_item_text": [["source_item_id"]],
    "ingest_dedup_marker": [["dedup_key"]],
    "classification_result": [["source_item_id"]],
    "curation_decision": [["source_item_id"]],
    "editor_brief": [["source_item_id"]],
    "curation_output": [["source_item_id"]],
    "approved_content_record": [["parent_content_id"], ["source_item_id"]],
    "translation_output": [["parent_content_id", "language_code"]],
    "publish_record": [["publish_record_id"], ["source_item_id"], ["slug"]],
    "publish_language_status": [["publish_record_id", "language_code"]],
    "publish_archive_metadata": [["language_code", "archive_month"]],
}

PARENTS: list[tuple[str, str, str]] = [
    ("fetch_attempt", "fetch_run_id", "fetch_run"),
    ("source_item_text", "source_item_id", "source_item"),
    ("source_item_raw", "source_item_id", "source_item"),
    ("ingest_dedup_marker", "source_item_id", "source_item"),
    ("classification_result", "source_item_id", "source_item"),
    ("curation_decision", "source_item_id", "source_item"),
    ("editor_brief", "source_item_id", "source_item"),
    ("curation_output", "source_item_id", "source_item"),
    ("approved_content_record", "source_item_id", "source_item"),
    ("translation_output", "parent_content_id", "approved_content_record"),
    ("publish_record", "source_item_id", "source_item"),
    ("publish_language_status", "publish_record_id", "publish_record"),
]


def _in(column: str, values: list[str], nullable: bool = False) -> str:
    body = f"{column} IN ({', '.join(repr(v) for v in values)})"
    return f"({column} IS NULL OR {body})" if nullable else body


CHECKS: dict[str, dict[str, str]] = {
    "source_state": {
        "health_status": _in("health_status", V.HEALTH_STATUSES),
        "last_error_class": _in("last_error_class", V.STORABLE_ERRORS, True)},
    "fetch_run": {
        "trigger_type": _in("trigger_type", V.TRIGGER_TYPES),
        "run_status": _in("run_status", V.RUN_STATUSES)},
    "fetch_attempt": {
        "outcome": _in("outcome", V.ATTEMPT_OUTCOMES),
        "error_class": _in("error_class", V.STORABLE_ERRORS, True)},
    "source_item": {"dedup_rule": _in("dedup_rule", V.DEDUP_RULES)},
    "source_item_text": {
        "text_processing_status": _in("text_processing_status", V.TEXT_STATUSES),
        "text_processing_reason": _in("text_processing_reason", V.TEXT_REASONS, True)},
    "ingest_dedup_marker": {"dedup_rule": _in("dedup_rule", V.MARKER_RULES)},
    "classification_result": {
        "topic_class": _in("topic_class", V.TOPIC_CLASSES),
        "classification_confidence":
            "classification_confidence IS NULL OR classification_confidence BETWEEN 0 AND 1",
        "content_density": _in("content_density", V.CONTENT_DENSITIES, True)},
    "curation_decision": {
        "curate_status": _in("curate_status", V.CURATE_STATUSES),
        "retry_count": "retry_count >= 0",
        "status_action":
            "CASE curate_status WHEN 'failed' THEN downstream_action IS NULL "
            "WHEN 'rejected' THEN " + _in("coalesce(downstream_action, '')", V.REJECT_ACTIONS)
            + " ELSE " + _in("coalesce(downstream_action, '')", V.PUBLISH_ACTIONS) + " END"},
    "translation_output": {
        "translation_status": _in("translation_status", V.TRANSLATION_STATUSES),
        "retry_count": "retry_count >= 0"},
    "publish_language_status": {"publish_status": _in("publish_status", V.PUBLISH_STATUSES)},
}
