"""Contracts of model responses: every row gets ``is_valid`` and the first ``reason``.

JSON is read as VARIANT, so the type of each value is known and ``true`` is never taken for 1.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pressline import fixed_values as V
from pressline.functions import content as K
from pressline.functions.titles import blank


def first_failure(*rules: tuple[Column, str]) -> Column:
    """Reason of the first broken rule; NULL conditions do not break a rule."""
    chain = None
    for broken, reason in rules:
        chain = F.when(broken, reason) if chain is None else chain.when(broken, reason)
    return chain


def judged(rows: DataFrame, reason: Column) -> DataFrame:
    return rows.withColumn("reason", reason).withColumn("is_valid", F.col("reason").isNull())


# --- reading values with their types -------------------------------------------------------------------

def kind(v: Column, path: str) -> Column:
    """Type name of the value at a path: OBJECT, ARRAY, STRING, BOOLEAN, numbers; VOID for null,
    SQL NULL when the path is absent."""
    return F.regexp_extract(F.schema_of_variant(F.variant_get(v, path, "variant")), "^[A-Z]+", 0)


def text_at(v: Column, path: str) -> Column:
    """The string at a path, NULL for every other type."""
    return F.when(kind(v, path) == "STRING", F.try_variant_get(v, path, "string"))


def number_at(v: Column, path: str) -> Column:
    return F.when(kind(v, path).isin("BIGINT", "DOUBLE", "DECIMAL"),
                  F.try_variant_get(v, path, "double"))


def absent(v: Column, path: str) -> Column:
    return kind(v, path).isNull()


def present(v: Column, path: str) -> Column:
    """Neither absent nor null."""
    return F.coalesce(kind(v, path) != "VOID", F.lit(False))


def not_in(c: Column, allowed: list[str]) -> Column:
    return c.isNull() | ~c.isin(allowed)


def too_long(c: Column, limit: int) -> Column:
    return c.isNull() | (F.length(c) > limit)


# --- envelope ----------------------------------------------------------------------------------------------

def open_envelope(rows: DataFrame, column: str = "response") -> DataFrame:
    """Outcome of the transport envelope and the message content.

    ``outcome``: ok, invalid_json, empty_choices, malformed_choice, malformed_message, refused,
    empty_content.
    """
    v = F.try_parse_json(column)
    rows = rows.withColumn("_v", v)
    v = F.col("_v")
    size = F.size(F.try_variant_get(v, "$.choices", "array<variant>"))
    refusal = F.try_variant_get(v, "$.choices[0].message.refusal", "string")
    content = text_at(v, "$.choices[0].message.content")
    reason = first_failure(
        (v.isNull() | (kind(v, "$") != "OBJECT"), "invalid_json"),
        ((F.coalesce(kind(v, "$.choices"), F.lit("")) != "ARRAY") | (F.coalesce(size, F.lit(0)) < 1),
         "empty_choices"),
        (F.coalesce(kind(v, "$.choices[0]"), F.lit("")) != "OBJECT", "malformed_choice"),
        (F.coalesce(kind(v, "$.choices[0].message"), F.lit("")) != "OBJECT", "malformed_message"),
        (F.coalesce(F.length(refusal), F.lit(0)) > 0, "refused"),
        (blank(content), "empty_content"))
    return (rows.withColumn("outcome", F.coalesce(reason, F.lit("ok")))
            .withColumn("content", F.when(reason.isNull(), content)).drop("_v"))


# --- classification ------------------------------------------------------------------------------------------

CLASSIFICATION_FIELDS = ["topic_class", "classification_confidence", "classification_reason",
                         "content_density", "source_text_quality", "primary_language_code",
                         "governmental_involvement"]


def check_classification(rows: DataFrame, column: str = "content") -> DataFrame:
    """Classification contract with the stable fields and the allow-listed signals of valid rows."""
    rows = rows.withColumn("_v", F.try_parse_json(column))
    v = F.col("_v")
    missing = [(absent(v, f"$.{f}"), f"missing {f}") for f in CLASSIFICATION_FIELDS]
    confidence, gov = number_at(v, "$.classification_confidence"), number_at(
        v, "$.governmental_involvement")
    timely, evidence = text_at(v, "$.content_timeliness"), text_at(v, "$.primary_evidence_type")
    reason = first_failure(
        (v.isNull() | (kind(v, "$") != "OBJECT"), "not an object"), *missing,
        (not_in(text_at(v, "$.topic_class"), V.TOPIC_CLASSES), "topic_class"),
        (confidence.isNull() | (confidence < 0) | (confidence > 1), "classification_confidence"),
        (not_in(text_at(v, "$.content_density"), V.CONTENT_DENSITIES), "content_density"),
        (not_in(text_at(v, "$.source_text_quality"), V.TEXT_QUALITIES), "source_text_quality"),
        (gov.isNull() | ~gov.isin(0.0, 1.0), "governmental_involvement"),
        (blank(text_at(v, "$.primary_language_code")), "primary_language_code"),
        (too_long(text_at(v, "$.classification_reason"), 300), "classification_reason"),
        (present(v, "$.content_timeliness") & not_in(timely, V.TIMELINESS_VALUES),
         "content_timeliness"),
        (present(v, "$.primary_evidence_type") & not_in(evidence, V.EVIDENCE_VALUES),
         "primary_evidence_type"))
    rows = judged(rows, reason)
    ok = F.col("is_valid")

    def when_ok(c: Column) -> Column:
        return F.when(ok, c)

    return (rows.withColumn("topic_class", when_ok(text_at(v, "$.topic_class")))
            .withColumn("classification_confidence", when_ok(confidence))
            .withColumn("content_density", when_ok(text_at(v, "$.content_density")))
            .withColumn("source_text_quality", when_ok(text_at(v, "$.source_text_quality")))
            .withColumn("primary_language_code", when_ok(text_at(v, "$.primary_language_code")))
            .withColumn("governmental_involvement", when_ok(gov.cast("int")))
            .withColumn("additional_signals", when_ok(F.to_json(F.struct(
                timely.alias("content_timeliness"), evidence.alias("primary_evidence_type")))))
            .drop("_v"))


# --- curation --------------------------------------------------------------------------------------------------

BRIEF_FIELDS = ["brief_goal", "target_format", "risk_flags", "tone_guidance"]


def check_curation(rows: DataFrame, column: str = "content") -> DataFrame:
    """Curation matrix: status, action, brief and output must fit together."""
    rows = rows.withColumn("_v", F.try_parse_json(column))
    v = F.col("_v")
    d, b, o = "$.curation_decision", "$.editor_brief", "$.curation_output"
    status, action = text_at(v, f"{d}.curate_status"), text_at(v, f"{d}.downstream_action")

    def object_at(path):
        return F.coalesce(kind(v, path) == "OBJECT", F.lit(False))

    publish = action.isin(V.PUBLISH_ACTIONS)
    briefed = publish | (action == "edit_rewrite")
    form = text_at(v, f"{b}.target_format")
    wanted = F.when(action == "publish_link", F.array(F.lit("link_card"))).when(
        action == "publish_summary", F.array(F.lit("structured_summary"))).otherwise(
        F.array(*map(F.lit, V.BRIEF_FORMATS)))
    bullets = [f"{o}.bullet_{i}" for i in (1, 2, 3)]
    any_bullet = reduce(lambda x, y: x | y, [present(v, p) for p in bullets])
    no_bullet = reduce(lambda x, y: x | y, [absent(v, p) for p in bullets])
    bad_bullet = reduce(lambda x, y: x | y, [blank(text_at(v, p)) for p in bullets])
    reason = first_failure(
        (v.isNull() | (kind(v, "$") != "OBJECT"), "not an object"),
        (absent(v, d), "missing curation_decision"),
        (~object_at(d), "curation_decision"),
        *[(absent(v, f"{d}.{f}"), f"missing {f}")
          for f in ("curate_status", "downstream_action", "decision_reason")],
        (not_in(status, ["approved", "rejected"]), "curate_status"),
        (not_in(action, V.DOWNSTREAM_ACTIONS), "downstream_action"),
        (too_long(text_at(v, f"{d}.decision_reason"), 250), "decision_reason"),
        ((status == "approved") & ~publish, "status and action"),
        ((status == "rejected") & publish, "status and action"),
        (absent(v, b), "missing editor_brief"), (absent(v, o), "missing curation_output"),
        ((action == "reject_discard") & present(v, b), "brief must be null"),
        (~publish & (action != "edit_rewrite") & present(v, o), "output must be null"),
        (briefed & ~object_at(b), "brief must be an object"),
        ((action == "edit_rewrite") & present(v, o), "output must be null"),
        (publish & ~object_at(o), "output must be an object"),
        *[(briefed & absent(v, f"{b}.{f}"), f"missing {f}") for f in BRIEF_FIELDS],
        (briefed & (form.isNull() | ~F.array_contains(wanted, form)), "target_format"),
        (briefed & (F.coalesce(kind(v, f"{b}.risk_flags"), F.lit("")) != "ARRAY"), "risk_flags"),
        *[(publish & absent(v, f"{o}.{f}"), f"missing {f}")
          for f in ("display_title", "summary_short")],
        ((action == "publish_summary") & no_bullet, "missing bullet"),
        (publish & too_long(text_at(v, f"{o}.display_title"), 250), "display_title"),
        (publish & too_long(text_at(v, f"{o}.summary_short"), 500), "summary_short"),
        ((action == "publish_link") & any_bullet, "bullets must be null"),
        ((action == "publish_summary") & bad_bullet, "bullets must be text"))
    return judged(rows, reason).drop("_v")


# --- translation ---------------------------------------------------------------------------------------------------

def check_translation(rows: DataFrame, column: str = "content", ratio_limit: float = 3.0) -> DataFrame:
    """Translation contract against the source row.

    Needs language_code, max_title_length, summary_short and bullet_1..3 of the source.
    """
    rows = rows.withColumn("_v", F.try_parse_json(column))
    v = F.col("_v")
    names = ["title", "summary", "bullet_1", "bullet_2", "bullet_3"]
    title, summary, *bullets = [text_at(v, f"$.translated_{n}") for n in names]
    source = [F.col(f"bullet_{i}") for i in (1, 2, 3)]
    ratio = K.length_ratio([summary, *bullets], [F.col("summary_short"), *source])
    lang = F.col("language_code")
    body = F.concat(summary, *[F.coalesce(b, F.lit("")) for b in bullets])
    labelled = reduce(lambda x, y: x | y, [K.has_guarded_label(c) for c in (summary, *bullets)])
    shape = []
    for i, (src, out) in enumerate(zip(source, bullets), start=1):
        path = f"$.translated_bullet_{i}"
        shape += [(present(v, path) & blank(out), f"bullet_{i} is no text"),
                  (src.isNull() & present(v, path), f"bullet_{i} must be null"),
                  (src.isNotNull() & ~present(v, path), f"bullet_{i} must be text")]
    reason = first_failure(
        (v.isNull() | (kind(v, "$") != "OBJECT"), "not an object"),
        *[(absent(v, f"$.translated_{n}"), f"missing translated_{n}") for n in names],
        (blank(title), "title"), (blank(summary), "summary"), *shape,
        (F.length(title) > F.col("max_title_length"), "title too long"),
        ((lang == "ja") & (F.length(title) > V.JA_TITLE_LIMIT), "japanese title too long"),
        (ratio > ratio_limit, "length ratio"),
        (~K.script_ok(lang, body), "script"),
        (lang.isin("zh", "ja") & labelled, "label prefix"))
    return judged(rows, reason).drop("_v")
