"""Response and payload contracts on literal rows."""

import json
import uuid

from pressline.functions.sources import analysis_flags, quadrant
from pressline.operators import audits as A
from pressline.operators import curation as U
from pressline.operators import requests as Q
from pressline.operators import responses as P
from pyspark.sql import functions as F

GOOD = {"topic_class": "core", "classification_confidence": 1, "classification_reason": "r",
        "content_density": "low", "source_text_quality": "usable", "primary_language_code": "en",
        "governmental_involvement": 0, "content_timeliness": "current", "primary_evidence_type": None,
        "extra": 5}


def reasons(spark, check, bodies, **columns):
    df = spark.createDataFrame([(i, b if isinstance(b, str) or b is None else json.dumps(b))
                                for i, b in enumerate(bodies)], "i int, content string")
    for name, value in columns.items():
        df = df.withColumn(name, F.lit(value))
    return [r.reason for r in check(df).orderBy("i").collect()]


def test_classification(spark):
    bodies = [GOOD, {**GOOD, "classification_confidence": True}, {**GOOD, "governmental_involvement": True},
              {**GOOD, "governmental_involvement": 1.0}, {**GOOD, "primary_language_code": " "},
              {**GOOD, "classification_reason": "x" * 301}, {**GOOD, "topic_class": 3},
              {**GOOD, "content_timeliness": "soon"}, "[]", "oops", None,
              {k: v for k, v in GOOD.items() if k != "content_density"}]
    assert reasons(spark, P.check_classification, bodies) == [
        None, "classification_confidence", "governmental_involvement", None, "primary_language_code",
        "classification_reason", "topic_class", "content_timeliness", "not an object",
        "not an object", "not an object", "missing content_density"]


def test_classification_extracts_only_known_signals(spark):
    df = spark.createDataFrame([(json.dumps(GOOD),)], "content string")
    row = P.check_classification(df).first()
    assert row.is_valid and row.governmental_involvement == 0
    assert json.loads(row.additional_signals) == {"content_timeliness": "current"}


def curated(status="approved", action="publish_link", brief="link_card", output=None, **change):
    b = None if brief is None else {"brief_goal": "g", "target_format": brief, "risk_flags": [],
                                    "tone_guidance": "t"}
    return {"curation_decision": {"curate_status": status, "downstream_action": action,
                                  "decision_reason": "r"},
            "editor_brief": b, "curation_output": output, **change}


def test_curation(spark):
    out = {"display_title": "t", "summary_short": "s"}
    three = {**out, "bullet_1": "a", "bullet_2": "b", "bullet_3": "c"}
    bodies = [curated(output=out), curated(output=three), curated(action="publish_summary",
              brief="structured_summary", output=three), curated(action="publish_summary",
              brief="structured_summary", output={**three, "bullet_2": " "}),
              curated("rejected", "edit_rewrite", output=out), curated("rejected", "edit_rewrite"),
              curated("rejected", "reject_discard", None), curated("rejected", "reject_discard"),
              curated("rejected"), curated(output={**out, "display_title": "x" * 251}),
              curated(output=out, curation_decision="x"), {"editor_brief": None}]
    assert reasons(spark, P.check_curation, bodies) == [
        None, "bullets must be null", None, "bullets must be text", "output must be null", None,
        None, "brief must be null", "status and action", "display_title", "curation_decision",
        "missing curation_decision"]


def translated(**change):
    return {"translated_title": "題", "translated_summary": "漢字です", "translated_bullet_1": None,
            "translated_bullet_2": None, "translated_bullet_3": None, **change}


def test_translation(spark):
    bodies = [translated(), translated(translated_summary="漢字" * 20), translated(translated_title=""),
              translated(translated_bullet_1="x"), translated(translated_title="x" * 121),
              translated(translated_summary="漢字"), translated(translated_summary="Key Claim: です")]
    got = reasons(spark, P.check_translation, bodies, language_code="ja", max_title_length=250,
                  summary_short="some text", bullet_1=None, bullet_2=None, bullet_3=None)
    assert got == [None, "length ratio", "title", "bullet_1 must be null", "japanese title too long",
                   "script", "label prefix"]


def test_quadrants_and_flags(spark):
    rows = spark.createDataFrame([
        (1, 0.9, 10, 0.5, 0.2, 1, False), (2, 0.9, 10, 0.3, 0.2, 2, False),
        (3, None, 10, 0.5, 0.01, 3, False), (4, 0.5, 10, 0.1, 0.01, None, True),
        (5, 0.4, 10, 0.5, 0.2, 1, True), (6, 0.9, 0, None, None, 2, False)],
        "id int, fetch_success_rate double, ingest_volume long, relevance_rate double, "
        "overall_yield double, category_id int, is_unknown_source boolean")
    got = {r.id: (r.q, r.f) for r in rows.select("id", quadrant().alias("q"),
                                                 analysis_flags().alias("f")).collect()}
    assert got == {1: ("golden_source", ["AUTHORITY"]), 2: ("needle_in_a_haystack", []),
                   3: ("filtering_burden", ["AUTHORITY"]), 4: ("dead_weight", ["INSUFFICIENT_DATA"]),
                   5: (None, ["AUTHORITY", "INSUFFICIENT_DATA", "CONNECTION_DIAGNOSTICS"]),
                   6: (None, ["INSUFFICIENT_DATA"])}


def test_prompt_slots_inside_values_stay(spark):
    df = spark.createDataFrame([(1, "a {sanitized_text} {{x}}", "b \"q\"")],
                               "source_item_id long, title string, sanitized_text string")
    s = Q.RequestSettings("m", "sys", "T={title};{sanitized_text}{{end}}", top_p=0.1)
    row = Q.classification_requests(df, s).first()
    assert row.prompt == 'T=a {sanitized_text} {{x}};b "q"{end}'
    body = json.loads(row.request)
    assert body["top_p"] == 0.1 and body["messages"][1]["content"] == row.prompt
    assert body["response_format"] == {"type": "json_object"}


def test_file_names_and_snapshot_names(spark):
    df = spark.createDataFrame([("archive_2024_01.json",), ("../x.json",), ("a..json",), ("x.txt",), (None,)],
                               "n string")
    assert [r.s for r in df.select(A.safe_file_name(F.col("n")).alias("s")).collect()] == [
        True, False, False, False, False]
    names = spark.createDataFrame([("2024-01-01T00-00-00Z-r2", "2024-02-30T00:00:00Z"),
                                   ("2024-01-01T00:00:00Z", "2024-02-29T00:00:00Z")], "n string, m string")
    assert [(r.valid_id, r.valid_time) for r in A.snapshot_names_audit(names, "n", "m").collect()] == [
        (True, False), (False, True)]


def test_upsert_keeps_the_first_creation_time(spark):
    old = spark.createDataFrame([(1, "a", 10, 10), (2, "b", 10, 10)], "k long, v string, at int, created_at int")
    new = spark.createDataFrame([(1, "c", 20, 20), (3, "x", 5, 5), (3, "y", 9, 9)], old.schema)
    got = {tuple(r) for r in U.upsert(old, new, ["k"], "at", ["created_at"]).collect()}
    assert got == {(1, "c", 20, 10), (2, "b", 10, 10), (3, "y", 9, 5)}


def test_constraints_are_judged_without_a_copy_of_the_tables(spark, monkeypatch):
    from pressline.catalog import QUERIES, canonical
    made = []
    monkeypatch.setattr(canonical, "folder", lambda t: made.append(t) or f"/tmp/{uuid.uuid4().hex}")
    QUERIES["table_violations"](spark, "/root/testdata/sf0.001")
    assert not made
