"""Queues, state changes, requests and response contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressline.catalog.helpers import LANGS, READY_SQL, TOPIC_SQL, iso_sql, text_times
from pressline.catalog.registry import query
from pressline.functions import content as K
from pressline.operators import curation as U
from pressline.operators import fetch as X
from pressline.operators import requests as Q
from pressline.operators import responses as P
from pressline.operators import translate as T

NOW = "2002-01-01 00:00:00"
NOW_SQL = "TIMESTAMP '2002-01-01 00:00:00'"
CLOCK = "2024-01-31 00:00:00"
CLOCK_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


# --- queues ---------------------------------------------------------------------------------------------

PENDING_CLASS_SQL = f"""
SELECT i.source_item_id, i.title, t.sanitized_text FROM b_item i
JOIN b_text t ON t.source_item_id = i.source_item_id
WHERE {READY_SQL} AND NOT EXISTS (SELECT 1 FROM b_class c
                                  WHERE c.source_item_id = i.source_item_id)"""


@query("pending_classification", "JOIN-3", PENDING_CLASS_SQL)
def _(t):
    return U.pending_classification(t.b_item, t.b_text, t.b_class)


@query("classification_batch", "SORT-5 JOIN-3",
       PENDING_CLASS_SQL + " ORDER BY i.source_item_id LIMIT 200")
def _(t):
    return U.pending_classification(t.b_item, t.b_text, t.b_class, 200)


VIEW_SQL = f"""
SELECT i.source_item_id, i.title AS raw_title, i.canonical_url, t.sanitized_text, c.topic_class,
       c.governmental_involvement
FROM b_item i JOIN b_text t ON t.source_item_id = i.source_item_id
JOIN b_class c ON c.source_item_id = i.source_item_id WHERE {TOPIC_SQL}"""
PENDING_CURATE_SQL = f"""
SELECT v.* FROM ({VIEW_SQL}) v LEFT JOIN b_decision d ON d.source_item_id = v.source_item_id
WHERE d.source_item_id IS NULL OR (d.curate_status = 'failed' AND d.retry_count < 3)"""


@query("pending_curation", "JOIN-4", PENDING_CURATE_SQL)
def _(t):
    return U.pending_curation(t.b_item, t.b_text, t.b_class, t.b_decision)


def wanted_items(t):
    """A request table: every order with an urgent line, forced when it was returned."""
    return t.lineitem.groupBy(F.col("l_orderkey").alias("source_item_id")).agg(
        F.max(F.col("l_returnflag") == "R").alias("force"))


WANTED_SQL = """SELECT l_orderkey AS source_item_id, bool_or(l_returnflag = 'R') AS force
FROM lineitem GROUP BY l_orderkey"""


@query("curation_item_lookup", "JOIN-5", f"""
SELECT * FROM ({VIEW_SQL}) v
WHERE source_item_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def _(t):
    view = U.curation_view(t.b_item, t.b_text, t.b_class)
    return U.find_items(view, wanted_items(t).filter("force"))


@query("curation_item_selection", "FLT-17", f"""
SELECT w.source_item_id, CASE WHEN v.source_item_id IS NULL THEN 'not_eligible'
       WHEN w.force OR d.source_item_id IS NULL
            OR (d.curate_status = 'failed' AND d.retry_count < 3) THEN 'selected'
       WHEN d.curate_status = 'failed' THEN 'locked' ELSE 'already_curated' END AS outcome
FROM ({WANTED_SQL}) w LEFT JOIN ({VIEW_SQL}) v ON v.source_item_id = w.source_item_id
LEFT JOIN b_decision d ON d.source_item_id = w.source_item_id""")
def _(t):
    view = U.curation_view(t.b_item, t.b_text, t.b_class)
    return U.select_items(wanted_items(t), view, t.b_decision).drop("force")


@query("curation_queue_counts", "AGG-45", f"""
SELECT (SELECT count(*) FROM b_class c JOIN b_item i ON i.source_item_id = c.source_item_id
        LEFT JOIN b_decision d ON d.source_item_id = c.source_item_id
        WHERE {TOPIC_SQL} AND (d.source_item_id IS NULL
              OR (d.curate_status = 'failed' AND d.retry_count < 3))) AS pending,
  count(*) FILTER (curate_status = 'failed' AND retry_count >= 3) AS locked,
  count(*) FILTER (curate_status = 'approved') AS approved_total,
  count(*) FILTER (curate_status = 'approved' AND downstream_action = 'publish_link') AS approved_link,
  count(*) FILTER (curate_status = 'approved' AND downstream_action = 'publish_summary') AS approved_summary,
  count(*) FILTER (curate_status = 'withdrawn') AS withdrawn_total,
  count(*) FILTER (curate_status = 'withdrawn' AND downstream_action = 'publish_link') AS withdrawn_link,
  count(*) FILTER (curate_status = 'withdrawn' AND downstream_action = 'publish_summary') AS withdrawn_summary,
  count(*) FILTER (curate_status = 'rejected') AS rejected_total,
  count(*) FILTER (curate_status = 'rejected' AND downstream_action = 'edit_rewrite') AS rejected_rewrite,
  count(*) FILTER (curate_status = 'rejected' AND downstream_action = 'reject_discard') AS rejected_discard,
  count(*) FILTER (curate_status = 'failed') AS failed_total
FROM b_decision""")
def _(t):
    return U.queue_counts(t.b_item, t.b_class, t.b_decision)


MATRIX_SQL = """
SELECT a.parent_content_id, a.source_item_id, a.approved_at, l.language_code,
       a.content_language_code, a.display_title, a.summary_short, a.bullet_1, a.bullet_2,
       a.bullet_3, a.content_fingerprint, coalesce(tr.translation_status, 'new') AS status,
       coalesce(tr.retry_count, 0) AS retry_count
FROM b_approved a CROSS JOIN b_lang l LEFT JOIN b_translation tr
  ON tr.parent_content_id = a.parent_content_id AND tr.language_code = l.language_code
WHERE tr.translation_status IS NULL OR tr.translation_status IN ('pending', 'stale')
   OR (tr.translation_status = 'failed' AND tr.retry_count < 3)"""


def tasks(t):
    return T.pending_tasks(t.b_approved, LANGS, t.b_translation)


@query("pending_translations", "JOIN-9", f"""
SELECT parent_content_id, language_code, status, retry_count, content_fingerprint
FROM ({MATRIX_SQL}) m""")
def _(t):
    return tasks(t).select("parent_content_id", "language_code", "status", "retry_count",
                           "content_fingerprint")


@query("translation_batch", "WIN-2", f"""
SELECT parent_content_id, language_code, status FROM ({MATRIX_SQL}) m
WHERE parent_content_id IN (SELECT parent_content_id FROM (
    SELECT DISTINCT approved_at, parent_content_id FROM ({MATRIX_SQL}) x
    ORDER BY approved_at, parent_content_id LIMIT 100) f)""")
def _(t):
    return T.take_batch(tasks(t), 100).select("parent_content_id", "language_code", "status")


@query("translation_task_selection", "FLT-17", f"""
SELECT w.source_item_id + 1000000 AS parent_content_id, l.language_code,
       CASE WHEN a.parent_content_id IS NULL THEN 'unknown_article'
            WHEN w.force OR tr.translation_status IS NULL
                 OR tr.translation_status IN ('pending', 'stale')
                 OR (tr.translation_status = 'failed' AND tr.retry_count < 3) THEN 'selected'
            WHEN tr.translation_status = 'failed' THEN 'locked' ELSE 'already_done' END AS outcome
FROM ({WANTED_SQL}) w CROSS JOIN b_lang l
LEFT JOIN b_approved a ON a.source_item_id = w.source_item_id
LEFT JOIN b_translation tr ON tr.parent_content_id = w.source_item_id + 1000000
     AND tr.language_code = l.language_code""")
def _(t):
    wanted = wanted_items(t).select((F.col("source_item_id") + 1000000).alias("parent_content_id"),
                                    "force", F.explode(F.array(*map(F.lit, LANGS)))
                                    .alias("language_code"))
    return T.select_tasks(wanted, t.b_approved, t.b_translation).select(
        "parent_content_id", "language_code", "outcome")


@query("translation_queue_status", "AGG-46", """
SELECT language_code, completed, pending_status, stale_status, failed_retryable, locked,
       greatest(articles - n, 0) AS no_translation,
       greatest(articles - n, 0) + pending_status + stale_status + failed_retryable AS pending_total
FROM (SELECT l.language_code, count(tr.parent_content_id) AS n,
        count(*) FILTER (translation_status = 'completed') AS completed,
        count(*) FILTER (translation_status = 'pending') AS pending_status,
        count(*) FILTER (translation_status = 'stale') AS stale_status,
        count(*) FILTER (translation_status = 'failed' AND retry_count < 3) AS failed_retryable,
        count(*) FILTER (translation_status = 'failed' AND retry_count >= 3) AS locked,
        (SELECT count(*) FROM b_approved) AS articles
      FROM b_lang l LEFT JOIN b_translation tr ON tr.language_code = l.language_code
      GROUP BY l.language_code) q""")
def _(t):
    return T.queue_status(t.b_approved, LANGS, t.b_translation)


@query("completed_languages", "AGG-48", """
SELECT DISTINCT language_code FROM b_translation WHERE translation_status = 'completed'""")
def _(t):
    return T.completed_languages(t.b_translation)


@query("absent_languages", "AGG-48", """
SELECT 'es' AS language_code FROM (SELECT count(*) AS n FROM b_translation
WHERE translation_status = 'completed' AND language_code = 'es') q WHERE n = 0""")
def _(t):
    more = t.b_lang.select("language_code").unionByName(
        t.spark.createDataFrame([("es",)], "language_code string"))
    return T.absent_languages(more, t.b_translation)


@query("approved_record_lookup", "JOIN-18", """
SELECT parent_content_id, source_item_id, content_fingerprint FROM b_approved
WHERE source_item_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def _(t):
    return T.find_approved(t.b_approved, wanted_items(t).filter("force"), "source_item_id").select(
        "parent_content_id", "source_item_id", "content_fingerprint")


@query("translation_lookup", "JOIN-18", """
SELECT parent_content_id, language_code, translation_status FROM b_translation
WHERE language_code = 'ja'
  AND source_item_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def _(t):
    wanted = wanted_items(t).filter("force").select(
        (F.col("source_item_id") + 1000000).alias("parent_content_id"),
        F.lit("ja").alias("language_code"))
    return T.find_outputs(t.b_translation, wanted).select(
        "parent_content_id", "language_code", "translation_status")


# --- source selection and health ---------------------------------------------------------------------------

@query("selected_sources", "FLT-10", """
SELECT source_id, fetch_group FROM b_source WHERE enabled = 1 AND fetch_group IN (1, 3)""")
def _(t):
    return X.select_sources(t.b_source, groups=[1, 3]).select("source_id", "fetch_group")


SKIP_SQL = f"""
SELECT m.source_id, CASE WHEN m.enabled = 0 THEN 'disabled'
   WHEN s.quarantine_until > {CLOCK_SQL} THEN 'quarantined'
   WHEN s.last_success_at IS NOT NULL
        AND (epoch({CLOCK_SQL}) - floor(epoch(s.last_success_at))) / 60.0
            < CASE m.schedule_class WHEN 'hourly' THEN 60 WHEN 'daily' THEN 1440 ELSE 4320 END
        THEN 'not_due' END AS skip_reason
FROM b_source m LEFT JOIN b_state s ON s.source_id = m.source_id"""


@query("skip_reasons", "FLT-11 FLT-12 FLT-13", SKIP_SQL)
def _(t):
    return X.skip_reasons(t.b_source, t.b_state, CLOCK).select("source_id", "skip_reason")


@query("forced_dry_run", "FLT-13", """
SELECT source_id, CASE WHEN enabled = 0 THEN 'disabled' ELSE 'dry_run' END AS skip_reason
FROM b_source""")
def _(t):
    return X.skip_reasons(t.b_source, t.b_state, CLOCK, force=True, dry_run=True).select(
        "source_id", "skip_reason")


@query("source_health_listing", "JOIN-15", f"""
SELECT m.source_id, m.title, coalesce(s.health_status, 'healthy') AS health_status,
       coalesce(s.consecutive_failures, 0) AS consecutive_failures, s.last_error_class,
       {iso_sql('s.quarantine_until')} AS quarantine_until,
       {iso_sql('s.last_success_at')} AS last_success_at
FROM b_source m LEFT JOIN b_state s ON s.source_id = m.source_id""")
def _(t):
    return text_times(X.source_health(t.b_source, t.b_state))


@query("health_histogram", "AGG-49", """
SELECT health_status, count(*) AS sources FROM (
  SELECT health_status FROM b_state UNION ALL
  SELECT CASE WHEN enabled = 1 THEN 'healthy' ELSE 'disabled' END FROM b_source m
  WHERE NOT EXISTS (SELECT 1 FROM b_state s WHERE s.source_id = m.source_id)) q GROUP BY ALL""")
def _(t):
    return X.health_histogram(t.b_source, t.b_state)


HISTORY_SQL = """
SELECT *, CASE WHEN fails >= 5 THEN 'quarantined' WHEN fails >= 3 THEN 'degraded' ELSE 'healthy' END
       AS health_status
FROM (SELECT *, CAST(sum(CASE WHEN outcome <> 'success' THEN 1 ELSE 0 END) OVER (
          PARTITION BY source_id, island ORDER BY started_at, fetch_attempt_id) AS BIGINT) AS fails
      FROM (SELECT *, sum(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) OVER (
              PARTITION BY source_id ORDER BY started_at, fetch_attempt_id
              ROWS UNBOUNDED PRECEDING) AS island FROM b_attempt) a) h"""


@query("source_health_history", "WIN-3", f"""
SELECT fetch_attempt_id, fails AS consecutive_failures, health_status,
       CASE WHEN fails >= 5 THEN {iso_sql("started_at + INTERVAL '24' HOUR")} END AS quarantine_until
FROM ({HISTORY_SQL}) h""")
def _(t):
    return text_times(X.health_history(t.b_attempt).select(
        "fetch_attempt_id", "consecutive_failures", "health_status", "quarantine_until"))


@query("next_source_state", "STA-13", f"""
SELECT source_id, {iso_sql('last.started_at')} AS last_fetch_at,
       {iso_sql('last_success')} AS last_success_at, last.fails AS consecutive_failures,
       CASE WHEN last.outcome <> 'success' THEN last.error_class END AS last_error_class,
       last.http_status AS last_http_status, last.health_status AS health_status
FROM (SELECT source_id, arg_max(ended_at, (started_at, fetch_attempt_id)) FILTER (outcome = 'success') AS last_success,
             arg_max(h, (started_at, fetch_attempt_id)) AS last
      FROM ({HISTORY_SQL}) h GROUP BY source_id) g""")
def _(t):
    empty = t.b_state.filter("false")
    return text_times(X.next_source_state(t.b_attempt, empty).select(
        "source_id", "last_fetch_at", "last_success_at", "consecutive_failures",
        "last_error_class", "last_http_status", "health_status"))


# --- runs ------------------------------------------------------------------------------------------------------

def results(t):
    skipped = (F.col("fetch_attempt_id") % 6) == 5
    crashed = (F.col("fetch_attempt_id") % 301) == 7
    return t.b_attempt.select(
        "run_started_at", "source_id", "new_item_count", "dedup_matched_count",
        F.when(crashed, "crashed").when(skipped, "skipped").otherwise(F.col("outcome"))
        .alias("outcome"),
        F.when(skipped & (F.col("source_id") % 2 == 0), "not_due").alias("skip_reason"),
        ((F.col("outcome") == "failed") & (F.col("http_status") == 503)).alias("quarantined_now"))


RESULT_SQL = """
SELECT run_started_at, source_id, new_item_count, dedup_matched_count,
       CASE WHEN fetch_attempt_id % 301 = 7 THEN 'crashed' WHEN fetch_attempt_id % 6 = 5
            THEN 'skipped' ELSE outcome END AS result,
       CASE WHEN fetch_attempt_id % 6 = 5 AND source_id % 2 = 0 THEN 'not_due' END AS skip_reason,
       outcome = 'failed' AND coalesce(http_status, 0) = 503 AS quarantined_now
FROM b_attempt"""


@query("run_rollup", "AGG-43", f"""
SELECT {iso_sql('run_started_at')} AS run_started_at, count(*) AS due_source_count,
  count(*) FILTER (result <> 'skipped') AS attempted_source_count,
  count(*) FILTER (result = 'success') AS succeeded_source_count,
  count(*) FILTER (result IN ('failed', 'crashed')) AS failed_source_count,
  CAST(coalesce(sum(new_item_count) FILTER (result = 'success'), 0) AS BIGINT) AS new_item_count,
  CAST(coalesce(sum(dedup_matched_count) FILTER (result = 'success'), 0) AS BIGINT)
      AS dedup_matched_count,
  count(*) FILTER (quarantined_now) AS quarantined_count,
  CASE WHEN count(*) FILTER (result = 'crashed') > 0 THEN 'failed'
       WHEN count(*) FILTER (result = 'failed') > 0 THEN 'partial_failure' ELSE 'success' END
      AS run_status
FROM ({RESULT_SQL}) r GROUP BY ALL""")
def _(t):
    return text_times(X.run_rollup(results(t), ["run_started_at"]))


@query("skip_histogram", "AGG-43", f"""
SELECT {iso_sql('run_started_at')} AS run_started_at, coalesce(skip_reason, 'unknown') AS skip_reason,
       count(*) AS sources FROM ({RESULT_SQL}) r WHERE result = 'skipped' GROUP BY ALL""")
def _(t):
    return text_times(X.skip_histogram(results(t), ["run_started_at"]))


@query("run_ledger", "STA-15", f"""
SELECT CAST(epoch(run_started_at) AS BIGINT) AS fetch_run_id, count(*) AS due_source_count,
  CASE WHEN count(*) FILTER (result = 'crashed') > 0 THEN 'failed'
       WHEN count(*) FILTER (result = 'failed') > 0 THEN 'partial_failure' ELSE 'success' END
      AS run_status FROM ({RESULT_SQL}) r GROUP BY run_started_at""")
def _(t):
    rollup = X.run_rollup(results(t), ["run_started_at"]).withColumn(
        "fetch_run_id", F.unix_seconds("run_started_at"))
    opened = results(t).select(F.unix_seconds("run_started_at").alias("fetch_run_id")).distinct() \
        .select("fetch_run_id", F.lit(0).cast("long").alias("due_source_count"),
                F.lit("running").alias("run_status"))
    return X.append_runs(opened, rollup)


@query("attempt_log", "STA-16", """
SELECT CAST(epoch(run_started_at) AS BIGINT) AS fetch_run_id, source_id, count(*) AS attempts,
       CAST(sum(new_item_count) AS BIGINT) AS new_item_count FROM b_attempt GROUP BY ALL""")
def _(t):
    rows = t.b_attempt.groupBy(F.unix_seconds("run_started_at").alias("fetch_run_id"),
                               "source_id").agg(F.count(F.lit(1)).alias("attempts"),
                                                F.sum("new_item_count").alias("new_item_count"))
    log = rows.filter("source_id < 50")
    return X.append_attempts(log, rows)


# --- state changes -------------------------------------------------------------------------------------------------

@query("classification_upsert", "STA-1", f"""
SELECT source_item_id, CASE WHEN fresh THEN 'core' ELSE topic_class END AS topic_class,
       {iso_sql(f"CASE WHEN fresh THEN {NOW_SQL} ELSE classified_at END")} AS classified_at,
       {iso_sql(f"CASE WHEN known THEN classified_at ELSE {NOW_SQL} END")} AS created_at
FROM (SELECT i.source_item_id, c.topic_class, c.classified_at, c.source_item_id IS NOT NULL AS known,
             i.source_id <= 40 AS fresh FROM b_item i
      LEFT JOIN b_class c ON c.source_item_id = i.source_item_id) q WHERE known OR fresh""")
def _(t):
    table = t.b_class.select("source_item_id", "topic_class", "classified_at",
                             F.col("classified_at").alias("created_at"))
    moment = F.lit(NOW).cast("timestamp")
    fresh = t.b_item.filter("source_id <= 40").select(
        "source_item_id", F.lit("core").alias("topic_class"), moment.alias("classified_at"),
        moment.alias("created_at"))
    return text_times(U.upsert(table, fresh, ["source_item_id"], "classified_at", ["created_at"]))


@query("decision_write_guard", "STA-2", """
SELECT source_item_id, CASE WHEN o_custkey % 10 = 3 THEN 'blocked' ELSE 'written' END AS outcome
FROM b_decision d JOIN orders o ON o.o_orderkey = d.source_item_id
WHERE d.curate_status <> 'failed'
UNION ALL SELECT source_item_id, 'written' FROM b_decision WHERE curate_status = 'failed'""")
def _(t):
    rows = t.b_decision.join(t.orders.select(F.col("o_orderkey").alias("source_item_id"),
                                             "o_custkey"), "source_item_id")
    broken = rows.withColumn("downstream_action", F.when(
        F.col("o_custkey") % 10 != 3, F.col("downstream_action")))
    ok, blocked = U.guard_actions(broken)
    return ok.select("source_item_id", F.lit("written").alias("outcome")).unionByName(
        blocked.select("source_item_id", F.lit("blocked").alias("outcome")))


def curation_results(t):
    """Results for every order: valid answers of all four actions and failures."""
    kind = F.col("o_custkey") % 5
    action = (F.when(kind == 0, "publish_link").when(kind == 1, "publish_summary")
              .when(kind == 2, "edit_rewrite").otherwise("reject_discard"))
    return t.orders.select(
        F.col("o_orderkey").alias("source_item_id"), (kind != 4).alias("ok"),
        F.when(kind < 2, "approved").otherwise("rejected").alias("curate_status"),
        action.alias("downstream_action"), F.lit("because").alias("decision_reason"),
        F.lit("goal").alias("brief_goal"), F.lit("link_card").alias("target_format"),
        F.lit("calm").alias("tone_guidance"), F.lit("New").alias("display_title"),
        F.lit("Short").alias("summary_short"), F.lit(None).cast("string").alias("bullet_1"),
        F.lit(None).cast("string").alias("bullet_2"), F.lit(None).cast("string").alias("bullet_3"))


def curation_tables(t):
    decision = t.b_decision.withColumn("updated_at", F.col("curated_at")).withColumn(
        "created_at", F.col("curated_at"))
    output = t.b_output.withColumn("created_at", F.col("updated_at"))
    brief = output.select("source_item_id", F.lit("old").alias("brief_goal"),
                          F.lit("link_card").alias("target_format"),
                          F.lit("warm").alias("tone_guidance"), "created_at", "updated_at")
    return U.apply_results(decision, brief, output, curation_results(t), NOW)


@query("curation_decisions_after", "STA-3 STA-4", """
SELECT source_item_id, CASE WHEN ok THEN new_status WHEN finished THEN curate_status
            ELSE 'failed' END AS curate_status,
       CASE WHEN ok THEN new_action WHEN finished THEN downstream_action END AS downstream_action,
       CASE WHEN ok THEN 0 WHEN finished THEN retry_count ELSE coalesce(retry_count, 0) + 1 END
       AS retry_count
FROM (SELECT o.o_orderkey AS source_item_id, o.o_custkey % 5 <> 4 AS ok, d.curate_status,
             d.downstream_action, d.retry_count,
             coalesce(d.curate_status IN ('approved', 'rejected', 'withdrawn'), FALSE) AS finished,
             CASE WHEN o.o_custkey % 5 < 2 THEN 'approved' ELSE 'rejected' END AS new_status,
             CASE o.o_custkey % 5 WHEN 0 THEN 'publish_link' WHEN 1 THEN 'publish_summary'
                  WHEN 2 THEN 'edit_rewrite' ELSE 'reject_discard' END AS new_action
      FROM orders o LEFT JOIN b_decision d ON d.source_item_id = o.o_orderkey) q""")
def _(t):
    return curation_tables(t)["curation_decision"].select(
        "source_item_id", "curate_status", "downstream_action", "retry_count")


@query("curation_outputs_after", "STA-2 STA-3", """
SELECT o.o_orderkey AS source_item_id, 'New' AS display_title, 1 AS has_brief FROM orders o
WHERE o.o_custkey % 5 < 2
UNION ALL SELECT b.source_item_id, b.display_title, 1 FROM b_output b
JOIN orders o ON o.o_orderkey = b.source_item_id WHERE o.o_custkey % 5 = 4
UNION ALL SELECT o.o_orderkey, NULL, 1 FROM orders o WHERE o.o_custkey % 5 = 2""")
def _(t):
    tables = curation_tables(t)
    return (tables["editor_brief"].select("source_item_id", F.lit(1).alias("has_brief"))
            .join(tables["curation_output"].select("source_item_id", "display_title"),
                  "source_item_id", "full"))


@query("decision_transitions", "STA-5", """
SELECT source_item_id, command, CASE WHEN curate_status IS NULL THEN 'no_decision'
       WHEN (command = 'withdraw' AND curate_status = 'approved')
         OR (command = 'reapprove' AND curate_status = 'withdrawn') THEN 'applied'
       ELSE 'wrong_status' END AS outcome
FROM (SELECT o.o_orderkey AS source_item_id, d.curate_status,
             CASE WHEN o.o_custkey % 2 = 0 THEN 'withdraw' ELSE 'reapprove' END AS command
      FROM orders o LEFT JOIN b_decision d ON d.source_item_id = o.o_orderkey) q""")
def _(t):
    return transition(t)[1].select("source_item_id", "command", "outcome")


def transition(t):
    commands = t.orders.select(
        F.col("o_orderkey").alias("source_item_id"), F.lit("operator request").alias("reason"),
        F.when(F.col("o_custkey") % 2 == 0, "withdraw").otherwise("reapprove").alias("command"))
    return U.transitions(t.b_decision.withColumn("updated_at", F.col("curated_at")), commands, NOW)


@query("decisions_after_transitions", "STA-5", """
SELECT d.source_item_id, CASE WHEN o.o_custkey % 2 = 0 AND d.curate_status = 'approved' THEN 'withdrawn'
       WHEN o.o_custkey % 2 = 1 AND d.curate_status = 'withdrawn' THEN 'approved'
       ELSE d.curate_status END AS curate_status,
       CASE WHEN (o.o_custkey % 2 = 0 AND d.curate_status = 'approved')
              OR (o.o_custkey % 2 = 1 AND d.curate_status = 'withdrawn') THEN 'operator'
            ELSE d.decision_actor END AS decision_actor
FROM b_decision d JOIN orders o ON o.o_orderkey = d.source_item_id""")
def _(t):
    return transition(t)[0].select("source_item_id", "curate_status", "decision_actor")


FP_SQL = """sha256('{"display_title":' || to_json(b.display_title) || ',"summary_short":'
  || to_json(b.summary_short) || ',"bullet_1":' || coalesce(CAST(to_json(b.bullet_1) AS VARCHAR), 'null')
  || ',"bullet_2":' || coalesce(CAST(to_json(b.bullet_2) AS VARCHAR), 'null') || ',"bullet_3":'
  || coalesce(CAST(to_json(b.bullet_3) AS VARCHAR), 'null') || '}')"""


@query("content_fingerprints", "FN-17", f"""
SELECT source_item_id, {FP_SQL} AS content_fingerprint FROM b_output b""")
def _(t):
    return t.b_output.select("source_item_id", K.content_fingerprint().alias("content_fingerprint"))


CHANGES_SQL = f"""
SELECT source_item_id, violation, CASE WHEN existing AND upstream <= seen THEN 'skip'
       WHEN violation IS NOT NULL THEN 'reject' WHEN NOT existing THEN 'insert'
       ELSE 'update' END AS change
FROM (SELECT d.source_item_id, a.source_item_id IS NOT NULL AS existing, b.updated_at AS upstream,
             TRY_CAST(replace(replace(json_extract_string(a.author_metadata,
                      '$.upstream_updated_at'), 'T', ' '), 'Z', '') AS TIMESTAMP) AS seen,
             CASE WHEN d.downstream_action = 'publish_summary' THEN
                    CASE WHEN b.bullet_1 IS NULL THEN 'bullet_1 is NULL'
                         WHEN trim(b.bullet_1) = '' THEN 'bullet_1 is blank'
                         WHEN b.bullet_2 IS NULL THEN 'bullet_2 is NULL'
                         WHEN trim(b.bullet_2) = '' THEN 'bullet_2 is blank'
                         WHEN b.bullet_3 IS NULL THEN 'bullet_3 is NULL'
                         WHEN trim(b.bullet_3) = '' THEN 'bullet_3 is blank' END
                  ELSE CASE WHEN b.bullet_1 IS NOT NULL THEN 'bullet_1 is populated'
                            WHEN b.bullet_2 IS NOT NULL THEN 'bullet_2 is populated'
                            WHEN b.bullet_3 IS NOT NULL THEN 'bullet_3 is populated' END END AS violation
      FROM b_decision d JOIN b_output b ON b.source_item_id = d.source_item_id
      LEFT JOIN b_approved a ON a.source_item_id = d.source_item_id
      WHERE d.curate_status = 'approved') q"""


def approved_changes(t):
    return U.assemble_approved(t.b_decision, t.b_output, t.b_approved)


@query("approved_content_changes", "STA-6 VAL-10", CHANGES_SQL)
def _(t):
    return approved_changes(t).select("source_item_id", "violation", "change")


@query("approved_change_counts", "STA-6", f"""
SELECT count(*) AS scanned, count(*) FILTER (change = 'insert') AS inserted,
       count(*) FILTER (change = 'update') AS updated, count(*) FILTER (change = 'skip') AS skipped,
       count(*) FILTER (change = 'reject') AS rejected FROM ({CHANGES_SQL}) c""")
def _(t):
    return U.change_counts(approved_changes(t))


@query("approved_records_after", "STA-6", f"""
SELECT source_item_id, parent_content_id FROM b_approved
UNION ALL SELECT source_item_id, 9000000 + row_number() OVER (ORDER BY source_item_id)
FROM ({CHANGES_SQL}) c WHERE change = 'insert'""")
def _(t):
    return U.apply_approved(t.b_approved, approved_changes(t), 9000000, NOW).select(
        "source_item_id", "parent_content_id")


@query("stale_translations", "STA-7", f"""
SELECT tr.parent_content_id, tr.language_code,
  CASE WHEN tr.source_fingerprint <> a.content_fingerprint AND tr.translation_status <> 'stale'
       THEN 'fingerprint_mismatch'
       WHEN tr.translation_status = 'completed'
        AND NOT (tr.model_name = 'bypass' AND tr.prompt_version = 'bypass')
        AND (tr.model_name <> 'model-a' OR tr.prompt_version <> 'v2') THEN 'config_change' END
      AS stale_reason,
  CASE WHEN (tr.source_fingerprint <> a.content_fingerprint)
        OR (tr.translation_status = 'completed' AND tr.model_name <> 'bypass'
            AND tr.prompt_version <> 'v2') THEN 'stale' ELSE tr.translation_status END
      AS translation_status
FROM b_translation tr JOIN b_approved a ON a.parent_content_id = tr.parent_content_id""")
def _(t):
    return T.mark_stale(t.b_translation, t.b_approved, "model-a", "v2", NOW).select(
        "parent_content_id", "language_code", "stale_reason", "translation_status")


@query("bypass_translations", "STA-8", f"""
SELECT parent_content_id, language_code, 'bypass' AS model_name, 'completed' AS translation_status,
       content_fingerprint AS source_fingerprint, bullet_1
FROM ({MATRIX_SQL}) m WHERE language_code = content_language_code""")
def _(t):
    return T.bypass_rows(tasks(t), NOW).select(
        "parent_content_id", "language_code", "model_name", "translation_status",
        "source_fingerprint", "bullet_1")


@query("translations_after_results", "STA-9", f"""
SELECT coalesce(r.parent_content_id, o.parent_content_id) AS parent_content_id,
       coalesce(r.language_code, o.language_code) AS language_code,
       CASE WHEN r.parent_content_id IS NULL THEN o.translation_status
            WHEN r.retry_count % 3 = 0 THEN 'completed' ELSE 'failed' END AS translation_status,
       CASE WHEN r.parent_content_id IS NULL THEN o.retry_count WHEN r.retry_count % 3 = 0 THEN 0
            WHEN r.retry_count % 3 = 1 THEN 3 ELSE coalesce(o.retry_count, 0) + 1 END AS retry_count,
       CASE WHEN r.parent_content_id IS NOT NULL AND r.retry_count % 3 = 0 THEN 'T'
            ELSE o.display_title END AS display_title
FROM ({MATRIX_SQL}) r FULL JOIN b_translation o
  ON o.parent_content_id = r.parent_content_id AND o.language_code = r.language_code""")
def _(t):
    kind = F.col("retry_count") % 3
    done = tasks(t).select(
        "parent_content_id", "language_code", "source_item_id", "content_fingerprint",
        F.lit(False).alias("forced"), F.when(kind == 0, "ok").when(kind == 1, "permanent")
        .otherwise("failed").alias("outcome"), F.lit("T").alias("display_title"),
        F.lit("S").alias("summary_short"), "bullet_1", "bullet_2", "bullet_3")
    return T.apply_results(t.b_translation, done, "model-a", "v2", NOW).select(
        "parent_content_id", "language_code", "translation_status", "retry_count", "display_title")


# --- requests --------------------------------------------------------------------------------------------------------

CLASSIFY = Q.RequestSettings("model-a", "Judge the item.", "Title: {title}\nText: {sanitized_text}\n"
                             'Answer as {{"topic_class": "core"}}', max_tokens=1024)
CURATE = Q.RequestSettings("model-a", "Decide.", "{raw_title} ({topic_class}, {governmental_involvement})"
                           "\n{sanitized_text}", top_p=0.5, max_tokens=2048)
TRANSLATE = Q.RequestSettings("model-a", "Translate.", "To {target_language}: {display_title} | "
                              "{summary_short} | {bullet_1} | {bullet_2} | {bullet_3}",
                              schema_name="result", schema_json='{"type":"object"}')


def body_sql(system: str, prompt: str, tail: str) -> str:
    return (f"""'{{"model":"model-a","messages":[{{"role":"system","content":"{system}"}},"""
            f"""{{"role":"user","content":' || to_json({prompt}) || '}}],"temperature":1.0,{tail}'""")


OBJECT = '"response_format":{"type":"json_object"}}'


@query("classification_requests", "PRJ-6", f"""
SELECT source_item_id, {body_sql('Judge the item.', 'p', '"max_tokens":1024,' + OBJECT)} AS request
FROM (SELECT source_item_id, 'Title: ' || title || chr(10) || 'Text: ' || sanitized_text || chr(10)
             || 'Answer as {{"topic_class": "core"}}' AS p FROM ({PENDING_CLASS_SQL}) c) q""")
def _(t):
    rows = U.pending_classification(t.b_item, t.b_text, t.b_class)
    return Q.classification_requests(rows, CLASSIFY).select("source_item_id", "request")


@query("curation_requests", "PRJ-7", f"""
SELECT source_item_id, {body_sql('Decide.', 'p', '"max_tokens":2048,"top_p":0.5,' + OBJECT)} AS request
FROM (SELECT source_item_id, raw_title || ' (' || topic_class || ', '
             || coalesce(CAST(governmental_involvement AS VARCHAR), '0') || ')' || chr(10)
             || sanitized_text AS p FROM ({PENDING_CURATE_SQL}) c) q""")
def _(t):
    rows = U.pending_curation(t.b_item, t.b_text, t.b_class, t.b_decision)
    return Q.curation_requests(rows, CURATE).select("source_item_id", "request")


SCHEMA = ('"max_tokens":1024,"response_format":{"type":"json_schema","json_schema":'
          '{"name":"result","strict":true,"schema":{"type":"object"}}}}')


@query("translation_requests", "PRJ-8", f"""
SELECT parent_content_id, language_code, {body_sql('Translate.', 'p', SCHEMA)} AS request
FROM (SELECT m.parent_content_id, m.language_code, 'To ' || l.label || ' (' || m.language_code || '): '
             || display_title || ' | ' || summary_short || ' | ' || coalesce(bullet_1, 'null') || ' | '
             || coalesce(bullet_2, 'null') || ' | ' || coalesce(bullet_3, 'null') AS p
      FROM ({MATRIX_SQL}) m JOIN b_lang l ON l.language_code = m.language_code
      WHERE m.language_code <> m.content_language_code) q""")
def _(t):
    rows = tasks(t).filter(F.col("language_code") != F.col("content_language_code"))
    return Q.translation_requests(rows, t.b_lang, TRANSLATE).select(
        "parent_content_id", "language_code", "request")


# --- responses --------------------------------------------------------------------------------------------------------

def replies(t):
    """Response envelopes around the whole conversation texts, some of them broken."""
    k = F.col("conv_id") % 8
    content = F.to_json(F.struct(F.col("text").alias("content")))
    return t.conversations.select("conv_id", "turn", "text", F.when(k == 0, "no json").when(
        k == 1, '{"choices":[]}').when(k == 2, '{"choices":["x"]}').when(
        k == 3, '{"choices":[{"message":null}]}').when(
        k == 4, '{"choices":[{"message":{"refusal":"no"}}]}').when(
        k == 5, '{"choices":[{"message":{"content":"  "}}]}').otherwise(
        F.concat(F.lit('{"choices":[{"message":'), content, F.lit("}]}"))).alias("response"))


@query("response_envelopes", "VAL-4", """
SELECT conv_id, turn, ['invalid_json', 'empty_choices', 'malformed_choice', 'malformed_message',
       'refused', 'empty_content', 'ok', 'ok'][conv_id % 8 + 1] AS outcome,
       CASE WHEN conv_id % 8 > 5 THEN md5(text) END AS content_md5 FROM conversations""")
def _(t):
    return P.open_envelope(replies(t)).select("conv_id", "turn", "outcome",
                                              F.md5("content").alias("content_md5"))


@query("classification_contract", "VAL-1", """
SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN 'not an object' WHEN 1 THEN 'missing topic_class'
  WHEN 2 THEN 'topic_class' WHEN 3 THEN 'classification_confidence' WHEN 4 THEN
  'classification_confidence' WHEN 5 THEN 'governmental_involvement' WHEN 6 THEN
  CASE WHEN n > 300 THEN 'classification_reason' END WHEN 7 THEN 'content_timeliness' END AS reason
FROM (SELECT doc_id, length(text) AS n FROM documents) d""")
def _(t):
    k = F.col("doc_id") % 10
    good = dict(topic_class='"core"', confidence="0.9", reason='"r"', gov="1", extra="")

    def body(**change):
        v = {**good, **change}
        head = "" if v["topic_class"] is None else f'"topic_class":{v["topic_class"]},'
        return (f'{{{head}"classification_confidence":{v["confidence"]},"classification_reason":'
                f'{v["reason"]},"content_density":"low","source_text_quality":"strong",'
                f'"primary_language_code":"en","governmental_involvement":{v["gov"]}{v["extra"]}}}')

    long = F.concat(F.lit(body(reason="@").split("@")[0]), F.regexp_extract(F.to_json(F.struct(
        F.col("text").alias("x"))), '(?s)^\\{"x":(.*)\\}$', 1), F.lit(body(reason="@").split("@")[1]))
    content = (F.when(k == 0, "[1]").when(k == 1, body(topic_class=None))
               .when(k == 2, body(topic_class='"other"')).when(k == 3, body(confidence="true"))
               .when(k == 4, body(confidence="1.5")).when(k == 5, body(gov="true"))
               .when(k == 6, long).when(k == 7, body(extra=',"content_timeliness":"soon"'))
               .when(k == 8, body(extra=',"content_timeliness":null,"other":1'))
               .otherwise(body(extra=',"primary_evidence_type":"eyewitness"')))
    rows = t.documents.select("doc_id", "text", content.alias("content"))
    return P.check_classification(rows).select("doc_id", "reason")


@query("curation_contract", "VAL-2", """
SELECT doc_id, CASE doc_id % 12 WHEN 0 THEN 'not an object' WHEN 1 THEN 'missing curation_decision'
  WHEN 2 THEN 'status and action' WHEN 3 THEN 'brief must be null' WHEN 4 THEN
  'output must be an object' WHEN 5 THEN 'target_format' WHEN 6 THEN 'bullets must be null'
  WHEN 7 THEN 'bullets must be text' WHEN 8 THEN CASE WHEN n > 500 THEN 'summary_short' END
  WHEN 9 THEN 'risk_flags' END AS reason
FROM (SELECT doc_id, length(text) AS n FROM documents) d""")
def _(t):
    k = F.col("doc_id") % 12

    def body(status="approved", action="publish_link", form="link_card", risk="[]", brief=True,
             output='{"display_title":"t","summary_short":"s"}'):
        b = (f'{{"brief_goal":"g","target_format":"{form}","risk_flags":{risk},'
             f'"tone_guidance":"t"}}' if brief else "null")
        return (f'{{"curation_decision":{{"curate_status":"{status}","downstream_action":"{action}",'
                f'"decision_reason":"r"}},"editor_brief":{b},"curation_output":{output}}}')

    three = '{"display_title":"t","summary_short":"s","bullet_1":"a","bullet_2":%s,"bullet_3":"c"}'
    whole = body(output='{"display_title":"t","summary_short":@}').split("@")
    text = F.regexp_extract(F.to_json(F.struct(F.col("text").alias("x"))),
                            '(?s)^\\{"x":(.*)\\}$', 1)
    content = (F.when(k == 0, "3").when(k == 1, "{}")
               .when(k == 2, body(status="rejected"))
               .when(k == 3, body("rejected", "reject_discard", output="null"))
               .when(k == 4, body(output="null")).when(k == 5, body(form="structured_summary"))
               .when(k == 6, body(output=three % "null"))
               .when(k == 7, body(action="publish_summary", form="structured_summary",
                                  output=three % '" "'))
               .when(k == 8, F.concat(F.lit(whole[0]), text, F.lit(whole[1])))
               .when(k == 9, body(risk='"x"'))
               .when(k == 10, body("rejected", "edit_rewrite", output="null"))
               .otherwise(body("rejected", "reject_discard", brief=False, output="null")))
    return P.check_curation(t.documents.select("doc_id", content.alias("content"))).select(
        "doc_id", "reason")


@query("translation_contract", "VAL-3 FN-20 FN-21 FN-22", """
SELECT doc_id, CASE WHEN k = 0 THEN 'not an object' WHEN k = 1 THEN 'missing translated_title'
  WHEN k = 2 THEN 'bullet_1 must be null' WHEN k = 3 THEN 'title too long'
  WHEN CASE k WHEN 4 THEN 4 * 50000 WHEN 6 THEN length('- **關鍵主張**：漢字') WHEN 7 THEN length('漢字')
       WHEN 8 THEN length('漢字 かな') END > 3 * n AND n > 0 THEN 'length ratio'
  WHEN k = 5 OR k = 7 THEN 'script' WHEN k = 6 THEN 'label prefix' END AS reason
FROM (SELECT doc_id, doc_id % 9 AS k, length(text) AS n FROM documents) d""")
def _(t):
    k = F.col("doc_id") % 9
    text = F.regexp_extract(F.to_json(F.struct(F.col("text").alias("x"))),
                            '(?s)^\\{"x":(.*)\\}$', 1)

    def body(title='"T"', summary='"漢字 かな"', b1="null"):
        return (f'{{"translated_title":{title},"translated_summary":{summary},'
                f'"translated_bullet_1":{b1},"translated_bullet_2":null,"translated_bullet_3":null}}')

    own = body(summary="@").split("@")
    four = body(summary="@").split("@")
    content = (F.when(k == 0, "[]").when(k == 1, '{"translated_summary":"x"}')
               .when(k == 2, body(b1='"b"')).when(k == 3, body(title='"' + "x" * 251 + '"'))
               .when(k == 4, F.concat(F.lit(four[0]), F.lit('"'), F.repeat(F.lit("漢"), 4 * 50000),
                                      F.lit('"'), F.lit(four[1])))
               .when(k == 5, F.concat(F.lit(own[0]), text, F.lit(own[1])))
               .when(k == 6, body(summary='"- **關鍵主張**：漢字"'))
               .when(k == 7, body(summary='"漢字"')).otherwise(body()))
    rows = t.documents.select(
        "doc_id", F.when(k == 7, "ja").otherwise("zh").alias("language_code"),
        F.lit(250).alias("max_title_length"), F.col("text").alias("summary_short"),
        *[F.lit(None).cast("string").alias(f"bullet_{i}") for i in (1, 2, 3)],
        content.alias("content"))
    return P.check_translation(rows).select("doc_id", "reason")
