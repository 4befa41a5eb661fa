"""Fetch attempts, runs, source selection and source health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressline import fixed_values as V
from pressline.functions import rates as R

# --- rates -----------------------------------------------------------------------------------------


def success_rate(attempts: DataFrame, window: tuple, by: list[str] | None = None) -> DataFrame:
    return (attempts.filter(R.in_window("started_at", *window)).groupBy(*(by or []))
            .agg(R.share(F.col("outcome") == "success", F.lit(1)).alias("fetch_success_rate")))


def run_success_rate(runs: DataFrame, window: tuple) -> DataFrame:
    return runs.filter(R.in_window("started_at", *window)).agg(
        R.ratio(F.sum("succeeded_source_count"), F.sum("attempted_source_count"))
        .alias("run_success_rate"))


def error_categories(attempts: DataFrame, window: tuple) -> DataFrame:
    """Failed attempts by class and status; rows without a status form their own groups."""
    return (attempts.filter(R.in_window("started_at", *window) & (F.col("outcome") == "failed"))
            .groupBy("error_class", "http_status").agg(F.count(F.lit(1)).alias("error_count")))


def health_snapshot(states: DataFrame) -> DataFrame:
    return states.select("source_id", "health_status", "consecutive_failures",
                         "last_http_status", "last_error_class")


def error_class(status: str | Column, failure: str | Column) -> Column:
    """Error class of a fetch outcome from its status code or transport failure kind."""
    s = F.col(status) if isinstance(status, str) else status
    kind = F.col(failure) if isinstance(failure, str) else failure
    return (F.when(kind == "timeout", "timeout_error").when(kind == "network", "network_error")
            .when(kind == "parse", "parse_error").when(kind.isNotNull(), "unexpected_error")
            .when(s.between(400, 499), "http_error_4xx").when(s >= 500, "http_error_5xx"))


# --- selection ---------------------------------------------------------------------------------------

def select_sources(sources: DataFrame, ids: list[int] | None = None,
                   groups: list[int] | None = None) -> DataFrame:
    """Enabled sources, narrowed by ids and fetch groups when given."""
    chosen = sources.filter(F.col("enabled").cast("boolean"))
    if ids is not None:
        chosen = chosen.filter(F.col("source_id").isin(ids))
    if groups is not None:
        chosen = chosen.filter(F.col("fetch_group").isin(groups))
    return chosen


def is_due(now, interval: Column, last_success: Column) -> Column:
    """Never succeeded, no known schedule, or the interval has passed."""
    minutes = (F.unix_seconds(R.at(now)) - F.unix_seconds(last_success)) / 60.0
    return last_success.isNull() | interval.isNull() | (minutes >= interval)


def is_quarantined(now, until: Column) -> Column:
    return F.coalesce(R.at(now) < until, F.lit(False))


def schedule_dim(spark) -> DataFrame:
    return spark.createDataFrame(list(V.SCHEDULE_MINUTES.items()),
                                 "schedule_class string, target_interval_minutes int")


def skip_reasons(sources: DataFrame, states: DataFrame, now, force: bool = False,
                 dry_run: bool = False) -> DataFrame:
    """Every source with the first reason not to fetch it, or NULL when it is to be fetched."""
    schedules = schedule_dim(sources.sparkSession)
    rows = (sources.join(F.broadcast(schedules), "schedule_class", "left")
            .join(states.select("source_id", "last_success_at", "quarantine_until"),
                  "source_id", "left"))
    reason = F.when(~F.col("enabled").cast("boolean"), "disabled")
    if not force:
        reason = reason.when(is_quarantined(now, F.col("quarantine_until")), "quarantined").when(
            ~is_due(now, F.col("target_interval_minutes"), F.col("last_success_at")), "not_due")
    if dry_run:
        reason = reason.when(F.lit(True), "dry_run")
    return rows.withColumn("skip_reason", reason)


def source_health(sources: DataFrame, states: DataFrame) -> DataFrame:
    """Every configured source with its state, or the healthy default."""
    return sources.select("source_id", "title", "enabled").join(
        states.select("source_id", "health_status", "consecutive_failures", "last_error_class",
                      "quarantine_until", "last_success_at"), "source_id", "left").select(
        "source_id", "title", F.coalesce("health_status", F.lit("healthy")).alias("health_status"),
        F.coalesce("consecutive_failures", F.lit(0)).alias("consecutive_failures"),
        "last_error_class", "quarantine_until", "last_success_at")


def health_histogram(sources: DataFrame, states: DataFrame) -> DataFrame:
    """State counts; configured sources without a state count as healthy or disabled."""
    unseen = sources.join(states.select("source_id"), "source_id", "left_anti").select(
        F.when(F.col("enabled").cast("boolean"), "healthy").otherwise("disabled")
        .alias("health_status"))
    return (states.select("health_status").unionByName(unseen)
            .groupBy("health_status").agg(F.count(F.lit(1)).alias("sources")))


# --- health state machine ------------------------------------------------------------------------------

def health_history(attempts: DataFrame, prior: DataFrame | None = None,
                   bucket_seconds: int = 3600) -> DataFrame:
    """State after every attempt: failures in a row, health and quarantine end.

    A source may own a third of all attempts, so its timeline is cut into stretches: runs of
    failures are counted inside (source, stretch), and the failures open at the end of a stretch
    are carried forward over the short list of stretches.
    """
    failed = (F.col("outcome") != "success").cast("int")
    rows = attempts.withColumn(
        "_b", F.floor(F.unix_seconds("started_at") / F.lit(bucket_seconds)))
    order = ["started_at", "fetch_attempt_id"]
    inner = W.partitionBy("source_id", "_b").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_wins", F.sum(1 - failed).over(inner)).withColumn(
        "_fails", F.sum(failed).over(inner))
    # Failures since the latest success = all failures so far minus those before that success.
    rows = rows.withColumn("_run", F.col("_fails") - F.coalesce(
        F.max(F.when(failed == 0, F.col("_fails"))).over(inner), F.lit(0)))
    ends = rows.groupBy("source_id", "_b").agg(
        F.max("_wins").alias("_w"),
        F.max_by("_run", F.struct(*order)).alias("_open"))
    outer = W.partitionBy("source_id").orderBy("_b")
    ends = ends.withColumn("_g", F.sum((F.col("_w") > 0).cast("int")).over(
        outer.rowsBetween(W.unboundedPreceding, 0)))
    ends = ends.withColumn("_after", F.sum("_open").over(
        W.partitionBy("source_id", "_g").orderBy("_b").rowsBetween(W.unboundedPreceding, 0)))
    ends = ends.withColumn("_carry", F.coalesce(F.lag("_after").over(outer), F.lit(0)))
    ends = ends.withColumn("_fresh", F.coalesce(F.lag("_g").over(outer), F.lit(0)) == 0)
    if prior is not None:
        ends = ends.join(prior.select(
            "source_id", F.col("consecutive_failures").alias("_prior")), "source_id", "left")
        ends = ends.withColumn("_carry", F.col("_carry") + F.when(
            F.col("_fresh"), F.coalesce("_prior", F.lit(0))).otherwise(0))
    out = rows.join(ends.select("source_id", "_b", "_carry"), ["source_id", "_b"])
    fails = (F.col("_run") + F.when(F.col("_wins") == 0, F.col("_carry")).otherwise(0)).cast("long")
    return (out.withColumn("consecutive_failures", fails)
            .withColumn("health_status",
                        F.when(F.col("consecutive_failures") >= V.QUARANTINE_AFTER, "quarantined")
                        .when(F.col("consecutive_failures") >= V.DEGRADED_AFTER, "degraded")
                        .otherwise("healthy"))
            .withColumn("quarantine_until", F.when(
                F.col("health_status") == "quarantined",
                F.col("started_at") + F.make_interval(hours=F.lit(V.QUARANTINE_HOURS))))
            .drop("_b", "_wins", "_fails", "_run", "_carry"))


def next_source_state(attempts: DataFrame, prior: DataFrame) -> DataFrame:
    """The complete new state table: latest attempt per source over the prior state."""
    history = health_history(attempts, prior)
    last = F.struct("started_at", "fetch_attempt_id")
    won = F.col("outcome") == "success"
    fresh = history.groupBy("source_id").agg(
        F.max("started_at").alias("n_fetch"),
        F.max_by(F.when(won, F.col("ended_at")), F.when(won, last)).alias("n_success"),
        F.max_by(F.struct("http_status", "error_class", "ended_at", "outcome",
                          "consecutive_failures", "health_status", "quarantine_until"),
                 last).alias("n"))
    old = prior.select("source_id", *[F.col(c).alias("o_" + c) for c in (
        "last_fetch_at", "last_success_at", "consecutive_failures", "health_status",
        "last_error_class", "last_http_status", "quarantine_until")])
    seen = F.col("n").isNotNull()

    def pick(new: Column, column: str) -> Column:
        return F.when(seen, new).otherwise(F.col("o_" + column)).alias(column)

    return old.join(fresh, "source_id", "full").select(
        "source_id", pick(F.col("n_fetch"), "last_fetch_at"),
        F.coalesce("n_success", "o_last_success_at").alias("last_success_at"),
        pick(F.col("n.http_status"), "last_http_status"),
        pick(F.col("n.consecutive_failures"), "consecutive_failures"),
        pick(F.when(F.col("n.outcome") != "success", F.col("n.error_class")), "last_error_class"),
        pick(F.col("n.health_status"), "health_status"),
        pick(F.col("n.quarantine_until"), "quarantine_until"))


# --- run ledger ------------------------------------------------------------------------------------------

def attempt_counters(items: DataFrame, keys: list[str]) -> DataFrame:
    """The five item counters per attempt from labelled items.

    ``label`` is new, dedup or normalization_failure; ``text_status`` and ``text_reason`` describe
    the text of new items.
    """
    new = F.col("label") == "new"
    broken = F.col("text_reason") == "sanitizer_exception"
    return items.groupBy(*keys).agg(
        R.tally(new).alias("new_item_count"),
        R.tally(F.col("label") == "dedup").alias("dedup_matched_count"),
        R.tally(new & (F.col("text_status") == "low_context")).alias("low_context_count"),
        R.tally(new & broken).alias("sanitization_failure_count"),
        R.tally(F.col("label") == "normalization_failure").alias("normalization_failure_count"))


def run_rollup(results: DataFrame, keys: list[str]) -> DataFrame:
    """Run totals and status from per-source results (outcome success, failed, skipped, crashed)."""
    tried = F.col("outcome").isin("success", "failed", "crashed")
    lost = F.col("outcome").isin("failed", "crashed")
    crashed = R.tally(F.col("outcome") == "crashed")
    return results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("due_source_count"),
        R.tally(tried).alias("attempted_source_count"),
        R.tally(F.col("outcome") == "success").alias("succeeded_source_count"),
        R.tally(lost).alias("failed_source_count"),
        F.coalesce(F.sum(F.when(F.col("outcome") == "success", F.col("new_item_count"))),
                   F.lit(0)).alias("new_item_count"),
        F.coalesce(F.sum(F.when(F.col("outcome") == "success", F.col("dedup_matched_count"))),
                   F.lit(0)).alias("dedup_matched_count"),
        R.tally(F.col("quarantined_now")).alias("quarantined_count"),
        F.when(crashed > 0, "failed").when(R.tally(lost) > 0, "partial_failure")
        .otherwise("success").alias("run_status"))


def skip_histogram(results: DataFrame, keys: list[str]) -> DataFrame:
    return (results.filter(F.col("outcome") == "skipped")
            .groupBy(*keys, F.coalesce("skip_reason", F.lit("unknown")).alias("skip_reason"))
            .agg(F.count(F.lit(1)).alias("sources")))


def append_runs(ledger: DataFrame, rollup: DataFrame) -> DataFrame:
    """Run ledger with the closed runs added; an open row of the same run is replaced."""
    kept = ledger.join(rollup.select("fetch_run_id"), "fetch_run_id", "left_anti")
    return kept.unionByName(rollup.select(*ledger.columns))


def append_attempts(log: DataFrame, attempts: DataFrame) -> DataFrame:
    """Attempt log with new attempts added; a (run, source) pair is logged once."""
    fresh = attempts.join(log.select("fetch_run_id", "source_id"), ["fetch_run_id", "source_id"],
                          "left_anti")
    return log.unionByName(fresh.select(*log.columns))
