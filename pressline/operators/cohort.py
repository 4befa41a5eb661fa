"""Cohort analytics over item, text, classification, decision, approved, translation and publish.

A cohort is the set of items fetched in a half-open window; later stages count whenever they
happened. All joins run on the item id, so one shuffle of each table serves the whole chain, and
the window filter reaches the item scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressline import fixed_values as V
from pressline.functions import rates as R
from pressline.operators.buckets import percentiles
from pressline.session import cut_lineage

KEY = "source_item_id"


# --- cohorts ---------------------------------------------------------------------------------

def cohort_items(item: DataFrame, window: tuple) -> DataFrame:
    """Items whose fetch time lies in the window."""
    return item.filter(R.in_window("fetched_at", *window))


def event_rows(table: DataFrame, column: str, window: tuple) -> DataFrame:
    """Rows whose own event time lies in the window."""
    return table.filter(R.in_window(column, *window))


def window_pair(end, days: int, offset_hours: int = V.MATURATION_HOURS) -> dict[str, tuple]:
    """The raw window ending at ``end`` and the matured one, shifted back by the offset."""
    stop = F.date_trunc("second", R.at(end))
    start = stop - F.make_interval(days=F.lit(days))
    back = F.make_interval(hours=F.lit(offset_hours))
    return {"raw": (start, stop), "matured": (start - back, stop - back)}


def in_windows(item: DataFrame, windows: dict[str, tuple]) -> DataFrame:
    """Items of any window with a flag ``in_<name>`` per window: one row per item, one scan."""
    flags = {f"in_{n}": R.in_window("fetched_at", *w) for n, w in windows.items()}
    starts = F.least(*[R.at(w[0]) for w in windows.values()])
    ends = F.greatest(*[R.at(w[1]) for w in windows.values()])
    return item.filter(R.in_window("fetched_at", starts, ends)).withColumns(flags)


def full_chain(item, text, cls, decision, approved) -> DataFrame:
    """Items that reached every stage up to an approved record (all keys unique, no fan-out)."""
    return (item.join(text, KEY).join(cls, KEY).join(decision, KEY).join(approved, KEY))


def wide_items(item, text, cls, decision, approved) -> DataFrame:
    """Every item with whatever later stages it has."""
    return (item.select(KEY, "source_id", "title", "published_at", "fetched_at",
                        *[c for c in item.columns if c.startswith("in_")])
            .join(text.select(KEY, "text_processing_status", "text_processing_reason",
                              "sanitized_text_length"), KEY, "left")
            .join(cls.select(KEY, "topic_class", "classification_confidence", "content_density",
                             "classified_at"), KEY, "left")
            .join(decision.select(KEY, "curate_status", "downstream_action", "curated_at"),
                  KEY, "left")
            .join(approved.select(KEY, "parent_content_id", "content_fingerprint",
                                  "content_language_code", "approved_at"), KEY, "left"))


def item_flags(approved, translation, publish, publish_status) -> tuple[DataFrame, DataFrame]:
    """Items with a current completed translation, and items live in at least one language."""
    master = approved.select("parent_content_id", KEY, "content_fingerprint")
    translated = (translation.filter(F.col("translation_status") == "completed")
                  .select("parent_content_id", "source_fingerprint")
                  .join(master, "parent_content_id").filter(R.current_version())
                  .select(KEY).distinct().withColumn("has_translation", F.lit(True)))
    live = (publish_status.filter(F.col("publish_status") == "published")
            .select("publish_record_id", "source_fingerprint")
            .join(publish.select("publish_record_id", KEY), "publish_record_id")
            .join(master.drop("parent_content_id"), KEY).filter(R.current_version())
            .select(KEY).distinct().withColumn("is_live", F.lit(True)))
    return translated, live


# --- funnel ----------------------------------------------------------------------------------

def funnel_stages() -> dict[str, Column]:
    """Stage name -> membership of one wide item row; every stage implies the text rule."""
    ready = R.classifiable() & F.col("topic_class").isNotNull()
    on_topic = ready & R.relevant()
    curated = on_topic & F.col("curate_status").isNotNull()
    approved = curated & (F.col("curate_status") == "approved") \
        & F.col("parent_content_id").isNotNull()
    return {
        "ingested": F.lit(True),
        "low_context_observation_count": F.col("text_processing_status") == "low_context",
        "classified": ready,
        "classified_relevant": on_topic,
        "curated": curated,
        "approved": approved,
        "translated": approved & F.col("has_translation"),
        "published": approved & F.col("is_live"),
    }


def with_flags(wide: DataFrame, approved, translation, publish, publish_status) -> DataFrame:
    translated, live = item_flags(approved, translation, publish, publish_status)
    return wide.join(translated, KEY, "left").join(live, KEY, "left")


def funnel_counts(flagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """All stage counts in one aggregate over the wide rows (one row per item)."""
    aggs = [R.tally(cond).alias(name) for name, cond in funnel_stages().items()]
    return flagged.groupBy(*(by or [])).agg(*aggs)


def readiness_states() -> dict[str, Column]:
    """State name -> membership of one item row."""
    return {
        "total_ingested": F.lit(True),
        "low_context_observation_count": F.col("text_processing_status") == "low_context",
        "total_classified": R.classifiable() & F.col("topic_class").isNotNull(),
        "pending_classification": R.classifiable() & F.col("topic_class").isNull(),
        "failed_text_processing": F.col("text_processing_status") == "failed",
        "missing_text_processing": F.col("text_processing_status").isNull(),
    }


def readiness_aggs() -> list[Column]:
    return [R.tally(state).alias(name) for name, state in readiness_states().items()]


def readiness(item, text, cls, window: tuple) -> DataFrame:
    """Readiness states of a cohort in one snapshot."""
    return (cohort_items(item, window).select(KEY)
            .join(text.select(KEY, "text_processing_status", "text_processing_reason"), KEY, "left")
            .join(cls.select(KEY, "topic_class"), KEY, "left").agg(*readiness_aggs()))


def stage_rates() -> dict[str, Column]:
    """The five stage-to-stage rates of a row that holds funnel and readiness counts."""
    c = F.col
    return {"classification_rate": R.ratio(c("total_classified"), c("total_ingested")),
            "curation_rate": R.ratio(c("curated"), c("total_classified")),
            "curation_approval_rate": R.ratio(c("approved"), c("curated")),
            "translation_rate": R.ratio(c("translated"), c("approved")),
            "publish_rate": R.ratio(c("published"), c("approved"))}


def cumulative_yield(counts: DataFrame) -> DataFrame:
    """(stage, items, yield) rows from a funnel count row."""
    stages = ["ingested", "classified", "curated", "approved", "translated", "published"]
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("items"),
                                        R.ratio(F.col(s), F.col("ingested")).alias("yield"))
                               for s in stages]))
    return counts.select(rows.alias("r")).select("r.*")


# --- approved and published coverage -----------------------------------------------------------

def eligible_approved(item, text, cls, decision, approved, window: tuple) -> DataFrame:
    """Active approved articles of the cohort that passed the text and topic rules."""
    return (full_chain(
        cohort_items(item, window).select(KEY),
        text.filter(R.classifiable()).select(KEY),
        cls.filter(R.relevant()).select(KEY),
        decision.filter(F.col("curate_status") == "approved").select(KEY),
        approved.select(KEY, "content_fingerprint")))


def live_by_language(eligible: DataFrame, publish, publish_status) -> DataFrame:
    """Distinct live items per language among the eligible articles."""
    live = (publish_status.filter(F.col("publish_status") == "published")
            .select("publish_record_id", "language_code", "source_fingerprint")
            .join(publish.select("publish_record_id", KEY), "publish_record_id"))
    return (live.join(eligible, KEY).filter(R.current_version())
            .groupBy("language_code").agg(F.countDistinct(KEY).alias("published_count")))


def coverage_by_language(languages: DataFrame, live: DataFrame, eligible: DataFrame) -> DataFrame:
    """Published count and coverage for every target language, zero-filled."""
    total = eligible.agg(F.countDistinct(KEY).alias("total_approved"))
    return (languages.select("language_code").join(live, "language_code", "left")
            .crossJoin(F.broadcast(total))
            .select("language_code",
                    F.coalesce("published_count", F.lit(0)).alias("published_count"),
                    R.ratio(F.coalesce("published_count", F.lit(0)), F.col("total_approved"))
                    .alias("coverage_rate")))


def active_approved(item, decision, approved, window: tuple) -> DataFrame:
    """Active approved articles of the cohort, without the text and topic rules."""
    return (cohort_items(item, window).select(KEY)
            .join(decision.filter(F.col("curate_status") == "approved").select(KEY), KEY)
            .join(approved.select(KEY, "parent_content_id", "content_fingerprint",
                                  "content_language_code"), KEY))


def publishing_coverage(languages, item, decision, approved, publish, publish_status,
                        window: tuple) -> DataFrame:
    """Coverage per language over all active approved articles.

    The articles meet their live rows once; one rollup counts them per language and altogether, and
    the handful of counts, not the articles, meets the language list.
    """
    active = active_approved(item, decision, approved, window).select(KEY, "content_fingerprint")
    live = (publish_status.filter(F.col("publish_status") == "published")
            .select("publish_record_id", "language_code", "source_fingerprint")
            .join(publish.select("publish_record_id", KEY), "publish_record_id").drop("publish_record_id"))
    version = [active[KEY] == live[KEY], active["content_fingerprint"] == live["source_fingerprint"]]
    rows = active.join(live, version, "left").select(active[KEY], "language_code")
    counts = rows.rollup("language_code").agg(F.countDistinct(KEY).alias("_n"), F.grouping("language_code").alias("_all"))
    entry = F.when((F.col("_all") == 0) & F.col("language_code").isNotNull(), F.struct("language_code", "_n"))
    one = counts.agg(F.map_from_entries(F.collect_list(entry)).alias("_live"),
                     F.max(F.when(F.col("_all") == 1, F.col("_n"))).alias("_total")).filter("_total > 0")
    published = F.coalesce(F.try_element_at("_live", F.col("language_code")), F.lit(0))
    return languages.select("language_code").crossJoin(F.broadcast(one)).select(
        "language_code", R.ratio(published, F.col("_total")).alias("coverage_rate"))


# --- classification ----------------------------------------------------------------------------

def topic_shares(population: str = "topic_class") -> list[Column]:
    return [R.share(F.col("topic_class") == t, population).alias(f"prop_{t}")
            for t in V.TOPIC_CLASSES]


def classified_cohort(item, cls, window: tuple) -> DataFrame:
    return cls.join(cohort_items(item, window).select(KEY, "source_id"), KEY)


def classify_kpis(item, cls, window: tuple) -> DataFrame:
    return classified_cohort(item, cls, window).agg(
        F.count("topic_class").alias("total_classified"),
        R.share(R.relevant(), "topic_class").alias("relevance_rate"),
        F.avg("classification_confidence").alias("average_confidence"), *topic_shares())


def classify_by_source(item, cls, window: tuple) -> DataFrame:
    density = [R.share(F.col("content_density") == d, "topic_class").alias(f"density_{d}_rate")
               for d in V.CONTENT_DENSITIES]
    return classified_cohort(item, cls, window).groupBy("source_id").agg(
        F.count("topic_class").alias("classify_volume"),
        R.share(R.relevant(), "topic_class").alias("relevance_rate"),
        F.avg("classification_confidence").alias("average_confidence"),
        *density, *topic_shares())


def _chars() -> Column:
    return F.length("title") + F.col("sanitized_text_length")


def char_volume_by_source(item, text, window: tuple) -> DataFrame:
    return (cohort_items(item, window).join(text.filter(R.classifiable()), KEY)
            .groupBy("source_id").agg(F.sum(_chars()).alias("char_volume")))


def source_scorecard(wide: DataFrame) -> DataFrame:
    """The per-source scorecard: one pass of conditional sums over wide cohort rows."""
    approved = F.col("curate_status") == "approved"
    decided = F.col("curate_status").isNotNull()
    return wide.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("ingest_volume"),
        F.count("topic_class").alias("classified_count"),
        R.share(R.relevant(), "topic_class").alias("relevance_rate"),
        R.share(approved, "curate_status").alias("curation_approval_rate"),
        R.tally(approved).alias("curate_approved_count"),
        R.ratio(F.count("parent_content_id"), F.count(F.lit(1))).alias("overall_yield"),
        F.sum(F.when(R.classifiable(), _chars()).otherwise(0))
        .alias("classification_char_volume_proxy"),
        F.sum(F.when(decided, _chars()).otherwise(0)).alias("curation_char_volume_proxy"),
        *topic_shares())


def ingest_quality(item, text, window: tuple) -> DataFrame:
    """Cohort size and the share observed as low context."""
    return (cohort_items(item, window).select(KEY)
            .join(text.select(KEY, "text_processing_status"), KEY, "left")
            .agg(F.count(F.lit(1)).alias("total_ingested_items"),
                 R.share(F.col("text_processing_status") == "low_context", F.lit(1))
                 .alias("low_context_observation_rate")))


def ingest_volume(item, window: tuple) -> DataFrame:
    return cohort_items(item, window).agg(F.count(F.lit(1)).alias("ingest_volume"))


def low_context_reasons(item, text, window: tuple) -> DataFrame:
    return (cohort_items(item, window).select(KEY)
            .join(text.filter((F.col("text_processing_status") == "low_context")
                              & F.col("text_processing_reason").isNotNull()), KEY)
            .groupBy("text_processing_reason").agg(F.count(F.lit(1)).alias("reason_count")))


def reasons_by_source(item, text, window: tuple) -> DataFrame:
    """Counts of the known reasons per source."""
    known = F.col("text_processing_reason").isin(V.TEXT_REASONS)
    return (cohort_items(item, window).select(KEY, "source_id").join(text.filter(known), KEY)
            .groupBy("source_id", "text_processing_reason")
            .agg(F.count(F.lit(1)).alias("reason_count")))


def reason_maps(reasons: DataFrame) -> DataFrame:
    """One map reason -> count per source; at most one entry per known reason."""
    pair = F.struct("text_processing_reason", "reason_count")
    return reasons.groupBy("source_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(pair)))
        .alias("text_processing_reason_distribution"))


def filtering_overhead(scorecard: DataFrame) -> DataFrame:
    return scorecard.withColumn("classification_filtering_overhead",
                                R.ratio(F.col("classified_count"), F.col("curate_approved_count")))


# --- curation ------------------------------------------------------------------------------------

def decided_cohort(item, decision, window: tuple) -> DataFrame:
    return decision.join(cohort_items(item, window).select(KEY, "title", "source_id"), KEY)


def approval_rate(item, decision, window: tuple) -> DataFrame:
    return decided_cohort(item, decision, window).agg(
        R.share(F.col("curate_status") == "approved", "curate_status").alias("approval_rate"))


def rejection_mix(item, decision, window: tuple) -> DataFrame:
    return (decided_cohort(item, decision.filter(F.col("curate_status") == "rejected"), window)
            .groupBy("downstream_action").agg(F.count(F.lit(1)).alias("rejected_count")))


def curation_chars(item, text, decision, window: tuple) -> DataFrame:
    return (decided_cohort(item, decision, window)
            .join(text.select(KEY, "sanitized_text_length"), KEY)
            .agg(F.coalesce(F.sum(_chars()), F.lit(0)).alias("char_volume")))


def low_context_outcome(item, text, cls, decision, window: tuple) -> DataFrame:
    """What became of low-context items that were classified, every key zero-filled."""
    rows = (cohort_items(item, window).select(KEY)
            .join(text.select(KEY, "text_processing_status", "text_processing_reason"), KEY)
            .join(cls.select(KEY, "topic_class"), KEY).filter(R.low_context_classified())
            .join(decision.select(KEY, "curate_status", "downstream_action"), KEY, "left"))
    approved = F.col("curate_status") == "approved"
    return rows.agg(
        F.count(F.lit(1)).alias("cohort_size"),
        *[R.tally(F.col("topic_class") == t).alias(f"topic_{t}") for t in V.TOPIC_CLASSES],
        F.count("curate_status").alias("curated_count"),
        R.tally(approved).alias("curation_approved_count"),
        R.share(approved, "curate_status").alias("curation_approval_rate"),
        *[R.tally(F.col("downstream_action") == a).alias(f"action_{a}")
          for a in V.DOWNSTREAM_ACTIONS])


def approval_by_density(item, cls, decision, window: tuple) -> DataFrame:
    return (classified_cohort(item, cls, window).select(KEY, "content_density")
            .join(decision.select(KEY, "curate_status"), KEY, "left")
            .groupBy("content_density")
            .agg(F.count(F.lit(1)).alias("items"),
                 R.tally(F.col("curate_status") == "approved").alias("approved_items"),
                 R.share(F.col("curate_status") == "approved", F.lit(1)).alias("approval_rate")))


def signal_outcomes(item, cls, decision, window: tuple) -> DataFrame:
    """Exploratory: each allow-listed signal value with its item and approval counts."""
    signals = F.from_json("additional_signals",
                          "content_timeliness string, primary_evidence_type string")
    rows = (classified_cohort(item, cls, window).select(KEY, signals.alias("s"))
            .join(decision.select(KEY, "curate_status"), KEY, "left"))
    pairs = F.explode(F.array(
        F.struct(F.lit("content_timeliness").alias("signal"),
                 F.col("s.content_timeliness").alias("value")),
        F.struct(F.lit("primary_evidence_type").alias("signal"),
                 F.col("s.primary_evidence_type").alias("value"))))
    return (rows.select(pairs.alias("p"), "curate_status").select("p.*", "curate_status")
            .filter(F.col("value").isNotNull()).groupBy("signal", "value")
            .agg(F.count(F.lit(1)).alias("items"),
                 F.count("curate_status").alias("decided_items"),
                 R.tally(F.col("curate_status") == "approved").alias("approved_items"),
                 R.share(F.col("curate_status") == "approved", "curate_status")
                 .alias("approval_rate")))


# --- latency ---------------------------------------------------------------------------------------

def _gap(stage: str, later: str, earlier: str, language: Column | None = None) -> Column:
    language = F.lit(None).cast("string") if language is None else language
    return F.struct(F.lit(stage).alias("stage"), R.seconds_between(later, earlier).alias("seconds"),
                    language.alias("language_code"))


def item_gaps(item, cls, decision, publish, window: tuple) -> DataFrame:
    """Lead time, freshness, classification and curation delay from one join of the items."""
    base = (cohort_items(item, window).select(KEY, "fetched_at", "published_at")
            .join(cls.select(KEY, "classified_at"), KEY, "left")
            .join(decision.select(KEY, "curated_at"), KEY, "left")
            .join(publish.select(KEY, "first_published_at"), KEY, "left"))
    return base.select(F.explode(F.array(
        _gap("pipeline_lead_time", "first_published_at", "fetched_at"),
        _gap("feed_freshness_delay", "fetched_at", "published_at"),
        _gap("classification_delay", "classified_at", "fetched_at"),
        _gap("curation_delay", "curated_at", "classified_at"))).alias("p")).select("p.*")


def fetch_gaps(attempt, window: tuple) -> DataFrame:
    return event_rows(attempt, "started_at", window).select(
        _gap("fetch_execution_latency", "ended_at", "started_at").alias("p")).select("p.*")


def cohort_outputs(item, approved, translation, window: tuple) -> DataFrame:
    """Translation outputs of the cohort's approved articles."""
    mine = (cohort_items(item, window).select(KEY)
            .join(approved.select(KEY, "parent_content_id", "approved_at"), KEY))
    return mine.join(translation.select("parent_content_id", "language_code", "model_name",
                                        "translated_at"), "parent_content_id")


def translation_gaps(outputs: DataFrame) -> DataFrame:
    return outputs.filter(R.not_bypass()).select(
        _gap("translation_delay", "translated_at", "approved_at", F.col("language_code"))
        .alias("p")).select("p.*")


def publish_gaps(outputs: DataFrame, publish, publish_status) -> DataFrame:
    """Time from translation to publication per (item, language)."""
    live = (publish_status.filter(F.col("published_at").isNotNull())
            .select("publish_record_id", "language_code", F.col("published_at").alias("live_at"))
            .join(publish.select("publish_record_id", KEY), "publish_record_id"))
    return (outputs.select(KEY, "language_code", "translated_at").join(live, [KEY, "language_code"])
            .select(_gap("publish_delay", "live_at", "translated_at", F.col("language_code"))
                    .alias("p")).select("p.*"))


def output_gaps(outputs: DataFrame, publish, publish_status) -> DataFrame:
    """Translation and publish gaps of the same outputs, which meet their publication once."""
    live = (publish_status.filter(F.col("published_at").isNotNull())
            .select("publish_record_id", "language_code", F.col("published_at").alias("live_at"))
            .join(publish.select("publish_record_id", KEY), "publish_record_id").drop("publish_record_id"))
    language = F.col("language_code")
    both = F.array(F.when(R.not_bypass(), _gap("translation_delay", "translated_at", "approved_at", language)),
                   _gap("publish_delay", "live_at", "translated_at", language))
    return outputs.join(live, [KEY, "language_code"], "left").select(
        F.explode(F.array_compact(both)).alias("p")).select("p.*")


def latency_series(item, cls, decision, approved, translation, publish, publish_status, attempt,
                   window: tuple, attempt_window: tuple | None = None) -> DataFrame:
    """The seven latency series as (stage, seconds, language_code)."""
    outputs = cohort_outputs(item, approved, translation, window)
    return (item_gaps(item, cls, decision, publish, window)
            .unionByName(fetch_gaps(attempt, attempt_window or window))
            .unionByName(output_gaps(outputs, publish, publish_status))
            .filter(F.col("seconds").isNotNull()))


LATENCY_STAGES = ["pipeline_lead_time", "feed_freshness_delay", "fetch_execution_latency", "classification_delay",
                  "curation_delay", "translation_delay", "publish_delay"]
LATENCY_PROBS = {"median": 0.5, "p90": 0.9}


def latency_summary(series: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Average, median and 90th percentile per stage."""
    return percentiles(series, by or ["stage"], "seconds", LATENCY_PROBS)


# --- data quality ----------------------------------------------------------------------------------

def anomaly_rows(item, text, cls, decision, window: tuple) -> DataFrame:
    """(code, item id) of every data-quality violation of the cohort, from one wide join."""
    rows = (cohort_items(item, window).select(KEY)
            .join(text.select(KEY, "text_processing_status", "text_processing_reason",
                              F.lit(True).alias("has_text")), KEY, "left")
            .join(cls.select(KEY, "topic_class", F.lit(True).alias("has_class")), KEY, "left")
            .join(decision.select(KEY, F.lit(True).alias("has_decision")), KEY, "left"))
    status, reason = F.col("text_processing_status"), F.col("text_processing_reason")
    no_text = F.col("has_text").isNull()
    codes = F.array_compact(F.array(
        F.when(F.col("has_class") & (no_text | (status == "failed")
                                     | (reason == "post_cleanup_empty")),
               "ORPHANED_CLASSIFICATION"),
        F.when(F.col("has_decision") & (F.col("has_class").isNull() | ~R.relevant()),
               "ORPHANED_CURATION"),
        F.when(no_text, "MISSING_TEXT_RECORD"),
        F.when(~status.isin(V.TEXT_STATUSES), "UNKNOWN_TEXT_PROCESSING_STATUS")))
    return rows.select(F.explode(codes).alias("code"), KEY)


def anomalies(rows: DataFrame, samples: int = 10) -> DataFrame:
    """Count and the first ids per code. The rank filter is applied map-side before the shuffle.

    Violations are stored first: they are few, while the joins that find them are not.
    """
    rows = cut_lineage(rows)
    counts = rows.groupBy("code").agg(F.count(F.lit(1)).alias("count"))
    first = (rows.withColumn("_r", F.row_number().over(W.partitionBy("code").orderBy(KEY)))
             .filter(F.col("_r") <= samples)
             .groupBy("code").agg(F.sort_array(F.collect_list(KEY)).alias("item_samples")))
    return counts.join(first, "code")
