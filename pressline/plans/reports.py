"""Report jobs: each is one plan over the cohort operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressline import fixed_values as V
from pressline.functions import rates as R
from pressline.functions import sources as S
from pressline.operators import cohort as C
from pressline.operators import fetch as X
from pressline.operators import translate as T


# --- sources -----------------------------------------------------------------------------------------

def source_breakdown(sources: DataFrame, attempts: DataFrame, wide: DataFrame,
                     attempt_window: tuple, **thresholds: float) -> DataFrame:
    """One row per configured, fetched or ingesting source with numbers, quadrant and flags."""
    card = C.filtering_overhead(C.source_scorecard(wide))
    fetched = X.success_rate(attempts, attempt_window, ["source_id"])
    rows = (sources.select("source_id").withColumn("_configured", F.lit(True))
            .join(fetched, "source_id", "full").join(card, "source_id", "full"))
    zero = ["ingest_volume", "classification_char_volume_proxy", "curation_char_volume_proxy"]
    rows = S.add_source_title(rows.drop("_configured").fillna(0, subset=zero),
                              sources.select("source_id", "title", "category_id"))
    isolation = thresholds.get("isolation", V.ISOLATION_THRESHOLD)
    rows = rows.withColumn("quadrant", S.quadrant(**thresholds)).withColumn(
        "analysis_flags", S.analysis_flags(isolation))
    return rows.drop("classified_count", "curate_approved_count")


def disable_suggestions(breakdown: DataFrame, floor: float = V.DISABLE_YIELD) -> DataFrame:
    """Sources whose yield is below the floor; flags stay visible for the human decision."""
    return breakdown.filter(F.col("overall_yield") < floor).select(
        "source_id", "source_title", "overall_yield", "analysis_flags")


def slices(wide: DataFrame, sources: DataFrame) -> DataFrame:
    """Cohort numbers by category and schedule class."""
    dim = sources.select("source_id", F.col("category_id").cast("string").alias("category"),
                         "schedule_class")
    per_source = wide.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("parent_content_id").alias("y"),
        R.tally(F.col("curate_status") == "approved").alias("a"))
    return (per_source.join(dim, "source_id", "left")
            .groupBy(F.coalesce("category", F.lit("unknown")).alias("category"),
                     F.coalesce("schedule_class", F.lit("unknown")).alias("schedule_class"))
            .agg(F.sum("n").alias("ingest_volume"), F.sum("a").alias("approved_items"),
                 R.ratio(F.sum("y"), F.sum("n")).alias("overall_yield")))


# --- funnel ------------------------------------------------------------------------------------------

FUNNEL_STAGES = ["classified_relevant", "curated", "approved", "translated", "published"]


def funnel_windows(t: dict[str, DataFrame], windows: dict[str, tuple]) -> DataFrame:
    """Stage counts, readiness states and rates per window, from one aggregate over the wide items."""
    wide = C.wide_items(C.in_windows(t["item"], windows), t["text"], t["cls"], t["decision"],
                        t["approved"])
    rows = C.with_flags(wide, t["approved"], t["translation"], t["publish"], t["publish_status"])
    stages = C.funnel_stages()
    counts = {**C.readiness_states(), **{n: stages[n] for n in FUNNEL_STAGES}}
    one = rows.agg(*[R.tally(F.col(f"in_{w}") & c).alias(f"{w}_{n}") for w in windows for n, c in counts.items()])
    per_window = F.array(*[F.struct(F.lit(w).alias("window_name"), *[F.col(f"{w}_{n}").alias(n) for n in counts])
                           for w in windows])
    return one.select(F.inline(per_window)).withColumns(C.stage_rates())


def window_metrics(rates: bool) -> Column:
    """The metrics of one window under the names of the document."""
    c, states = F.col, ["low_context_observation_count", "total_classified", "pending_classification",
                        "failed_text_processing", "missing_text_processing"]
    return F.struct(
        "total_ingested", "low_context_observation_count", "total_classified",
        c("classified_relevant").alias("relevant_classified"), c("curated").alias("total_curated"),
        c("approved").alias("curation_approved"), c("translated").alias("total_translated"),
        c("published").alias("total_published"), *(list(C.stage_rates()) if rates else []),
        F.struct(*states).alias("classification_readiness_breakdown"))


def latency_metrics(summary: DataFrame) -> DataFrame:
    """All latency stages as one row; a stage without rows keeps its place with empty figures."""
    def of(stage: str) -> Column:
        return F.struct(*[F.max(F.when(F.col("stage") == stage, F.col(c))).alias(c) for c in ("average", "median", "p90")])
    lead, *stages = C.LATENCY_STAGES
    return summary.agg(F.struct(of(lead).alias(f"{lead}_seconds"), F.struct(*[of(x).alias(x) for x in stages]).alias(
        "stage_latency_breakdown_seconds")).alias("raw_latency_metrics"))


def funnel_document(t: dict[str, DataFrame], languages: DataFrame, end: str, days: int,
                    generated_at: str, offset_hours: int = V.MATURATION_HOURS) -> DataFrame:
    """The whole funnel report as one row: both windows, latencies, coverage and anomalies."""
    windows = C.window_pair(end, days, offset_hours)
    pick = lambda name, rates: F.max(F.when(F.col("window_name") == name, window_metrics(rates)))
    metrics = funnel_windows(t, windows).agg(pick("raw", False).alias("raw_metrics"),
                                             pick("matured", True).alias("matured_metrics"))
    series = C.latency_series(t["item"], t["cls"], t["decision"], t["approved"], t["translation"],
                              t["publish"], t["publish_status"], t["attempt"], windows["raw"])
    latency = latency_metrics(C.latency_summary(series))
    eligible = C.eligible_approved(t["item"], t["text"], t["cls"], t["decision"], t["approved"],
                                   windows["matured"])
    coverage = C.coverage_by_language(
        languages, C.live_by_language(eligible, t["publish"], t["publish_status"]), eligible).agg(
        F.sort_array(F.collect_list(F.struct("language_code", "published_count", "coverage_rate")))
        .alias("published_by_language"))
    bad = C.anomalies(C.anomaly_rows(t["item"], t["text"], t["cls"], t["decision"],
                                     windows["raw"])).agg(
        F.sort_array(F.collect_list(F.struct("code", "count", "item_samples")))
        .alias("data_quality_anomalies"))
    # Aggregates without a key have one row each.
    one = metrics.crossJoin(F.broadcast(latency)).crossJoin(F.broadcast(coverage)).crossJoin(F.broadcast(bad))
    span = [F.struct(R.iso(w[0]).alias("start"), R.iso(w[1]).alias("end")).alias(f"{n}_window")
            for n, w in windows.items()]
    return one.select(F.lit("funnel").alias("report_type"), F.lit("3.0.0").alias("schema_version"),
                      F.lit(generated_at).alias("generated_at"), F.lit(days).alias("lookback_days"),
                      F.lit(offset_hours).alias("maturation_offset_hours"), *span, "raw_metrics",
                      "matured_metrics", "raw_latency_metrics", "published_by_language", "data_quality_anomalies")


# --- the other families ----------------------------------------------------------------------------------

def classify_breakdown(item, text, cls, window: tuple) -> DataFrame:
    """Per-source classification numbers with the character volume."""
    return (C.classify_by_source(item, cls, window)
            .join(C.char_volume_by_source(item, text, window), "source_id", "left")
            .withColumn("classification_character_volume_proxy",
                        F.coalesce("char_volume", F.lit(0))).drop("char_volume"))


def classify_metrics(item, text, cls, window: tuple) -> DataFrame:
    volume = C.char_volume_by_source(item, text, window).agg(
        F.coalesce(F.sum("char_volume"), F.lit(0)).alias("classification_character_volume_proxy"))
    return C.classify_kpis(item, cls, window).crossJoin(F.broadcast(volume))


def translation_breakdown(item, decision, approved, translation, languages: DataFrame,
                          window: tuple) -> DataFrame:
    """Every target language with its rates, latency and volume, zero-filled."""
    rates = T.success_rates(translation, window, by_language=True)
    done = T.language_completion(item, decision, approved, translation, languages, window)
    work = (T.cohort_texts(item, approved, translation, window).groupBy("language_code")
            .agg(F.avg(R.seconds_between("translated_at", "approved_at"))
                 .alias("average_latency_seconds"),
                 F.sum(T.five_field_length()).alias("_chars")))
    return (languages.select("language_code").join(rates, "language_code", "left")
            .join(done, "language_code", "left").join(work, "language_code", "left")
            .select("language_code", F.col("success_rate").alias("translation_success_rate"),
                    F.col("completion_rate").alias("translation_completion_rate"),
                    "average_latency_seconds", "stale_rate",
                    F.coalesce("_chars", F.lit(0)).alias("translation_character_volume_proxy")))


def translation_metrics(item, decision, approved, translation, languages: list[str],
                        window: tuple) -> DataFrame:
    return (T.success_rates(translation, window)
            .crossJoin(T.article_completion(item, decision, approved, translation, languages,
                                            window))
            .crossJoin(F.broadcast(T.average_latency(item, approved, translation, window))))


def curation_metrics(item, text, cls, decision, window: tuple) -> DataFrame:
    """Approval rate, volume and curation delay in one row."""
    delay = (C.cohort_items(item, window).select(C.KEY)
             .join(cls.select(C.KEY, "classified_at"), C.KEY)
             .join(decision.select(C.KEY, "curated_at"), C.KEY)
             .select(R.seconds_between("curated_at", "classified_at").alias("seconds")))
    return (C.approval_rate(item, decision, window)
            .crossJoin(F.broadcast(C.curation_chars(item, text, decision, window)))
            .crossJoin(C.latency_summary(delay.withColumn("stage", F.lit("curation")))
                       .drop("stage")))


def ingest_metrics(item, text, attempts, runs, window: tuple, attempt_window: tuple) -> DataFrame:
    return (X.success_rate(attempts, attempt_window)
            .crossJoin(F.broadcast(X.run_success_rate(runs, attempt_window)))
            .crossJoin(F.broadcast(C.ingest_quality(item, text, window))))


def publishing_breakdown(languages, item, decision, approved, translation, publish, publish_status,
                         window: tuple) -> DataFrame:
    """Coverage and publish delay per language."""
    coverage = C.publishing_coverage(languages, item, decision, approved, publish, publish_status,
                                     window)
    series = C.publish_gaps(C.cohort_outputs(item, approved, translation, window), publish,
                            publish_status)
    return (languages.select("language_code").join(coverage, "language_code", "left")
            .join(C.latency_summary(series, ["language_code"]), "language_code", "left"))


def document(report_type: str, version: str, generated_at: str, window: tuple, metrics: DataFrame,
             breakdown: DataFrame | None = None) -> DataFrame:
    """One report row: head, metrics and, when given, the breakdown rows.

    A breakdown has one row per source or language, so it is report-sized by nature.
    """
    one = metrics.select(F.struct(*metrics.columns).alias("metrics"))
    if breakdown is not None:
        rows = breakdown.agg(F.sort_array(F.collect_list(F.struct(*breakdown.columns)))
                             .alias("breakdowns"))
        one = one.crossJoin(rows)
    return one.select(F.lit(report_type).alias("report_type"),
                      F.lit(version).alias("schema_version"),
                      F.lit(generated_at).alias("generated_at"),
                      R.iso(R.at(window[0])).alias("window_start"),
                      R.iso(R.at(window[1])).alias("window_end"), *one.columns)
