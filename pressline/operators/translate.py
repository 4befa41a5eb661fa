"""Translation queue, staleness, results and workload metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressline import fixed_values as V
from pressline.functions import rates as R
from pressline.operators.cohort import KEY, active_approved, cohort_items

TASK = ["parent_content_id", "language_code"]
FIELDS = ["display_title", "summary_short", "bullet_1", "bullet_2", "bullet_3"]


def _lang_array(languages: list[str]) -> Column:
    return F.array(*map(F.lit, languages))


# --- metrics ---------------------------------------------------------------------------------------

def success_rates(translation: DataFrame, window: tuple, by_language: bool = False) -> DataFrame:
    """Success (and stale) shares of the outputs touched in the window."""
    status = F.col("translation_status")
    done, failed, stale = (status == s for s in ("completed", "failed", "stale"))
    rows = translation.filter(R.in_window("updated_at", *window))
    success = R.ratio(R.tally(done), R.tally(done | failed)).alias("success_rate")
    if not by_language:
        return rows.agg(success)
    return rows.groupBy("language_code").agg(
        success, R.ratio(R.tally(stale), R.tally(done | failed | stale)).alias("stale_rate"))


def article_completion(item, decision, approved, translation, languages: list[str],
                       window: tuple) -> DataFrame:
    """Share of active articles with every required foreign language done in the current version."""
    active = active_approved(item, decision, approved, window)
    done = (translation.filter((F.col("translation_status") == "completed") & R.not_bypass()
                               & F.col("language_code").isin(languages))
            .select("parent_content_id", "language_code", "source_fingerprint"))
    finished = (active.join(done, "parent_content_id").filter(R.current_version()
                & (F.col("language_code") != F.col("content_language_code")))
                .groupBy("parent_content_id")
                .agg(F.countDistinct("language_code").alias("completed_count")))
    required = F.size(F.array_except(_lang_array(languages),
                                     F.array("content_language_code")))
    return (active.join(finished, "parent_content_id", "left").agg(
        R.share(F.coalesce("completed_count", F.lit(0)) == required, F.lit(1))
        .alias("translation_completion_rate")))


def language_completion(item, decision, approved, translation, languages: DataFrame,
                        window: tuple) -> DataFrame:
    """Completion per language: any current completed output over the foreign-language articles.

    Both sides are aggregated to one row per language before they meet; no article is repeated.
    """
    active = active_approved(item, decision, approved, window)
    done = (translation.filter(F.col("translation_status") == "completed")
            .select("parent_content_id", "language_code", "source_fingerprint")
            .join(active, "parent_content_id").filter(R.current_version())
            .groupBy("language_code")
            .agg(F.countDistinct("parent_content_id").alias("done")))
    own = (active.groupBy("content_language_code").agg(F.count(F.lit(1)).alias("own")))
    total = active.agg(F.count(F.lit(1)).alias("articles"))
    return (languages.select("language_code").join(done, "language_code", "left")
            .join(own, F.col("language_code") == F.col("content_language_code"), "left")
            .crossJoin(F.broadcast(total)).filter("articles > 0")
            .select("language_code", R.ratio(
                F.coalesce("done", F.lit(0)),
                F.col("articles") - F.coalesce("own", F.lit(0))).alias("completion_rate")))


def cohort_texts(item, approved, translation, window: tuple) -> DataFrame:
    """Model-made outputs of the cohort's approved articles with the master text."""
    master = (cohort_items(item, window).select(KEY)
              .join(approved.select(KEY, "parent_content_id", "approved_at", *FIELDS), KEY))
    return (translation.filter(R.not_bypass())
            .select("parent_content_id", "language_code", "translated_at")
            .join(master, "parent_content_id"))


def average_latency(item, approved, translation, window: tuple,
                    by_language: bool = False) -> DataFrame:
    rows = cohort_texts(item, approved, translation, window)
    return rows.groupBy(*(["language_code"] if by_language else [])).agg(
        F.avg(R.seconds_between("translated_at", "approved_at")).alias("avg_latency"))


def five_field_length(columns: list[str] = FIELDS) -> Column:
    """Title and summary length plus whatever bullets exist."""
    title, summary, *bullets = columns
    total = F.length(title) + F.length(summary)
    for b in bullets:
        total = total + F.coalesce(F.length(b), F.lit(0))
    return total


def recorded_chars(item, approved, translation, window: tuple) -> DataFrame:
    return (cohort_texts(item, approved, translation, window).groupBy("language_code")
            .agg(F.sum(five_field_length()).alias("char_volume")))


def intended_chars(item, approved, languages: list[str], window: tuple) -> DataFrame:
    """Upper bound: every article goes into every target language but its own."""
    return (cohort_items(item, window).select(KEY).join(approved, KEY).agg(
        F.coalesce(F.sum(five_field_length()) * (len(languages) - 1), F.lit(0))
        .cast("long").alias("intended_char_volume")))


def completed_char_share(translation: DataFrame, window: tuple) -> DataFrame:
    """Characters of completed outputs per language with the share of the window total."""
    per_lang = (translation.filter((F.col("translation_status") == "completed")
                                   & R.in_window("updated_at", *window))
                .groupBy("language_code").agg(F.sum(five_field_length()).alias("char_volume")))
    total = per_lang.agg(F.sum("char_volume").alias("_all"))
    return (per_lang.crossJoin(F.broadcast(total))
            .select("language_code", "char_volume",
                    R.ratio(F.col("char_volume"), F.col("_all")).alias("char_share")))


# --- queue -------------------------------------------------------------------------------------------

def eligible(status: Column, retries: Column, limit: int) -> Column:
    return status.isNull() | status.isin("pending", "stale") \
        | ((status == "failed") & (retries < limit))


def translation_matrix(approved: DataFrame, languages: list[str],
                       translation: DataFrame) -> DataFrame:
    """Approved articles times target languages with the output each pair has, if any."""
    pairs = approved.withColumn("language_code", F.explode(_lang_array(languages)))
    old = translation.select(*TASK, "translation_status",
                             F.col("retry_count").alias("old_retry_count"))
    return pairs.join(old, TASK, "left")


def pending_tasks(approved: DataFrame, languages: list[str], translation: DataFrame,
                  retry_limit: int = V.RETRY_LIMIT) -> DataFrame:
    """Pairs that still need work: none yet, pending, stale, or failed below the limit."""
    status = F.col("translation_status")
    return (translation_matrix(approved, languages, translation)
            .filter(eligible(status, F.col("old_retry_count"), retry_limit))
            .withColumn("status", F.coalesce(status, F.lit("new")))
            .withColumn("retry_count", F.coalesce("old_retry_count", F.lit(0)))
            .drop("translation_status", "old_retry_count"))


def take_batch(tasks: DataFrame, batch_size: int) -> DataFrame:
    """All tasks of the first ``batch_size`` articles by (approved_at, id).

    The batch list comes from a distributed top-k and holds at most ``batch_size`` rows.
    """
    first = (tasks.select("approved_at", "parent_content_id").distinct()
             .orderBy("approved_at", "parent_content_id").limit(batch_size))
    return tasks.join(F.broadcast(first.select("parent_content_id")), "parent_content_id",
                      "left_semi")


def select_tasks(requests: DataFrame, approved: DataFrame, translation: DataFrame,
                 retry_limit: int = V.RETRY_LIMIT) -> DataFrame:
    """Outcome of every requested (article, language, force): selected or the reason why not."""
    old = translation.select(*TASK, F.col("translation_status").alias("status"), "retry_count")
    known = approved.select("parent_content_id", F.lit(True).alias("_known"))
    status = F.col("status")
    return (requests.join(known, "parent_content_id", "left").join(old, TASK, "left").select(
        *TASK, "force", F.coalesce(status, F.lit("new")).alias("status"),
        F.when(F.col("_known").isNull(), "unknown_article")
        .when(F.col("force") | eligible(status, F.col("retry_count"), retry_limit), "selected")
        .when(status == "failed", "locked").otherwise("already_done").alias("outcome")))


def queue_status(approved: DataFrame, languages: list[str], translation: DataFrame,
                 retry_limit: int = V.RETRY_LIMIT) -> DataFrame:
    """Queue numbers per language from one aggregate; absent outputs = articles - outputs."""
    status, retries = F.col("translation_status"), F.col("retry_count")
    per_lang = translation.groupBy("language_code").agg(
        R.tally(status == "completed").alias("completed"),
        R.tally(status == "pending").alias("pending_status"),
        R.tally(status == "stale").alias("stale_status"),
        R.tally((status == "failed") & (retries < retry_limit)).alias("failed_retryable"),
        R.tally((status == "failed") & (retries >= retry_limit)).alias("locked"),
        F.count(F.lit(1)).alias("_rows"))
    total = approved.agg(F.count(F.lit(1)).alias("_articles"))
    wanted = total.withColumn("language_code", F.explode(_lang_array(languages)))
    counted = ["completed", "pending_status", "stale_status", "failed_retryable", "locked"]
    filled = wanted.join(per_lang, "language_code", "left").select(
        "language_code", "_articles", *[F.coalesce(c, F.lit(0)).alias(c) for c in counted],
        F.coalesce("_rows", F.lit(0)).alias("_rows"))
    missing = F.greatest(F.col("_articles") - F.col("_rows"), F.lit(0))
    return filled.select(
        "language_code", *counted, missing.alias("no_translation"),
        (missing + F.col("pending_status") + F.col("stale_status") + F.col("failed_retryable"))
        .alias("pending_total"))


def completed_languages(translation: DataFrame) -> DataFrame:
    return (translation.filter(F.col("translation_status") == "completed")
            .select("language_code").distinct())


def absent_languages(languages: DataFrame, translation: DataFrame) -> DataFrame:
    """Configured languages without a single completed output."""
    return languages.select("language_code").join(completed_languages(translation),
                                                  "language_code", "left_anti")


# --- state changes -----------------------------------------------------------------------------------

def mark_stale(translation: DataFrame, approved: DataFrame, model: str, prompt: str,
               now) -> DataFrame:
    """The complete output table with stale rows marked and the reason of each change."""
    master = approved.select("parent_content_id", "content_fingerprint")
    status = F.col("translation_status")
    moved = F.col("content_fingerprint").isNotNull() & ~R.current_version() & (status != "stale")
    copied = (F.col("model_name") == "bypass") & (F.col("prompt_version") == "bypass")
    changed = (status == "completed") & ~copied & (
        (F.col("model_name") != model) | (F.col("prompt_version") != prompt))
    reason = F.when(moved, "fingerprint_mismatch").when(changed, "config_change")
    rows = translation.join(master, "parent_content_id", "left").withColumn("stale_reason", reason)
    hit = F.col("stale_reason").isNotNull()
    return (rows.withColumn("translation_status", F.when(hit, "stale").otherwise(status))
            .withColumn("updated_at", F.when(hit, R.at(now)).otherwise(F.col("updated_at")))
            .drop("content_fingerprint"))


def bypass_rows(tasks: DataFrame, now) -> DataFrame:
    """Finished rows for the tasks whose target is the article's own language."""
    return tasks.filter(F.col("language_code") == F.col("content_language_code")).select(
        "parent_content_id", "source_item_id", "language_code", *FIELDS,
        F.col("content_fingerprint").alias("source_fingerprint"),
        F.lit("completed").alias("translation_status"), F.lit(0).alias("retry_count"),
        F.lit("bypass").alias("model_name"), F.lit("bypass").alias("prompt_version"),
        R.at(now).alias("translated_at"), R.at(now).alias("updated_at"))


def apply_results(translation: DataFrame, results: DataFrame, model: str, prompt: str, now,
                  retry_limit: int = V.RETRY_LIMIT) -> DataFrame:
    """The complete output table after a batch of results.

    ``results``: task keys, ``source_item_id``, ``content_fingerprint``, ``forced``, ``outcome``
    (ok, failed, permanent) and the five translated fields. A failure keeps the earlier text, a
    permanent failure locks the row at the limit, and a failed forced re-run changes nothing.
    """
    old = translation.select(*TASK, *[F.col(c).alias("o_" + c) for c in translation.columns
                                      if c not in TASK], F.lit(True).alias("_old"))
    new = results.select(*TASK, *[F.col(c).alias("n_" + c) for c in results.columns
                                  if c not in TASK], F.lit(True).alias("_new"))
    ok = F.coalesce(F.col("n_outcome") == "ok", F.lit(False))
    keep = F.col("_new").isNull() | (F.col("n_forced") & ~ok)
    retry = (F.when(ok, 0).when(F.col("n_outcome") == "permanent", retry_limit)
             .otherwise(F.coalesce("o_retry_count", F.lit(0)) + 1))

    def pick(name: str, value: Column) -> Column:
        return F.when(keep, F.col("o_" + name)).otherwise(value).alias(name)

    done = old.join(new, TASK, "full")
    done = done.filter(F.col("_old") | ~keep)
    return done.select(
        *TASK, pick("source_item_id", F.col("n_source_item_id")),
        *[pick(f, F.when(ok, F.col("n_" + f)).otherwise(F.col("o_" + f))) for f in FIELDS],
        pick("source_fingerprint", F.col("n_content_fingerprint")),
        pick("translation_status", F.when(ok, "completed").otherwise("failed")),
        pick("retry_count", retry), pick("model_name", F.lit(model)),
        pick("prompt_version", F.lit(prompt)),
        pick("translated_at", F.when(ok, R.at(now)).otherwise(F.col("o_translated_at"))),
        pick("updated_at", R.at(now)))


def find_outputs(translation: DataFrame, wanted: DataFrame) -> DataFrame:
    """Outputs of the wanted (article, language) pairs."""
    return translation.join(wanted.select(*TASK).distinct(), TASK, "left_semi")


def find_approved(approved: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Approved records of the wanted ids, by record id or by item id."""
    return approved.join(wanted.select(key).distinct(), key, "left_semi")
