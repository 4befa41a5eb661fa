"""Recent rows, lifetime summaries, roll-ups, clean-up selection and keyset paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressline import fixed_values as V
from pressline.functions import rates as R
from pressline.operators.cohort import KEY


def newest(rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """Top rows by an order; runs as a distributed top-k."""
    return rows.orderBy(*order).limit(limit)


def recent_classified(item, cls, limit: int = 100) -> DataFrame:
    """The latest classified items with titles. The top-k runs before the title join."""
    top = newest(cls.select(KEY, "topic_class", "classification_confidence", "classified_at"),
                 [F.desc("classified_at"), F.col(KEY)], limit)
    return item.select(KEY, "title").join(F.broadcast(top), KEY)


def lifetime_summary(cls: DataFrame) -> DataFrame:
    return cls.agg(F.count(F.lit(1)).alias("total"),
                   *[R.tally(F.col("topic_class") == t).alias(t) for t in V.TOPIC_CLASSES],
                   F.coalesce(F.avg("classification_confidence"), F.lit(0.0))
                   .alias("average_confidence"))


def volume_rank(per_source: DataFrame) -> DataFrame:
    """Rank of each source by volume. One row per source comes in, so a single sort is small."""
    return per_source.withColumn("rank", F.row_number().over(
        W.orderBy(F.desc("classify_volume"), F.col("source_id"))))


def top_and_others(per_source: DataFrame, means: list[str], top: int = 15) -> DataFrame:
    """The largest sources plus one row for all others (summed volume, mean shares)."""
    order = [F.desc("classify_volume"), F.col("source_id")]
    first = per_source.orderBy(*order).limit(top)
    rest = per_source.join(F.broadcast(first.select("source_id")), "source_id", "left_anti")
    others = rest.agg(F.count(F.lit(1)).alias("_n"),
                      F.sum("classify_volume").alias("classify_volume"),
                      *[F.avg(m).alias(m) for m in means]).filter("_n > 0")
    label = F.concat(F.lit("Others ("), F.col("_n").cast("string"), F.lit(" sources)"))
    return (first.select(F.col("source_id").cast("string").alias("source"), "classify_volume",
                         *means)
            .unionByName(others.select(label.alias("source"), "classify_volume", *means)))


# --- raw record clean-up -----------------------------------------------------------------------------------

def cleanup_plan(raw: DataFrame, now, exceptions: list[str] = V.RETENTION_EXCEPTIONS) -> DataFrame:
    """Every raw record with keep or delete: expired records go unless their class is excepted."""
    gone = (F.col("expires_at") < R.at(now)) & ~F.col("retention_class").isin(exceptions)
    return raw.withColumn("decision", F.when(F.coalesce(gone, F.lit(False)), "delete")
                          .otherwise("keep"))


def cleanup_counts(plan: DataFrame, now) -> DataFrame:
    expired = F.coalesce(F.col("expires_at") < R.at(now), F.lit(False))
    return plan.groupBy("retention_class").agg(
        F.count(F.lit(1)).alias("records"), R.tally(expired).alias("expired"),
        R.tally(F.col("decision") == "delete").alias("to_delete"))


# --- article listing -----------------------------------------------------------------------------------------

def article_page(index: DataFrame, language: str, event_from: str, event_to: str, limit: int = 100,
                 after: tuple[str, str] | None = None) -> DataFrame:
    """One page of articles by event date, newest first, slug descending on ties.

    ``after`` is the (source_published_at, slug) of the last row of the page before. The page is a
    filter and a top-k; nothing before the cursor is sorted again.
    """
    moment, slug = F.col("source_published_at"), F.col("slug")
    rows = index.filter((F.col("language_code") == language) & (moment >= R.at(event_from))
                        & (moment < R.at(event_to) + F.make_interval(days=F.lit(1))))
    if after:
        at = R.at(after[0])
        rows = rows.filter((moment < at) | ((moment == at) & (slug < after[1])))
    return rows.orderBy(F.desc("source_published_at"), F.desc("slug")).limit(limit)


def article_coverage(index: DataFrame, language: str, event_from: str, event_to: str, now,
                     last_run, sla_hours: int = 48) -> DataFrame:
    """Matches and the window and freshness flags that go with a listing."""
    moment = F.col("source_published_at")
    end = R.at(event_to) + F.make_interval(days=F.lit(1))
    stale = R.at(last_run) < R.at(now) - F.make_interval(hours=F.lit(sla_hours))
    return (index.filter(F.col("language_code") == language)
            .agg(F.min(moment).alias("window_from"), F.max(moment).alias("window_to"),
                 R.tally((moment >= R.at(event_from)) & (moment < end)).alias("total_count"),
                 R.tally(moment.isNull()).alias("items_without_event_time"))
            .withColumn("request_exceeds_window_to",
                        R.at(event_to) > F.date_trunc("day", F.col("window_to")))
            .withColumn("data_may_be_stale", stale))
