"""Source dimension rules: quality quadrant, flags, merged sanitising profile, title lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressline import fixed_values as V




def quadrant(yield_floor: float = V.YIELD_THRESHOLD, relevance: float = V.RELEVANCE_THRESHOLD,
             isolation: float = V.ISOLATION_THRESHOLD) -> Column:
    """Quality quadrant; NULL when the source is isolated or lacks an axis."""
    cut_off = F.coalesce(F.col("fetch_success_rate") < isolation, F.lit(False))
    known = (F.col("ingest_volume") > 0) & F.col("relevance_rate").isNotNull() \
        & F.col("overall_yield").isNotNull()
    rich, fit = F.col("overall_yield") >= yield_floor, F.col("relevance_rate") >= relevance
    return F.when(~cut_off & known,
                  F.when(rich & fit, "golden_source").when(rich, "needle_in_a_haystack")
                  .when(fit, "filtering_burden").otherwise("dead_weight"))


def analysis_flags(isolation: float = V.ISOLATION_THRESHOLD) -> Column:
    """Flags in a fixed order: authority, missing data, connection trouble.

    An isolated source is not also judged on its numbers, so only an unknown source keeps the
    missing-data flag there.
    """
    cut_off = F.coalesce(F.col("fetch_success_rate") < isolation, F.lit(False))
    no_numbers = (F.col("ingest_volume") <= 0) | F.col("relevance_rate").isNull() \
        | F.col("overall_yield").isNull()
    return F.array_compact(F.array(
        F.when(F.col("category_id").isin(V.AUTHORITY_CATEGORIES), "AUTHORITY"),
        F.when(F.col("is_unknown_source") | (~cut_off & no_numbers), "INSUFFICIENT_DATA"),
        F.when(cut_off, "CONNECTION_DIAGNOSTICS")))


def with_any_flag(rows: DataFrame, wanted: list[str], column: str = "analysis_flags") -> DataFrame:
    """Rows that carry at least one wanted flag; no wish keeps all rows."""
    if not wanted:
        return rows
    return rows.filter(F.arrays_overlap(F.col(column), F.array(*map(F.lit, wanted))))


def with_both_axes(rows: DataFrame) -> DataFrame:
    return rows.dropna(subset=["relevance_rate", "overall_yield"])


def add_source_title(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Title and category per source id. The source dimension is configuration, hence broadcast."""
    dim = sources.select("source_id", F.col("title").alias("_title"), "category_id",
                         F.lit(False).alias("_unknown"))
    joined = rows.join(dim, "source_id", "left")
    label = F.concat(F.lit("Unknown Source (ID: "), F.col("source_id").cast("string"),
                     F.lit(") " + V.NO_DATA))
    return (joined.withColumn("source_title", F.coalesce("_title", label))
            .withColumn("is_unknown_source", F.coalesce("_unknown", F.lit(True)))
            .drop("_title", "_unknown"))


def merged_profiles(sources: DataFrame, profiles: DataFrame, fields: list[str]) -> DataFrame:
    """Per-source sanitising profile: an override field replaces the profile field when present.

    ``sources`` holds ``sanitization_profile`` and ``override_<field>`` columns.
    """
    joined = sources.join(profiles, "sanitization_profile", "left")
    return joined.select("source_id", "sanitization_profile",
                         *[F.coalesce(F.col("override_" + f), F.col(f)).alias(f) for f in fields])
