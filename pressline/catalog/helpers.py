"""Small helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressline.bindings import EVENT_WINDOW, ITEM_WINDOW

LANGS = ["en", "zh", "ja"]
IW, EW = ITEM_WINDOW, EVENT_WINDOW


def sql_window(column: str, window: tuple[str, str]) -> str:
    return f"({column} >= TIMESTAMP '{window[0]}' AND {column} < TIMESTAMP '{window[1]}')"


ITEM_SQL = sql_window("fetched_at", IW)
START_SQL = sql_window("started_at", EW)
READY_SQL = ("text_processing_status <> 'failed' AND (text_processing_reason IS NULL "
             "OR text_processing_reason <> 'post_cleanup_empty')")
TOPIC_SQL = "topic_class IN ('core', 'adjacent')"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison with the oracle."""
    return df.select([F.round(c, digits).alias(c) if t == "double" else F.col(c)
                      for c, t in df.dtypes])


def joined(df: DataFrame, *columns: str) -> DataFrame:
    """String arrays shown as comma-separated text."""
    for c in columns:
        df = df.withColumn(c, F.array_join(F.transform(c, lambda x: x.cast("string")), ","))
    return df


def text_times(df: DataFrame) -> DataFrame:
    """Timestamps shown as ISO text."""
    return df.select([F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(c)
                      if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes])


def iso_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%dT%H:%M:%SZ')"
