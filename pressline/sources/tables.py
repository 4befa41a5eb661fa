"""Canonical table scans and configuration dimensions."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressline.schemas import TABLES


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One canonical table with its declared schema; no footer is read to infer it."""
    return spark.read.schema(TABLES[name]).parquet(f"{root.rstrip('/')}/{name}")


def register_tables(spark: SparkSession, root: str, names: list[str] | None = None) -> dict:
    """All canonical tables as temp views of their own names."""
    frames = {n: read_table(spark, root, n) for n in names or TABLES}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


def write_snapshot(df: DataFrame, root: str, name: str, snapshot: str) -> str:
    """Write a complete new version of a state table beside the old ones."""
    path = f"{root.rstrip('/')}/{name}/snapshot={snapshot}"
    df.write.mode("error").parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Store a state table bucketed by its join key, so later joins on the key need no shuffle."""
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
     .saveAsTable(table))


# --- configuration ---------------------------------------------------------------------------------------

SOURCE_FIELDS = ("source_id long, title string, category_id int, enabled boolean, fetch_group int, "
                 "schedule_class string, xml_url string, html_url string, "
                 "sanitization_profile string")
CATEGORY_FIELDS = "category_id int, name string, slug string, enabled boolean"


def _load_yaml(path: str) -> dict:
    if not os.path.exists(path):
        return {}
    import yaml
    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle) or {}


def source_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Source dimension from a configuration file; entries without id, title or category are left
    out. The file is hand-written configuration, so it is small by nature."""
    rows = []
    for entry in _load_yaml(path).get("sources") or []:
        try:
            rows.append((int(entry["id"]), str(entry["title"]), int(entry["category_id"]),
                         bool(entry.get("enabled", True)), int(entry.get("fetch_group", 1)),
                         entry.get("schedule_class"), entry.get("xml_url"), entry.get("html_url"),
                         entry.get("sanitization_profile")))
        except (KeyError, TypeError, ValueError):
            continue
    return spark.createDataFrame(rows, SOURCE_FIELDS)


def category_dimension(spark: SparkSession, path: str) -> DataFrame:
    rows = []
    for key, entry in (_load_yaml(path).get("categories") or {}).items():
        try:
            rows.append((int(key), str(entry["name"]), str(entry["slug"]), bool(entry["enabled"])))
        except (KeyError, TypeError, ValueError):
            continue
    return spark.createDataFrame(rows, CATEGORY_FIELDS)


def valid_sources(raw: DataFrame) -> DataFrame:
    """The same rule for source entries that already are a table of text columns."""
    number = F.try_to_number(F.col("id"), F.lit("999999999"))
    return (raw.withColumn("source_id", number.cast("long"))
            .withColumn("_category", F.try_to_number(F.col("category_id"), F.lit("999999999"))
                        .cast("int"))
            .filter(F.col("source_id").isNotNull() & F.col("title").isNotNull()
                    & F.col("_category").isNotNull())
            .select("source_id", "title", F.col("_category").alias("category_id")))


