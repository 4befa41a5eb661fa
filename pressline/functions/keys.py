"""Identity keys of feed items."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressline import fixed_values as V
from pressline.functions.rates import iso
from pressline.functions.titles import blank, dedup_title, strip


def with_dedup_keys(rows: DataFrame) -> DataFrame:
    """Add the primary key with its rule and the title-hash marker of every item.

    Needs source_id, guid, canonical_url, title, published_at (timestamp) and summary. A URL
    identifies an article everywhere; the other primary keys only count inside one source. Titles
    of some length also give a key that counts everywhere.
    """
    source = F.col("source_id").cast("string")
    title, stamp = strip(F.col("title")), iso("published_at")
    has_url, has_guid = ~blank(F.col("canonical_url")), ~blank(F.col("guid"))
    has_title = ~blank(F.col("title"))
    fallback = F.md5(F.concat_ws(
        "|", source, F.when(F.col("title") != "", title), strip(F.col("canonical_url")), stamp,
        F.when(F.col("summary") != "", strip(F.col("summary")))))
    rule = (F.when(has_url, "url").when(has_guid, "guid")
            .when(has_title & stamp.isNotNull(), "tp").otherwise("fh"))
    key = (F.when(has_url, F.concat(F.lit("url:"), strip(F.col("canonical_url"))))
           .when(has_guid, F.concat_ws(":", F.lit("guid"), source, strip(F.col("guid"))))
           .when(has_title & stamp.isNotNull(), F.concat_ws(
               ":", F.lit("tp"), source, F.md5(F.concat_ws("|", title, stamp))))
           .otherwise(F.concat_ws(":", F.lit("fh"), source, fallback)))
    rows = rows.withColumn("_fold", dedup_title(F.col("title")))
    return (rows.withColumn("ingest_dedup_key", key).withColumn("dedup_rule", rule)
            .withColumn("title_key", F.when(
                F.length("_fold") >= V.MIN_TITLE_HASH_LENGTH,
                F.concat(F.lit("th:"), F.md5(F.col("_fold")))))
            .drop("_fold"))


def markers(rows: DataFrame) -> DataFrame:
    """All identity keys of each item as an array of (key, rule)."""
    main = F.struct(F.col("ingest_dedup_key").alias("dedup_key"),
                    F.col("dedup_rule").alias("dedup_rule"))
    extra = F.when(F.col("title_key").isNotNull(), F.struct(
        F.col("title_key").alias("dedup_key"), F.lit("th").alias("dedup_rule")))
    return rows.withColumn("markers", F.array_compact(F.array(main, extra)))


