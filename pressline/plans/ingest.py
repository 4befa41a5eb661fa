"""Feed entries to state tables: normalise, key, dedup, sanitise, fan out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressline import fixed_values as V
from pressline.functions import titles as N
from pressline.functions.html import PROFILE, sanitize, sanitize_by_profile
from pressline.functions.keys import with_dedup_keys
from pressline.functions.times import published_at
from pressline.operators import dedup as D
from pressline.session import cut_columns, cut_lineage


KEYED = ["source_id", "guid", "canonical_url", "title", "published_at", "fetched_at", D.K1, D.K2, "dedup_rule"]
"""What the item tables take from a keyed entry beside its body."""


def keyed_entries(entries: DataFrame) -> DataFrame:
    """Entries with title, canonical URL, date and identity keys."""
    return with_dedup_keys(
        entries.withColumn("title", N.display_title(F.col("raw_title")))
        .withColumn("canonical_url", N.canonical_url(F.col("link")))
        .withColumn("published_at", published_at(F.col("raw_date"))))


def keys_alone(entries: DataFrame, order: list[str]) -> DataFrame:
    """What ``keyed_entries`` adds to each entry, beside its unique ``order`` columns.

    The rules for titles, URLs and dates are the costly part of a batch and are applied once; what is
    stored is small, since bodies stay where they are.
    """
    keyed = keyed_entries(entries)
    return cut_lineage(keyed.select(*order, *[c for c in keyed.columns if c not in entries.columns]))


def labelled_entries(entries: DataFrame, order: list[str],
                     markers: DataFrame | None = None) -> DataFrame:
    """Keyed entries with a label: new, dedup or normalization_failure."""
    judged = entries.join(D.accept_first(keys_alone(entries, order), order, markers), order, "left")
    return judged.withColumn("label", F.when(F.col("accepted"), "new").when(
        F.length("title") > 0, "dedup").otherwise("normalization_failure"))


def ingest_by_profile(entries: DataFrame, profiles: DataFrame, order: list[str], markers: DataFrame | None = None,
                      last_id: int = 0, retention_days: int = V.RAW_RETENTION_DAYS) -> dict[str, DataFrame]:
    """Like ``ingest``, with the merged sanitising profile of each entry's source.

    ``profiles`` has one row per source: source_id, sanitization_profile and the fields of ``PROFILE``. It
    is configuration, so adaptive execution sends it to the rows; its selectors are compiled once per
    distinct list, whatever the number of entries. Entries bring ``summary`` and ``content``. They may come
    from a parser, so they are stored with their keys, and dedup and the bodies' join read that.
    """
    bodies = ["summary", "content"]
    keyed = cut_columns(keyed_entries(entries).select(*dict.fromkeys([*order, *KEYED, *bodies])))
    places = D.first_places(keyed.filter(F.length("title") > 0), order, markers)
    fields = [c.split()[0] for c in PROFILE.split(", ")]
    own = profiles.select("source_id", F.struct(*fields).alias("_profile"), F.col("sanitization_profile").alias("_method"))
    new = keyed.join(D.number_places(places, order, last_id), order).join(own, "source_id", "left")
    clean = sanitize_by_profile(new, "_profile", "title", bodies, F.coalesce("_method", F.lit("default")))
    return D.item_tables(cut_columns(clean.drop("_profile", "_method", *bodies)), retention_days)


def ingest(entries: DataFrame, order: list[str], markers: DataFrame | None = None,
           last_id: int = 0, retention_days: int = V.RAW_RETENTION_DAYS,
           max_length: int | None = None) -> dict[str, DataFrame]:
    """The rows a batch of entries adds to the four item tables.

    Dedup and numbering work on keys alone; the bodies move once, to meet their new id, and are
    stored with it before they fan out to the tables.
    """
    keyed = keyed_entries(entries)
    places = D.first_places(keyed.filter(F.length("title") > 0), order, markers)
    new = keyed.join(D.number_places(places, order, last_id), order).withColumn(
        "body", F.when(N.strip(F.col("summary")) != "", F.col("summary")))
    return D.item_tables(cut_lineage(sanitize(new, "body", "title", max_length)), retention_days)
