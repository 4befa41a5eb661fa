"""Publishing: reconciliation, status rows, catalogues, archives, digests and snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressline import fixed_values as V
from pressline.functions import rates as R
from pressline.functions.content import canonical_json, disclosure_note
from pressline.functions.times import archive_file, archive_month
from pressline.operators.cohort import KEY

PAIR = [KEY, "language_code"]
CATALOGUE = ["slug", "display_title", "summary_short", "canonical_url", "source_published_at",
             "approved_at", "published_at"]


# --- reconciliation -------------------------------------------------------------------------------------

def candidates(approved, decision, translation, item, publish, publish_status) -> DataFrame:
    """Approved articles with each current finished translation and what is published of it."""
    live = publish_status.join(publish.select("publish_record_id", KEY), "publish_record_id").select(
        *PAIR, "publish_status", F.col("source_fingerprint").alias("published_fingerprint"))
    done = translation.filter(F.col("translation_status") == "completed").select(
        "parent_content_id", "language_code", "display_title", "source_fingerprint", "translated_at")
    return (approved.select(KEY, "parent_content_id", "content_fingerprint", "approved_at",
                            "author_metadata")
            .join(decision.filter(F.col("curate_status") == "approved")
                  .select(KEY, "downstream_action"), KEY)
            .join(item.select(KEY, "canonical_url", F.col("published_at")
                              .alias("source_published_at")), KEY)
            .join(publish.select(KEY, "publish_record_id", "slug"), KEY, "left")
            .join(done, "parent_content_id").filter(R.current_version())
            .join(live, PAIR, "left"))


def published_pairs(publish, publish_status) -> DataFrame:
    """Every publish record with its language rows."""
    return publish_status.join(publish.select("publish_record_id", KEY, "slug"),
                               "publish_record_id")


def active_rows(publish, publish_status) -> DataFrame:
    return published_pairs(publish, publish_status.filter(
        F.col("publish_status") == "published")).select(*PAIR, "slug", "published_at")


def eligible_items(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Items that have every configured language."""
    return (rows.filter(F.col("language_code").isin(languages)).groupBy(KEY)
            .agg(F.count_distinct("language_code").alias("_n"))
            .filter(F.col("_n") == len(languages)).select(KEY))


def to_publish(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Pairs to publish or refresh: eligible and unpublished, or published in another version."""
    mine = rows.filter(F.col("language_code").isin(languages)).join(
        eligible_items(rows, languages), KEY, "left_semi")
    live = F.coalesce(F.col("publish_status") == "published", F.lit(False))
    return mine.filter(~live | (F.col("published_fingerprint") != F.col("content_fingerprint")))


def to_withdraw(rows: DataFrame, publish, publish_status, languages: list[str]) -> DataFrame:
    """Published pairs that are no longer eligible."""
    live = published_pairs(publish, publish_status.filter(F.col("publish_status") == "published"))
    pairs = eligible_items(rows, languages).withColumn(
        "language_code", F.explode(F.array(*map(F.lit, languages))))
    return live.join(pairs, PAIR, "left_anti")


def status_counts_by_policy(decision, approved, translation, publish, publish_status,
                            languages: list[str]) -> DataFrame:
    """Published, withdrawn, frozen slugs, eligible and blocked items in one row."""
    done = translation.filter((F.col("translation_status") == "completed")
                              & F.col("language_code").isin(languages)).select(
        "parent_content_id", "language_code", "source_fingerprint")
    full = (approved.select(KEY, "parent_content_id", "content_fingerprint")
            .join(done, "parent_content_id").filter(R.current_version())
            .groupBy(KEY).agg(F.collect_set("language_code").alias("_have"))
            .filter(F.size(F.array_except(F.array(*map(F.lit, languages)), "_have")) == 0)
            .select(KEY, F.lit(True).alias("_full")))
    items = (decision.filter(F.col("curate_status") == "approved").select(KEY)
             .join(full, KEY, "left").agg(
                 R.tally(F.col("_full").isNotNull()).alias("eligible_items"),
                 R.tally(F.col("_full").isNull()).alias("blocked_items")))
    rows = publish_status.agg(
        R.tally(F.col("publish_status") == "published").alias("published_artifacts"),
        R.tally(F.col("publish_status") == "withdrawn").alias("withdrawn_artifacts"))
    slugs = publish.agg(F.count(F.lit(1)).alias("frozen_slugs"))
    return rows.crossJoin(F.broadcast(slugs)).crossJoin(F.broadcast(items))


def upsert_status(publish_status: DataFrame, changes: DataFrame) -> DataFrame:
    """The complete status table: a change sets only the time of its own status.

    ``changes``: publish_record_id, language_code, publish_status, moment, source_fingerprint.
    """
    key = ["publish_record_id", "language_code"]
    new = changes.select(*key, F.col("publish_status").alias("_s"), F.col("moment").alias("_m"),
                         F.col("source_fingerprint").alias("_f"))
    both = publish_status.join(new, key, "full")
    status, hit = F.coalesce("_s", "publish_status"), F.col("_s")
    return both.select(
        *key, status.alias("publish_status"),
        F.when(hit == "published", F.col("_m")).otherwise(F.col("published_at"))
        .alias("published_at"),
        F.when(hit == "withdrawn", F.col("_m")).otherwise(F.col("withdrawn_at"))
        .alias("withdrawn_at"),
        F.coalesce("_f", "source_fingerprint").alias("source_fingerprint"))


def title_source(rows: DataFrame) -> DataFrame:
    """Title each unpublished item is slugged from: English, else the first filled language."""
    title = F.col("display_title")
    filled = F.when(F.length(title) > 0, F.col("language_code"))
    return rows.groupBy(KEY).agg(F.coalesce(
        F.max(F.when(F.col("language_code") == "en", title)),
        F.min_by(title, filled)).alias("title"))


def new_records(rows: DataFrame, publish: DataFrame, run_ts) -> DataFrame:
    """Publish records of items published for the first time; existing slugs never move."""
    from pressline.operators.slugs import assign_slugs
    fresh = rows.join(publish.select(KEY), KEY, "left_anti")
    slugs = assign_slugs(title_source(fresh), publish.select("slug"), KEY, "title")
    return slugs.withColumn("first_published_at", R.at(run_ts))


# --- payloads ----------------------------------------------------------------------------------------------

def payload_rows(approved, decision, translation, item, publish, publish_status) -> DataFrame:
    """Everything an exported item shows, one row per live (item, language)."""
    live = published_pairs(publish, publish_status.filter(
        F.col("publish_status") == "published")).select(*PAIR, "slug", "published_at")
    master = approved.select(KEY, "parent_content_id", "content_fingerprint", "approved_at",
                             "author_metadata")
    text = translation.select("parent_content_id", "language_code", "display_title",
                              "summary_short", "bullet_1", "bullet_2", "bullet_3",
                              "source_fingerprint")
    return (live.join(master, KEY)
            .join(decision.select(KEY, "downstream_action"), KEY)
            .join(item.select(KEY, "canonical_url",
                              F.col("published_at").alias("source_published_at")), KEY)
            .join(text, ["parent_content_id", "language_code"]).filter(R.current_version())
            .drop("parent_content_id", "source_fingerprint", "content_fingerprint"))


def canonical_payloads(approved, decision, translation, item) -> DataFrame:
    """The same fields straight from the upstream tables, published or not."""
    master = approved.select(KEY, "parent_content_id", "content_fingerprint", "approved_at",
                             "author_metadata")
    text = translation.select("parent_content_id", "language_code", "display_title",
                              "summary_short", "bullet_1", "bullet_2", "bullet_3",
                              "source_fingerprint")
    return (master.join(decision.select(KEY, "downstream_action"), KEY)
            .join(item.select(KEY, "canonical_url",
                              F.col("published_at").alias("source_published_at")), KEY)
            .join(text, "parent_content_id").filter(R.current_version())
            .drop("parent_content_id", "source_fingerprint", "content_fingerprint"))


def find_payloads(payloads: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Payloads of the wanted keys, by (item, language) or by (language, slug)."""
    return payloads.join(wanted.select(*keys).distinct(), keys, "left_semi")


def with_note(rows: DataFrame) -> DataFrame:
    writer = F.get_json_object("author_metadata", "$.writer_type")
    return rows.withColumn("disclosure_note", disclosure_note(writer))


def bullets_struct() -> Column:
    """The three named bullets for a summary, NULL for a link."""
    named = [F.col(f"bullet_{i}").alias(k) for i, k in enumerate(V.BULLET_KEYS, start=1)]
    return F.when(F.col("downstream_action") == "publish_summary", F.struct(*named))


def item_documents(rows: DataFrame) -> DataFrame:
    """The export document of each payload row as JSON text, absent values written as null.

    The stored metadata object is spliced in as it is, so unknown keys survive.
    """
    rows = with_note(rows)
    head = canonical_json(
        F.col(KEY), F.col("language_code"), F.col("slug"), F.col("display_title"),
        F.col("summary_short"), bullets_struct().alias("bullets"), F.col("canonical_url"),
        R.iso("source_published_at").alias("source_published_at"),
        R.iso("approved_at").alias("approved_at"), R.iso("published_at").alias("published_at"),
        F.col("downstream_action"), F.col("disclosure_note"))
    meta = F.coalesce(F.when(F.try_parse_json("author_metadata").isNotNull(),
                             F.col("author_metadata")), F.lit("null"))
    return rows.withColumn("document", F.concat(
        F.regexp_replace(head, "\\}$", ""), F.lit(',"author_metadata":'), meta, F.lit("}")))


# --- catalogues ----------------------------------------------------------------------------------------------

def catalogue_rows(payloads: DataFrame) -> DataFrame:
    """The seven catalogue fields with language and archive month."""
    return payloads.select("language_code", *CATALOGUE,
                           archive_month(F.col("source_published_at")).alias("archive_month"))


def _newest(order_desc: str = "source_published_at") -> list[Column]:
    return [F.col(order_desc).desc_nulls_last(), F.col("slug")]


def latest_index(catalogue: DataFrame, limit: int = V.LATEST_LIMIT) -> DataFrame:
    """Newest entries per language; the rank limit is applied map-side before the shuffle."""
    w = W.partitionBy("language_code").orderBy(*_newest())
    return catalogue.withColumn("position", F.row_number().over(w)).filter(
        F.col("position") <= limit)


def archive_sorted(catalogue: DataFrame) -> DataFrame:
    """All dated entries in archive order, range-partitioned so a big month spans many tasks."""
    return (catalogue.filter(F.col("archive_month").isNotNull())
            .repartitionByRange("language_code", "archive_month",
                                F.col("source_published_at").desc(), "slug")
            .sortWithinPartitions("language_code", "archive_month",
                                  F.col("source_published_at").desc(), "slug"))


def month_counts(publish, publish_status, item) -> DataFrame:
    """Live items per language and archive month (undated ones under NULL)."""
    rows = active_rows(publish, publish_status).select(*PAIR).join(
        item.select(KEY, archive_month(F.col("published_at")).alias("archive_month")), KEY)
    return rows.groupBy("language_code", "archive_month").agg(
        F.count(F.lit(1)).alias("item_count"))


def active_months(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("archive_month").isNotNull()).select(
        "language_code", "archive_month")


def month_stats(counts: DataFrame, languages: DataFrame) -> DataFrame:
    """Month count and oldest month per configured language."""
    stats = counts.groupBy("language_code").agg(
        F.count("archive_month").alias("archive_month_count"),
        F.min("archive_month").alias("oldest_archive_month"))
    return languages.select("language_code").join(stats, "language_code", "left").fillna(
        0, subset=["archive_month_count"])


def status_counts(publish_status, languages: DataFrame) -> DataFrame:
    """Published and withdrawn rows per language, zero-filled for configured languages."""
    counts = (publish_status.groupBy("language_code")
              .pivot("publish_status", V.PUBLISH_STATUSES).count())
    return languages.select("language_code").join(counts, "language_code", "full").fillna(
        0, subset=V.PUBLISH_STATUSES)


def export_stats(publish, publish_status, item, languages: DataFrame,
                 limit: int = V.LATEST_LIMIT) -> DataFrame:
    """All per-language export numbers."""
    counts = month_counts(publish, publish_status, item)
    return (status_counts(publish_status, languages)
            .withColumn("latest_index_count", F.least(F.col("published"), F.lit(limit)))
            .join(month_stats(counts, languages), "language_code", "left")
            .fillna(0, subset=["archive_month_count"]))


def stats_document(stats: DataFrame, run_ts) -> DataFrame:
    """The one-row stats document: five maps by language and the run time."""
    def by_language(column: str) -> Column:
        return F.map_from_entries(F.sort_array(F.collect_list(
            F.struct("language_code", column))))
    return stats.agg(
        by_language("published").alias("total_active_published_items_by_language"),
        by_language("withdrawn").alias("total_withdrawn_items_by_language"),
        by_language("latest_index_count").alias("latest_index_count_by_language"),
        by_language("archive_month_count").alias("archive_month_count_by_language"),
        by_language("oldest_archive_month").alias("oldest_archive_month_by_language"),
        F.max(R.iso(R.at(run_ts))).alias("last_export_run_timestamp"))


# --- digests -------------------------------------------------------------------------------------------------

LANE_BITS = 20


def lanes(row_digest: Column) -> list[Column]:
    """Four 60-bit lanes of a row digest."""
    return [F.conv(F.substring(row_digest, 1 + 15 * i, 15), 16, 10).cast("long") for i in range(4)]


def lane_sum(lane: Column) -> Column:
    """Exact sum of a lane as a decimal: 20 bits at a time, so that rows are added up as plain longs."""
    def piece(k: int) -> Column:
        part = F.shiftright(lane, LANE_BITS * k).bitwiseAND(F.lit((1 << LANE_BITS) - 1))
        return F.coalesce(F.sum(part), F.lit(0)).cast("decimal(20,0)") * F.lit(1 << LANE_BITS * k).cast("decimal(13,0)")
    return (piece(2) + piece(1) + piece(0)).cast("decimal(38,0)")


def set_digest(row_digest: Column) -> Column:
    """Digest of a whole group of rows from their digests, as an aggregate.

    Lane sums combine map-side, so no group is ever gathered in one place, and the result does not
    depend on partitioning. The order of the rows must be part of the row text where it matters.
    """
    sums = [lane_sum(lane).cast("string") for lane in lanes(row_digest)]
    return F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *sums), 256)


def entry_json() -> Column:
    return canonical_json(
        F.col("slug"), F.col("display_title"), F.col("summary_short"), F.col("canonical_url"),
        R.iso("source_published_at").alias("source_published_at"),
        R.iso("approved_at").alias("approved_at"), R.iso("published_at").alias("published_at"))


def archive_digests(catalogue: DataFrame) -> DataFrame:
    """Digest per (language, month); the entries' own fields fix their order."""
    return (catalogue.filter(F.col("archive_month").isNotNull())
            .withColumn("_d", F.sha2(entry_json(), 256)).groupBy("language_code", "archive_month")
            .agg(set_digest(F.col("_d")).alias("digest"), F.count(F.lit(1)).alias("item_count")))


def archive_stamps(digests: DataFrame, metadata: DataFrame, prior: DataFrame, run_ts,
                   rebuild: bool = False) -> DataFrame:
    """Manifest entries with their time stamp: the old one while the content is the same.

    ``prior``: language_code, archive_month, digest of the previous snapshot.
    """
    key = ["language_code", "archive_month"]
    rows = (digests.join(metadata.withColumnRenamed("updated_at", "_old"), key, "left")
            .join(prior.select(*key, F.col("digest").alias("_prior")), key, "left"))
    same = F.col("_old").isNotNull() & (F.col("_prior") == F.col("digest")) & F.lit(not rebuild)
    return rows.select(*key, archive_file(F.col("archive_month")).alias("file_name"), "item_count",
                       "digest", F.when(same, F.col("_old")).otherwise(R.at(run_ts))
                       .alias("updated_at"))


def shrunk_metadata(metadata: DataFrame, languages: DataFrame) -> DataFrame:
    """Archive metadata of languages that are no longer configured."""
    return metadata.join(languages.select("language_code"), "language_code", "left_anti")


def retired_months(metadata: DataFrame, months: DataFrame, languages: DataFrame) -> DataFrame:
    """Metadata months of configured languages that have no live item any more."""
    return (metadata.join(languages.select("language_code"), "language_code", "left_semi")
            .join(months, ["language_code", "archive_month"], "left_anti"))


def metadata_changes(metadata: DataFrame, stamps: DataFrame) -> DataFrame:
    """What a run changes in the metadata table: new or moved stamps, and months that are gone (``_gone``)."""
    key = ["language_code", "archive_month"]
    planned = stamps.select(*metadata.columns)
    gone = metadata.join(planned.select(*key), key, "left_anti").withColumn("_gone", F.lit(True))
    return planned.exceptAll(metadata).withColumn("_gone", F.lit(False)).unionByName(gone)


def synced_metadata(metadata: DataFrame, stamps: DataFrame) -> DataFrame:
    """The metadata table after a run: exactly the planned months with their stamps."""
    return stamps.select(*metadata.columns)


def artifact_digests(documents: DataFrame, index: DataFrame, stamps: DataFrame,
                     stats: DataFrame) -> DataFrame:
    """(path, digest, ordinal) of every artifact of a snapshot in the fixed artifact order."""
    def row(rows, path, digest, ordinal):
        return rows.select(path.alias("path"), digest.alias("digest"), ordinal.alias("ordinal"))
    lang = F.col("language_code")

    def order(kind: str, *more: Column) -> Column:
        return F.concat_ws("/", F.lit("0"), lang, F.lit(kind), *more)

    items = row(documents, F.concat_ws("/", lang, F.lit("items"), F.concat("slug", F.lit(".json"))),
                F.sha2("document", 256), order("4", F.col("slug")))
    entries = index.withColumn("_d", F.sha2(F.concat_ws("|", F.col("position").cast("string"),
                                                        entry_json()), 256))
    indexes = row(entries.groupBy("language_code").agg(set_digest(F.col("_d")).alias("_g")),
                  F.concat_ws("/", lang, F.lit("index.json")), F.col("_g"), order("1"))
    line = canonical_json(F.col("archive_month"), F.col("file_name"), F.col("item_count"),
                          R.iso("updated_at").alias("updated_at"))
    manifests = row(stamps.withColumn("_d", F.sha2(line, 256)).groupBy("language_code").agg(
        set_digest(F.col("_d")).alias("_g")),
        F.concat_ws("/", lang, F.lit("archives/index.json")), F.col("_g"), order("2"))
    months = row(stamps, F.concat_ws("/", lang, F.lit("archives"), F.col("file_name")),
                 F.col("digest"), order("3", F.col("archive_month")))
    # The run time stays out, so it never looks like a change.
    numbers = row(stats.drop("last_export_run_timestamp").withColumn(
        "_g", F.sha2(F.to_json(F.struct("*")), 256)), F.lit("stats.json"), F.col("_g"), F.lit("1"))
    parts = [indexes, manifests, months, items, numbers]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "digest", F.concat(F.lit("sha256:"), "digest"))


def state_fingerprint(digests: DataFrame, languages: list[str],
                      limit: int = V.LATEST_LIMIT) -> DataFrame:
    """One value for the whole export state: header plus all (path, digest) pairs."""
    header = "|".join(["setdigest-v1", "strict_match", str(limit), "month", ",".join(languages)])
    rows = digests.withColumn("_d", F.sha2(F.concat_ws("|", "path", "digest"), 256))
    return rows.agg(F.concat(F.lit("setdigest-v1:"), F.sha2(F.concat_ws(
        "|", F.lit(header), set_digest(F.col("_d"))), 256)).alias("content_fingerprint"))


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """added, changed, unchanged or removed per path; unchanged ones need no rewrite."""
    a = old.select("path", F.col("digest").alias("old_digest"))
    b = new.select("path", F.col("digest").alias("new_digest"))
    state = (F.when(F.col("old_digest").isNull(), "added")
             .when(F.col("new_digest").isNull(), "removed")
             .when(F.col("old_digest") == F.col("new_digest"), "unchanged").otherwise("changed"))
    return a.join(b, "path", "full").select("path", state.alias("change"))


def snapshots_to_retire(snapshots: DataFrame, live: str | None, keep: int = V.KEEP_SNAPSHOTS) -> DataFrame:
    """Ids beyond the newest ``keep``; the live one never goes, unknown names are left alone."""
    base = F.regexp_extract("generation_id", "^(.*Z)(?:-r[0-9]+)?$", 1)
    suffix = F.coalesce(F.nullif(F.regexp_extract("generation_id", "-r([0-9]+)$", 1), F.lit(""))
                        .cast("long"), F.lit(0))
    valid = snapshots.filter(F.col("generation_id").rlike(V.SNAPSHOT_ID_PATTERN)).select(
        "generation_id", base.alias("_b"), suffix.alias("_s"))
    # The newest few come from a top-k; everything else retires without a global sort.
    newest = valid.orderBy(F.desc("_b"), F.desc("_s")).limit(keep).select("generation_id")
    old = valid.join(F.broadcast(newest), "generation_id", "left_anti").select("generation_id")
    return old if live is None else old.filter(F.col("generation_id") != live)


# --- site ----------------------------------------------------------------------------------------------------

def translation_map(rows: DataFrame) -> DataFrame:
    """Slug -> sorted languages."""
    return rows.groupBy("slug").agg(F.sort_array(F.collect_set("language_code")).alias("languages"))


def repeated_slugs(rows: DataFrame) -> DataFrame:
    """Slugs that occur twice in one language, which stops an export."""
    return rows.groupBy("language_code", "slug").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def post_routes(slug_map: DataFrame) -> DataFrame:
    return slug_map.select(F.explode("languages").alias("lang"), "slug")


def month_pages(stamps: DataFrame) -> DataFrame:
    return stamps.select(F.col("language_code").alias("lang"), F.col("archive_month").alias("month"),
                         "file_name")


def home_page(index: DataFrame, limit: int = V.HOME_LIMIT) -> DataFrame:
    return index.filter(F.col("position") <= limit)


def _quoted(c: Column) -> Column:
    """A JSON string literal, or null."""
    return F.regexp_extract(canonical_json(c.alias("x")), "(?s)^\\{\"x\":(.*)\\}$", 1)


def post_documents(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Post text: front matter, summary and the labelled bullets when there are any."""
    rows = with_note(rows).join(labels, "language_code")

    def quoted(c: Column) -> Column:
        return F.when(c.isNull() | (c == ""), "null").otherwise(_quoted(c))

    lines = [F.concat(F.lit("* **"), F.col(f"label_{i}"), F.lit("**: "), F.col(f"bullet_{i}"))
             for i in (1, 2, 3)]
    body = F.when(F.col("downstream_action") == "publish_summary", F.concat(
        F.col("summary_short"), F.lit("\n\n"), F.concat_ws("\n", *lines))).otherwise(
        F.col("summary_short"))
    text = F.concat_ws(
        "\n", F.lit("---"),
        F.concat(F.lit("title: "), _quoted(F.col("display_title"))),
        F.concat(F.lit("publishDate: "), _quoted(R.iso("source_published_at"))),
        F.concat(F.lit("description: "), _quoted(F.col("summary_short"))),
        F.concat(F.lit("canonicalUrl: "), quoted(F.col("canonical_url"))),
        F.concat(F.lit("disclosureNote: "), quoted(F.col("disclosure_note"))),
        F.concat(F.lit("authorMetadata: "), F.coalesce("author_metadata", F.lit("{}"))),
        F.lit("---"), F.lit(""), body)
    return rows.select("language_code", "slug", text.alias("post"))


def post_labels(spark) -> DataFrame:
    rows = [(lang, *names) for lang, names in V.POST_LABELS.items()]
    return spark.createDataFrame(rows, "language_code string, label_1 string, label_2 string, "
                                       "label_3 string")
