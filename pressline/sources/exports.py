"""Writing and reading exported snapshots.

An export root holds ``generations/generation=<id>/`` with one folder per small artifact kind,
``store/`` with the item and archive files by the generation that wrote them, and ``pointer/``, an
append-only log whose newest row names the live snapshot. Readers follow the pointer, so a
half-written snapshot is never seen. A generation lists its parts with their digests; a part that has
the digest of the generation before is not written again, its entry refers to the files it has. So the
files of a generation may be removed when no kept generation refers to them any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pressline import fixed_values as V
from pressline.functions import rates as R
from pressline.operators import publish as B
from pressline.operators.audits import archive_entries_audit, catalogue_audit, stats_audit
from pressline.session import cut_lineage

CATALOGUE_SCHEMA = ("slug string, display_title string, summary_short string, "
                    "canonical_url string, source_published_at string, approved_at string, "
                    "published_at string")
MANIFEST_SCHEMA = ("archive_month string, file_name string, item_count long, updated_at string")
STATS_SCHEMA = ("total_active_published_items_by_language map<string,long>, "
                "total_withdrawn_items_by_language map<string,long>, "
                "latest_index_count_by_language map<string,long>, "
                "archive_month_count_by_language map<string,long>, "
                "oldest_archive_month_by_language map<string,string>, "
                "last_export_run_timestamp string")
POINTER_SCHEMA = ("generation string, export_completed_at string, last_successful_run_at string, "
                  "languages array<string>, content_fingerprint string")
DIGEST_SCHEMA = "path string, digest string, ordinal string"
PARTS_SCHEMA = "kind string, language_code string, part string, digest string, n long, home string"
ITEM_PARTS = 32
"""Parts of the item documents of one language, by a hash of the slug."""


# --- sinks ---------------------------------------------------------------------------------------------------

def write_items(documents: DataFrame, path: str) -> None:
    """One JSON document per line and (language, slug), a folder per language."""
    documents.select("language_code", F.col("document").alias("value")).write.partitionBy(
        "language_code").text(path)


def _iso_columns(df: DataFrame) -> DataFrame:
    return df.select([R.iso(c).alias(c) if isinstance(f.dataType, T.TimestampType) else F.col(c)
                      for c, f in zip(df.columns, df.schema.fields)])


def write_index(index: DataFrame, path: str) -> None:
    """The latest entries per language in order; bounded by the index limit."""
    rows = _iso_columns(index.select("language_code", "position", *B.CATALOGUE))
    (rows.repartition("language_code").sortWithinPartitions("language_code", "position")
     .write.partitionBy("language_code").option("ignoreNullFields", "false").json(path))


def write_archives(catalogue: DataFrame, path: str) -> None:
    """Month archives in archive order; a large month is split over several files in order."""
    rows = _iso_columns(B.archive_sorted(catalogue).select("language_code", "archive_month",
                                                           *B.CATALOGUE))
    rows.write.partitionBy("language_code", "archive_month").option(
        "ignoreNullFields", "false").json(path)


def write_manifest(stamps: DataFrame, path: str) -> None:
    rows = _iso_columns(stamps.select("language_code", "archive_month", "file_name", "item_count",
                                      "updated_at"))
    (rows.repartition("language_code")
     .sortWithinPartitions("language_code", F.desc("archive_month"))
     .write.partitionBy("language_code").json(path))


def write_stats(document: DataFrame, path: str) -> None:
    document.coalesce(1).write.option("ignoreNullFields", "false").json(path)


def write_posts(posts: DataFrame, path: str) -> None:
    """Post texts per language, one row per post with its slug."""
    posts.write.partitionBy("language_code").json(path)


def write_translation_map(rows: DataFrame, path: str) -> None:
    """Slug -> languages. A slug that occurs twice in a language stops the export."""
    repeated = B.repeated_slugs(rows).limit(1).count()
    if repeated:
        raise ValueError("a slug occurs twice in one language")
    B.translation_map(rows).repartitionByRange("slug").sortWithinPartitions("slug").write.json(path)


def write_digests(digests: DataFrame, path: str) -> None:
    """Digest manifest in the fixed artifact order."""
    digests.select("path", "digest", "ordinal").orderBy("ordinal", "path").write.json(path)


def emit_report(report: DataFrame, path: str) -> None:
    """A report document: one row of JSON."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


# --- readers ---------------------------------------------------------------------------------------------------

def _fail_on(bad: DataFrame, what: str) -> None:
    """Stop when an audit leaves a row; one row is enough to know."""
    first = bad.limit(1).collect()
    if first:
        raise ValueError(f"{what}: {first[0].asDict()}")


def _index_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("position int, language_code string, " + CATALOGUE_SCHEMA).json(
        path, mode="FAILFAST")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    rows = _index_rows(spark, path)
    _fail_on(catalogue_audit(rows).filter("NOT is_valid"), "invalid index entry")
    return rows


def split_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) entries of a written index; undated ones are invalid, with the reason."""
    rows = catalogue_audit(_index_rows(spark, path))
    return rows.filter("is_valid"), rows.filter("NOT is_valid")


def read_archives(spark: SparkSession, path: str, language: str | None = None,
                  month: str | None = None) -> DataFrame:
    """Archive entries; language and month prune folders before anything is read."""
    rows = spark.read.schema("language_code string, archive_month string, "
                             + CATALOGUE_SCHEMA).json(path, mode="FAILFAST")
    if language:
        rows = rows.filter(F.col("language_code") == language)
    if month:
        rows = rows.filter(F.col("archive_month") == month)
    _fail_on(catalogue_audit(rows).filter("NOT is_valid"), "invalid archive entry")
    return rows


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("language_code string, " + MANIFEST_SCHEMA).json(path, mode="FAILFAST")
    _fail_on(archive_entries_audit(rows).filter("NOT is_valid"), "invalid manifest entry")
    return rows


def read_stats(spark: SparkSession, path: str, locales: list[str]) -> DataFrame:
    rows = spark.read.schema(STATS_SCHEMA).json(path, mode="FAILFAST")
    _fail_on(stats_audit(rows, locales).filter("NOT is_valid"), "invalid stats")
    return rows


def legal_path(c):
    """A relative path with forward slashes and no empty or dot segments."""
    parts = F.split(c, "/")
    return (F.length(c) > 0) & ~c.contains("\\") & ~c.contains(":") & ~F.exists(
        parts, lambda p: p.isin("", ".", ".."))


def digest_problems(digests: DataFrame) -> DataFrame:
    """(problem, path) rows of a digest manifest: bad records, repeats, empty or cut short."""
    ok = F.coalesce(legal_path(F.col("path")) & F.col("digest").rlike(V.DIGEST_PATTERN),
                    F.lit(False))
    bad = digests.filter(~ok).select(F.lit("invalid record").alias("problem"), "path")
    twice = digests.groupBy("path").count().filter("count > 1").select(
        F.lit("repeated path").alias("problem"), "path")
    end = digests.agg(F.count(F.lit(1)).alias("n"), F.max_by("path", "ordinal").alias("path"))
    shape = end.filter((F.col("n") == 0) | (F.col("path") != "stats.json")).select(
        F.when(F.col("n") == 0, "empty manifest").otherwise("cut short").alias("problem"), "path")
    return bad.unionByName(twice).unionByName(shape)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(DIGEST_SCHEMA).json(path, mode="FAILFAST")
    _fail_on(digest_problems(rows), "corrupt digest manifest")
    return rows


# --- snapshots ---------------------------------------------------------------------------------------------------

def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def read_pointer(spark: SparkSession, root: str) -> dict | None:
    """The newest pointer row, or None before the first export."""
    path = f"{root}/pointer"
    if not path_exists(spark, path):
        return None
    rows = (spark.read.schema(POINTER_SCHEMA).json(path)
            .orderBy(F.desc("last_successful_run_at")).limit(1).collect())
    return rows[0].asDict() if rows else None


def write_pointer(spark: SparkSession, root: str, pointer: dict) -> None:
    names = [f.split()[0] for f in POINTER_SCHEMA.split(", ")]
    spark.createDataFrame([tuple(pointer[n] for n in names)], POINTER_SCHEMA).coalesce(
        1).write.mode("append").json(f"{root}/pointer")


def live_path(root: str, pointer: dict, kind: str) -> str:
    return f"{root}/generations/generation={pointer['generation']}/{kind}"


def snapshot_parts(plan: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """kind -> rows with ``part``, ``line`` (the stored text) and ``_d`` (its digest)."""
    items = plan["documents"].select(
        "language_code", F.format_string("%02d", F.pmod(F.xxhash64("slug"), F.lit(ITEM_PARTS))).alias("part"),
        F.col("document").alias("line"))
    entry = F.to_json(F.struct(*[F.col(c) for c in B.CATALOGUE]), {"ignoreNullFields": "false"})
    rows = plan["catalogue"].filter(F.col("archive_month").isNotNull())
    archives = _iso_columns(rows.select("language_code", F.col("archive_month").alias("part"), *B.CATALOGUE)).select(
        "language_code", "part", entry.alias("line"))
    return {"items": items, "archives": archives}


def part_digests(parts: dict[str, DataFrame]) -> DataFrame:
    """(kind, language_code, part, digest, n): sums of line digests, so no part is gathered anywhere."""
    out = [rows.groupBy(F.lit(kind).alias("kind"), "language_code", "part").agg(
        B.set_digest(F.sha2("line", 256)).alias("digest"), F.count(F.lit(1)).alias("n")) for kind, rows in parts.items()]
    return out[0].unionByName(out[1])


def read_parts(spark: SparkSession, root: str, pointer: dict) -> DataFrame:
    return spark.read.schema(PARTS_SCHEMA).json(live_path(root, pointer, "parts"), mode="FAILFAST")


def read_lines(spark: SparkSession, root: str, pointer: dict, kind: str) -> DataFrame:
    """(language_code, part, line) of a generation, wherever its parts were written."""
    homes = read_parts(spark, root, pointer).filter(F.col("kind") == kind).select("home").distinct().collect()
    wanted = read_parts(spark, root, pointer).filter(F.col("kind") == kind).select("language_code", "part", "home")
    if not homes:
        return spark.createDataFrame([], "language_code string, part string, line string")
    # Partition columns only, so files of other parts are pruned; there is one row per part on the other side.
    stored = spark.read.schema("value string, home string, language_code string, part string").text(f"{root}/store/{kind}")
    here = stored.filter(F.col("home").isin([r[0] for r in homes]))
    return here.join(wanted, ["home", "language_code", "part"], "left_semi").select(
        "language_code", "part", F.col("value").alias("line"))


def write_changed_parts(spark: SparkSession, root: str, pointer: dict, old: dict | None,
                        parts: dict[str, DataFrame], rebuild: bool = False) -> None:
    """Write the parts that the generation before does not hold, and the list of all parts."""
    fresh = part_digests(parts)
    key = ["kind", "language_code", "part", "digest"]
    before = (read_parts(spark, root, old).select(*key, "home") if old and not rebuild
              else spark.createDataFrame([], PARTS_SCHEMA).select(*key, "home"))
    listed = cut_lineage(fresh.join(before, key, "left").withColumn(
        "home", F.coalesce("home", F.lit(pointer["generation"]))))
    new = listed.filter(F.col("home") == pointer["generation"])
    for kind, rows in parts.items():
        own = new.filter(F.col("kind") == kind).select("language_code", "part")
        # Rows of a part meet before the write, else every task opens a file for each part; only a part that is
        # too large for one task is split over several.
        (rows.join(own, ["language_code", "part"], "left_semi")
         .select("language_code", "part", F.col("line").alias("value"))
         .hint("rebalance", "language_code", "part")
         .write.mode("overwrite").partitionBy("language_code", "part")
         .text(f"{root}/store/{kind}/home={pointer['generation']}"))
    listed.write.json(live_path(root, pointer, "parts"))


def publish_snapshot(spark: SparkSession, root: str, plan: dict[str, DataFrame], run_ts: str,
                     languages: list[str], rebuild: bool = False) -> dict:
    """Make a new complete snapshot when the export state changed, then move the pointer.

    ``plan``: documents, index, catalogue, stamps, stats. Without a change only the time of the
    last successful run moves on. Of items and archives only parts with another digest than in the live
    snapshot are written; ``rebuild`` writes all. The pointer row comes last, so a lost job leaves the
    old snapshot live.
    """
    digests = cut_lineage(B.artifact_digests(plan["documents"], plan["index"], plan["stamps"],
                                             plan["stats"]))
    fingerprint = B.state_fingerprint(digests, languages).first()[0]
    old = read_pointer(spark, root)
    changed = rebuild or old is None or old["content_fingerprint"] != fingerprint
    if not changed:
        pointer = {**old, "last_successful_run_at": run_ts}
    else:
        generation = run_ts.replace(":", "-")
        step = 2
        while path_exists(spark, f"{root}/generations/generation={generation}"):
            generation = f"{run_ts.replace(':', '-')}-r{step}"
            step += 1
        pointer = {"generation": generation, "export_completed_at": run_ts,
                   "last_successful_run_at": run_ts, "languages": languages,
                   "content_fingerprint": fingerprint}
        write_changed_parts(spark, root, pointer, old, snapshot_parts(plan), rebuild)
        write_index(plan["index"], live_path(root, pointer, "index"))
        write_manifest(plan["stamps"], live_path(root, pointer, "manifest"))
        write_stats(plan["stats"], live_path(root, pointer, "stats"))
        write_digests(digests, live_path(root, pointer, "digests"))
    write_pointer(spark, root, pointer)
    return {**pointer, "changed": changed}
