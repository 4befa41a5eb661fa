"""Contract audits: total functions that give every row ``is_valid`` and the first ``reason``,
or list the violations of a whole table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pressline import fixed_values as V
from pressline.functions import content as K
from pressline.functions import rates as R
from pressline.functions.titles import blank
from pressline.functions.times import valid_iso
from pressline.operators.responses import first_failure, judged
from pressline.schemas import CHECKS, KEYS, PARENTS, TABLES


def is_date(c: Column) -> Column:
    return F.try_to_timestamp(c).isNotNull()


def bad_slug(c: Column) -> Column:
    return ~F.coalesce(c.rlike(V.SLUG_PATTERN), F.lit(False))


# --- export payloads -------------------------------------------------------------------------------------

def payload_audit(rows: DataFrame) -> DataFrame:
    """Export item contract on payload rows (flat bullets, metadata as JSON text)."""
    meta = F.try_parse_json("author_metadata")
    rows = rows.withColumn("_m", meta)

    def text(name: str) -> Column:
        path = f"$.{name}"
        typed = F.schema_of_variant(F.variant_get("_m", path, "variant"))
        return F.when(typed == "STRING", F.try_variant_get("_m", path, "string"))

    writer, summary = text("writer_type"), F.col("downstream_action") == "publish_summary"
    bullets = [F.col(f"bullet_{i}") for i in (1, 2, 3)]
    shape = []
    for b, name in sorted(zip(bullets, V.BULLET_KEYS), key=lambda p: p[1]):
        shape += [(summary & blank(b), f"bullets.{name} is blank"),
                  (summary & K.has_label_prefix(b), f"bullets.{name} starts with a label")]
    reason = first_failure(
        (blank(F.col("display_title")), "display_title is blank"),
        (blank(F.col("language_code")), "language_code is blank"),
        (blank(F.col("slug")), "slug is blank"),
        (blank(F.col("summary_short")), "summary_short is blank"),
        (K.has_label_prefix(F.col("summary_short")), "summary_short starts with a label"),
        (~F.coalesce(F.col("downstream_action").isin(V.PUBLISH_ACTIONS), F.lit(False)),
         "downstream_action"), *shape,
        (F.col("_m").isNull() | ~F.schema_of_variant("_m").startswith("OBJECT"),
         "author_metadata is no object"),
        (blank(text("source_module")), "source_module"),
        (writer.isin(V.WRITER_TYPES_EDITED) & blank(text("editor")), "editor is required"),
        (~F.coalesce(writer.isin(V.WRITER_TYPES_EDITED + V.WRITER_TYPES_GENERATED), F.lit(False)),
         "writer_type"))
    return judged(rows, reason).drop("_m")


def catalogue_audit(rows: DataFrame) -> DataFrame:
    """Catalogue entry contract on text columns."""
    return judged(rows, first_failure(
        (blank(F.col("slug")), "slug is blank"), (bad_slug(F.col("slug")), "slug format"),
        (blank(F.col("display_title")), "display_title is blank"),
        (blank(F.col("summary_short")), "summary_short is blank"),
        (~is_date(F.col("source_published_at")), "source_published_at")))


def safe_file_name(c: Column) -> Column:
    return F.coalesce(c.rlike(V.ARCHIVE_FILE_PATTERN) & ~c.contains(".."), F.lit(False))


def archive_entries_audit(rows: DataFrame) -> DataFrame:
    """Archive manifest contract."""
    return judged(rows, first_failure(
        (~F.coalesce(F.col("archive_month").rlike(V.MONTH_PATTERN), F.lit(False)), "archive_month"),
        (~safe_file_name(F.col("file_name")), "file_name"),
        (F.col("item_count").isNull() | (F.col("item_count") < 0), "item_count"),
        (~is_date(F.col("updated_at")), "updated_at")))


COUNT_MAPS = ["total_active_published_items_by_language", "total_withdrawn_items_by_language",
              "latest_index_count_by_language", "archive_month_count_by_language"]


def stats_audit(rows: DataFrame, locales: list[str]) -> DataFrame:
    """Stats contract: every locale in all five maps; further locales are fine."""
    rules = [(~is_date(F.col("last_export_run_timestamp")), "last_export_run_timestamp")]
    for m in COUNT_MAPS:
        rules.append((F.col(m).isNull(), f"{m} is missing"))
        for lang in locales:
            value = F.try_element_at(F.col(m), F.lit(lang))
            rules.append((value.isNull() | (value < 0), f"{m}.{lang}"))
    oldest = F.col("oldest_archive_month_by_language")
    rules.append((oldest.isNull(), "oldest_archive_month_by_language is missing"))
    for lang in locales:
        value = F.try_element_at(oldest, F.lit(lang))
        rules.append((~F.map_contains_key(oldest, lang)
                      | (value.isNotNull() & ~value.rlike(V.MONTH_PATTERN)),
                      f"oldest_archive_month_by_language.{lang}"))
    return judged(rows, first_failure(*rules))


def post_audit(rows: DataFrame, locale: str = "language_code", expected: str | None = None) -> DataFrame:
    """Post item contract; ``expected`` names the column with the requested locale."""
    named = [F.col(f"bullet_{i}") for i in (1, 2, 3)]
    any_set = reduce(lambda x, y: x | y, [b.isNotNull() for b in named])
    any_blank = reduce(lambda x, y: x | y, [blank(b) for b in named])
    rules = [(blank(F.col("slug")), "slug is blank"), (bad_slug(F.col("slug")), "slug format"),
             (blank(F.col("display_title")), "display_title is blank"),
             (blank(F.col(locale)), "language_code is blank"),
             (~is_date(F.col("source_published_at")), "source_published_at"),
             (blank(F.col("summary_short")), "summary_short is blank"),
             (any_set & any_blank, "bullets are incomplete")]
    if expected:
        rules.append((F.col(locale) != F.col(expected), "locale mismatch"))
    return judged(rows, first_failure(*rules))


def label_table_audit(labels: DataFrame) -> DataFrame:
    """Post label contract on (locale, key, label) rows: exactly the three keys, none blank."""
    known = F.col("key").isin(V.BULLET_KEYS)
    rows = labels.groupBy("locale").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_distinct(F.when(known, F.col("key"))).alias("_known"),
        R.tally(~known).alias("_other"), R.tally(blank(F.col("label"))).alias("_blank"))
    return judged(rows, first_failure(
        ((F.col("_known") != 3) | (F.col("_other") > 0) | (F.col("_n") != 3), "label keys"),
        (F.col("_blank") > 0, "blank label"))).drop("_n", "_known", "_other", "_blank")


def absent_locales(locales: DataFrame, exported: DataFrame) -> DataFrame:
    """Configured locales that an export lacks."""
    return locales.select("language_code").join(exported.select("language_code").distinct(),
                                                "language_code", "left_anti")


# --- text audits --------------------------------------------------------------------------------------------

def label_leaks(rows: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """Scanned values and values that start with a presentation label, per group and field."""
    long = rows.select(*by, F.explode(F.array(*[F.struct(
        F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("p"))
    return (long.select(*by, "p.*").filter(F.col("value").isNotNull()).groupBy(*by, "field")
            .agg(F.count(F.lit(1)).alias("scanned"),
                 R.tally(K.has_label_prefix(F.col("value"))).alias("leaks")))


def structure_audit(approved, decision, translation, payloads, hex_length: int) -> DataFrame:
    """(check, rows, violations) over fingerprints, bullet shapes and exported text."""
    bullets = ["bullet_1", "bullet_2", "bullet_3"]
    filled = sum((F.col(b).isNotNull().cast("int") for b in bullets), F.lit(0))

    def check(rows: DataFrame, name: str, broken: Column) -> DataFrame:
        return rows.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("rows"),
                        R.tally(broken).alias("violations"))

    shape = approved.join(decision.select("source_item_id", "downstream_action"), "source_item_id")
    wrong_shape = F.when(F.col("downstream_action") == "publish_summary", filled != 3).when(
        F.col("downstream_action") == "publish_link", filled != 0)
    done = translation.filter("translation_status = 'completed'")
    mirror = done.select("parent_content_id", *[F.col(b).alias("t_" + b) for b in bullets]).join(
        approved.select("parent_content_id", *bullets), "parent_content_id")
    uneven = reduce(lambda x, y: x | y, [F.col("t_" + b).isNull() != F.col(b).isNull()
                                        for b in bullets])
    text = ["display_title", "summary_short", *bullets]
    shown = payloads.select("source_item_id", "language_code",
                            *[F.col(c).alias("p_" + c) for c in text]).join(
        translation.select("source_item_id", "language_code", *text),
        ["source_item_id", "language_code"])
    differs = reduce(lambda x, y: x | y, [~F.col("p_" + c).eqNullSafe(F.col(c)) for c in text])
    parts = [
        check(approved, "fingerprint format",
              ~F.col("content_fingerprint").rlike(f"^[0-9a-f]{{{hex_length}}}$")),
        check(shape, "none or three bullets", wrong_shape),
        check(translation, "no partial bullets", ~filled.isin(0, 3)),
        check(mirror, "same bullets as the master", uneven),
        check(shown, "export equals table", differs)]
    return reduce(DataFrame.unionByName, parts)


# --- table constraints ----------------------------------------------------------------------------------------

def check_violations(df: DataFrame, table: str) -> DataFrame:
    """(table, rule, violations) of the check rules and required columns of one table, in one pass."""
    rules = {f"check {n}": ~F.coalesce(F.expr(e).cast("boolean"), F.lit(False))
             for n, e in CHECKS.get(table, {}).items() if _usable(df, e)}
    row = df.agg(*[R.tally(broken).alias(name) for name, broken in rules.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations"))
                                for n in rules]))
    return row.select(F.lit(table).alias("table_name"), pairs.alias("p")).select(
        "table_name", "p.*")


def _usable(df: DataFrame, expression: str) -> bool:
    import re
    names = set(re.findall(r"[a-z_]+[a-z0-9_]*", re.sub(r"'[^']*'", "", expression)))
    known = {"coalesce"}
    return all(n in df.columns for n in names if n not in known and n == n.lower())


def key_violations(df: DataFrame, table: str) -> DataFrame:
    """(table, rule, violations): key values held by more than one row."""
    parts = []
    for key in KEYS.get(table, []):
        if not set(key) <= set(df.columns):
            continue
        parts.append(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.lit(table).alias("table_name"), F.lit("unique " + ",".join(key)).alias("rule"),
            R.tally(F.col("_n") > 1).alias("violations")))
    return reduce(DataFrame.unionByName, parts)


def parent_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rule, violations): rows whose parent row is missing."""
    parts = []
    for table, key, parent in PARENTS:
        if table in tables and parent in tables:
            lost = tables[table].select(key).filter(F.col(key).isNotNull()).join(
                tables[parent].select(key), key, "left_anti")
            parts.append(lost.agg(F.lit(table).alias("table_name"),
                                  F.lit(f"parent {parent}").alias("rule"),
                                  F.count(F.lit(1)).alias("violations")))
    return reduce(DataFrame.unionByName, parts)


def _rule_counts(df: DataFrame, table: str) -> DataFrame:
    """(table, rule, violations) of all check rules and required columns of a table: one aggregate."""
    rules = {f"check {n}": ~F.coalesce(F.expr(e).cast("boolean"), F.lit(False)) for n, e in CHECKS.get(table, {}).items()}
    rules |= {f"required {f.name}": F.col(f.name).isNull() for f in TABLES[table] if not f.nullable}
    row = df.agg(*[R.tally(broken).alias(name) for name, broken in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules])
    return row.select(F.lit(table).alias("table_name"), F.explode(pairs).alias("p")).select("table_name", "p.*")


def table_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rule, violations) of every declared constraint of ``tables``.

    Checks and required columns of a table are one aggregate, each key one grouping that combines
    map-side, and all tables that refer to the same parent meet it in one anti-join. A check that is
    not true is broken; null keys and null references are none.
    """
    parts = [_rule_counts(df, name) for name, df in tables.items()]
    for name, df in tables.items():
        for key in KEYS.get(name, []):
            whole = df.select(*key).dropna()
            parts.append(whole.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(
                F.lit(name).alias("table_name"), F.lit("unique " + ",".join(key)).alias("rule"),
                R.tally(F.col("_n") > 1).alias("violations")))
    by_parent: dict[tuple[str, str], list[str]] = {}
    for child, key, parent in PARENTS:
        if child in tables and parent in tables:
            by_parent.setdefault((parent, key), []).append(child)
    for (parent, key), children in by_parent.items():
        # Equal references are one row before they meet the parent.
        keys = reduce(DataFrame.unionByName, [tables[c].select(F.lit(c).alias("_c"), key) for c in children])
        counted = keys.filter(F.col(key).isNotNull()).groupBy("_c", key).agg(F.count(F.lit(1)).alias("_n"))
        lost = counted.join(tables[parent].select(key), key, "left_anti").agg(
            *[F.coalesce(F.sum(F.when(F.col("_c") == c, F.col("_n"))), F.lit(0)).alias(c) for c in children])
        rows = F.array(*[F.struct(F.lit(c).alias("table_name"), F.lit(f"parent {parent}").alias("rule"),
                                  F.col(c).alias("violations")) for c in children])
        parts.append(lost.select(F.explode(rows).alias("p")).select("p.*"))
    return reduce(DataFrame.unionByName, parts)


def error_class_audit(rows: DataFrame, column: str = "error_class") -> DataFrame:
    """Rows by what may be done with their error class: writable, storable only, unknown."""
    c = F.col(column)
    return rows.withColumn("verdict", F.when(c.isNull() | c.isin(V.EMITTABLE_ERRORS), "writable")
                           .when(c.isin(V.STORABLE_ERRORS), "storable").otherwise("unknown"))


def snapshot_names_audit(rows: DataFrame, name: str, moment: str) -> DataFrame:
    return (rows.withColumn("valid_id", F.coalesce(F.col(name).rlike(V.SNAPSHOT_ID_PATTERN),
                                                   F.lit(False)))
            .withColumn("valid_time", valid_iso(F.col(moment))))


# --- configuration -----------------------------------------------------------------------------------------------

def repeated_values(sources: DataFrame, column: str) -> DataFrame:
    """Values shared by several sources, with the ids that share them.

    The source list is configuration, so the id lists stay short.
    """
    return (sources.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.sort_array(F.collect_list("source_id")).alias("source_ids"))
            .filter(F.size("source_ids") > 1))


def source_config_audit(sources: DataFrame, categories: DataFrame, schedules: DataFrame,
                        profiles: DataFrame) -> DataFrame:
    """(source_id, level, message) of every configuration problem."""
    counts = sources.groupBy("source_id").agg(F.count(F.lit(1)).alias("_uses"))
    rows = (sources.join(counts, "source_id")
            .join(categories.select("category_id", F.col("enabled").alias("_on")),
                  "category_id", "left")
            .join(schedules.select("schedule_class", F.lit(True).alias("_schedule")),
                  "schedule_class", "left")
            .join(profiles.select("sanitization_profile", F.lit(True).alias("_profile")),
                  "sanitization_profile", "left"))
    def found(broken: Column, level: str, message: str) -> Column:
        return F.when(broken, F.struct(F.lit(level).alias("level"), F.lit(message).alias("message")))

    problems = F.array_compact(F.array(
        found(F.col("_uses") > 1, "error", "duplicate source id"),
        found(F.col("_on").isNull(), "error", "unknown category"),
        found(~F.col("_on").cast("boolean"), "error", "disabled category"),
        found(F.col("_schedule").isNull(), "error", "unknown schedule"),
        found(F.col("_profile").isNull(), "error", "unknown profile"),
        found(blank(F.col("html_url")), "warning", "missing html_url")))
    return rows.select("source_id", F.explode(problems).alias("p")).select("source_id", "p.*")
