"""Catalogue order, digests, snapshots and configuration."""

import hashlib
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pressline.bindings import Tables
from pressline.operators import publish as B
from pressline.sources import exports as E
from pressline.sources import tables as ST

FIELDS = ("language_code string, slug string, display_title string, summary_short string, "
          "canonical_url string, source_published_at timestamp, approved_at timestamp, "
          "published_at timestamp, archive_month string")


def catalogue(spark, rows):
    at = datetime(2024, 1, 5)
    return spark.createDataFrame([("en", slug, "T", "S", None, when, at, at,
                                   when.strftime("%Y-%m") if when else None) for slug, when in rows], FIELDS)


def test_index_order_and_limit(spark):
    same, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = catalogue(spark, [("zulu", same), ("undated", None), ("alpha", same), ("newer", late)])
    ranked = B.latest_index(rows, 10).orderBy("position").collect()
    assert [r.slug for r in ranked] == ["newer", "alpha", "zulu", "undated"]
    assert {r.slug for r in B.latest_index(rows, 2).collect()} == {"newer", "alpha"}


def test_index_limit_runs_before_the_shuffle(spark):
    plan = B.latest_index(catalogue(spark, [("a", datetime(2024, 1, 1))]), 10) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_digest_does_not_depend_on_partitions(spark):
    rows = catalogue(spark, [(f"s{i}", datetime(2024, 1 + i % 3, 1 + i % 20)) for i in range(100)])
    one = {tuple(r) for r in B.archive_digests(rows.repartition(7, "slug")).collect()}
    assert one == {tuple(r) for r in B.archive_digests(rows.coalesce(1)).collect()}
    changed = rows.withColumn("display_title", F.when(F.col("slug") == "s5", "U").otherwise("T"))
    other = {tuple(r) for r in B.archive_digests(changed).collect()}
    assert len(one & other) == 2 and len(other) == 3


def test_digest_sums_are_exact(spark):
    # The largest lanes and a small one: their sums leave 64 bits, and no digest at all is a sum of zero.
    digests = ["f" * 64] * 40 + ["0" * 63 + "1"]
    rows = spark.createDataFrame([(d,) for d in digests], "d string")
    sums = [sum(int(d[15 * i:15 * i + 15], 16) for d in digests) for i in range(4)]
    assert max(sums) > 1 << 64
    text = "|".join(map(str, [len(digests), *sums]))
    assert rows.agg(B.set_digest(F.col("d"))).first()[0] == hashlib.sha256(text.encode()).hexdigest()
    assert rows.filter("false").agg(B.set_digest(F.col("d"))).first()[0] == hashlib.sha256(b"0|0|0|0|0").hexdigest()


def test_digest_adds_rows_up_as_longs(spark):
    rows = spark.range(3).select(F.sha2(F.col("id").cast("string"), 256).alias("d")).agg(B.set_digest(F.col("d")))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    # The buffers of a partial sum over decimals hold a flag beside each sum.
    assert "isEmpty#" not in plan


def test_each_part_of_a_snapshot_is_one_file(spark, tmp_path):
    # Eight tasks hold rows of every part; before, each of them wrote a file of its own for each part.
    # Small partitions are not merged here, as large ones would not be.
    rows = spark.range(0, 4000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "en").otherwise("ja").alias("language_code"),
        F.format_string("%02d", F.col("id") % 20).alias("part"), F.col("id").cast("string").alias("line"))
    pointer = {"generation": "g1"}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        E.write_changed_parts(spark, str(tmp_path), pointer, None, {"items": rows, "archives": rows.filter("part < '10'")})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for kind, parts in (("items", 20), ("archives", 10)):
        files = list((tmp_path / "store" / kind / "home=g1").rglob("*.txt"))
        assert len(files) == parts
        got = sorted(tuple(r) for r in E.read_lines(spark, str(tmp_path), pointer, kind).collect())
        assert got == sorted(tuple(r) for r in rows.filter(F.col("part") < parts).collect())


def test_snapshot_with_itself_has_no_change(spark):
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, digest string")
    assert {r.change for r in B.snapshot_diff(rows, rows).collect()} == {"unchanged"}


def test_status_keeps_the_time_of_the_other_status(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    old = spark.createDataFrame([(1, "en", "published", t1, None, "f1")],
                                "publish_record_id long, language_code string, publish_status string, "
                                "published_at timestamp, withdrawn_at timestamp, source_fingerprint string")
    change = spark.createDataFrame([(1, "en", "withdrawn", t2, "f1"), (2, "ja", "published", t2, "f2")],
                                   "publish_record_id long, language_code string, publish_status string, "
                                   "moment timestamp, source_fingerprint string")
    got = {r.publish_record_id: r for r in B.upsert_status(old, change).collect()}
    assert (got[1].publish_status, got[1].published_at, got[1].withdrawn_at) == ("withdrawn", t1, t2)
    assert (got[2].published_at, got[2].withdrawn_at) == (t2, None)


def test_retention_orders_suffixes_as_numbers(spark):
    ids = ["2024-01-01T00-00-00Z", "2024-01-01T00-00-00Z-r2", "2024-01-01T00-00-00Z-r10",
           "2023-01-01T00-00-00Z", "junk"]
    df = spark.createDataFrame([(i,) for i in ids], "generation_id string")
    got = {r.generation_id for r in B.snapshots_to_retire(df, "2023-01-01T00-00-00Z", 2).collect()}
    assert got == {"2024-01-01T00-00-00Z"}


def test_digest_manifest_problems(spark):
    good = "sha256:" + "0" * 64
    rows = spark.createDataFrame([("en/index.json", good, "0"), ("en//x", good, "0"), ("a/../b", good, "0"),
                                  ("stats.json", good, "1")], E.DIGEST_SCHEMA)
    assert {(r.problem, r.path) for r in E.digest_problems(rows).collect()} == {
        ("invalid record", "en//x"), ("invalid record", "a/../b")}
    assert E.digest_problems(rows.filter("false")).first().problem == "empty manifest"


def test_readers_stop_on_bad_rows(spark, tmp_path):
    rows = catalogue(spark, [("Bad Slug", datetime(2024, 1, 1))])
    E.write_index(B.latest_index(rows), str(tmp_path / "index"))
    with pytest.raises(ValueError):
        E.read_index(spark, str(tmp_path / "index"))


def test_repeated_slug_stops_the_map(spark, tmp_path):
    rows = spark.createDataFrame([("en", "a"), ("en", "a")], "language_code string, slug string")
    with pytest.raises(ValueError):
        E.write_translation_map(rows, str(tmp_path / "map"))


def test_configuration_files(spark, tmp_path):
    path = tmp_path / "sources.yaml"
    path.write_text("sources:\n  - {id: 1, title: A, category_id: 3}\n  - {id: x, title: B, category_id: 1}\n"
                    "  - {title: C}\n  - {id: 2, title: D, category_id: 1, enabled: false}\n")
    got = {r.source_id: r.enabled for r in ST.source_dimension(spark, str(path)).collect()}
    assert got == {1: True, 2: False}
    assert ST.source_dimension(spark, str(tmp_path / "none.yaml")).count() == 0
    cats = tmp_path / "categories.yaml"
    cats.write_text("categories:\n  1: {name: A, slug: a, enabled: true}\n  z: {name: B}\n")
    assert [r.category_id for r in ST.category_dimension(spark, str(cats)).collect()] == [1]


def test_whole_index_reads_back_with_its_undated_entries(spark, tmp_path):
    rows = catalogue(spark, [("dated", datetime(2024, 1, 1)), ("undated", None)])
    E.write_index(B.latest_index(rows), str(tmp_path / "index"))
    valid, invalid = E.split_index(spark, str(tmp_path / "index"))
    assert [(r.slug, r.position) for r in valid.collect()] == [("dated", 1)]
    assert [(r.slug, r.position) for r in invalid.collect()] == [("undated", 2)]


def test_artifact_digests_start_from_payloads_stored_once(spark, monkeypatch):
    from pressline.bindings import Tables
    from pressline.catalog import publishing
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    real, calls = publishing.payloads, []
    monkeypatch.setattr(publishing, "payloads", lambda t: calls.append(t) or real(t))
    out = publishing.digests(Tables(spark, folder))
    assert len(calls) == 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_kept_binding_is_not_derived_again(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    old, new = Tables(spark, folder), Tables(spark, folder)
    new.keep("b_translation", str(tmp_path / "translation"))
    for name in ("b_translation", "b_publish_status"):
        before, after = getattr(old, name), getattr(new, name)
        assert [f for f in before.inputFiles() if "lineitem" in f]
        assert not [f for f in after.inputFiles() if "lineitem" in f]
        assert before.schema.simpleString() == after.schema.simpleString()
        assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()
