"""Bucketed tables: a merge rewrites only the buckets of its changes."""

import os

from pyspark.sql import functions as F

from pressline.sources.bucketed import BucketedTable, replaced

SCHEMA = "id long, value string"


def files(root, generation=None):
    found = {}
    for folder, _, names in os.walk(f"{root}/data"):
        for n in names:
            if n.endswith(".parquet"):
                found[f"{folder}/{n}"] = os.stat(f"{folder}/{n}").st_mtime_ns
    return found


def test_merge_keeps_the_files_of_untouched_buckets(spark, tmp_path):
    rows = spark.range(200).select("id", F.col("id").cast("string").alias("value"))
    table = BucketedTable(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, ["id"], buckets=16)
    assert table.read().count() == 0
    table.create(rows)
    before, homes = files(tmp_path), table.homes()
    changes = spark.createDataFrame([(5, "new", False), (7, None, True), (999, "more", False)],
                                    "id long, value string, _gone boolean")
    touched = table.merge(changes, replaced(["id"]))
    assert 1 <= len(touched) <= 3
    want = {i: str(i) for i in range(200)} | {5: "new", 999: "more"}
    del want[7]
    assert {r.id: r.value for r in table.read().collect()} == want
    after = table.homes()
    assert all(after[b] == g for b, g in homes.items() if b not in touched)
    assert all(after[b] == 1 for b in touched)
    now = files(tmp_path)
    assert all(now[f] == at for f, at in before.items())
    assert {f.split("bucket=")[1].split("/")[0] for f in set(now) - set(before)} == {str(b) for b in touched}
    # The generation before is whole still, and a merge without changes touches nothing.
    assert {r.id for r in table.read(0).collect()} == set(range(200))
    assert table.merge(changes.limit(0), replaced(["id"])) == []
    assert {r.id: r.value for r in table.read().collect()} == want
    gone = table.read().select("id", "value", F.lit(True).alias("_gone"))
    table.merge(gone, replaced(["id"]))
    assert table.read().count() == 0 and table.homes() == {}
