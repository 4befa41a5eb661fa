"""The marker store and the streaming ingest over several batches."""

import random

from pyspark.sql import functions as F

from pressline.plans import ingest as I
from pressline.streaming import jobs as J
from pressline.streaming.markers import MarkerStore

ENTRY = ("entry_id long, source_id long, raw_title string, link string, guid string, summary string, "
         "raw_date string, fetched_at timestamp")


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "dedup_key string")


def test_store_answers_exactly_and_reads_its_own_buckets(spark, tmp_path):
    rng = random.Random(2)
    store = MarkerStore(spark, str(tmp_path), buckets=16, bits=1 << 14)
    held, read = set(), []
    for batch in range(5):
        fresh = [f"url:{batch}-{k}" for k in range(30)]
        known, folders = store.known(keys(spark, fresh), batch)
        assert {r[0] for r in known.collect()} == set()
        read.append(len(folders))
        store.append(keys(spark, fresh).withColumn("source_item_id", F.lit(batch)), batch)
        held |= set(fresh)
    # A batch of new keys opens next to no folder, however many batches came before it.
    assert max(read) <= 1
    one = rng.choice(sorted(held))
    known, folders = store.known(keys(spark, [one, "url:never"]), 5)
    assert [r[0] for r in known.collect()] == [one]
    assert {f.split("bucket=")[1] for f in folders} and len({f.split("bucket=")[1] for f in folders}) <= 2
    some = rng.sample(sorted(held), 40) + [f"url:new-{k}" for k in range(40)]
    assert {r[0] for r in store.known(keys(spark, some), 5)[0].collect()} == held & set(some)
    # A repeated batch replaces itself.
    store.append(keys(spark, ["url:again"]), 5)
    store.append(keys(spark, ["url:other"]), 5)
    got = store.known(keys(spark, ["url:again", "url:other", one]), 6)[0].collect()
    assert {r[0] for r in got} == {"url:other", one}


def test_streamed_ingest_equals_one_batch_and_numbers_on(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, rng.randrange(3), f"A headline number {rng.randrange(40)}", f"https://a.example/{rng.randrange(50)}",
             None, "body", None) for i in range(90)]
    entries = spark.createDataFrame(rows, ENTRY.rsplit(", ", 1)[0]).withColumn(
        "fetched_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("entry_id"))).select(
        *[c.split()[0] for c in ENTRY.split(", ")])
    order = ["fetched_at", "source_id", "entry_id"]
    for k in range(3):
        entries.filter(F.col("entry_id").between(30 * k, 30 * k + 29)).write.mode("append").parquet(f"{tmp_path}/in")
        J.stream_ingest(J.file_stream(spark, f"{tmp_path}/in", ENTRY), f"{tmp_path}/out", f"{tmp_path}/state",
                        order, buckets=8).awaitTermination()
    whole = I.ingest(entries, order)
    for name, columns in (("source_item", ["source_item_id", "title", "canonical_url"]),
                          ("ingest_dedup_marker", ["source_item_id", "dedup_key", "dedup_rule"])):
        got = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out/{name}").select(*columns).collect()}
        assert got == {tuple(r) for r in whole[name].select(*columns).collect()}
    ledger = {r["batch"]: r["last_id"] for r in spark.read.parquet(f"{tmp_path}/out/ledger").collect()}
    assert ledger[2] == whole["source_item"].count()
