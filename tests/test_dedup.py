"""First-wins dedup and near-duplicate groups against sequential models."""

import random

import pytest
from pyspark.sql import functions as F

from pressline.functions.html import PROFILE
from pressline.operators import dedup as D
from pressline.plans import ingest as I

SCHEMA = "id long, ingest_dedup_key string, title_key string, title string"


def sequential(rows, known=()):
    owned, passed = set(known), set()
    for i, k1, k2, _ in sorted(rows):
        keys = {k for k in (k1, k2) if k}
        if not keys & owned:
            owned |= keys
            passed.add(i)
    return passed


def random_rows(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k1 = "url:hot" if rng.random() < 0.3 else f"url:{rng.randrange(n)}"
        k2 = None if rng.random() < 0.2 else "th:hot" if rng.random() < 0.4 else f"th:{rng.randrange(n // 2)}"
        rows.append((i, k1, k2, "t"))
    return rows


@pytest.mark.parametrize("settled", [20, D.SETTLED_ROWS])
def test_matches_the_sequential_rule(spark, settled):
    rows = random_rows(1)
    got = D.accept_first(spark.createDataFrame(rows, SCHEMA), ["id"], settled=settled)
    assert got.count() == len(rows)
    assert {r.id for r in got.filter("accepted").collect()} == sequential(rows)


@pytest.mark.parametrize("places", [list(range(70)), [(i % 26 > 0) * 1000 + i * 37 % 130 for i in range(70)]])
def test_chains_of_alternating_keys(spark, monkeypatch, places):
    rows = [(p, f"url:{(i + 1) // 2}", f"th:{i // 2}", "t") for i, p in enumerate(places)]
    rounds = []
    decided = D._decided
    monkeypatch.setattr(D, "_decided", lambda left: rounds.append(1) or decided(left))
    got = D.accept_first(spark.createDataFrame(rows, SCHEMA), ["id"], settled=0)
    assert {r.id for r in got.filter("accepted").collect()} == sequential(rows)
    assert len(rounds) <= 3


def test_rows_without_second_key_and_no_rows(spark):
    rows = [(i, f"url:{i % 5}", None if i % 3 else f"th:{i % 4}", "t") for i in range(40)]
    for settled in (5, 100):
        got = D.accept_first(spark.createDataFrame(rows, SCHEMA), ["id"], settled=settled)
        assert {r.id for r in got.filter("accepted").collect()} == sequential(rows)
        assert D.accept_first(spark.createDataFrame([], SCHEMA), ["id"], settled=settled).count() == 0


@pytest.mark.parametrize("settled", [4, D.SETTLED_ROWS])
def test_stored_markers_block_items(spark, settled):
    rows = random_rows(9, 60)
    known = ["url:3", "th:hot", "url:hot", "th:5"]
    markers = spark.createDataFrame([(k,) for k in known], "dedup_key string")
    got = D.accept_first(spark.createDataFrame(rows, SCHEMA), ["id"], markers, settled)
    assert {r.id for r in got.filter("accepted").collect()} == sequential(rows, known)


def test_second_run_adds_nothing(spark):
    entries = spark.createDataFrame(
        [(1, 5, "A long enough title", "https://a.example/x?utm_source=q", "g1", "body one", None),
         (2, 6, "A Long  Enough Title", None, "g2", "body two", "2024-01-01"),
         (3, 6, "Another fine headline", None, None, "body three", "2024-01-01"),
         (4, 6, "   ", None, "g4", "body", None)],
        "entry_id long, source_id long, raw_title string, link string, guid string, "
        "summary string, raw_date string").withColumn(
        "fetched_at", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    order = ["fetched_at", "source_id", "entry_id"]
    first = I.ingest(entries, order, last_id=10)
    items = {r.source_item_id: r for r in first["source_item"].collect()}
    assert sorted(items) == [11, 12]
    assert items[11].canonical_url == "https://a.example/x" and items[11].dedup_rule == "url"
    assert items[12].dedup_rule == "tp"
    assert first["ingest_dedup_marker"].count() == 4
    assert first["source_item_raw"].first().expires_at.isoformat() == "2024-02-15T00:00:00"
    again = I.labelled_entries(entries, order, first["ingest_dedup_marker"].select("dedup_key"))
    assert {r.label for r in again.collect()} == {"dedup", "normalization_failure"}


def test_entries_are_parsed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def parse(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    n = 40
    rows = [(k, k % 4, f"Headline number {k}", f"https://a.example/{k}", None, f"<p>body {k}</p>", None, None) for k in range(n)]
    entries = spark.createDataFrame(rows, "entry_id long, source_id long, raw_title string, link string, guid string, "
                                    "summary string, content string, raw_date string")
    entries = entries.mapInArrow(parse, entries.schema).withColumn("fetched_at", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    fields = PROFILE.split(", ")
    profiles = spark.range(3).select(F.col("id").alias("source_id"), F.lit("own").alias("sanitization_profile"),
                                     *[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in fields])
    tables = I.ingest_by_profile(entries, profiles, ["fetched_at", "source_id", "entry_id"])
    assert {name: df.count() for name, df in tables.items()} == {
        "source_item": n, "source_item_text": n, "ingest_dedup_marker": 2 * n, "source_item_raw": n}
    assert {r.sanitized_text for r in tables["source_item_text"].collect()} == {f"body {k}" for k in range(n)}
    assert seen.value == n


def test_near_groups_match_union_find(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(60)]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(60)] = rng.choice(words)
            texts.append(" ".join(copy))
    rows = [(i, x, "2024-01-01 00:00:00" if i % 5 else "2024-03-01 00:00:00") for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, text string, at string").withColumn(
        "at", F.col("at").cast("timestamp"))
    got = {r.id: r.group_id for r in D.near_groups(df, "id", "text", "at").collect()}

    signed = D.signatures(df, "text").withColumn("b", F.floor(F.unix_seconds("at") / F.lit(86400)))
    banded = D.band_keys(signed, "b", 8).select("id", "band").collect()
    parent = {i: i for i, _, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = {}
    for r in banded:
        other = seen.setdefault(r.band, r.id)
        a, b = find(other), find(r.id)
        parent[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in parent}
    assert len(set(got.values())) < len(rows)


def test_preferred_takes_the_best_tier(spark):
    groups = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (9, 9)], "id long, group_id long")
    tiers = spark.createDataFrame([(1, 3), (2, 1), (3, 1), (9, 2)], "id long, tier int")
    got = {r.group_id: (r.primary_item, r.alternatives) for r in
           D.preferred(groups, tiers, "id").collect()}
    assert got == {1: (2, 2), 9: (9, 0)}


def test_near_groups_over_a_long_chain(spark, monkeypatch):
    # Neighbours share a band and nothing else, so labels need many rounds; estimates must not pile up.
    n, bits = 200, []
    own = lambda j: F.col("entry_id") * 100 + 1_000_000 + j
    link = [*[F.floor(F.col("entry_id") / 2)] * 4, *[F.floor((F.col("entry_id") + 1) / 2)] * 4]
    monkeypatch.setattr(D, "signatures", lambda rows, text, hashes: rows.withColumn(
        "signature", F.array(*link, *[own(j) for j in range(24)])))
    real = D.cut_round

    def watched(df):
        bits.append(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()).bit_length())
        return real(df)

    monkeypatch.setattr(D, "cut_round", watched)
    rows = spark.range(n + 5).filter(f"id <> {n}").select(
        F.col("id").alias("entry_id"), F.lit("x").alias("t"), F.to_timestamp(F.lit("2024-01-01")).alias("m"))
    got = {r.entry_id: r.group_id for r in D.near_groups(rows, "entry_id", "t", "m").collect()}
    assert got == {i: 0 if i < n else n + 1 for i in got} and len(got) == n + 4
    assert max(bits) < 2000
