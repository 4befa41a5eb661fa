"""Ranks, running sums, percentiles and ids against plain Python."""

import random

import numpy as np
from pyspark.sql import functions as F

from pressline.operators import buckets as B


def test_running_sum_over_narrow_stretches(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(4)}", p, rng.randrange(5))
            for p in rng.sample(range(10_000_000), 400)]
    df = spark.createDataFrame(rows, "k string, pos long, v int")
    for strict in (False, True):
        got = {(r.k, r.pos): r.s for r in B.running_sum(
            df, ["k"], "pos", "v", "s", width=100, strict=strict).collect()}
        total: dict = {}
        for k, pos, v in sorted(rows, key=lambda r: r[1]):
            before = total.get(k, 0)
            total[k] = before + v
            assert got[(k, pos)] == (before if strict else total[k])


def test_running_sum_keeps_null_keys_and_ties(spark):
    df = spark.createDataFrame([(None, 1, 1, 0), (None, 1, 5, 1), (None, 3, 2, 0)],
                               "k string, pos long, v int, t int")
    got = [r.s for r in B.running_sum(df, ["k"], "pos", "v", "s", width=2, tie=["t"])
           .orderBy("pos", "t").collect()]
    assert got == [1, 6, 8]


def test_row_rank_equals_sorted_order(spark):
    rng = random.Random(2)
    ids = rng.sample(range(1 << 40), 300)
    df = spark.createDataFrame([("a" if i % 3 else "b", i) for i in ids], "k string, id long")
    got = {r.id: r.n for r in B.row_rank(df, ["k"], "id", "n").collect()}
    for key in ("a", "b"):
        mine = sorted(i for i in ids if ("a" if i % 3 else "b") == key)
        assert [got[i] for i in mine] == list(range(1, len(mine) + 1))


def test_percentiles_are_exact(spark):
    rng = random.Random(3)
    rows = [(k, rng.randrange(-50_000, 500_000)) for k in "xyz" for _ in range(rng.choice([1, 2, 777]))]
    rows += [("x", 7)] * 500 + [("y", None)]
    df = spark.createDataFrame(rows, "k string, v long")
    got = {r.k: r for r in B.percentiles(df, ["k"], "v", {"p50": 0.5, "p90": 0.9, "p0": 0.0,
                                                          "p100": 1.0}).collect()}
    for key in "xyz":
        values = [v for k, v in rows if k == key and v is not None]
        assert got[key].average == np.mean(values) or abs(got[key].average - np.mean(values)) < 1e-6
        for name, p in (("p50", 50), ("p90", 90), ("p0", 0), ("p100", 100)):
            assert abs(got[key][name] - np.percentile(values, p)) < 1e-6


def test_percentile_of_four_values(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (10,)], "v long").withColumn("k", F.lit("a"))
    row = B.percentiles(df, ["k"], "v", {"p90": 0.9}).first()
    assert abs(row.p90 - 8.2) < 1e-9 and row.average == 4.25


def test_sequence_ids_are_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("x"), (F.col("id") % 3).alias("g"))
    rows = B.sequence_ids(df, ["g", "x"], "n", 50).orderBy("g", "x").collect()
    assert [r.n for r in rows] == list(range(51, 1051))


def test_lookup_with_a_hot_key(spark):
    rows = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), "id")
    keyed = spark.createDataFrame([("hot", 1), ("k1", 2), ("none", 3)], "k string, v int")
    got = B.lookup(rows, keyed, "k")
    assert got.count() == 3000
    assert got.filter("v = 1").count() == 1000 and got.filter("v = 2").count() == 1
    assert B.lookup(rows, keyed, "k", "inner").count() == 1001
