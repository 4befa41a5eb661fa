"""Source health over attempt histories."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pressline.operators import fetch as X
from pressline.streaming import jobs as J

SCHEMA = "fetch_attempt_id long, source_id long, started_at timestamp, outcome string"


def model(rows, prior=None):
    fails, out = dict(prior or {}), {}
    for i, s, at, outcome in sorted(rows, key=lambda r: (r[2], r[0])):
        fails[s] = 0 if outcome == "success" else fails.get(s, 0) + 1
        n = fails[s]
        out[i] = (n, "quarantined" if n >= 5 else "degraded" if n >= 3 else "healthy")
    return out


def history(spark, rows, prior=None, width=3600):
    p = None if prior is None else spark.createDataFrame(
        list(prior.items()), "source_id long, consecutive_failures int")
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.fetch_attempt_id: (r.consecutive_failures, r.health_status)
            for r in X.health_history(df, p, width).collect()}


def random_rows(seed, n=250):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [(i, 1 if rng.random() < 0.6 else rng.randrange(2, 6),
             start + timedelta(seconds=rng.randrange(200_000)),
             "failed" if rng.random() < 0.75 else "success") for i in range(n)]


def test_history_matches_the_model(spark):
    rows = random_rows(1)
    for width in (600, 3600, 10_000_000):
        assert history(spark, rows, width=width) == model(rows)


def test_prior_failures_count_until_the_first_success(spark):
    rows = random_rows(2, 120)
    prior = {1: 4, 2: 2, 3: 0}
    assert history(spark, rows, prior) == model(rows, prior)


def test_six_failures_and_a_reset(spark):
    start = datetime(2024, 1, 1)
    rows = [(i, 7, start + timedelta(minutes=50 * i), "failed") for i in range(6)]
    rows.append((6, 7, start + timedelta(minutes=400), "success"))
    got = history(spark, rows)
    assert [got[i][1] for i in range(7)] == [
        "healthy", "healthy", "degraded", "degraded", "quarantined", "quarantined", "healthy"]


def test_quarantine_lasts_a_day(spark):
    at = datetime(2024, 1, 1, 5)
    df = spark.createDataFrame([(1, 1, at, "failed")], SCHEMA)
    prior = spark.createDataFrame([(1, 4)], "source_id long, consecutive_failures int")
    assert X.health_history(df, prior).first().quarantine_until == at + timedelta(hours=24)


def test_skip_order_and_due_border(spark):
    sources = spark.createDataFrame(
        [(1, 0, "hourly"), (2, 1, "hourly"), (3, 1, "hourly"), (4, 1, "hourly"), (5, 1, "odd")],
        "source_id long, enabled int, schedule_class string")
    ts = lambda h, m=0: datetime(2024, 1, 1, h, m)
    states = spark.createDataFrame(
        [(1, ts(1), ts(20)), (2, ts(11, 1), ts(13)), (3, ts(11, 1), None), (4, ts(11), None),
         (5, ts(11, 59), ts(12))],
        "source_id long, last_success_at timestamp, quarantine_until timestamp")
    got = {r.source_id: r.skip_reason for r in
           X.skip_reasons(sources, states, "2024-01-01 12:00:00").collect()}
    assert got == {1: "disabled", 2: "quarantined", 3: "not_due", 4: None, 5: None}


def test_streamed_health_takes_late_and_shuffled_attempts(spark, tmp_path):
    rows = random_rows(7, 160)
    rng = random.Random(3)
    # Shuffled within three hours, then cut into four arrivals, each with a restart of the job.
    rows.sort(key=lambda r: r[2] + timedelta(seconds=rng.randrange(10_000)))
    for k in range(4):
        part = rows[40 * k:40 * k + 40]
        spark.createDataFrame(part, SCHEMA).repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
        J.stream_health(J.file_stream(spark, f"{tmp_path}/in", SCHEMA), f"{tmp_path}/out", f"{tmp_path}/state",
                        delay_seconds=10_800).awaitTermination()
        got = {r.source_id: (r.attempts, r.consecutive_failures, r.health_status) for r in spark.read.parquet(
            f"{tmp_path}/out/health").filter(F.col("batch") == k).collect()}
        seen = rows[:40 * k + 40]
        states = model(seen)
        last = {s: max((r for r in seen if r[1] == s), key=lambda r: (r[2], r[0]))[0] for s in {r[1] for r in seen}}
        assert got == {s: (sum(r[1] == s for r in seen), *states[i]) for s, i in last.items()}
    # The wait is bounded by the delay, not by the history; what comes behind the mark is dropped.
    waiting = spark.read.parquet(f"{tmp_path}/out/waiting").filter("batch = 3")
    newest = max(r[2] for r in rows)
    assert waiting.count() == sum(r[2] > newest - timedelta(seconds=10_800) for r in rows)
    spark.createDataFrame([(900, 1, rows[0][2] - timedelta(days=1), "success")], SCHEMA).write.mode(
        "append").parquet(f"{tmp_path}/in")
    J.stream_health(J.file_stream(spark, f"{tmp_path}/in", SCHEMA), f"{tmp_path}/out", f"{tmp_path}/state",
                    delay_seconds=10_800).awaitTermination()
    after = {r.source_id: r.consecutive_failures for r in spark.read.parquet(
        f"{tmp_path}/out/health").filter("batch = 4").collect()}
    assert after == {s: v[1] for s, v in got.items()}
