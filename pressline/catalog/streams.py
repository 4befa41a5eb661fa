"""Streaming jobs driven to completion over the event and document tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressline.bindings import BINDINGS, RAW_SCHEMAS
from pressline.catalog.content import KEYED_SQL, ORDER, greedy_sql
from pressline.catalog.helpers import iso_sql, rounded, text_times
from pressline.catalog.publishing import folder
from pressline.catalog.registry import query
from pressline.catalog.state import HISTORY_SQL
from pressline.streaming import jobs as J


def attempts_of(t, path: str, files: int = 100):
    raw = J.file_stream(t.spark, path, RAW_SCHEMAS["events"], files)
    return t.spark.sql(BINDINGS["b_attempt"].replace("FROM events", "FROM {events}"), events=raw)


def entries_of(t, path: str):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.b_entry.schema.fields)
    return J.file_stream(t.spark, path, columns)


def drain(stream, path: str, mode: str = "append"):
    """Run a query over everything available into a Parquet folder; a later call goes on from there."""
    (stream.writeStream.format("parquet").option("path", f"{path}/rows").outputMode(mode)
     .option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination())
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows")


# Every fiftieth attempt arrives after the restart, most of them behind the watermark by then.
@query("stream_fetch_rates", "STR-3", f"""
WITH arrived AS (SELECT *, date_trunc('hour', started_at) + INTERVAL 1 HOUR AS window_end,
                        started_at < TIMESTAMP '2024-01-16' AND fetch_attempt_id % 50 <> 0 AS early
                 FROM b_attempt),
marks AS (SELECT max(started_at) FILTER (early) - INTERVAL 2 HOUR AS first_mark,
                 max(started_at) - INTERVAL 2 HOUR AS last_mark FROM arrived)
SELECT {iso_sql("date_trunc('hour', started_at)")} AS window_start, source_id, count(*) AS attempts,
       ROUND(avg(CASE WHEN outcome = 'success' THEN 1.0 ELSE 0.0 END), 6) AS fetch_success_rate
FROM arrived CROSS JOIN marks WHERE (early OR window_end > first_mark) AND window_end <= last_mark
GROUP BY ALL""")
def _(t):
    path = folder(t)
    early = (F.col("ts") < "2024-01-16") & (F.col("event_id") % 50 != 0)
    for arrival in (early, ~early):
        t.events.filter(arrival).write.mode("append").parquet(f"{path}/in")
        # One batch per arrival, so that the mark moves between the two and not inside them.
        rates = J.stream_fetch_rates(attempts_of(t, f"{path}/in", files=1 << 30))
        out = drain(rates, path)
    return rounded(text_times(out))


@query("stream_source_health", "STR-2", f"""
SELECT source_id, count(*) AS attempts, arg_max(fails, (started_at, fetch_attempt_id))
       AS consecutive_failures,
       arg_max(health_status, (started_at, fetch_attempt_id)) AS health_status
FROM ({HISTORY_SQL}) h GROUP BY source_id""")
def _(t):
    # Two arrivals with a restart between them; every seventh attempt of the first weeks comes with the
    # second one, behind attempts that were judged before it, and each arrival is several files in any order.
    path = folder(t)
    early = (F.col("ts") < "2024-01-16") & (F.col("event_id") % 7 != 0)
    for arrival in (early, ~early):
        t.events.filter(arrival).repartition(3, F.xxhash64("event_id")).write.mode("append").parquet(f"{path}/in")
        J.stream_health(attempts_of(t, f"{path}/in", files=2), f"{path}/out", f"{path}/state",
                        delay_seconds=40 * 86400).awaitTermination()
    return t.spark.read.parquet(f"{path}/out/health").groupBy("source_id").agg(
        F.max("attempts").alias("attempts"), F.max_by(
            F.struct("consecutive_failures", "health_status"), "batch").alias("s")).select(
        "source_id", "attempts", "s.consecutive_failures", "s.health_status")


@query("stream_ingest", "STR-1", greedy_sql("""
SELECT source_id, title, dedup_rule, ingest_dedup_key FROM judged WHERE label = 'new'"""))
def _(t):
    # Two arrivals in fetch order; the second one meets the stored markers of the first.
    path = folder(t)
    cut = F.lit("2024-01-01 00:01:40").cast("timestamp")
    for arrival in (F.col("fetched_at") < cut, F.col("fetched_at") >= cut):
        t.b_entry.filter(arrival).write.mode("append").parquet(f"{path}/in")
        J.stream_ingest(entries_of(t, f"{path}/in"), f"{path}/out", f"{path}/state",
                        ORDER).awaitTermination()
    return t.spark.read.parquet(f"{path}/out/source_item").select(
        "source_id", "title", "dedup_rule", "ingest_dedup_key")


@query("stream_single_key", "STR-1", f"""
SELECT DISTINCT dedup_rule, ingest_dedup_key FROM ({KEYED_SQL}) k""")
def _(t):
    path = folder(t)
    t.b_entry.write.parquet(f"{path}/in")
    return drain(J.stream_single_key(entries_of(t, f"{path}/in")).select(
        "dedup_rule", "ingest_dedup_key"), path)
