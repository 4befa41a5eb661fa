"""Streaming forms: ingest with dedup, source health and windowed fetch rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressline import fixed_values as V
from pressline.functions import rates as R
from pressline.operators.buckets import lookup
from pressline.plans.ingest import ingest, keyed_entries
from pressline.session import cut_lineage
from pressline.streaming.markers import MarkerStore


def file_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


# --- ingest -----------------------------------------------------------------------------------------

LEDGER = "last_id long, marker_folders_read long"


def stream_ingest(entries: DataFrame, root: str, checkpoint: str, order: list[str], buckets: int = 64,
                  bits: int = 1 << 20):
    """Every micro-batch runs the whole ingest plan against the stored markers of its own keys.

    The markers lie in buckets behind Bloom filters (see ``markers``), and the last item id in the
    ledger of the batch before, so no batch reads the history. Each table is written under
    ``batch=<id>`` with overwrite, so a repeated batch replaces its own rows and nothing else.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = MarkerStore(spark, root, buckets, bits)
        last = (spark.read.schema(LEDGER).parquet(f"{root}/ledger/batch={batch_id - 1}").first()["last_id"]
                if batch_id else 0)
        keys = cut_lineage(keyed_entries(batch).select(F.explode(F.array_compact(
            F.array("ingest_dedup_key", "title_key"))).alias("dedup_key")).distinct())
        known, folders = store.known(keys, batch_id)
        tables = ingest(batch, order, cut_lineage(known), last)
        for name, rows in tables.items():
            if name != "ingest_dedup_marker":
                rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")
        items = spark.read.parquet(f"{root}/source_item/batch={batch_id}")
        last = items.agg(F.max("source_item_id")).first()[0] or last
        store.append(tables["ingest_dedup_marker"], batch_id)
        spark.createDataFrame([(last, len(folders))], LEDGER).coalesce(1).write.mode("overwrite").parquet(
            f"{root}/ledger/batch={batch_id}")

    return (entries.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_single_key(entries: DataFrame, delay: str = "7 days") -> DataFrame:
    """Entries without repeats of their main key inside the watermark."""
    return (keyed_entries(entries).withWatermark("fetched_at", delay)
            .dropDuplicatesWithinWatermark(["ingest_dedup_key"]))


# --- source health ------------------------------------------------------------------------------------

def health_summary(attempts: DataFrame) -> DataFrame:
    """Per source: attempts, the latest one, the latest success, and the failures after that success.

    Both aggregates combine map-side, so a source with a third of all attempts sends one row per task.
    """
    place = F.struct("started_at", "fetch_attempt_id")
    won = F.col("outcome") == "success"
    wins = attempts.filter(won).groupBy("source_id").agg(F.max(place).alias("win"))
    marked = lookup(attempts.select("source_id", "started_at", "fetch_attempt_id", "outcome"), wins, "source_id")
    return marked.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("attempts"), F.max(place).alias("latest"), F.max("win").alias("win"),
        F.count_if(~won & (F.col("win").isNull() | (place > F.col("win")))).alias("failures"))


def merged_health(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """The summary of two stretches of time: a success of the later one ends all earlier failures."""
    a, b = earlier.alias("a"), later.alias("b")
    of = lambda c: F.coalesce(F.col(f"a.{c}"), F.lit(0)), lambda c: F.coalesce(F.col(f"b.{c}"), F.lit(0))
    return a.join(b, F.col("a.source_id") == F.col("b.source_id"), "full").select(
        F.coalesce("a.source_id", "b.source_id").alias("source_id"),
        (of[0]("attempts") + of[1]("attempts")).alias("attempts"),
        F.greatest("a.latest", "b.latest").alias("latest"), F.greatest("a.win", "b.win").alias("win"),
        F.when(F.col("b.win").isNotNull(), F.col("b.failures")).otherwise(
            of[0]("failures") + of[1]("failures")).alias("failures"))


def health_rows(summary: DataFrame) -> DataFrame:
    """Health status of each source from its failures in a row."""
    failures = F.col("failures")
    return summary.select(
        "source_id", "attempts", failures.alias("consecutive_failures"),
        F.when(failures >= V.QUARANTINE_AFTER, "quarantined").when(failures >= V.DEGRADED_AFTER, "degraded")
        .otherwise("healthy").alias("health_status"),
        F.when(failures >= V.QUARANTINE_AFTER, F.col("latest.started_at") + F.make_interval(
            hours=F.lit(V.QUARANTINE_HOURS))).alias("quarantine_until"))


def stream_health(attempts: DataFrame, root: str, checkpoint: str, delay_seconds: int = 7200):
    """Source health after each micro-batch, under ``root``/health/batch=<id>.

    Attempts may come in any order as long as none is later than ``delay_seconds`` behind the newest
    one seen. The carry of a source is one summary of everything before that mark; the attempts behind
    the mark wait in a table of their own, shared by all sources, until it has passed them. An attempt
    before the mark of an earlier batch is dropped, as behind a watermark. A batch reads what the batch
    before it wrote and overwrites only its own folders, so it may be repeated after a restart.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = {name: spark.read.parquet(f"{root}/{name}/batch={batch_id - 1}")
               for name in ("settled", "waiting", "mark")} if batch_id else {}
        rows = batch.select("source_id", "started_at", "fetch_attempt_id", "outcome")
        before = old["mark"].first()[0] if old else None
        if before is not None:
            rows = rows.filter(F.col("started_at") > F.lit(before))
        if old:
            rows = rows.unionByName(old["waiting"])
        rows = cut_lineage(rows)
        newest = rows.agg(F.max("started_at") - F.make_interval(secs=F.lit(delay_seconds))).first()[0]
        mark = max((x for x in (before, newest) if x is not None), default=None)
        passed = F.coalesce(F.col("started_at") <= F.lit(mark), F.lit(False)) if mark else F.lit(False)
        settled = health_summary(rows.filter(passed))
        if old:
            settled = merged_health(old["settled"], settled)
        settled.write.mode("overwrite").parquet(f"{root}/settled/batch={batch_id}")
        rows.filter(~passed).write.mode("overwrite").parquet(f"{root}/waiting/batch={batch_id}")
        spark.createDataFrame([(mark,)], "mark timestamp").write.mode("overwrite").parquet(
            f"{root}/mark/batch={batch_id}")
        now = merged_health(spark.read.parquet(f"{root}/settled/batch={batch_id}"),
                            health_summary(spark.read.parquet(f"{root}/waiting/batch={batch_id}")))
        health_rows(now).write.mode("overwrite").parquet(f"{root}/health/batch={batch_id}")

    return (attempts.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


# --- windowed rates -------------------------------------------------------------------------------------

def stream_fetch_rates(attempts: DataFrame, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Fetch success per source and time window; rows behind the watermark are dropped."""
    return (attempts.withWatermark("started_at", delay)
            .groupBy(F.window("started_at", width), "source_id")
            .agg(F.count(F.lit(1)).alias("attempts"),
                 R.share(F.col("outcome") == "success", F.lit(1)).alias("fetch_success_rate"))
            .select(F.col("window.start").alias("window_start"), "source_id", "attempts",
                    "fetch_success_rate"))
