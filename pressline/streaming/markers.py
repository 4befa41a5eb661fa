"""Marker store of the streaming ingest: identity keys by hash bucket, each bucket behind a Bloom filter.

A batch asks which of its keys are stored. It reads the filters of its own buckets, whose size is fixed,
and then the markers of those buckets where a key may be known; a batch of new keys reads no marker at
all, however long the history is. Everything is written under the id of the batch, with the manifest
last, so a repeated batch replaces its own files and a broken one leaves none behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

HASHES = 4
MANIFEST = "bucket int, filter_batch long, batches array<long>"


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def filter_bits(keys: DataFrame, bits: int) -> DataFrame:
    """(dedup_key, bucket, word, mask): the bits of each key in the filter of its bucket."""
    places = [F.pmod(F.xxhash64("dedup_key", F.lit(j)), F.lit(bits)) for j in range(1, HASHES + 1)]
    return keys.withColumn("_p", F.explode(F.array_distinct(F.array(*places)))).select(
        "dedup_key", "bucket", F.expr("_p div 64").alias("word"),
        F.expr("shiftleft(1L, cast(_p % 64 AS int))").alias("mask"))


class MarkerStore:
    """Markers under one folder; ``bits`` a bucket should be ten times its markers or more."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, bits: int = 1 << 20):
        self.spark, self.root, self.buckets, self.bits = spark, root, buckets, bits

    def manifest(self, batch_id: int) -> dict[int, tuple[int, list[int]]]:
        """bucket -> (batch of its filter, batches with markers of it), as the batch before left it."""
        if batch_id == 0:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/marker_manifest/batch={batch_id - 1}")
        return {r["bucket"]: (r["filter_batch"], r["batches"]) for r in rows.collect()}

    def _filters(self, manifest: dict, buckets: list[int]) -> DataFrame:
        """(bucket, word, bits) of the filters of some buckets."""
        paths = [f"{self.root}/marker_filter/batch={manifest[b][0]}/bucket={b}" for b in buckets]
        kind = "word long, bits long, of int"
        rows = (self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind))
        return rows.select(F.col("of").alias("bucket"), "word", "bits")

    def known(self, keys: DataFrame, batch_id: int) -> tuple[DataFrame, list[str]]:
        """(stored keys among ``keys`` (dedup_key), marker folders that were read)."""
        manifest = self.manifest(batch_id)
        keys = keys.select("dedup_key", bucket_of("dedup_key", self.buckets).alias("bucket"))
        # At most one row per bucket comes to the driver.
        own = [r[0] for r in keys.select("bucket").distinct().collect() if r[0] in manifest]
        wanted = filter_bits(keys, self.bits)
        there = wanted.join(self._filters(manifest, own), ["bucket", "word"], "left").groupBy(
            "dedup_key", "bucket").agg(F.bool_and(F.coalesce(
                F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))).alias("maybe"))
        maybe = there.filter("maybe").select("dedup_key", "bucket")
        hit = [r[0] for r in maybe.select("bucket").distinct().collect()] if own else []
        paths = [f"{self.root}/ingest_dedup_marker/batch={k}/bucket={b}" for b in sorted(hit) for k in manifest[b][1]]
        if not paths:
            return self.spark.createDataFrame([], "dedup_key string"), []
        stored = self.spark.read.schema("dedup_key string").parquet(*paths)
        return maybe.join(stored, "dedup_key", "left_semi").select("dedup_key"), paths

    def append(self, markers: DataFrame, batch_id: int) -> None:
        """Store the markers of a batch and new filters of the buckets they fall into."""
        manifest = self.manifest(batch_id)
        folder = f"{self.root}/ingest_dedup_marker/batch={batch_id}"
        # Sorted files let the reader skip pages that cannot hold a wanted key.
        (markers.withColumn("bucket", bucket_of("dedup_key", self.buckets)).repartition("bucket")
         .sortWithinPartitions("bucket", "dedup_key").write.mode("overwrite").partitionBy("bucket").parquet(folder))
        new = self.spark.read.schema("dedup_key string, bucket int").parquet(folder)
        touched = [r[0] for r in new.select("bucket").distinct().collect()]
        bits = filter_bits(new, self.bits).groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
        merged = self._filters(manifest, [b for b in touched if b in manifest]).unionByName(bits).groupBy(
            "bucket", "word").agg(F.bit_or("bits").alias("bits"))
        (merged.withColumn("of", F.col("bucket")).repartition("bucket").write.mode("overwrite")
         .partitionBy("bucket").parquet(f"{self.root}/marker_filter/batch={batch_id}"))
        for b in touched:
            manifest[b] = (batch_id, [*manifest.get(b, (0, []))[1], batch_id])
        rows = [(b, f, k) for b, (f, k) in sorted(manifest.items())]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/marker_manifest/batch={batch_id}")
