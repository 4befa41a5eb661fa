"""Tables whose upserts rewrite only the buckets that change.

Plain Parquet has no MERGE. Rows lie in buckets by a hash of their key, and a manifest says for every
bucket in which generation its files were written. A merge reads and writes the buckets of its changes
alone; all other entries of the new manifest point to the files they had. The manifest is written last,
so a broken merge leaves the old generation whole, and old generations can still be read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pressline.session import cut_lineage
from pressline.sources.exports import path_exists

MANIFEST = "bucket int, home long"


class BucketedTable:
    """One table under ``root``; ``keys`` say which rows belong together."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], buckets: int = 64):
        self.spark, self.root, self.schema, self.keys, self.buckets = spark, root, schema, keys, buckets

    def generation(self) -> int | None:
        """The newest complete generation."""
        path = f"{self.root}/manifest"
        if not path_exists(self.spark, path):
            return None
        rows = self.spark.read.schema(f"{MANIFEST}, generation long").parquet(path)
        return rows.agg(F.max("generation")).first()[0]

    def homes(self, generation: int | None = None) -> dict[int, int]:
        """bucket -> generation that wrote it."""
        generation = self.generation() if generation is None else generation
        if generation is None:
            return {}
        # A row for bucket -1 says that the generation exists, even when it holds no row.
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/generation={generation}")
        return {r["bucket"]: r["home"] for r in rows.collect() if r["bucket"] >= 0}

    def _rows(self, homes: dict[int, int]) -> DataFrame:
        paths = [f"{self.root}/data/generation={g}/bucket={b}" for b, g in sorted(homes.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, generation: int | None = None) -> DataFrame:
        return self._rows(self.homes(generation))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _publish(self, rows: DataFrame, touched: list[int] | None) -> None:
        last = self.generation()
        homes = self.homes(last) if last is not None else {}
        new = 0 if last is None else last + 1
        path = f"{self.root}/data/generation={new}"
        (rows.select(*self.schema.names).withColumn("bucket", self._bucket()).repartition("bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(path))
        full = self.spark.read.schema("bucket int").parquet(path).distinct().collect()
        kept = {} if touched is None else {b: g for b, g in homes.items() if b not in set(touched)}
        homes = kept | {r[0]: new for r in full}
        self.spark.createDataFrame([(-1, new), *sorted(homes.items())], MANIFEST).coalesce(1).write.mode(
            "overwrite").parquet(f"{self.root}/manifest/generation={new}")

    def create(self, rows: DataFrame) -> None:
        """A generation with exactly these rows."""
        self._publish(rows, None)

    def merge(self, changes: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """A generation with ``combine(stored rows, changes)`` in the buckets of ``changes``; their list.

        ``changes`` has the key columns. ``combine`` sees whole buckets and returns all rows they hold
        from now on; a bucket without changes is neither read nor written.
        """
        changes = cut_lineage(changes.withColumn("_bucket", self._bucket()))
        touched = sorted(r[0] for r in changes.select("_bucket").distinct().collect())
        homes = self.homes()
        old = self._rows({b: homes[b] for b in touched if b in homes})
        self._publish(combine(old, changes.drop("_bucket")), touched)
        return touched


def replaced(keys: list[str], gone: str = "_gone") -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Combine by key: a change replaces the stored row or, where ``gone`` is true, removes it."""
    def combine(old: DataFrame, changes: DataFrame) -> DataFrame:
        kept = old.join(changes.select(*keys), keys, "left_anti")
        return kept.unionByName(changes.filter(~F.col(gone)).select(*old.columns))
    return combine
