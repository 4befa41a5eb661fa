"""Written intermediate tables and connected components, for jobs that must survive lost executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressline.session import ensure_checkpoint_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_collected: list[list[str]] = []


@contextmanager
def folders_noted() -> Iterator[list[str]]:
    """The folders that ``stored`` makes meanwhile, so that their maker can free them."""
    made: list[str] = []
    _collected.append(made)
    try:
        yield made
    finally:
        # By identity: notes of an outer and an inner maker may be equal.
        _collected[:] = [x for x in _collected if x is not made]


def freed(spark: SparkSession, folders: list[str]) -> None:
    """Delete stored folders that nothing reads any more."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Later steps restart from these files, so a lost executor costs a step, never the job. The folder
    goes when the application ends or its maker frees it; the shuffle files of the step go as soon as it
    is written. With ``by`` the rows of each value of that column lie in a folder of their own.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    # With a writer per folder at a time no sort by ``by`` is needed.
    settings = {CLEANUP: "true", **({WRITERS: "16"} if by else {})}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        # A frame of its own plans under the setting.
        df.select("*").write.parquet(folder, partitionBy=by)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    for made in _collected:
        made.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def keyed_rows(docs: DataFrame, *others: DataFrame, below: bool = False) -> DataFrame:
    """(row_key, kept): every row of ``docs`` as a struct, under a key of its own.

    The key is the doc_id. A row without doc_id, and every row but one of those that repeat a doc_id,
    gets an id that lies above (or below) all ids of ``docs`` and ``others``: such a row meets all other
    rows, takes no row's id, and gives way to rows with one. These ids are written down once. As the
    columns stay inside the struct, none of their names can clash.
    """
    own = F.col("doc_id").cast("long")
    per_id = docs.groupBy(own.alias("i")).agg(F.count(F.lit(1)).alias("n"))
    ids = per_id
    for other in others:
        ids = ids.unionByName(other.select(own.alias("i"), F.lit(0).cast("long").alias("n")))
    low, high, missing, repeated = ids.agg(F.min("i"), F.max("i"), F.count_if(F.expr("n > 0 AND i IS NULL")),
                                           F.count_if(F.expr("n > 1 AND i IS NOT NULL"))).first()
    rows = docs.select(own.alias("row_key"), F.struct("*").alias("kept"))
    if not missing and not repeated:
        return rows
    again = stored(per_id.where("n > 1 AND i IS NOT NULL").select(F.col("i").alias("row_key")))
    odd = rows.join(again, "row_key", "left_semi").unionByName(rows.where("row_key IS NULL"))
    odd = stored(odd.withColumn("place", F.monotonically_increasing_id() + 1))
    first = odd.where("row_key IS NOT NULL").groupBy("row_key").agg(F.min("place").alias("first"))
    key = F.lit(low or 0) - F.col("place") if below else F.lit(high or 0) + F.col("place")
    odd = odd.join(first, "row_key", "left").select(
        F.when(F.col("place") == F.col("first"), F.col("row_key")).otherwise(key).alias("row_key"), "kept")
    plain = rows.where("row_key IS NOT NULL").join(again, "row_key", "left_anti")
    return plain.unionByName(stored(odd))


def judged_rows(rows: DataFrame) -> DataFrame:
    """(doc_id, text) of keyed rows, as the operators take them."""
    return rows.select(F.col("row_key").alias("doc_id"), F.col("kept.text").alias("text"))


def rows_with(rows: DataFrame, found: DataFrame, how: str = "left_semi") -> DataFrame:
    """The documents of keyed rows whose key is (or, by left_anti, is not) a doc_id of ``found``."""
    keys = found.select(F.col("doc_id").alias("row_key")).distinct()
    return rows.join(keys, "row_key", how).select("kept.*")


def components(edges: DataFrame, kind: str = "long") -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), for every node in them.

    Each round hangs every node under its smallest neighbour, follows the hooks to their roots and
    merges what hangs together, so the number of rounds grows with the logarithm of the longest
    path, and the edges that are left shrink in every round. Only joins on node keys are used;
    adaptive execution splits the hot ones.
    """
    both = edges.select("a", "b").where("a <> b")
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    named = None
    while not both.isEmpty():
        up = both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("root"))
        up = stored(up)
        while True:
            above = up.select(F.col("node").alias("root"), F.col("root").alias("above"))
            next_up = stored(up.join(above, "root").select("node", F.col("above").alias("root"),
                                                          (F.col("above") < F.col("root")).alias("moved")))
            up = next_up.select("node", "root")
            if next_up.where("moved").isEmpty():
                break
        if named is None:
            named = up
        else:
            step = up.select(F.col("node").alias("root"), F.col("root").alias("above"))
            named = stored(named.join(step, "root", "left").select(
                "node", F.coalesce("above", "root").alias("root")))
        left = up.select(F.col("node").alias("a"), F.col("root").alias("a_root"))
        right = up.select(F.col("node").alias("b"), F.col("root").alias("b_root"))
        both = stored(both.join(left, "a").join(right, "b")
                      .select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
                      .where("a <> b").distinct())
    if named is None:
        return both.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return named.select("node", F.col("root").alias("component"))
