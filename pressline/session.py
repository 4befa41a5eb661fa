"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints of finished iterations go with the frames that held them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "pressline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators expect; partition counts are left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    ``spark.checkpoint.dir`` wins. Only a local master may fall back to a temporary folder, because
    on a cluster such a folder would live on one machine and die with it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="spark-pressline-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later rounds restart from stored files when executors are lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_columns(df: DataFrame) -> DataFrame:
    """``cut_lineage`` for wide rows with several readers: a reader of a few columns reads no others.

    The folder goes when the application ends.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(folder)


def cut_round(df: DataFrame) -> DataFrame:
    """``cut_lineage`` for frames that a loop builds on.

    A checkpoint hands on the size that was estimated for it, and a join's estimate is the product of
    its sides. In a loop its digits double with every join, until planning on the driver takes most
    of the time and memory; rows taken over as an RDD have no such estimate.
    """
    kept, spark = cut_lineage(df), df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(kept._jdf.javaRDD(), kept._jdf.schema()), spark)
