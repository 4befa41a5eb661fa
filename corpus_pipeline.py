"""The corpus pipeline: five stages, each over all that its predecessor kept.

Every stage is written as Parquet into the shared checkpoint folder and read again, so a lost
executor costs one stage at most. What a stage has stored for itself is freed when the next one begins on
its written result, so the disk holds the intermediates of one stage at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from pressline.llm import decontamination, exact_dedup, jaccard_join, packing, quality
from pressline.llm.storage import folders_noted, freed, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Application -> folders that its stage before has stored for itself.
_left: dict[str, list[str]] = {}


def tidy(stage: Stage) -> Stage:
    """``stage`` with the intermediates of the stage before freed first, unless ``docs`` still reads them.

    An application runs one pipeline at a time.
    """
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        before = _left.pop(application, [])
        if before:
            read = "\n".join(docs.inputFiles())
            used = [f for f in before if f.rsplit("/", 1)[1] in read]
            freed(spark, [f for f in before if f not in used])
            before = used
        with folders_noted() as made:
            out = stage(spark, docs, sf_dir)
        if run_stage is not STAGES[-1][1]:
            # What the last stage returns may be read at any time.
            _left[application] = before + made
        return out
    return run_stage


@tidy
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.drop_poor(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@tidy
def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id."""
    return exact_dedup.drop_copies(docs)


@tidy
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the smallest doc_id."""
    return jaccard_join.drop_near_copies(docs)


@tidy
def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by test items."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@tidy
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, packed into sequences."""
    return packing.packed_documents(docs)


STAGES = [("quality_classifier", quality_stage), ("exact_dedup", exact_stage),
          ("ngram_jaccard_join", near_stage), ("benchmark_decontamination", benchmark_stage),
          ("best_fit_packing", packing_stage)]

# The classifier is trained, so no SQL gives its rows; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs)
    return docs
