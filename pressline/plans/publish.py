"""A publish run: reconcile, assign slugs, change status rows, build the snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressline.functions import rates as R
from pressline.operators import publish as B
from pressline.operators.audits import payload_audit
from pressline.operators.cohort import KEY
from pressline.session import cut_lineage


def reconcile(tables: dict[str, DataFrame], languages: list[str], run_ts,
              last_record_id: int = 0) -> dict[str, DataFrame]:
    """The complete publish_record and publish_language_status tables after a run.

    New records are numbered from ``last_record_id``, or from the largest id in use if that is higher.

    Pairs whose payload is missing or breaks the contract come back as ``rejected``. Nothing of their
    items is published or refreshed, in no language, and no slug or record is made for them.
    """
    from pressline.operators.buckets import sequence_ids
    item, approved, decision = tables["item"], tables["approved"], tables["decision"]
    translation, publish, status = (tables["translation"], tables["publish"],
                                    tables["publish_status"])
    rows = cut_lineage(B.candidates(approved, decision, translation, item, publish, status))
    wanted = B.to_publish(rows, languages)
    withdrawn = B.to_withdraw(rows, publish, status, languages)
    # Judged before any slug is given: an assigned slug is never blank, so a mark stands in for it.
    payloads = (B.canonical_payloads(approved, decision, translation, item)
                .join(publish.select(KEY, "slug"), KEY, "left").fillna("item", ["slug"]))
    judged = payload_audit(payloads).select(KEY, "language_code", "is_valid", "reason")
    plan = cut_lineage(
        wanted.select(KEY, "language_code", "content_fingerprint", "display_title")
        .join(judged, [KEY, "language_code"], "left")
        .withColumn("reason", F.when(F.col("is_valid").isNull(), "payload is missing").otherwise(F.col("reason")))
        .withColumn("is_valid", F.coalesce("is_valid", F.lit(False))))
    failed = plan.filter("NOT is_valid")
    accepted = plan.join(failed.select(KEY).distinct(), KEY, "left_anti")
    fresh = B.new_records(accepted, publish, run_ts)
    in_use = publish.agg(F.max("publish_record_id")).first()[0] or 0
    numbered = cut_lineage(sequence_ids(fresh, [KEY], "publish_record_id", max(last_record_id, in_use)))
    records = publish.unionByName(numbered.select(*publish.columns))
    changes = (accepted.select(KEY, "language_code",
                               F.lit("published").alias("publish_status"),
                               F.col("content_fingerprint").alias("source_fingerprint"))
               .unionByName(withdrawn.select(KEY, "language_code",
                                             F.lit("withdrawn").alias("publish_status"),
                                             "source_fingerprint"))
               .join(records.select(KEY, "publish_record_id"), KEY)
               .withColumn("moment", R.at(run_ts)))
    return {"publish_record": records,
            "publish_language_status": B.upsert_status(status, changes),
            "rejected": failed.drop("display_title")}


def export_plan(tables: dict[str, DataFrame], languages: DataFrame, metadata: DataFrame,
                prior: DataFrame, run_ts, limit: int = 1000) -> dict[str, DataFrame]:
    """Everything a snapshot holds, from the current tables."""
    payloads = B.payload_rows(tables["approved"], tables["decision"], tables["translation"],
                              tables["item"], tables["publish"], tables["publish_status"]).join(
        languages.select("language_code"), "language_code", "left_semi")
    # Five datasets start from these rows, so the six-table join is stored once.
    payloads = cut_lineage(payloads)
    catalogue = B.catalogue_rows(payloads)
    stamps = B.archive_stamps(B.archive_digests(catalogue), metadata, prior, run_ts)
    stats = B.export_stats(tables["publish"], tables["publish_status"], tables["item"], languages,
                           limit)
    return {"documents": B.item_documents(payloads), "catalogue": catalogue,
            "index": B.latest_index(catalogue, limit), "stamps": stamps,
            "stats": B.stats_document(stats, run_ts)}
