"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every
query is run once to warm up and then timed over its full result (no sink cost, all columns
computed).
"""

from __future__ import annotations

import json
import os
import time

from pressline.catalog import QUERIES
from pressline.session import build_session

HEADLINE = [
    "funnel_report", "readiness_breakdown", "source_report", "source_scorecard",
    "classify_report", "translation_report", "curation_report", "ingest_report",
    "publishing_report", "latency_percentiles", "data_quality_anomalies",
    "article_translation_completion", "language_translation_completion", "pending_translations",
    "stale_translations", "approved_content_changes", "publish_or_update_set", "withdraw_set",
    "latest_index", "archive_digests", "export_stats", "item_documents", "source_health_history",
    "feed_entries", "dedup_keys", "document_text_labels", "page_text_records",
    "classification_contract", "translation_requests", "hot_title_slugs", "first_wins_dedup",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.log.level": "ERROR", "spark.driver.memory": "16g"})
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    times = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": folder.rstrip("/").split("sf")[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
