"""Canonical tables derived from the driver tables.

Each binding is one SQL text that Spark and DuckDB both accept, so a query and its oracle read the
same rows. The ``CASE``/``WHERE`` arithmetic models which items have reached which stage (a state
table holds only the items that got there); the driver tables themselves are always read whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RAW_SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, "
              "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}

# Cohort windows used by the registered queries: nearly all rows, with both borders exercised.
ITEM_WINDOW = ("1995-03-01 00:00:00", "2001-06-01 00:00:00")
EVENT_WINDOW = ("2024-01-03 00:00:00", "2024-01-29 00:00:00")

_LANG = "CASE lang_no WHEN 1 THEN 'en' WHEN 2 THEN 'zh' ELSE 'ja' END"
_ISO = "concat(replace(CAST({} AS VARCHAR(30)), ' ', 'T'), 'Z')"

BINDINGS: dict[str, str] = {
    "b_lang": """
SELECT 'en' AS language_code, 'English' AS label, 250 AS max_title_length
UNION ALL SELECT 'zh', 'Traditional Chinese', 250 UNION ALL SELECT 'ja', 'Japanese', 250""",
    "b_item": """
SELECT o_orderkey AS source_item_id, o_custkey % 98 + 1 AS source_id,
       concat('Order ', CAST(o_orderkey AS VARCHAR(20)), ' ', o_orderpriority) AS title,
       concat('https://desk.example/', CAST(o_orderkey AS VARCHAR(20))) AS canonical_url,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL
            ELSE o_orderdate - (o_custkey % 30) * INTERVAL '1' DAY END AS published_at,
       o_orderdate AS fetched_at, 'url' AS dedup_rule,
       concat('url:https://desk.example/', CAST(o_orderkey AS VARCHAR(20))) AS ingest_dedup_key
FROM orders""",
    "b_text": """
SELECT o_orderkey AS source_item_id,
       concat('Text of order ', CAST(o_orderkey AS VARCHAR(20))) AS sanitized_text,
       CASE WHEN o_orderkey % 40 = 1 THEN 'failed' WHEN o_orderkey % 4 = 2 THEN 'low_context'
            ELSE 'completed' END AS text_processing_status,
       CASE WHEN o_orderkey % 40 = 1 THEN 'missing_body'
            WHEN o_orderkey % 16 = 2 THEN 'mostly_links' WHEN o_orderkey % 16 = 6 THEN 'too_short'
            WHEN o_orderkey % 16 = 10 THEN 'title_heavy'
            WHEN o_orderkey % 16 = 14 THEN 'post_cleanup_empty' END AS text_processing_reason,
       CAST(floor(o_totalprice) AS BIGINT) % 12000 AS sanitized_text_length
FROM orders WHERE o_orderkey % 50 <> 0""",
    "b_class": """
SELECT o_orderkey AS source_item_id,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'core' WHEN '2' THEN 'core'
            WHEN '3' THEN 'adjacent' WHEN '4' THEN 'irrelevant' ELSE 'unknown' END AS topic_class,
       CAST(o_custkey % 101 AS DOUBLE) / 100 AS classification_confidence,
       CASE o_orderkey % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS content_density,
       CAST(CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_custkey % 2 END AS INTEGER)
           AS governmental_involvement,
       CASE o_custkey % 5 WHEN 0 THEN NULL
            WHEN 1 THEN '{"content_timeliness":"current","primary_evidence_type":"media_report"}'
            WHEN 2 THEN '{"content_timeliness":"historical"}'
            WHEN 3 THEN '{"primary_evidence_type":"eyewitness","other":"x"}'
            ELSE '{"content_timeliness":"evergreen","primary_evidence_type":"none"}' END
           AS additional_signals,
       o_orderdate + (o_orderkey % 600) * INTERVAL '1' SECOND AS classified_at
FROM orders WHERE o_orderkey % 20 <> 3""",
    "b_decision": """
SELECT o_orderkey AS source_item_id,
       CASE WHEN o_orderstatus = 'F' THEN 'approved' WHEN o_orderstatus = 'O' THEN 'rejected'
            WHEN o_orderkey % 2 = 0 THEN 'withdrawn' ELSE 'failed' END AS curate_status,
       CASE WHEN o_orderstatus = 'O' AND o_custkey % 10 = 0 THEN 'edit_rewrite'
            WHEN o_orderstatus = 'O' THEN 'reject_discard'
            WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 1 THEN NULL
            WHEN o_custkey % 2 = 0 THEN 'publish_link' ELSE 'publish_summary' END
           AS downstream_action,
       'rule' AS decision_reason, 'system' AS decision_actor,
       CAST(CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 1 THEN o_custkey % 5 ELSE 0 END
            AS INTEGER) AS retry_count,
       o_orderdate + (o_orderkey % 600 + o_custkey % 900) * INTERVAL '1' SECOND AS curated_at
FROM orders
WHERE (substr(o_orderpriority, 1, 1) IN ('1', '2', '3') AND o_orderkey % 20 <> 3)
   OR o_orderkey % 200 = 4""",
    "b_output": f"""
SELECT d.source_item_id,
       concat('Title ', o.o_orderpriority, CASE WHEN o.o_custkey % 7 = 0 THEN ' v2' ELSE '' END)
           AS display_title,
       concat('Summary of order ', CAST(d.source_item_id AS VARCHAR(20))) AS summary_short,
       CASE WHEN o.o_custkey % 2 = 1 THEN 'claim' END AS bullet_1,
       CASE WHEN o.o_custkey % 22 = 11 THEN ' ' WHEN o.o_custkey % 2 = 1 THEN 'evidence'
            WHEN o.o_custkey % 26 = 0 THEN 'stray' END AS bullet_2,
       CASE WHEN o.o_custkey % 2 = 1 THEN 'impact' END AS bullet_3,
       d.curated_at + (o.o_custkey % 3) * INTERVAL '1' HOUR AS updated_at
FROM b_decision d JOIN orders o ON o.o_orderkey = d.source_item_id
WHERE d.downstream_action IN ('publish_link', 'publish_summary')""",
    "b_approved": """
SELECT o_orderkey + 1000000 AS parent_content_id, o_orderkey AS source_item_id,
       concat('Title ', o_orderpriority) AS display_title,
       concat('Summary of order ', CAST(o_orderkey AS VARCHAR(20))) AS summary_short,
       CASE WHEN o_custkey % 2 = 1 THEN 'claim' END AS bullet_1,
       CASE WHEN o_custkey % 2 = 1 THEN 'evidence' END AS bullet_2,
       CASE WHEN o_custkey % 2 = 1 THEN 'impact' END AS bullet_3,
       md5(concat(CAST(o_orderkey AS VARCHAR(20)), '|', o_orderpriority)) AS content_fingerprint,
       CASE WHEN o_custkey % 12 = 5 THEN 'zh' ELSE 'en' END AS content_language_code,
       o_orderdate + (o_orderkey % 600 + o_custkey % 900) * INTERVAL '1' SECOND AS approved_at,
       concat('{"source_module":"curate","writer_type":"',
              CASE o_custkey % 9 WHEN 0 THEN 'human' WHEN 1 THEN 'hybrid' ELSE 'AI' END,
              CASE WHEN o_custkey % 9 IN (0, 1) THEN '","editor":"desk' ELSE '' END,
              '","upstream_updated_at":"', ISO, '"}') AS author_metadata
FROM orders
WHERE substr(o_orderpriority, 1, 1) IN ('1', '2', '3') AND o_orderkey % 20 <> 3
  AND (o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 2 = 0))""".replace(
        "ISO", _ISO.format(
            "o_orderdate + (o_orderkey % 600 + o_custkey % 900) * INTERVAL '1' SECOND")),
    "b_line": """
SELECT l_orderkey, l_linenumber % 3 AS lang_no, min(l_returnflag) AS rf, min(l_linestatus) AS ls,
       min(l_suppkey) AS sk
FROM lineitem GROUP BY l_orderkey, l_linenumber % 3""",
    "b_translation": f"""
SELECT a.parent_content_id, a.source_item_id, {_LANG} AS language_code,
       concat(a.display_title, ' ', {_LANG}) AS display_title, a.summary_short,
       a.bullet_1, CASE WHEN l.sk % 33 = 7 THEN NULL ELSE a.bullet_2 END AS bullet_2, a.bullet_3,
       CASE WHEN l.rf = 'R' AND l.ls = 'F' THEN 'failed' WHEN l.rf = 'R' THEN 'stale'
            ELSE 'completed' END AS translation_status,
       CAST(l.sk % 5 AS INTEGER) AS retry_count,
       CASE WHEN a.content_language_code = {_LANG} THEN 'bypass' ELSE 'model-a' END AS model_name,
       CASE WHEN a.content_language_code = {_LANG} THEN 'bypass'
            WHEN l.sk % 4 = 1 THEN 'v1' ELSE 'v2' END AS prompt_version,
       CASE WHEN l.sk % 10 = 0 THEN 'old' ELSE a.content_fingerprint END AS source_fingerprint,
       a.approved_at + (l.sk % 3000) * INTERVAL '1' SECOND AS translated_at,
       a.approved_at + (l.sk % 3000) * INTERVAL '1' SECOND AS updated_at, l.ls AS line_status
FROM b_line l JOIN b_approved a ON a.source_item_id = l.l_orderkey""",
    "b_publish": """
SELECT source_item_id + 2000000 AS publish_record_id, source_item_id,
       concat('order-', CAST(source_item_id AS VARCHAR(20))) AS slug,
       approved_at + INTERVAL '1' HOUR AS first_published_at
FROM b_approved WHERE source_item_id % 5 <> 0""",
    "b_publish_status": """
SELECT p.publish_record_id, t.language_code,
       CASE WHEN t.line_status = 'F' THEN 'published' ELSE 'withdrawn' END AS publish_status,
       CASE WHEN t.line_status = 'F' THEN p.first_published_at END AS published_at,
       CASE WHEN t.line_status <> 'F' THEN p.first_published_at + INTERVAL '1' HOUR END AS withdrawn_at,
       t.source_fingerprint
FROM b_publish p JOIN b_translation t ON t.source_item_id = p.source_item_id""",
    "b_archive_meta": """
SELECT 'en' AS language_code, substr(CAST(published_at AS VARCHAR(30)), 1, 7) AS archive_month,
       max(fetched_at) AS updated_at
FROM b_item WHERE published_at IS NOT NULL
GROUP BY substr(CAST(published_at AS VARCHAR(30)), 1, 7)
UNION ALL
SELECT 'fr', substr(CAST(fetched_at AS VARCHAR(30)), 1, 7), max(fetched_at)
FROM b_item GROUP BY substr(CAST(fetched_at AS VARCHAR(30)), 1, 7)""",
    "b_attempt": """
SELECT event_id AS fetch_attempt_id, date_trunc('hour', ts) AS run_started_at,
       user_id % 98 + 1 AS source_id, ts AS started_at,
       ts + CAST(floor(value) AS BIGINT) * INTERVAL '1' SECOND AS ended_at,
       CASE WHEN event_type IN ('error', 'view') THEN 'failed' ELSE 'success' END AS outcome,
       CASE WHEN event_type NOT IN ('error', 'view') THEN NULL
            WHEN event_id % 3 = 0 THEN 'http_error_4xx'
            WHEN event_id % 3 = 1 THEN 'http_error_5xx' ELSE 'timeout_error' END AS error_class,
       CAST(CASE WHEN event_type NOT IN ('error', 'view') THEN 200 WHEN event_id % 3 = 0 THEN 404
            WHEN event_id % 3 = 1 THEN 503 END AS INTEGER) AS http_status,
       CAST(event_id % 4 AS INTEGER) AS new_item_count,
       CAST(event_id % 3 AS INTEGER) AS dedup_matched_count
FROM events""",
    "b_last_success": """
SELECT source_id, max(started_at) AS success_started_at, max(ended_at) AS last_success_at
FROM b_attempt WHERE outcome = 'success' GROUP BY source_id""",
    "b_state_base": """
SELECT a.source_id, max(a.started_at) AS last_fetch_at, max(s.last_success_at) AS last_success_at,
       CAST(sum(CASE WHEN s.success_started_at IS NULL OR a.started_at > s.success_started_at
                     THEN 1 ELSE 0 END) AS INTEGER) AS consecutive_failures
FROM b_attempt a LEFT JOIN b_last_success s ON s.source_id = a.source_id GROUP BY a.source_id""",
    "b_state": """
SELECT source_id, last_fetch_at, last_success_at, consecutive_failures,
       CASE WHEN consecutive_failures >= 5 THEN 'quarantined' WHEN consecutive_failures >= 3
            THEN 'degraded' ELSE 'healthy' END AS health_status,
       CASE WHEN consecutive_failures > 0 THEN 'timeout_error' END AS last_error_class,
       CAST(CASE WHEN consecutive_failures > 0 THEN 503 ELSE 200 END AS INTEGER)
           AS last_http_status,
       CASE WHEN consecutive_failures >= 5 THEN last_fetch_at + INTERVAL '24' HOUR END
           AS quarantine_until
FROM b_state_base WHERE source_id % 10 <> 9""",
    "b_run": """
SELECT run_started_at AS started_at, count(*) AS attempted_source_count,
       CAST(sum(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) AS BIGINT)
           AS succeeded_source_count
FROM b_attempt GROUP BY run_started_at""",
    "b_source": """
SELECT CAST(s_suppkey + 1 AS BIGINT) AS source_id, s_name AS title,
       CAST(s_nationkey % 6 AS INTEGER) AS category_id,
       CASE WHEN s_suppkey % 9 = 5 THEN 0 ELSE 1 END AS enabled,
       CAST(s_suppkey % 5 + 1 AS INTEGER) AS fetch_group,
       CASE s_nationkey % 3 WHEN 0 THEN 'hourly' WHEN 1 THEN 'daily' ELSE 'slow' END
           AS schedule_class,
       concat('https://feeds.example/', CAST(s_nationkey AS VARCHAR(20))) AS xml_url,
       CASE WHEN s_suppkey % 8 <> 0 THEN concat('https://site.example/', s_name) END AS html_url,
       CASE WHEN s_suppkey % 30 = 7 THEN 'missing_profile' ELSE 'default_html_article' END
           AS sanitization_profile
FROM supplier WHERE s_suppkey % 16 <> 15""",
    "b_entry": """
SELECT doc_id AS entry_id, CAST(substr(source, 4) AS BIGINT) AS source_id,
       split_part(text, chr(10), 1) AS raw_title,
       CASE WHEN doc_id % 3 = 0 THEN NULL
            ELSE concat('https://Example.com/a/', CAST(doc_id % 700 AS VARCHAR(20)),
                        '/?utm_source=x&id=', CAST(doc_id % 700 AS VARCHAR(20)), '#top') END AS link,
       CASE WHEN doc_id % 2 = 0 THEN concat('g-', CAST(doc_id % 900 AS VARCHAR(20))) END AS guid,
       text AS summary,
       CASE doc_id % 6 WHEN 0 THEN NULL
            WHEN 1 THEN concat(CASE WHEN doc_id % 5 = 0 THEN 'Monday ' ELSE 'Mon, ' END,
                               CAST(doc_id % 28 + 1 AS VARCHAR(20)),
                               CASE doc_id % 4 WHEN 1 THEN ' Jan 2024 05:20:30 EST'
                                    ELSE ' Jan 24 10:20:30 GMT' END)
            WHEN 2 THEN concat('2024-02-', CASE WHEN doc_id % 28 < 9 THEN '0' ELSE '' END,
                               CAST(doc_id % 28 + 1 AS VARCHAR(20)), 'T20:00:00+08:00')
            WHEN 3 THEN concat('2024-03-', CAST(doc_id % 28 + 1 AS VARCHAR(20)))
            WHEN 4 THEN 'yesterday'
            ELSE concat('2024-04-', CAST(doc_id % 28 + 1 AS VARCHAR(20)), ' 01:02:03') END
            AS raw_date,
       TIMESTAMP '2024-01-01 00:00:00' + (doc_id % 2592000) * INTERVAL '1' SECOND AS fetched_at
FROM documents""",
    "b_escaped": """
SELECT doc_id AS payload_id, CAST(substr(source, 4) AS BIGINT) AS source_id, text AS plain,
       CASE WHEN doc_id % 12 = 8 THEN 'body' ELSE 'content' END AS prefix,
       replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS body,
       replace(replace(replace(split_part(text, chr(10), 1), '&', '&amp;'), '<', '&lt;'),
               '>', '&gt;') AS head
FROM documents""",
    "b_payload": """
SELECT payload_id, source_id,
       CASE WHEN payload_id % 2 = 0 THEN concat(
            '<?xml version="1.0"?><rss version="2.0" xmlns:media="http://search.yahoo.com/mrss/" ',
            'xmlns:itunes="http://www.itunes.com/dtds/podcast-1.0.dtd" ',
            'xmlns:', prefix, '="http://purl.org/rss/1.0/modules/content/"><channel><title>c</title><item><title>', head,
            '</title>', CASE WHEN payload_id % 4 = 0 THEN '<media:title>Caption</media:title>' ELSE '' END,
            '<link>https://Example.com/p/', CAST(payload_id AS VARCHAR(20)),
            '/</link><guid isPermaLink="false">g', CAST(payload_id AS VARCHAR(20)),
            '</guid><pubDate>', CASE WHEN payload_id % 4 = 0 THEN 'Fri 5 Jan 24 05:00 EST'
                                 ELSE 'Fri, 05 Jan 2024 10:00:00 GMT' END, '</pubDate>',
            CASE WHEN payload_id % 6 = 2 THEN concat('<', prefix, ':encoded>') ELSE '<description>' END,
            CASE WHEN payload_id % 24 = 8 THEN concat('<![CDATA[<body:b>', plain, '</body:b>]]>') ELSE body END,
            CASE WHEN payload_id % 6 = 2 THEN concat('</', prefix, ':encoded>') ELSE '</description>' END,
            CASE WHEN payload_id % 4 = 0 THEN '<media:description>Alt</media:description><itunes:summary>S</itunes:summary>'
                 ELSE '' END, '</item>',
            CASE WHEN payload_id % 10 = 0 THEN
                '<item><title>Episode</title><enclosure url="https://media.example/e.mp3"/></item>'
                ELSE '' END,
            CASE WHEN payload_id % 17 = 4 THEN '' ELSE '</channel></rss>' END)
       ELSE concat(
            '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>', head, '</title><id>u:',
            CAST(payload_id AS VARCHAR(20)), '</id><link rel="alternate" href="https://a.example/',
            CAST(payload_id AS VARCHAR(20)),
            '"/><updated>2024-01-05T18:00:00+08:00</updated><content type="',
            CASE WHEN payload_id % 4 = 1 THEN 'xhtml"><div xmlns="http://www.w3.org/1999/xhtml">' ELSE 'html">' END, body,
            CASE WHEN payload_id % 4 = 1 THEN '</div>' ELSE '' END, '</content></entry>', CASE WHEN payload_id % 17 = 4 THEN '' ELSE '</feed>' END) END
       AS payload
FROM b_escaped""",
}

_NAME = re.compile(r"\b(FROM|JOIN)\s+(\w+)")


class Tables:
    """Lazy access to the driver tables and the canonical bindings of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._cache = spark, folder.rstrip("/"), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            if name in BINDINGS:
                self._cache[name] = self.sql(BINDINGS[name])
            else:
                reader = self.spark.read
                if name in RAW_SCHEMAS:
                    reader = reader.schema(RAW_SCHEMAS[name])
                self._cache[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._cache[name]

    def keep(self, name: str, path: str, *columns: str) -> None:
        """Store a binding under ``path`` (only ``columns``, if given): it and what derives from it read that."""
        rows = getattr(self, name)
        rows = rows.select(*columns) if columns else rows
        rows.write.parquet(path)
        self._cache[name] = self.spark.read.schema(rows.schema).parquet(path)

    def sql(self, text: str) -> DataFrame:
        """Run SQL whose table names are driver tables or bindings."""
        names = {m.group(2) for m in _NAME.finditer(text)}
        marked = _NAME.sub(r"\1 {\2}", text.replace("{", "{{").replace("}", "}}"))
        return self.spark.sql(marked, **{n: getattr(self, n) for n in names})


def _needed(text: str, found: list[str]) -> list[str]:
    for name in BINDINGS:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(BINDINGS[name], found)
            found.append(name)
    return found


def with_bindings(sql: str) -> str:
    """Prefix an oracle query with the bindings it refers to."""
    names = _needed(sql, [])
    body = sql.strip()
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({BINDINGS[n]})" for n in names)
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
