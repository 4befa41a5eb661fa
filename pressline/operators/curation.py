"""Classification and curation state: queues, validated writes, failures, transitions, handoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressline import fixed_values as V
from pressline.functions import rates as R
from pressline.functions.content import FIVE, content_fingerprint
from pressline.functions.titles import blank
from pressline.operators.cohort import KEY
from pressline.operators.dedup import latest_rows

DONE = ["approved", "rejected", "withdrawn"]


# --- queues ------------------------------------------------------------------------------------------

def pending_classification(item, text, cls, limit: int | None = None) -> DataFrame:
    """Classifiable items without a classification, in id order."""
    rows = (item.select(KEY, "title")
            .join(text.filter(R.classifiable()).select(KEY, "sanitized_text"), KEY)
            .join(cls.select(KEY), KEY, "left_anti"))
    return rows if limit is None else rows.orderBy(KEY).limit(limit)


def curation_view(item, text, cls) -> DataFrame:
    """Relevant items with what a curator needs."""
    return (item.select(KEY, F.col("title").alias("raw_title"), "canonical_url")
            .join(text.select(KEY, "sanitized_text"), KEY)
            .join(cls.filter(R.relevant()).select(KEY, "topic_class", "governmental_involvement"),
                  KEY))


def may_curate(retry_limit: int = V.RETRY_LIMIT) -> Column:
    status = F.col("curate_status")
    return status.isNull() | ((status == "failed") & (F.col("retry_count") < retry_limit))


def pending_curation(item, text, cls, decision, limit: int | None = None,
                     retry_limit: int = V.RETRY_LIMIT) -> DataFrame:
    """Relevant items without decision, or failed below the limit, in id order."""
    rows = (curation_view(item, text, cls)
            .join(decision.select(KEY, "curate_status", "retry_count"), KEY, "left")
            .filter(may_curate(retry_limit)).drop("curate_status", "retry_count"))
    return rows if limit is None else rows.orderBy(KEY).limit(limit)


def find_items(view: DataFrame, wanted: DataFrame) -> DataFrame:
    """Curation view of the wanted items; irrelevant or unknown ids give no row."""
    return view.join(wanted.select(KEY).distinct(), KEY, "left_semi")


def select_items(requests: DataFrame, view: DataFrame, decision: DataFrame,
                 retry_limit: int = V.RETRY_LIMIT) -> DataFrame:
    """Outcome of every requested (item, force): selected, or why not."""
    known = view.select(KEY, F.lit(True).alias("_known"))
    rows = (requests.join(known, KEY, "left")
            .join(decision.select(KEY, "curate_status", "retry_count"), KEY, "left"))
    return rows.select(KEY, "force", F.when(F.col("_known").isNull(), "not_eligible")
                       .when(F.col("force") | may_curate(retry_limit), "selected")
                       .when(F.col("curate_status") == "failed", "locked")
                       .otherwise("already_curated").alias("outcome"))


def queue_counts(item, cls, decision, retry_limit: int = V.RETRY_LIMIT) -> DataFrame:
    """Queue numbers in one row: pending from the join, the rest from one aggregate."""
    pending = (item.select(KEY).join(cls.filter(R.relevant()).select(KEY), KEY)
               .join(decision.select(KEY, "curate_status", "retry_count"), KEY, "left")
               .agg(R.tally(may_curate(retry_limit)).alias("pending")))
    status, action = F.col("curate_status"), F.col("downstream_action")

    def count(s, a=None):
        return R.tally((status == s) & (action == a) if a else status == s)

    counts = decision.agg(
        R.tally((status == "failed") & (F.col("retry_count") >= retry_limit)).alias("locked"),
        count("approved").alias("approved_total"),
        count("approved", "publish_link").alias("approved_link"),
        count("approved", "publish_summary").alias("approved_summary"),
        count("withdrawn").alias("withdrawn_total"),
        count("withdrawn", "publish_link").alias("withdrawn_link"),
        count("withdrawn", "publish_summary").alias("withdrawn_summary"),
        count("rejected").alias("rejected_total"),
        count("rejected", "edit_rewrite").alias("rejected_rewrite"),
        count("rejected", "reject_discard").alias("rejected_discard"),
        count("failed").alias("failed_total"))
    return pending.crossJoin(F.broadcast(counts))


# --- writes ------------------------------------------------------------------------------------------

def upsert(table: DataFrame, fresh: DataFrame, keys: list[str], newest: str,
           keep: list[str] | None = None) -> DataFrame:
    """The complete new table: fresh rows replace old ones, ``keep`` columns survive from the old.

    Several fresh rows of one key count as writes in the order of ``newest``.
    """
    keep = [c for c in (keep or []) if c in table.columns]
    last = latest_rows(fresh, keys, [F.col(newest).desc()])
    if not keep:
        return table.join(last.select(*keys), keys, "left_anti").unionByName(
            last.select(*table.columns))
    firsts = latest_rows(fresh, keys, [F.col(newest)]).select(
        *keys, *[F.col(c).alias("_f_" + c) for c in keep])
    old = table.select(*keys, *[F.col(c).alias("_o_" + c) for c in keep])
    merged = last.join(firsts, keys).join(old, keys, "left")
    for c in keep:
        merged = merged.withColumn(c, F.coalesce("_o_" + c, "_f_" + c))
    return table.join(last.select(*keys), keys, "left_anti").unionByName(
        merged.select(*table.columns))


def guard_actions(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decisions that may be written, and those that lack the action their status demands."""
    bad = (F.col("curate_status") != "failed") & F.col("downstream_action").isNull()
    return decisions.filter(~bad), decisions.filter(bad)


def apply_results(decision: DataFrame, brief: DataFrame, output: DataFrame, results: DataFrame,
                  now, retry_limit: int = V.RETRY_LIMIT) -> dict[str, DataFrame]:
    """The three complete curation tables after a batch of results.

    ``results``: item id, ``ok``, curate_status, downstream_action, decision_reason, the brief and
    the five output fields. Published actions write brief and output, a rewrite keeps only the
    brief, a discard neither. A failure counts one retry unless the item was finished before; then
    nothing changes.
    """
    moment = R.at(now)
    prior = decision.select(KEY, F.col("curate_status").alias("_was"),
                            F.col("retry_count").alias("_retries"))
    rows = results.join(prior, KEY, "left")
    finished = F.coalesce(F.col("_was").isin(DONE), F.lit(False))
    won = rows.filter(F.col("ok"))
    lost = rows.filter(~F.col("ok") & ~finished)
    shared = [F.lit("system").alias("decision_actor"), moment.alias("curated_at"),
              moment.alias("updated_at"), moment.alias("created_at")]
    written = won.select(KEY, "curate_status", "downstream_action", "decision_reason",
                         F.lit(0).alias("retry_count"), *shared).unionByName(
        lost.select(KEY, F.lit("failed").alias("curate_status"),
                    F.lit(None).cast("string").alias("downstream_action"),
                    F.col("decision_reason"),
                    (F.coalesce("_retries", F.lit(0)) + 1).alias("retry_count"), *shared))
    action = F.col("downstream_action")
    with_output = won.filter(action.isin(V.PUBLISH_ACTIONS))
    with_brief = won.filter(action.isin(V.PUBLISH_ACTIONS) | (action == "edit_rewrite"))
    new_brief = with_brief.withColumn("created_at", moment).withColumn("updated_at", moment)
    new_output = with_output.withColumn("created_at", moment).withColumn("updated_at", moment)
    gone_output = won.filter(~action.isin(V.PUBLISH_ACTIONS)).select(KEY)
    gone_brief = won.filter(action == "reject_discard").select(KEY)
    kept = ["created_at"]
    return {
        "curation_decision": upsert(decision, written.select(*decision.columns), [KEY],
                                    "updated_at", kept),
        "editor_brief": upsert(brief.join(gone_brief, KEY, "left_anti"),
                               new_brief.select(*brief.columns), [KEY], "updated_at", kept),
        "curation_output": upsert(output.join(gone_output, KEY, "left_anti"),
                                  new_output.select(*output.columns), [KEY], "updated_at", kept),
    }


def transitions(decision: DataFrame, commands: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """Withdraw approved and re-approve withdrawn decisions.

    ``commands``: item id, ``command`` (withdraw, reapprove), ``reason``. Returns the complete new
    decisions and one outcome row per command.
    """
    wants = F.when(F.col("command") == "withdraw", "approved").when(
        F.col("command") == "reapprove", "withdrawn")
    rows = commands.join(decision.select(KEY, "curate_status"), KEY, "left")
    outcome = (F.when(F.col("curate_status").isNull(), "no_decision")
               .when(F.col("curate_status") == wants, "applied").otherwise("wrong_status"))
    outcomes = rows.withColumn("outcome", outcome).drop("curate_status")
    new = outcomes.filter("outcome = 'applied'").select(
        KEY, F.when(F.col("command") == "withdraw", "withdrawn").otherwise("approved")
        .alias("_status"), F.col("reason").alias("_reason"))
    hit = F.col("_status").isNotNull()
    table = decision.join(new, KEY, "left")
    table = (table.withColumn("curate_status", F.coalesce("_status", "curate_status"))
             .withColumn("decision_reason", F.when(hit, F.col("_reason"))
                         .otherwise(F.col("decision_reason")))
             .withColumn("decision_actor", F.when(hit, "operator")
                         .otherwise(F.col("decision_actor")))
             .withColumn("updated_at", F.when(hit, R.at(now)).otherwise(F.col("updated_at")))
             .select(*decision.columns))
    return table, outcomes


# --- handoff of approved content -----------------------------------------------------------------------

def bullet_violation(action: str = "downstream_action",
                     bullets: list[str] = FIVE[2:]) -> Column:
    """First bullet that breaks the none-or-three rule, NULL when the shape is legal."""
    reason = F.lit(None).cast("string")
    for i, b in reversed(list(enumerate(bullets, start=1))):
        c = F.col(b)
        reason = (F.when((F.col(action) == "publish_summary") & c.isNull(), f"bullet_{i} is NULL")
                  .when((F.col(action) == "publish_summary") & blank(c), f"bullet_{i} is blank")
                  .when((F.col(action) == "publish_link") & c.isNotNull(),
                        f"bullet_{i} is populated").otherwise(reason))
    return reason


def assemble_approved(decision, output, approved) -> DataFrame:
    """Every publishable decision with the change its approved record needs.

    ``change`` is insert, update, touch (only the freshness mark moves), skip or reject; the new
    field values come along. Records already up to date by upstream time are skipped before any
    comparison.
    """
    fields = [F.col(c) for c in FIVE]
    candidates = (decision.filter((F.col("curate_status") == "approved")
                                  & F.col("downstream_action").isin(V.PUBLISH_ACTIONS))
                  .select(KEY, "downstream_action", F.col("curated_at").alias("approved_at"))
                  .join(output.select(KEY, *fields, F.col("updated_at").alias("upstream_at")), KEY))
    seen = F.try_to_timestamp(F.get_json_object("author_metadata", "$.upstream_updated_at"))
    old = approved.select(KEY, seen.alias("o_upstream"), F.lit(True).alias("o_exists"),
                          *[F.col(c).alias("o_" + c) for c in FIVE],
                          F.col("content_fingerprint").alias("o_fingerprint"),
                          F.col("content_language_code").alias("o_language"),
                          F.col("approved_at").alias("o_approved_at"))
    rows = candidates.join(old, KEY, "left").withColumn(
        "content_fingerprint", content_fingerprint()).withColumn(
        "content_language_code", F.lit("en")).withColumn("violation", bullet_violation())
    same = F.col("o_fingerprint").eqNullSafe(F.col("content_fingerprint")) \
        & F.col("o_language").eqNullSafe(F.col("content_language_code")) \
        & F.col("o_approved_at").eqNullSafe(F.col("approved_at"))
    for c in FIVE:
        same = same & F.col("o_" + c).eqNullSafe(F.col(c))
    change = (F.when(F.col("o_exists") & (F.col("upstream_at") <= F.col("o_upstream")), "skip")
              .when(F.col("violation").isNotNull(), "reject")
              .when(F.col("o_exists").isNull(), "insert")
              .when(same, "touch").otherwise("update"))
    metadata = F.to_json(F.struct(F.lit("curate").alias("source_module"),
                                  F.lit("AI").alias("writer_type"),
                                  R.iso("upstream_at").alias("upstream_updated_at")))
    return rows.select(KEY, "downstream_action", change.alias("change"), "violation", *fields,
                       "content_fingerprint", "content_language_code", "approved_at",
                       metadata.alias("author_metadata"))


def change_counts(changes: DataFrame) -> DataFrame:
    """Scanned, inserted, updated, skipped (touched included) and rejected candidates."""
    c = F.col("change")
    return changes.agg(F.count(F.lit(1)).alias("scanned"), R.tally(c == "insert").alias("inserted"),
                       R.tally(c == "update").alias("updated"),
                       R.tally(c.isin("skip", "touch")).alias("skipped"),
                       R.tally(c == "reject").alias("rejected"))


def apply_approved(approved: DataFrame, changes: DataFrame, first_id: int, now) -> DataFrame:
    """The complete approved table; new records get the next ids in item order."""
    from pressline.operators.buckets import sequence_ids
    moment = R.at(now)
    new = sequence_ids(changes.filter("change = 'insert'"), [KEY], "parent_content_id", first_id)
    if "created_at" in approved.columns:
        new = new.withColumn("created_at", moment).withColumn("updated_at", moment)
    moved = changes.filter("change IN ('update', 'touch')").select(
        KEY, "change", *[F.col(c).alias("n_" + c) for c in (
            *FIVE, "content_fingerprint", "content_language_code", "approved_at",
            "author_metadata")])
    table = approved.join(moved, KEY, "left")
    for c in (*FIVE, "content_fingerprint", "content_language_code", "approved_at"):
        table = table.withColumn(c, F.when(F.col("change") == "update", F.col("n_" + c))
                                 .otherwise(F.col(c)))
    table = table.withColumn("author_metadata", F.coalesce("n_author_metadata", "author_metadata"))
    if "updated_at" in approved.columns:
        table = table.withColumn("updated_at", F.when(F.col("change").isNotNull(), moment)
                                 .otherwise(F.col("updated_at")))
    return table.select(*approved.columns).unionByName(new.select(*approved.columns))
