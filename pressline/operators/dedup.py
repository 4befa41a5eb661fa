"""First-wins dedup on any of several keys, latest-row rules and near-duplicate grouping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressline.functions import rates as R
from pressline.operators.buckets import lookup, sequence_ids
from pressline.session import cut_lineage, cut_round

K1, K2 = "ingest_dedup_key", "title_key"


def has_required_fields() -> Column:
    """A title and a key are present."""
    return (F.coalesce(F.length("title"), F.lit(0)) > 0) & (
        F.coalesce(F.length(K1), F.lit(0)) > 0)


def required_fields(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a title and a key, and the rows that lack one."""
    return rows.filter(has_required_fields()), rows.filter(~has_required_fields())


def known_keys(rows: DataFrame, markers: DataFrame) -> DataFrame:
    """Keys of the rows that are already owned by a stored item."""
    keys = rows.select(F.explode(F.array_compact(F.array(K1, K2))).alias("dedup_key")).distinct()
    return keys.join(markers.select("dedup_key"), "dedup_key", "left_semi")


SALTS = 64


def _hot(rows: DataFrame, key: str, parts: int = 1000) -> DataFrame:
    """Keys with more than 1/``parts`` of the rows: fewer than ``parts`` keys, whatever the data."""
    freq = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = freq.agg((F.sum("_n") / parts).alias("_cut"))
    return (freq.crossJoin(F.broadcast(total)).filter(F.col("_n") > F.greatest("_cut", F.lit(1)))
            .select(key, F.lit(True).alias("_hot")))


def _salted(rows: DataFrame, key: str, salt: str) -> DataFrame:
    """Spread the rows of hot keys over several salts; all other rows have salt 0."""
    spread = F.pmod(F.xxhash64("_o"), F.lit(SALTS)).cast("int")
    return (rows.join(F.broadcast(_hot(rows, key)), key, "left")
            .withColumn(salt, F.when(F.col("_hot"), spread).otherwise(F.lit(-1))).drop("_hot"))


def _without(rows: DataFrame, key: str, salt: str, owners: DataFrame) -> DataFrame:
    """Rows whose key no owner holds. A hot key's owner is repeated once per salt."""
    every = F.when(F.col(salt) < 0, F.array(F.lit(-1))).otherwise(
        F.sequence(F.lit(0), F.lit(SALTS - 1)))
    keys = owners.filter(F.col(key).isNotNull()).select(key, F.explode(every).alias(salt))
    return rows.join(keys, [key, salt], "left_anti")


SETTLED_ROWS = 1 << 17
"""Rows that are settled in one task: what is left of the key graph, never more than this."""


def _settled(left: DataFrame) -> DataFrame:
    """The rows of a piece of at most SETTLED_ROWS rows that pass, by the sequential rule itself."""
    import pyarrow as pa

    def run(batches):
        owned: set = set()
        for batch in batches:
            kept = []
            for keys in zip(batch.column(K1).to_pylist(), batch.column(K2).to_pylist()):
                free = not any(k in owned for k in keys if k is not None)
                if free:
                    owned.update(k for k in keys if k is not None)
                kept.append(free)
            yield batch.filter(pa.array(kept, pa.bool_()))

    piece = left.select("_o", K1, K2).repartition(1).sortWithinPartitions("_o")
    return piece.mapInArrow(run, piece.schema)


def _two_first(left: DataFrame, key: str, place: str, before: str) -> DataFrame:
    """The first two rows of each key: ``place`` is 1 or 2, ``before`` the row in front of the second.

    The rank limit is applied before the shuffle, so a hot key sends two rows per task.
    """
    w = W.partitionBy(key).orderBy("_o")
    return (left.filter(F.col(key).isNotNull()).select(key, "_o")
            .withColumn(place, F.row_number().over(w)).filter(F.col(place) <= 2)
            .withColumn(before, F.lag("_o").over(w)).drop(key))


def _decided(left: DataFrame) -> DataFrame:
    """Rows of ``left`` that surely pass: those that come first under all their keys, and those whose
    chain of blockers ends at such a row after an even number of steps.

    A row that is second under one key and first under the other passes if and only if the row in
    front of it does not. Such rows form chains, and pointer jumping halves what is left of every chain
    in each step. A row with two blockers, or further behind, ends a chain undecided.
    """
    titled = left.join(_two_first(left, K2, "_n2", "_p2"), "_o", "left")
    near = titled.join(_two_first(left, K1, "_n1", "_p1"), "_o").withColumn(
        "_n2", F.when(F.col(K2).isNull(), 1).otherwise(F.col("_n2")))
    known = cut_lineage(near.filter("_n1 + _n2 <= 3").select(
        "_o", K1, K2, "_s1", "_s2", F.coalesce("_p1", "_p2", "_o").alias("_up")))
    free = F.col("_up") == F.col("_o")
    chain = known.select("_o", "_up", (~free).alias("_odd"), free.alias("_free"))
    while True:
        above = chain.select(F.col("_o").alias("_up"), F.col("_up").alias("_top"),
                             F.col("_odd").alias("_more"), F.col("_free").alias("_end"))
        joined = chain.filter("NOT _free").join(above, "_up", "left").select(
            "_o", F.coalesce("_top", "_up").alias("_up"),
            F.coalesce(F.col("_odd") != F.col("_more"), F.col("_odd")).alias("_odd"),
            F.coalesce("_end", F.lit(False)).alias("_free"),
            F.coalesce(F.col("_top") != F.col("_up"), F.lit(False)).alias("_moved"))
        chain = cut_lineage(joined.unionByName(
            chain.filter("_free").withColumn("_moved", F.lit(False))))
        moved = chain.filter("_moved AND NOT _free").isEmpty()
        chain = chain.drop("_moved")
        if moved:
            break
    return known.join(chain.filter("_free AND NOT _odd").select("_o"), "_o", "left_semi").drop("_up")


def first_places(rows: DataFrame, order: list[str], markers: DataFrame | None = None,
                 settled: int = SETTLED_ROWS) -> DataFrame:
    """Places (the ``order`` columns) of the rows that pass: in ``order``, which must be unique, a
    row passes if none of its keys is owned by a row that passed.

    Only keys and order take part. Rows with the same two keys are reduced to their first one
    before any shuffle by a single key. In each round the rows that come first under all their keys
    pass, and with them every row whose chain of blockers leads to one of them by an even number of
    steps; everything sharing a key with them drops out, and the rest goes on. A chain of any length
    is decided in one round of logarithmically many steps, and the first undecided row always passes,
    so the rounds end. Once at most ``settled`` rows are left, one task takes them in order.
    """
    left = cut_lineage(rows.groupBy(K1, K2).agg(F.min(F.struct(*order)).alias("_o")))
    count = left.count()
    if count > settled:
        left = cut_lineage(_salted(_salted(left, K1, "_s1"), K2, "_s2"))
    else:
        left = left.withColumns({"_s1": F.lit(-1), "_s2": F.lit(-1)})
    if markers is not None:
        for key, salt in ((K1, "_s1"), (K2, "_s2")):
            mine = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(salt).alias(salt))
            owned = mine.join(markers.select(F.col("dedup_key").alias(key)), key, "left_semi")
            left = _without(left, key, salt, owned)
        left = cut_lineage(left) if count > settled else left
    passed: list[DataFrame] = []
    while count > settled:
        first = cut_lineage(_decided(left))
        passed.append(first.select("_o"))
        left = cut_lineage(_without(_without(left, K1, "_s1", first), K2, "_s2", first))
        count = left.count()
    return reduce(DataFrame.unionByName, [*passed, _settled(left).select("_o")]).select("_o.*")


def accept_first(rows: DataFrame, order: list[str], markers: DataFrame | None = None,
                 settled: int = SETTLED_ROWS) -> DataFrame:
    """Add ``accepted`` by the first-wins rule; rows without title are never accepted.

    The key rule always yields a key, and a filter on it would compute every key twice.
    """
    won = first_places(rows.filter(F.length("title") > 0), order, markers, settled)
    return (rows.join(won.withColumn("_won", F.lit(True)), order, "left")
            .withColumn("accepted", F.coalesce("_won", F.lit(False))).drop("_won"))


def single_key_first(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row per key; the rank limit is applied before the shuffle."""
    w = W.partitionBy(key).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def latest_rows(rows: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """The newest row per key, which is what every upsert leaves behind."""
    w = W.partitionBy(*keys).orderBy(*newest)
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def archive_over_live(archive: DataFrame, live: DataFrame, key: str = "canonical_url") -> DataFrame:
    """Both collections with the archived version winning on equal keys; rows without key stay."""
    both = archive.withColumn("origin", F.lit("archive")).unionByName(
        live.withColumn("origin", F.lit("live")))
    kept = latest_rows(both.filter(F.col(key).isNotNull()), [key],
                       [F.col("origin"), F.col("published_at").desc_nulls_last(), F.col("slug")])
    return kept.unionByName(both.filter(F.col(key).isNull()))


def unique_contribution(rows: DataFrame, approved_ids: DataFrame, item: str) -> DataFrame:
    """Per source: accepted and approved items over all ingested ones."""
    ok = approved_ids.select(item, F.lit(True).alias("_ok"))
    good = F.col("accepted") & F.coalesce("_ok", F.lit(False))
    return (rows.select("source_id", "accepted", item).join(ok, item, "left")
            .groupBy("source_id").agg(
                F.count(F.lit(1)).alias("ingested"), R.tally(good).alias("unique_approved"),
                R.share(good, F.lit(1)).alias("unique_contribution_rate")))


# --- state tables of accepted items ---------------------------------------------------------------

def number_places(places: DataFrame, order: list[str], last_id: int) -> DataFrame:
    """Item ids for the passed places, in order. Only the order columns are moved around."""
    return sequence_ids(places, order, "source_item_id", last_id)


def item_tables(numbered: DataFrame, retention_days: int) -> dict[str, DataFrame]:
    """The four tables an accepted item writes to, each one projection of the numbered rows."""
    from pressline.functions.keys import markers
    from pressline.functions.times import expires_at
    item = numbered.select(
        "source_item_id", "source_id", F.col("guid").alias("source_item_guid"), "canonical_url",
        "title", "published_at", "fetched_at", K1, "dedup_rule")
    text = numbered.select(
        "source_item_id", "sanitized_text", "sanitization_method", "html_detected",
        "was_truncated", "text_processing_status", "text_processing_reason", "raw_text_length",
        "sanitized_text_length", "reduction_ratio")
    marker = (markers(numbered).select(F.explode("markers").alias("m"), "source_item_id",
                                       F.col("fetched_at").alias("created_at"))
              .select("m.dedup_key", "m.dedup_rule", "source_item_id", "created_at"))
    out = {"source_item": item, "source_item_text": text, "ingest_dedup_marker": marker}
    if retention_days > 0:
        out["source_item_raw"] = numbered.select(
            "source_item_id", F.coalesce("body", F.lit("")).alias("raw_payload"),
            F.lit("default").alias("retention_class"),
            expires_at(F.col("fetched_at"), retention_days).alias("expires_at"),
            F.col("fetched_at").alias("created_at"))
    return out


# --- near duplicates --------------------------------------------------------------------------------

PRIME = (1 << 31) - 1


def permutations(hashes: int) -> list[tuple[int, int]]:
    """(factor, shift) of each permutation modulo PRIME, by a linear congruential rule."""
    out, x = [], 1
    for _ in range(hashes):
        a = x = (x * 1_103_515_245 + 12_345) % PRIME
        x = (x * 1_103_515_245 + 12_345) % PRIME
        out.append((a or 1, x))
    return out


def signatures(rows: DataFrame, text: str, hashes: int = 32, words: int = 3) -> DataFrame:
    """Min-hash signature over all word runs of the whole text.

    A run is hashed by the start of its MD5, which every engine has, and permuted modulo PRIME.
    """
    token = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    rows = rows.withColumn("_t", token)
    size = F.greatest(F.size("_t") - (words - 1), F.lit(1))
    grams = F.transform(F.sequence(F.lit(1), size), lambda i: F.conv(F.substring(F.md5(
        F.array_join(F.slice("_t", i, words), " ")), 1, 8), 16, 10).cast("long") % PRIME)
    rows = rows.withColumn("_g", F.array_distinct(grams))
    def least(a: int, c: int) -> Column:
        return F.array_min(F.transform("_g", lambda g: (g * a + c) % PRIME))
    mins = [least(a, c) for a, c in permutations(hashes)]
    return rows.withColumn("signature", F.array(*mins)).drop("_t", "_g")


def band_keys(rows: DataFrame, bucket: str, bands: int, hashes: int = 32) -> DataFrame:
    """One row per (row, band): rows with an equal band key inside a time bucket are near copies."""
    width = hashes // bands
    keys = F.array(*[F.xxhash64(F.lit(b), F.col(bucket), F.slice("signature", b * width + 1, width))
                     for b in range(bands)])
    return rows.withColumn("band", F.explode(keys))


def near_groups(rows: DataFrame, item: str, text: str, moment: str, bucket_hours: int = 24,
                bands: int = 8, hashes: int = 32) -> DataFrame:
    """(item, group_id): items linked by shared bands inside a time bucket, group = smallest id.

    Equal signatures collapse to one row first, so copies cost nothing later. Links only run
    between a band and its members, never between all pairs, and labels sink to the smallest id
    until nothing changes. Only bands with two signatures or more link anything, so the rounds see
    no others; each step of a round is stored, and no table of rows is broadcast.
    """
    base = signatures(rows.select(item, text, moment), text, hashes).select(
        item, "signature",
        F.floor(F.unix_seconds(moment) / F.lit(bucket_hours * 3600)).alias("_b"))
    base = cut_lineage(base)
    heads = cut_lineage(base.groupBy("_b", "signature").agg(F.min(item).alias("head")))
    members = cut_lineage(band_keys(heads, "_b", bands, hashes).select("head", "band"))
    shared = members.groupBy("band").agg(F.min("head").alias("_low"), F.max("head").alias("_high")).filter(
        "_low <> _high").select("band")
    edges = cut_round(members.join(shared.hint("merge"), "band", "left_semi"))
    labels = cut_round(edges.select("head").distinct().withColumn("group_id", F.col("head")))
    while True:
        held = cut_round(edges.join(labels.hint("merge"), "head"))
        low = held.groupBy("band").agg(F.min("group_id").alias("_low"))
        sunk = cut_round(lookup(held, low, "band").groupBy("head")
                           .agg(F.min(F.least("group_id", "_low")).alias("group_id")))
        # One more hop through the label's own label shortens long chains.
        hop = sunk.select(F.col("head").alias("group_id"), F.col("group_id").alias("_up"))
        fresh = cut_round(lookup(sunk, hop, "group_id").select("head", F.least(
            "group_id", F.coalesce("_up", F.col("group_id"))).alias("group_id")))
        moved = fresh.join(labels.withColumnRenamed("group_id", "_was").hint("merge"), "head").filter(
            "group_id <> _was")
        labels = fresh
        if moved.isEmpty():
            break
    named = heads.join(labels.hint("merge"), "head", "left").withColumn(
        "group_id", F.coalesce("group_id", "head"))
    on = [base["_b"].eqNullSafe(named["_b"]), base["signature"].eqNullSafe(named["signature"])]
    return base.join(named.hint("merge"), on).select(base[item], "group_id")


def preferred(groups: DataFrame, tiers: DataFrame, item: str) -> DataFrame:
    """Best item per group: lowest tier number, then smallest id, with the number of alternatives."""
    rows = groups.join(tiers.select(item, "tier"), item)
    return rows.groupBy("group_id").agg(
        F.min_by(item, F.struct("tier", item)).alias("primary_item"),
        F.min("tier").alias("tier"), (F.count(F.lit(1)) - 1).alias("alternatives"))
