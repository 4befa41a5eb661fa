"""Unique slugs for a batch of new items against frozen slugs.

The rule is sequential: in id order each item takes its base slug, or the first free ``base-2``,
``base-3``, ... Here a base is a line of numbered slots. The i-th item of a base takes the i-th
slot that is not blocked, so ranks give all slots at once. Slots are blocked by frozen slugs and by
items of a related base: the base ``a-3`` and slot 3 of base ``a`` are the same slug. Who gets such
a shared slug follows from counts, parent before child, folded stretch by stretch, so the result
equals the sequential rule exactly and no base, however popular, is walked item by item or held in
one task.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pressline.functions.titles import slugify
from pressline.operators.buckets import lookup, row_rank, running_sum
from pressline.session import cut_lineage, cut_round

_NUMBERED = "^(.+)-([1-9][0-9]{0,17})$"


def _numbered(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is a numbered slot: adds ``parent`` and ``slot`` (two or more)."""
    return (df.filter(F.col(column).rlike(_NUMBERED))
            .withColumn("parent", F.regexp_extract(column, _NUMBERED, 1))
            .withColumn("slot", F.regexp_extract(column, _NUMBERED, 2).cast("long"))
            .filter("slot >= 2"))


def _runs(slots: DataFrame) -> DataFrame:
    """Blocked slots folded into runs: ``free`` slots lie before a run of ``n`` from ``first``."""
    ranked = row_rank(slots, ["base"], "slot", "_rank")
    return (ranked.groupBy("base", (F.col("slot") - F.col("_rank")).alias("free"))
            .agg(F.min("slot").alias("first"), F.count(F.lit(1)).alias("n")))


STRETCH = 8192
"""Claims of one base that are folded in one task."""


def _thresholds(limits: list[int]) -> list[int]:
    """The claims of a stretch as one function: of ``b`` claims won before it, the stretch makes
    ``b`` plus the number of thresholds that are ``b`` or more.

    A claim with limit ``c`` is won if at most ``c`` claims below it are won. Such steps never turn
    the order of two starting points around, so the starting points from which a claim is won are all
    those up to one threshold, which binary search finds among the thresholds so far.
    """
    found: list[int] = []
    for c in limits:
        low, high = -1, c + 1
        # The largest x with x + |{t >= x}| <= c, or -1.
        while high - low > 1:
            x = (low + high) // 2
            if x + len(found) - bisect_left(found, x) <= c:
                low = x
            else:
                high = x
        if low >= 0:
            insort(found, low)
    return found


def _folded(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row per stretch: thresholds that count from any possible start, and those that may not."""
    rows = pdf.sort_values("rank")
    least, most = int(rows["sure_before"].iloc[0]), int(rows["rank"].iloc[0]) - 1
    found = _thresholds(rows["limit"].tolist())
    return pd.DataFrame({"base": [rows["base"].iloc[0]], "stretch": [rows["stretch"].iloc[0]],
                         "sure": [sum(t >= most for t in found)],
                         "open": [[t for t in found if least <= t < most]]})


def _resolved(pdf: pd.DataFrame) -> pd.DataFrame:
    """Every claim of a stretch, once the number of claims won below the stretch is known."""
    rows = pdf.sort_values("rank")
    won, out = int(rows["start"].iloc[0]), []
    for limit in rows["limit"].tolist():
        out.append(won <= limit)
        won += out[-1]
    return pd.DataFrame({"base": rows["base"], "slot": rows["slot"], "child": rows["child"],
                         "child_wins": out})


def won_claims(runs: DataFrame, claims: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(base, slot, child, child_wins) of every claim (base, slot, child, before).

    A child gets its slot if the items of its parent that came before it fit into the free slots below:
    ``before`` plus the claims won below is at most the slots below less the blocked ones (``runs``:
    base, first, n). So each claim maps the number of claims won below it to the number including it.
    The claims of a base are cut into stretches by slot; every stretch is folded into one such map, the
    maps are applied one after the other, and then every stretch is resolved from its own start. A map
    keeps only thresholds between the fewest and the most claims that can be won below it, which are
    the claims that really compete; a claim that any number of others leaves room for is never one.
    """
    events = runs.select("base", F.col("first").alias("at"), F.col("n").alias("blocked"),
                         F.lit(None).cast("string").alias("child"), F.lit(0).cast("long").alias("before")).unionByName(
        claims.select("base", F.col("slot").alias("at"), F.lit(0).cast("long").alias("blocked"), "child", "before"))
    # Each running sum reads its input more than once, so inputs are stored first.
    below = running_sum(cut_lineage(events), ["base"], "at", "blocked", "_blocked").filter(F.col("child").isNotNull())
    limited = below.select("base", F.col("at").alias("slot"), "child",
                           (F.col("at") - 1 - F.col("_blocked") - F.col("before")).alias("limit"))
    ranked = cut_lineage(row_rank(cut_lineage(limited), ["base"], "slot", "rank"))
    ranked = ranked.withColumn("_sure", (F.col("limit") >= F.col("rank") - 1).cast("long"))
    ranked = running_sum(ranked, ["base"], "rank", "_sure", "sure_before", strict=True).withColumn(
        "stretch", F.floor((F.col("rank") - 1) / stretch)).drop("_sure")
    ranked = cut_lineage(ranked)
    maps = ranked.groupBy("base", "stretch").applyInPandas(
        _folded, "base string, stretch long, sure long, open array<long>")
    # A base has one row per stretch here, with its open thresholds alone.
    start = F.aggregate(
        F.array_sort(F.collect_list(F.struct("stretch", "sure", "open"))),
        F.struct(F.lit(0).cast("long").alias("won"), F.array().cast("array<struct<stretch: long, start: long>>").alias("starts")),
        lambda so, m: F.struct(
            (so["won"] + m["sure"] + F.size(F.filter(m["open"], lambda t: t >= so["won"]))).alias("won"),
            F.array_append(so["starts"], F.struct(m["stretch"].alias("stretch"), so["won"].alias("start"))).alias("starts")),
        lambda so: so["starts"])
    starts = maps.groupBy("base").agg(start.alias("_s")).select("base", F.inline("_s"))
    return ranked.join(starts, ["base", "stretch"]).groupBy("base", "stretch").applyInPandas(
        _resolved, "base string, slot long, child string, child_wins boolean")


def _shared_slots(items: DataFrame, bases: DataFrame, frozen: DataFrame) -> DataFrame:
    """Extra blocked (base, slot) rows caused by related new bases."""
    # A parent is looked up among the distinct bases, one row each.
    children = (_numbered(bases, "base").select(F.col("base").alias("child"), "parent", "slot",
                                                F.col("first_id").alias("since"))
                .join(bases.select(F.col("base").alias("parent")), "parent", "left_semi")
                .join(frozen.select(F.col("slug").alias("child")), "child", "left_anti"))
    children = cut_lineage(children)
    empty = bases.select("base", F.lit(1).cast("long").alias("slot")).filter("false")
    if children.isEmpty():
        return empty
    parents = children.select(F.col("parent").alias("base"), F.lit(True).alias("_p")).distinct()
    events = lookup(items.select("base", "id"), parents, "base", "inner").select(
        "base", F.col("id").alias("pos"), F.lit(1).alias("one"),
        F.lit(None).cast("string").alias("child")).unionByName(
        children.select(F.col("parent").alias("base"), F.col("since").alias("pos"),
                        F.lit(0).alias("one"), "child"))
    before = (running_sum(events, ["base"], "pos", "one", "before")
              .filter(F.col("child").isNotNull()).select("child", "before"))
    children = cut_lineage(children.join(before, "child"))
    blocked = frozen_slots(frozen, parents.drop("_p"))
    extra = empty
    level = children.join(children.select(F.col("child").alias("parent")), "parent", "left_anti")
    while not level.isEmpty():
        here = level.select(F.col("parent").alias("base")).distinct()
        slots = blocked.unionByName(extra.select("base", "slot")).join(here, "base", "left_semi")
        claims = level.select(F.col("parent").alias("base"), "slot", "child",
                              F.col("before").cast("long").alias("before"))
        wins = won_claims(_runs(slots.distinct()), claims)
        extra = cut_round(extra.unionByName(wins.select(
            F.when(F.col("child_wins"), F.col("base")).otherwise(F.col("child")).alias("base"),
            F.when(F.col("child_wins"), F.col("slot")).otherwise(F.lit(1)).alias("slot"))))
        level = cut_round(children.join(level.select(F.col("child").alias("parent")), "parent",
                                        "left_semi"))
    return extra


def frozen_slots(frozen: DataFrame, bases: DataFrame) -> DataFrame:
    """(base, slot) of every frozen slug that is a slot of one of the bases."""
    own = frozen.select(F.col("slug").alias("base"), F.lit(1).cast("long").alias("slot"))
    numbered = _numbered(frozen, "slug").select(F.col("parent").alias("base"), "slot")
    mark = bases.select("base", F.lit(True).alias("_b")).distinct()
    return lookup(own.unionByName(numbered), mark, "base", "inner").select("base", "slot")


def assign_slugs(new: DataFrame, frozen: DataFrame, item: str, title: str) -> DataFrame:
    """(item, slug) for new items; ``item`` is a unique long that also gives the order."""
    items = cut_lineage(new.select(F.col(item).alias("id"), slugify(
        F.coalesce(F.col(title), F.lit(""))).alias("base")))
    bases = cut_lineage(items.groupBy("base").agg(F.min("id").alias("first_id")))
    slots = frozen_slots(frozen, bases).unionByName(
        _shared_slots(items, bases, frozen).select("base", "slot")).distinct()
    runs = _runs(cut_lineage(slots))
    ranked = row_rank(items, ["base"], "id", "rank")
    events = ranked.select("base", "id", F.col("rank").alias("pos"), F.lit(0).alias("shift"),
                           F.lit(0).alias("_t")).unionByName(
        runs.select("base", F.lit(None).cast("long").alias("id"), F.col("free").alias("pos"),
                    F.col("n").cast("int").alias("shift"), F.lit(1).alias("_t")))
    placed = running_sum(events, ["base"], "pos", "shift", "moved", tie=["_t"]).filter(
        F.col("id").isNotNull())
    slot = F.col("pos") + F.col("moved")
    return placed.select(F.col("id").alias(item), F.when(slot == 1, F.col("base")).otherwise(
        F.concat_ws("-", "base", slot.cast("string"))).alias("slug"))
