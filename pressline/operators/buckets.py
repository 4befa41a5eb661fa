"""Ranks, running sums, exact percentiles and dense ids that never pull one group into one task.

A plain window over a key sorts the whole key in one task. Here the ordering column is cut into
fixed-width buckets first: rows meet only inside (key, bucket), the per-bucket totals are small,
and their running total gives every bucket its offset. All results are exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressline.session import cut_lineage


def running_sum(df: DataFrame, keys: list[str], position: str, value: str, out: str,
                width: int = 1 << 16, tie: list[str | Column] | None = None,
                strict: bool = False, levels: int = 2) -> DataFrame:
    """Running sum of ``value`` per key in the order of the long ``position`` (then ``tie``).

    ``strict`` leaves the row itself out. Work per task is bounded by the rows that share one
    stretch of ``width`` positions, not by the size of the key; the stretch totals are summed the
    same way once more, so sparse positions do not pile up either.
    """
    if levels == 0:
        whole = W.partitionBy(*keys).orderBy(position, *(tie or [])).rowsBetween(
            W.unboundedPreceding, -1 if strict else 0)
        return df.withColumn(out, F.coalesce(F.sum(value).over(whole), F.lit(0)))
    b = "_bucket" + str(levels)
    rows = df.withColumn(b, F.floor(F.col(position) / F.lit(width)))
    inner = W.partitionBy(*keys, b).orderBy(position, *(tie or []))
    span = inner.rowsBetween(W.unboundedPreceding, -1 if strict else 0)
    rows = rows.withColumn("_within", F.coalesce(F.sum(value).over(span), F.lit(0)))
    totals = (df.withColumn(b, F.floor(F.col(position) / F.lit(width)))
              .groupBy(*keys, b).agg(F.sum(value).alias("_total")))
    offsets = running_sum(totals, keys, b, "_total", "_before", width, None, True,
                          levels - 1).drop("_total")
    cond = [rows[k].eqNullSafe(offsets[k]) for k in [*keys, b]]
    joined = rows.join(offsets, reduce(lambda x, y: x & y, cond), "left")
    kept = [rows[c] for c in df.columns]
    return joined.select(*kept, (F.col("_within") + F.col("_before")).alias(out))


def row_rank(df: DataFrame, keys: list[str], position: str, out: str,
             width: int = 1 << 16) -> DataFrame:
    """``row_number`` per key ordered by a unique long column."""
    one = df.withColumn("_one", F.lit(1))
    return running_sum(one, keys, position, "_one", out, width).drop("_one")


def percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                average: str | None = "average", width: int = 4096) -> DataFrame:
    """Exact linear-interpolation percentiles of a whole-number column.

    Equal values are counted first, so a hot key shrinks to its distinct values before any order
    matters; only the value stretches that hold a wanted rank are looked at closely.
    """
    hist = (df.filter(F.col(value).isNotNull()).withColumn("_v", F.col(value).cast("long"))
            .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")))
    coarse = (hist.withColumn("_b", F.floor(F.col("_v") / F.lit(width)))
              .groupBy(*keys, "_b").agg(F.sum("_n").alias("_bn"),
                                        F.sum(F.col("_v") * F.col("_n")).alias("_bs")))
    order = W.partitionBy(*keys).orderBy("_b")
    coarse = (coarse
              .withColumn("_lo", F.coalesce(F.sum("_bn").over(
                  order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_all", F.sum("_bn").over(W.partitionBy(*keys)))
              .withColumn("_sum", F.sum("_bs").over(W.partitionBy(*keys))))
    ranks = []
    for p in probs.values():
        target = F.lit(p) * (F.col("_all") - 1)
        ranks += [F.floor(target), F.ceil(target)]
    coarse = coarse.withColumn("_ranks", F.array_distinct(F.array(*ranks)))
    touched = coarse.filter(F.exists("_ranks", lambda r: (r >= F.col("_lo"))
                                     & (r < F.col("_lo") + F.col("_bn"))))
    h = hist.withColumn("_b", F.floor(F.col("_v") / F.lit(width)))
    on = reduce(lambda x, y: x & y, [h[k].eqNullSafe(touched[k]) for k in [*keys, "_b"]])
    near = (h.join(touched, on, "inner")
            .select(*[h[k] for k in keys], h["_b"], "_v", "_n", "_lo", "_all", "_sum", "_ranks"))
    step = W.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    near = near.withColumn("_hi", F.sum("_n").over(step) + F.col("_lo"))
    at_rank = (near.withColumn("_r", F.explode("_ranks"))
               .filter((F.col("_r") < F.col("_hi")) & (F.col("_r") >= F.col("_hi") - F.col("_n"))))
    aggs = []
    for name, p in probs.items():
        target = F.lit(p) * (F.col("_all") - 1)
        low = F.max(F.when(F.col("_r") == F.floor(target), F.col("_v")))
        high = F.max(F.when(F.col("_r") == F.ceil(target), F.col("_v")))
        part = F.max(target - F.floor(target))
        aggs.append((low * (1 - part) + high * part).cast("double").alias(name))
    if average:
        aggs.insert(0, (F.max("_sum") / F.max("_all")).cast("double").alias(average))
    if keys:
        return at_rank.groupBy(*keys).agg(*aggs)
    return at_rank.agg(*aggs)


def sequence_ids(df: DataFrame, order: list[str], out: str, start: int | Column = 0) -> DataFrame:
    """Dense ids ``start + 1, ...`` in a total order.

    Rows are range-partitioned and stored (the partition bounds come from sampling, so they must
    not be drawn twice); one count per partition then gives the offsets.
    """
    placed = cut_lineage(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()))
    inner = W.partitionBy("_pid").orderBy(*order)
    # One row per partition: its number is the partition count, never the data.
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    ranked = placed.withColumn("_rn", F.row_number().over(inner))
    start = start if isinstance(start, Column) else F.lit(start)
    return (ranked.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (start + F.col("_off") + F.col("_rn")).cast("long"))
            .drop("_pid", "_rn", "_off"))


def lookup(rows: DataFrame, keyed: DataFrame, key: str, how: str = "left",
           hot_parts: int = 1000) -> DataFrame:
    """Join rows to a table with one row per ``key`` when a few keys may hold most rows.

    Keys with more than 1/``hot_parts`` of all rows number fewer than ``hot_parts``, whatever the
    data, so their entries are broadcast; all other keys meet in a shuffled join, also when their
    table is small enough for Spark to send it through the driver.
    """
    freq = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = freq.agg((F.sum("_n") / hot_parts).alias("_cut"))
    hot = (freq.crossJoin(F.broadcast(total)).filter(F.col("_n") > F.greatest("_cut", F.lit(1)))
           .select(key, F.lit(True).alias("_hot")))
    marked = rows.join(F.broadcast(hot), key, "left")
    table = keyed.join(F.broadcast(hot), key, "left")
    warm = (marked.filter("_hot").drop("_hot")
            .join(F.broadcast(table.filter("_hot").drop("_hot")), key, how))
    cold = (marked.filter("_hot IS NULL").drop("_hot")
            .join(table.filter("_hot IS NULL").drop("_hot").hint("merge"), key, how))
    return warm.unionByName(cold)
