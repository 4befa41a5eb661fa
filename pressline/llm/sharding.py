"""Shard placement by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size, made from two
hashes of its name. The shards take turns, and each claims the first slot of its order that is still
free, until the table is full. So all shards own equally many slots (give or take one), and when a
shard leaves, few slots of the others change hands. Placing a key is one hash and one look into the
table, which has a fixed size and is broadcast.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def filled_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """Slot -> index of its shard. The table is settings, not data: its size is fixed."""
    if not is_prime(slots) or not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("the table size must be a prime, not below the number of distinct shards")
    start = [int(md5(f"start {s}".encode()).hexdigest(), 16) % slots for s in shards]
    step = [int(md5(f"step {s}".encode()).hexdigest(), 16) % (slots - 1) + 1 for s in shards]
    table, left, turn = [-1] * slots, slots, 0
    while left:
        while table[start[turn]] >= 0:
            start[turn] = (start[turn] + step[turn]) % slots
        table[start[turn]] = turn
        left -= 1
        turn = (turn + 1) % len(shards)
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of its MD5, modulo the table size. Null goes with the empty key."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def lookup_table(spark: SparkSession, shards: tuple[str, ...] = SHARDS,
                 slots: int = SLOTS) -> DataFrame:
    """(slot, shard) as rows: the filled table is one literal, opened by its position."""
    listed = ",".join(map(str, filled_table(shards, slots)))
    names = F.array(*[F.lit(s) for s in shards])
    owner = F.get(F.split(F.lit(listed), ","), F.col("id").cast("int")).cast("int")
    return spark.range(slots).select(F.col("id").cast("int").alias("slot"),
                                     F.get(names, owner).alias("shard"))


def place(rows: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS,
          slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``rows`` with the columns ``slot`` and ``shard``.

    Rows never move: the table of ``slots`` rows is broadcast, whatever the size of ``rows``. Rows
    with equal keys, nulls among them, share a shard; columns of the same names are replaced.
    """
    table = F.broadcast(lookup_table(rows.sparkSession, shards, slots)
                        .toDF("_place_slot", "_place_shard"))
    placed = rows.drop(slot, shard).withColumn("_place_at", slot_of(F.col(key), slots))
    return (placed.join(table, F.col("_place_at") == F.col("_place_slot"))
            .withColumn(slot, F.col("_place_at")).withColumn(shard, F.col("_place_shard"))
            .drop("_place_at", "_place_slot", "_place_shard"))


def write_shards(rows: DataFrame, key: str, path: str, shards: tuple[str, ...] = SHARDS,
                 files: int = 1) -> None:
    """One folder per shard, each in ``files`` parts; rows of one key may share a part only."""
    placed = place(rows, key, shards)
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(files))
    (placed.repartition(len(shards) * files, "shard", part)
     .write.partitionBy("shard").mode("overwrite").parquet(path))


def shard_report(placed: DataFrame) -> DataFrame:
    """Rows and distinct slots per shard."""
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count_distinct("slot").alias("n_slots"))
