"""Exact duplicates through a minimal perfect hash over the distinct digests of the history.

The history is grouped by digest first. Its distinct digests are dealt into buckets by their leading
bits, and every bucket gets a minimal perfect hash: levels of bit arrays in which a digest owns the
first bit that it alone maps to, so that the rank of the bit is its slot. A slot holds the whole
digest and the locator of the winner. A lookup computes one slot, compares all 32 bytes there, and so
never takes a stranger for a member; what is no member is grouped on its own.

Copies are summed up per digest before anything is shuffled by digest, so a text that fills a third
of the table is one row per task when it reaches its bucket.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pressline.llm.hashing import mix
from pressline.llm.storage import judged_rows, keyed_rows, rows_with, stored

BUCKET_DIGESTS = 50_000
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column | str) -> Column:
    """A-Z in lower case, nothing else changed; null is the empty text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), UPPER, SMALL)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): the SHA-256 of every normalised text."""
    return docs.select("doc_id", F.unhex(F.sha2(normalised("text"), 256)).alias("digest"))


def grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: the largest doc_id (the winner) and the number of rows."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("n"))


def _level_hash(words: np.ndarray, level: int) -> np.ndarray:
    """A hash of all 32 digest bytes that differs from level to level."""
    salt = mix(np.array([level * 4 + i + 1 for i in range(4)], dtype=np.uint64))
    return mix((mix(words ^ salt)).sum(axis=1, dtype=np.uint64))


def build_perfect_hash(words: np.ndarray, gamma: float = 2.0) -> list[np.ndarray]:
    """Bit arrays of a minimal perfect hash for distinct digests, given as rows of four uint64."""
    levels, left = [], words
    while len(left):
        size = max(1, int(gamma * len(left)))
        at = (_level_hash(left, len(levels)) % np.uint64(size)).astype(np.int64)
        owned = np.bincount(at, minlength=size) == 1
        levels.append(owned)
        left = left[~owned[at]]
    return levels


def slots(levels: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """The slot of each digest; -1 where the hash proves that it is not a member.

    Members get distinct slots from 0; a stranger may get any slot.
    """
    found = np.full(len(words), -1, dtype=np.int64)
    open_, before = np.arange(len(words)), 0
    for k, owned in enumerate(levels):
        if not len(open_):
            break
        at = (_level_hash(words[open_], k) % np.uint64(len(owned))).astype(np.int64)
        rank = np.cumsum(owned) - 1
        hit = owned[at]
        found[open_[hit]] = before + rank[at[hit]]
        open_, before = open_[~hit], before + int(owned.sum())
    return found


def _words(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint64).reshape(-1, 4)


GROUPS = "digest binary, winner long, n long, repeated boolean"


def _merge_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """The groups of one bucket after the batch: members change the locator of their slot."""
    history, batch = rows[rows["old"]], rows[~rows["old"]]
    known, new = _words(history["digest"]), _words(batch["digest"])
    levels = build_perfect_hash(known)
    home = slots(levels, known)
    digest = np.zeros((len(known), 4), dtype=np.uint64)
    winner, n = np.zeros(len(known), dtype=np.int64), np.zeros(len(known), dtype=np.int64)
    digest[home] = known
    winner[home] = history["winner"].to_numpy(np.int64)
    n[home] = history["n"].to_numpy(np.int64)
    at = slots(levels, new)
    member = at >= 0
    if len(known):
        member &= (digest[np.maximum(at, 0)] == new).all(axis=1)
    np.maximum.at(winner, at[member], batch["winner"].to_numpy(np.int64)[member])
    np.add.at(n, at[member], batch["n"].to_numpy(np.int64)[member])
    kept = pd.DataFrame({"digest": [x.tobytes() for x in digest], "winner": winner, "n": n,
                         "repeated": n > 1})
    fresh = batch.loc[~member, ["digest", "winner", "n"]].assign(repeated=lambda x: x["n"] > 1)
    return pd.concat([kept, fresh], ignore_index=True)[["digest", "winner", "n", "repeated"]]


def merge_groups(history: DataFrame, batch: DataFrame, n_buckets: int) -> DataFrame:
    """Groups of history and batch together; both come from :func:`grouped`.

    ``n_buckets`` should keep a bucket near ``BUCKET_DIGESTS`` distinct digests; digests spread
    evenly, so no bucket is much larger than the mean.
    """
    bucket = F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).alias("bucket")
    both = history.withColumn("old", F.lit(True)).unionByName(batch.withColumn("old", F.lit(False)))
    return both.groupBy(bucket).applyInPandas(_merge_bucket, GROUPS)


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    The lower half of the doc_id range is the history, the upper half the batch that is looked up in
    it. Null texts are empty texts, and all empty texts are equal. Rows that repeat a doc_id with an
    equal text count each in ``group_size`` and are all kept if that doc_id wins. A null doc_id never
    wins; a group of such rows alone has no ``keep_id`` and keeps one of them. An empty table gives none.
    """
    rows = stored(digests(docs).withColumn("place", F.monotonically_increasing_id()))
    low, high, total, with_id = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("digest"),
                                         F.count("doc_id")).first()
    # Rows without doc_id are grouped beside, under an id below all others.
    floor = (low if low is not None else 0) - 1
    middle = ((low or 0) + (high or 0)) // 2
    seen = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(floor)))
    history, batch = (grouped(seen.where(c)) for c in (F.col("doc_id") <= middle,
                                                       F.col("doc_id") > middle))
    merged = merge_groups(history, batch, max(8, total // BUCKET_DIGESTS + 1))
    winner = F.when(F.col("winner") > floor, F.col("winner"))
    out = rows.join(merged.select("digest", winner.alias("keep_id"), F.col("n").alias("group_size")), "digest")
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False))
    if with_id < total:
        lone = rows.where("doc_id IS NULL").groupBy("digest").agg(F.min("place").alias("first"))
        out = out.join(lone, "digest", "left")
        kept = kept | (F.col("keep_id").isNull() & (F.col("place") == F.col("first")))
    return out.select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text a row with a larger doc_id repeats; columns unchanged.

    Rows are judged one by one. Rows without doc_id and further rows of a repeated doc_id come last: one
    stays where no other row has its text, so of equal rows one stays.
    """
    rows = keyed_rows(docs, below=True)
    return rows_with(rows, exact_groups(judged_rows(rows)).where("kept"))
