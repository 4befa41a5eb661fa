"""Benchmark decontamination by one Aho-Corasick automaton over the windows of all test items.

Test questions and answers are cut into windows of 13 words (an item of fewer words is one window).
All distinct windows form one automaton. Each document is normalised once, the automaton runs over
it once, and every occurrence is mapped back to words and to places in the original text.

The automaton is broadcast, so the benchmark is measured first: up to ``BLOCK_BYTES`` of items it is
one automaton; a larger benchmark is cut into blocks of whole items, and the documents are scanned
once per block. Either way every item meets every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressline.llm.hashing import texts_of
from pressline.llm.storage import judged_rows, keyed_rows, rows_with, stored

WINDOW = 13
BLOCK_BYTES = 16 << 20
ENOUGH = 20
"""A document is contaminated when at least one word in ``ENOUGH`` is hit."""

_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    """Words after A-Z are lower-cased: runs of letters a-z, digits and all that is beyond ASCII."""
    return text.lower().translate(_WORD_BYTES).split()


def windows_of(words: list[bytes]) -> list[bytes]:
    """The windows of one item as normalised strings with a space at both ends."""
    last = max(len(words) - WINDOW, 0)
    return [b" " + b" ".join(words[i:i + WINDOW]) + b" " for i in range(last + 1)] if words else []


def build_automaton(items: list[tuple[str, bytes]]) -> ahocorasick.Automaton | None:
    """Window -> (number of words, ids of the items that have it). None without any window."""
    found: dict[bytes, set[str]] = {}
    for item, text in items:
        for window in windows_of(words_of(text)):
            found.setdefault(window, set()).add(item)
    if not found:
        return None
    out = ahocorasick.Automaton()
    for window, ids in found.items():
        # One character per byte, so that places count bytes.
        out.add_word(window.decode("latin-1"), (window.count(b" ") - 1, tuple(sorted(ids))))
    out.make_automaton()
    return out


def scan(automaton: ahocorasick.Automaton | None, text: bytes) -> tuple[int, np.ndarray, set[str]]:
    """(number of words, first word and number of words of each merged run of hits, items)."""
    words = words_of(text)
    none = np.zeros((0, 2), dtype=np.int64)
    if automaton is None or not words:
        return len(words), none, set()
    line = b" " + b" ".join(words) + b" "
    ends, sizes, items = [], [], set()
    for at, (size, ids) in automaton.iter(line.decode("latin-1")):
        ends.append(at)
        sizes.append(size)
        items.update(ids)
    if not ends:
        return len(words), none, items
    space = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
    stop = np.searchsorted(space, np.array(ends))
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, stop - np.array(sizes), 1)
    np.add.at(steps, stop, -1)
    edge = np.diff(np.concatenate(([0], (np.cumsum(steps)[:-1] > 0).astype(np.int8), [0])))
    first = np.flatnonzero(edge == 1)
    return len(words), np.stack([first, np.flatnonzero(edge == -1) - first], axis=1), items


def original_spans(text: bytes, runs: np.ndarray) -> list[dict]:
    """Runs of words as character offsets [start, stop) in the text as it was."""
    if not len(runs):
        return []
    place = [m.span() for m in _WORD.finditer(text)]
    return [{"start": len(text[:place[a][0]].decode()), "stop": len(text[:place[a + n - 1][1]].decode())}
            for a, n in runs.tolist()]


HITS = ("row long, doc_id long, n_words long, runs array<struct<first: long, n: long>>, items array<string>, "
        "spans array<struct<start: long, stop: long>>")


def hits(docs: DataFrame, items: list[tuple[str, bytes]]) -> DataFrame:
    """What one block of items hits in every (row, doc_id, text) of ``docs`` (schema ``HITS``), from one scan."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    kinds = pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())]))
    places = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton(shared.value)
        for batch in batches:
            texts = texts_of(batch.column("text"))
            n_words, runs, found, spans = [], [], [], []
            for text in texts:
                n, r, ids = scan(automaton, text)
                n_words.append(n)
                runs.append([{"first": a, "n": k} for a, k in r.tolist()])
                found.append(sorted(ids))
                spans.append(original_spans(text, r))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(runs, kinds),
                 pa.array(found, pa.list_(pa.string())), pa.array(spans, places)],
                ["row", "doc_id", "n_words", "runs", "items", "spans"])

    return docs.select("row", "doc_id", "text").mapInArrow(run, HITS)


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of about ``block_bytes``; a block is all that is ever on the driver."""
    rows = benchmark.where("item_id IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n_blocks = -(-size // block_bytes) or 1
    block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
    for k in range(n_blocks):
        yield [(r["item_id"], r["text"].encode()) for r in rows.where(block == k).collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: n_words, n_hit, n_items, items_sha256, contaminated, items, spans.

    Null texts have no words, and documents without words are clean. Items without id or words hit
    nothing. Every row is judged by its own text, whether its doc_id repeats or is null, and whatever
    the size of the benchmark. Other columns are never read.
    """
    every_block = blocks(benchmark, block_bytes)
    ahead = list(islice(every_block, 2))
    docs = docs.select(F.lit(0).cast("long").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    if len(ahead) > 1:
        # The blocks' hits of one row meet by its number, which is written down before any scan.
        docs = stored(docs.withColumn("row", F.monotonically_increasing_id()))
    parts = [hits(docs, items) for items in chain(ahead, every_block)]
    if len(parts) == 1:
        every = parts[0].select(
            "doc_id", "n_words", "items", "spans",
            F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["n"]).alias("n_hit"))
    else:
        # Blocks can hit the same words, so their runs are joined as sets of words.
        part = stored(_union(parts))
        word = F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["first"] + r["n"] - 1)))
        every = (part.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
            F.size(F.array_distinct(F.flatten(F.collect_list(word)))).cast("long").alias("n_hit")))
    return every.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (ENOUGH * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "items", "spans")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents; columns unchanged.

    Every row is kept or dropped by its own hits, whether its doc_id is missing or repeated or not.
    """
    rows = keyed_rows(docs)
    return rows_with(rows, contamination(judged_rows(rows), benchmark).where("contaminated"), "left_anti")
