"""Periodic runs of words in every document, by maximal pairs over its LCP-interval tree.

A run is a stretch of words with smallest period q that no neighbouring word extends. Its first word
and the word q later begin a maximal pair: the words before them differ, and so do the words behind
their longest common stretch of l words, where l + q is the length of the run. So runs are found as
pairs, and nothing is extended word by word.

The suffixes that share enough words with another one are sorted by prefix doubling, in arrays; all
others are single leaves that no long pair can use. Over the sorted suffixes and their LCP values the
interval tree is closed bottom-up. An interval keeps its places as lists by left word, in text order: a
list holds the places between which no other left word comes. When a smaller child joins its siblings,
each of its places meets only the nearest places of lists with another left word, on both sides. That
is enough: places of an interval of depth l whose distances are at most l / 2 lie in one periodic
stretch (Fine and Wilf), where only the first can have a left word of its own, and a place between two
others would give the smaller period. Lists are merged smaller into larger.

Only one document is held against itself, so nothing is shuffled; memory follows the longest text.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressline.llm.hashing import WHITE, chunks, mix, same_spans, span_hashes, spans_taken, texts_of, word_spans

LEAST, EXPONENT = 6, 4
"""A run has LEAST words and EXPONENT periods at least."""


def least_depth(least: int, exponent: int) -> int:
    """The shortest common stretch that a pair of a run can have."""
    return min(max((exponent - 1) * d, least - d) for d in range(1, max(least, 2)))


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Equal words of one document have equal numbers, all other words different ones.

    Words are told apart by a hash and then compared byte by byte with the first of their number.
    """
    key = span_hashes(data, starts, ends) ^ mix(owner.astype(np.uint64) + np.uint64(1))
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    like = first[number]
    odd = np.flatnonzero(~same_spans(data, starts, ends, like) | (owner != owner[like]))
    if len(odd):
        known: dict = {}
        for i in odd.tolist():
            word = (int(owner[i]), data[starts[i]:ends[i]].tobytes())
            number[i] = known.setdefault(word, len(first) + len(known))
    return number.astype(np.int64)


def sorted_suffixes(number: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in suffix order, group of each) of the suffixes that share ``shared`` words (a power of
    two) with another one; a group shares these words. Prefix doubling on what is not yet told apart."""
    n = len(number)
    rank = np.full(n + 1, -1, dtype=np.int64)
    at = np.argsort(number, kind="stable")
    value, old = number[at], np.zeros(n, dtype=np.int64)
    depth, kept, group = 1, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    while len(at):
        # Ranks are places of first members: an old group's members stay together.
        index = np.arange(len(at))
        new = np.concatenate(([True], value[1:] != value[:-1]))
        first = np.maximum.accumulate(np.where(new, index, 0))
        if depth == 1:
            rank[at] = first
        else:
            fresh = np.concatenate(([True], old[1:] != old[:-1]))
            rank[at] = old + first - np.maximum.accumulate(np.where(fresh, index, 0))
        last = np.concatenate((new[1:], [True]))
        at = at[~(new & last)]
        if depth == shared:
            kept, group = at, rank[at].copy()
        old, then = rank[at], rank[at + depth]
        order = np.argsort(old * (n + 2) + then + 1, kind="stable")
        at, old = at[order], old[order]
        value = old * (n + 2) + then[order] + 1
        depth *= 2
    order = np.argsort(rank[kept], kind="stable")
    return kept[order], group[order]


def common_lengths(number: list[int], suffixes: list[int], groups: list[int]) -> list[int]:
    """Words that each suffix shares with the one before it; 0 for the first of a group.

    In text order the length falls by one a word at most, so all comparisons together are linear.
    """
    before = dict(zip(suffixes[1:], suffixes[:-1]))
    for k in range(len(suffixes)):
        if k == 0 or groups[k] != groups[k - 1]:
            before[suffixes[k]] = -1
    found, length, last = {}, 0, 0
    for i in sorted(suffixes):
        length = max(0, length - (i - last))
        last, j = i, before[i]
        if j < 0:
            length = 0
        else:
            while number[i + length] == number[j + length]:
                length += 1
        found[i] = length
    return [found[i] for i in suffixes]


class Places:
    """Places of an interval as lists by left word, in text order; neighbours have different left words."""

    __slots__ = ("lists", "firsts", "size")

    def __init__(self, place: int) -> None:
        self.lists, self.firsts, self.size = [[place]], [place], 1

    def strangers(self, p: int, left: list[int]) -> tuple[int, int]:
        """The nearest places on both sides of ``p`` with another left word than that of ``p``, or -1.

        A side where a place with the left word of ``p`` comes first has none.
        """
        k = bisect_right(self.firsts, p) - 1
        low = high = -1
        own = left[p]
        if k >= 0:
            here = self.lists[k]
            if left[here[0]] != own:
                low = here[bisect_right(here, p) - 1]
            if here[-1] > p:
                return low, here[bisect_right(here, p)] if low >= 0 else -1
        if k + 1 < len(self.lists) and left[self.firsts[k + 1]] != own:
            high = self.firsts[k + 1]
        return low, high

    def add(self, p: int, left: list[int]) -> None:
        self.size += 1
        own, firsts, lists = left[p], self.firsts, self.lists
        k = bisect_right(firsts, p) - 1
        if k >= 0:
            here = lists[k]
            if left[here[0]] == own:
                here.insert(bisect_left(here, p), p) if here[-1] > p else here.append(p)
                return
            if here[-1] > p:
                cut = bisect_right(here, p)
                lists[k + 1:k + 1] = [[p], here[cut:]]
                firsts[k + 1:k + 1] = [p, here[cut]]
                del here[cut:]
                return
        if k + 1 < len(lists) and left[firsts[k + 1]] == own:
            lists[k + 1].insert(0, p)
            firsts[k + 1] = p
        else:
            lists.insert(k + 1, [p])
            firsts.insert(k + 1, p)


def maximal_pairs(number: list[int], suffixes: list[int], groups: list[int], least: int,
                  exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run: the maximal pairs of fitting distance in the interval tree."""
    lengths = common_lengths(number, suffixes, groups)
    floor = least_depth(least, exponent)
    # The word before the first word of all is the end mark, and that of a document another document's.
    left = [number[-1], *number[:-1]]
    found = []

    def joined(big, small, depth: int):
        """Both children as one, with the pairs between them."""
        if not isinstance(big, Places):
            big, small = (small, big) if isinstance(small, Places) else (Places(big), small)
        if isinstance(small, Places):
            if small.size > big.size:
                big, small = small, big
            places = [p for part in small.lists for p in part]
        else:
            places = [small]
        before = -1
        for k, p in enumerate(places):
            low, high = big.strangers(p, left)
            # A place of the same child in between would belong to the pair of the smaller period.
            if low > before and (exponent - 1) * (p - low) <= depth and depth + p - low >= least:
                found.append((low, depth + p - low, p - low))
            if high >= 0 and (exponent - 1) * (high - p) <= depth and depth + high - p >= least and (
                    k + 1 == len(places) or places[k + 1] > high):
                found.append((p, depth + high - p, high - p))
            before = p
        for p in places:
            big.add(p, left)
        return big

    open_: list[tuple[int, object]] = []
    for k, suffix in enumerate(suffixes):
        depth = lengths[k] if lengths[k] >= floor else 0
        if k:
            done = suffixes[k - 1]
            while open_ and open_[-1][0] > depth:
                above, places = open_.pop()
                done = joined(places, done, above)
            if depth:
                if open_ and open_[-1][0] == depth:
                    open_[-1] = (depth, joined(open_[-1][1], done, depth))
                else:
                    open_.append((depth, done))
    if suffixes:
        done = suffixes[-1]
        while open_:
            above, places = open_.pop()
            done = joined(places, done, above)
    return found


def chunk_runs(number: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """Runs of all documents of a chunk: rows (start, length, period), by start and period."""
    shared = 1 << (least_depth(least, exponent).bit_length() - 1)
    suffixes, groups = sorted_suffixes(number, shared)
    if not len(suffixes):
        return np.zeros((0, 3), dtype=np.int64)
    found = maximal_pairs([*number.tolist(), -1], suffixes.tolist(), groups.tolist(), least, exponent)
    return np.array(sorted(set(found)), dtype=np.int64).reshape(-1, 3)


RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


Source = Callable[[int | None, int], np.ndarray | None]


def runs_in(least: int, exponent: int, source: Source | None = None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, data, bounds in chunks(texts_of(batch.column("text"))):
                starts, ends = word_spans(data, WHITE)
                owner = np.searchsorted(bounds, starts, side="right") - 1
                n = len(bounds) - 1
                first_word = np.searchsorted(owner, np.arange(n + 1))
                counts = np.diff(first_word)
                number = word_numbers(data, starts, ends, owner)
                if source:
                    taken = np.arange(len(starts))
                    for k in np.flatnonzero(counts).tolist():
                        places = source(ids[first + k], int(counts[k]))
                        if places is not None:
                            taken[first_word[k]:first_word[k + 1]] = first_word[k] + places
                    starts, ends, number = starts[taken], ends[taken], number[taken]
                runs = chunk_runs(number, least, exponent)
                # Words of any run after its first period.
                change = np.zeros(len(starts) + 1, dtype=np.int64)
                np.add.at(change, runs[:, 0] + runs[:, 2], 1)
                np.add.at(change, runs[:, 0] + runs[:, 1], -1)
                kept = np.cumsum(change)[:-1] == 0
                at = np.searchsorted(runs[:, 0], first_word)
                inner = runs[:, 0] - np.repeat(first_word[:-1], np.diff(at))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(inner), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(kind)))
                # Each kept word with one space behind it; the last space of a document falls away.
                spaced = data.copy()
                spaced[ends] = 32
                flat, _ = spans_taken(spaced, starts[kept], ends[kept] + 1)
                size = np.concatenate(([0], np.cumsum((ends - starts + 1) * kept)))[first_word]
                text = flat.tobytes()
                collapsed = [text[a:max(a, b - 1)].decode() for a, b in zip(size[:-1].tolist(), size[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first:first + n], pa.int64()), pa.array(counts, pa.int64()), lists,
                     pa.array(collapsed, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT,
                  source: Source | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs``.

    ``runs`` has start, length and period of every run, by start and period; ``collapsed`` is the text
    with one space between words and without the words that a run holds after its first period. Null
    counts as empty and has no runs. Repeated rows and rows without doc_id are judged each by itself.
    Other columns of ``docs`` are never read. ``exponent`` is 3 at least. ``source`` may give, for an id and a
    number of words, the places that the words of that document are taken from.
    """
    if exponent < 3:
        raise ValueError("the lists by left word need an exponent of 3 at least")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(runs_in(least, exponent, source), RUNS)


def planted_periods(doc_id: int | None, n: int) -> np.ndarray | None:
    """The word that stands at each place of a document of ``n`` words, if its id is a tenth one.

    With h the CRC of the id and g = h // 10, word i >= a becomes word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) // (3 + g % 8). Documents without id or words and all others are left as they are: None.
    """
    h = zlib.crc32(b"%d" % doc_id) if doc_id is not None else 1
    if h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return places


def run_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("_b", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_b.back")).alias("start"),
        F.col("_b.length").alias("length"), (-F.col("_b.short")).alias("period"),
        F.expr("(1000 * _b.length) div (-_b.short)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
