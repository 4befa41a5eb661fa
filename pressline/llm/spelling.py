"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

An edit changes few letter counts: a replaced letter takes one from one letter and gives it to another
(squared distance 2), an inserted or deleted one adds or takes one (squared distance 1). So near words
lie in equal or adjacent lengths, at a squared distance of two at most, and this is tested for whole
blocks at once: |x - y|^2 = |x|^2 + |y|^2 - 2 xy is one matrix product of the counts of two blocks. What
is left is verified letter by letter.

Blocks are made by the same bound. The letters are dealt into GROUPS groups; a block holds the words with
the same counts by group. Near words have group counts at a squared distance of two at most, too, so a
block meets itself, the blocks with one letter moved between two groups and those with one letter more:
no pair is lost, and most pairs of words are never compared. A block of many words is cut into parts of at
most BLOCK words by a range partition over (counts, word), so no block has to fit into one task; parts
meet by an equi-join and every pair of parts is a row of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pressline.llm.hashing import chunks, same_spans, span_hashes, spans_taken, texts_of, LOWER
from pressline.llm.storage import stored

GROUPS = 6
"""Groups of letters: code point modulo GROUPS."""
BLOCK = 2048
"""Words of one part of a block, at most."""
CELLS = 1 << 21
"""Distances that are held at once."""
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
SHORT = 64
"""Runs of at most this many bytes are hashed together in arrays, longer ones one by one."""


def crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, np.uint32(0xEDB88320) ^ (out >> np.uint32(1)), out >> np.uint32(1))
    return out


CRC = crc_table()


def crc_after(prefix: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the bytes of each span behind a prefix of which ``prefix`` is the CRC-32."""
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    first = int(np.count_nonzero(length > SHORT))
    out = np.zeros(len(starts), dtype=np.uint32)
    for k in order[:first].tolist():
        out[k] = zlib.crc32(data[starts[k]:ends[k]].tobytes(), int(prefix[k]))
    rest = order[first:]
    state, at, length = ~prefix[rest], starts[rest], length[rest]
    for k in range(int(length[0]) if len(rest) else 0):
        live = np.searchsorted(-length, -k, side="left")
        s = state[:live]
        state[:live] = CRC[(s ^ data[at[:live] + k]) & np.uint32(255)] ^ (s >> np.uint32(8))
    out[rest] = ~state
    return out


def letter_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and code points of the maximal runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    lower = data | 32
    latin = data == 0xC3
    inside[1:-1] = ((lower >= 97) & (lower <= 122) & (data < 128)) | latin
    inside[2:-1] |= latin[:-1]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    wide = np.concatenate(([0], np.cumsum(latin)))
    return starts, ends, ends - starts - (wide[ends] - wide[starts])


def counted_words(drop_every: int, least: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def row(words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            heads = np.array([zlib.crc32(b"%d:" % i) if i is not None else 0 for i in ids], dtype=np.uint32)
            known = np.array([i is not None for i in ids], dtype=bool)
            for first, data, bounds in chunks(texts_of(batch.column("text"))):
                data = LOWER[data]
                starts, ends, length = letter_runs(data)
                long = length >= least
                starts, ends, length = starts[long], ends[long], length[long]
                owner = first + np.searchsorted(bounds, starts, side="right") - 1
                single = np.zeros(len(starts), dtype=bool)
                if drop_every and len(starts):
                    h = crc_after(heads[owner], data, starts, ends)
                    single = (h % drop_every == 0) & known[owner]
                    made = []
                    for k in np.flatnonzero(single & (length > least)).tolist():
                        word = data[starts[k]:ends[k]].tobytes().decode()
                        at = int(h[k]) % len(word)
                        made.append(word[:at] + word[at + 1:])
                    yield row(pa.array(made, pa.string()), np.ones(len(made), dtype=np.int64))
                starts, ends = starts[~single], ends[~single]
                _, where, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
                same = same_spans(data, starts, ends, where[which])
                n = np.bincount(which[same], minlength=len(where))
                # A word that only shares the hash of another one is its own row.
                where = np.concatenate((where, np.flatnonzero(~same)))
                n = np.concatenate((n, np.ones(len(where) - len(n), dtype=np.int64)))
                flat, offsets = spans_taken(data, starts[where], ends[where])
                yield row(pa.LargeStringArray.from_buffers(
                    len(where), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)).cast(pa.string()), n)

    return run


def word_counts(docs: DataFrame, drop_every: int = 0, least: int = LEAST_LENGTH) -> DataFrame:
    """(word, n) of all runs of Latin letters with ``least`` code points or more, A-Z lower-cased.

    With ``drop_every``, a run of which the CRC of "doc_id:run" is divisible by it loses the code point
    CRC % length first. Null texts have no words; words of rows without doc_id are left as they are.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(counted_words(drop_every, least), "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n"))


# --- blocks -----------------------------------------------------------------------------------------

def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words in a row, length of each)."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32), length


def tallies(points: np.ndarray, length: np.ndarray, kinds: int) -> np.ndarray:
    """How often each of ``kinds`` numbers comes in each word; ``points`` are numbers below ``kinds``."""
    word = np.repeat(np.arange(len(length)), length)
    return np.bincount(word * kinds + points, minlength=len(length) * kinds).reshape(len(length), kinds)


def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, word, n): the counts by group as big-endian numbers, which sort like the counts."""
    for batch in batches:
        points, length = code_points(batch.column("word").to_pylist())
        counts = np.ascontiguousarray(tallies(points % GROUPS, length, GROUPS).astype(">u4"))
        block = counts.view(f"V{4 * GROUPS}").ravel().tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(block, pa.binary()), batch.column("word"), batch.column("n")], ["block", "word", "n"])


def block_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, block, words, counts): up to BLOCK words of one block that follow each other, as one row."""
    part = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    now, words, counts = None, [], []

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([now], pa.binary()),
             pa.array(["\n".join(words)]), pa.array([np.array(counts, dtype=np.int64).tobytes()], pa.binary())],
            ["part", "block", "words", "counts"])

    for batch in batches:
        for block, word, n in zip(*[batch.column(c).to_pylist() for c in ("block", "word", "n")]):
            if words and (block != now or len(words) >= BLOCK):
                yield flush()
                part += 1
                words, counts = [], []
            now = block
            words.append(word)
            counts.append(n)
    if words:
        yield flush()


def visited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(home, visitor, own): the blocks that a part visits. Of two blocks that must meet one visits the other.

    A part visits its own block, all blocks with one letter more, and of the blocks with one letter in
    another group those that sort behind it.
    """
    for batch in batches:
        homes, parts, own = [], [], []
        for part, block in zip(batch.column("part").to_pylist(), batch.column("block").to_pylist()):
            counts = np.frombuffer(block, dtype=">u4").astype(np.int64)
            goals = [counts]
            for a in range(GROUPS):
                more = counts.copy()
                more[a] += 1
                goals.append(more)
            # One more in an earlier group and one less in a later one sorts behind.
            for a, b in combinations(range(GROUPS), 2):
                if counts[b]:
                    moved = counts.copy()
                    moved[a] += 1
                    moved[b] -= 1
                    goals.append(moved)
            homes += [g.astype(">u4").tobytes() for g in goals]
            parts += [part] * len(goals)
            own += [True] + [False] * (len(goals) - 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(homes, pa.binary()), pa.array(parts, pa.int64()), pa.array(own, pa.bool_())],
            ["home", "visitor", "own"])


def letter_numbers(points: np.ndarray) -> np.ndarray:
    """a-z as 0 to 25, U+00C0 to U+00FF as 26 to 89."""
    return np.where(points < 192, points.astype(np.int64) - 97, points.astype(np.int64) - 166)


LETTERS = 90


class Block:
    """Words of a part with their counts and letters."""

    def __init__(self, words: list[str], counts: np.ndarray) -> None:
        self.words, self.counts = words, counts
        self.points, self.length = code_points(words)
        letters = tallies(letter_numbers(self.points), self.length, LETTERS)
        # Squares of counts must be exact.
        letters = letters.astype(np.float32 if self.length.max() <= 1000 else np.float64)
        square = (letters ** 2).sum(axis=1, keepdims=True)
        one = np.ones_like(square)
        # Products of these rows are squared distances at once.
        self.left = np.concatenate((-2 * letters, square, one), axis=1)
        self.right = np.concatenate((letters, one, square), axis=1)
        self.ends = np.cumsum(self.length)
        self.starts = self.ends - self.length


def common(a: Block, i: np.ndarray, b: Block, j: np.ndarray, back: bool) -> np.ndarray:
    """Letters that words i of ``a`` and j of ``b`` share from their start, or from their end."""
    out = np.zeros(len(i), dtype=np.int64)
    live = np.arange(len(i))
    most = np.minimum(a.length[i], b.length[j])
    k = 0
    while len(live):
        live = live[most[live] > k]
        x = a.ends[i[live]] - 1 - k if back else a.starts[i[live]] + k
        y = b.ends[j[live]] - 1 - k if back else b.starts[j[live]] + k
        live = live[a.points[x] == b.points[y]]
        out[live] += 1
        k += 1
    return out


def one_edit(a: Block, i: np.ndarray, b: Block, j: np.ndarray) -> np.ndarray:
    """Whether exactly one letter is inserted, deleted or replaced between words i of ``a`` and j of ``b``."""
    longer = np.maximum(a.length[i], b.length[j])
    shared = common(a, i, b, j, False) + common(a, i, b, j, True)
    # Equal words share all letters twice; else what both ends share must leave one letter.
    return (shared >= longer - 1) & ((a.length[i] != b.length[j]) | (shared == longer - 1))


def near_in(a: Block, b: Block, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of near words of two blocks; of one block with itself each pair once."""
    found = []
    rows = max(1, CELLS // max(len(b.words), 1))
    for at in range(0, len(a.words), rows):
        distance = a.left[at:at + rows] @ b.right.T
        i, j = np.nonzero((distance < 2.5) & (distance > 0.5))
        i += at
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        keep = one_edit(a, i, b, j)
        found.append((i[keep], j[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


def near_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, other, other_n), both ways, of each pair of parts."""
    held: tuple = (None, None)
    for batch in batches:
        words, counts, visitor, guests, guest_counts, home = (batch.column(c).to_pylist() for c in (
            "words", "counts", "visitor", "guests", "guest_counts", "part"))
        at = 0
        while at < len(home):
            if held[0] != home[at]:
                held = home[at], Block(words[at].split("\n"), np.frombuffer(counts[at], dtype=np.int64))
            a, stop, names, n = held[1], at, [], []
            # Guests of one home that follow each other are compared at once.
            if visitor[at] == home[at]:
                stop, b = at + 1, a
            else:
                while stop < len(home) and home[stop] == home[at] and visitor[stop] != home[at] and len(names) < 8 * BLOCK:
                    names += guests[stop].split("\n")
                    n.append(np.frombuffer(guest_counts[stop], dtype=np.int64))
                    stop += 1
                b = Block(names, np.concatenate(n))
            i, j = near_in(a, b, a is b)
            for x, p, y, q in ((a, i, b, j), (b, j, a, i)):
                if len(p):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.words).take(pa.array(p)), pa.array(x.counts[p]),
                         pa.array(y.words).take(pa.array(q)), pa.array(y.counts[q])],
                        ["word", "n", "other", "other_n"])
            at = stop


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n), both ways, for all words exactly one edit apart.

    ``words`` (word, n) is stored and has every word once, of letters a-z and U+00C0 to U+00FF.
    """
    n_parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (words.mapInArrow(keyed, "block binary, word string, n long")
             .repartitionByRange(n_parts, "block", "word").sortWithinPartitions("block", "word"))
    parts = stored(dealt.mapInArrow(block_parts, "part long, block binary, words string, counts binary"))
    goals = parts.select("part", "block").mapInArrow(visited, "home binary, visitor long, own boolean")
    homes = parts.select(F.col("block").alias("home"), "part")
    # Only numbers of parts meet here; of two parts of one block the later one visits.
    meet = goals.join(homes, "home").where("NOT own OR visitor >= part").select("part", "visitor")
    guests = parts.select(F.col("part").alias("visitor"), F.col("words").alias("guests"),
                          F.col("counts").alias("guest_counts"))
    pairs = meet.join(guests, "visitor").join(parts.select("part", "words", "counts"), "part")
    return pairs.mapInArrow(near_pairs, "word string, n long, other string, other_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that is reached over ``forms`` (word, form), stored.

    Counts grow tenfold a step, so chains are short; each round doubles what is followed.
    """
    up = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        above = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        further = stored(up.join(above, "root", "left").select(
            "word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")))
        up = further.select("word", "root")
        if further.where("moved").isEmpty():
            return up


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of ``words`` (word, n), which has each word once.

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if that is at least
    ``ratio`` times n, else null; ``root`` follows the forms to the last. A table without words gives none.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")))
    near = near_words(words)
    best = F.min(F.struct((-F.col("other_n")).alias("low"), F.col("other").alias("form")))
    known = stored(near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    fits = -F.col("best.low") >= ratio * F.col("n")
    rows = stored(words.join(known, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.form")).alias("form"),
        F.when(fits, -F.col("best.low")).alias("form_n")))
    ends = roots(rows.where("form IS NOT NULL"))
    return rows.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
