"""Similarity join of documents on word shingles by parity sketches.

A document is its set of distinct five-word shingles (64-bit hashes); documents with equal sets are
one class. XOR of hashes is a parity: equal elements of two sets cancel, so parities of the same
part of the hash range differ only if the symmetric difference has an element there. Two sets A and B
of Jaccard similarity 0.8 or more differ in at most (|A| + |B|) / 9 elements, which the size of one
set bounds by some d. Sizes are cut into bands, each with its number of parts of the hash range, so
by the pigeonhole principle linked sets have the same parity in one of any d + 1 parts of a set that
are not empty. Documents that share the parity of a part are candidates.

Which d + 1 parts a set shows is free, as long as all sets prefer the same ones. A shingle that many
documents have would make a part that many sets share, and the pairs of such a group grow with the
square of the table. So shingles are counted first, and a part comes the later the more often its
rarest shingle was seen. A wrong count costs time, never a link.

Candidates are never written out as all pairs of a group. First every class is paired with the one
leader that it shares most parts with. Verified pairs grow into components. Only where a group still
holds several components are its classes compared across components, block by block, by bit sketches:
a sketch is the parity of every residue of the hashes, and the Hamming distance of two sketches is a
lower bound of the symmetric difference. What the bound does not rule out is verified on the texts:
in the merging rounds the nearest candidate of every class, and then, after these have merged, every
pair that is left.
Every linked pair shares a part, so no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from pressline.llm.hashing import LOWER, WHITE, chunks, mix, span_hashes, texts_of, word_spans
from pressline.llm.storage import components, judged_rows, keyed_rows, rows_with, stored

SHINGLE = 5
SIMILAR, OF = 80, 100
"""Linked when OF * |A and B| >= SIMILAR * |A or B|."""
MERGING_ROUNDS = 2
BLOCK = 1024
"""Classes of one group that are compared in one block."""
AT_ONCE = 1 << 20
"""Words of 64 bits that are compared at once."""


STACK = 1 << 17
"""Shingles of the sets that are handled at once."""
RUN = 1 << 21
"""Shingles of one run; those that repeat in a run are counted."""
LISTED = 1 << 19
"""Most shingles whose counts are broadcast; they only order the parts of a set."""
PACKS = 1 << 12
"""Ranges of parts; what a batch has in one of them travels as one row."""
BUCKETS = 1 << 20
"""Buckets of doc_ids that tell which texts a verification can do without."""


def bands(top: int = 1 << 40) -> list[int]:
    """Smallest set size of every band: steps of four, as only sets near the end of one join two levels."""
    out = [1]
    while out[-1] < top:
        out.append(out[-1] * 4)
    return out


BANDS = np.array(bands(), dtype=np.int64)


def most_different(size_a, size_b):
    """Largest symmetric difference of two linked sets of these sizes (numbers or arrays)."""
    return (size_a + size_b) * (OF - SIMILAR) // (OF + SIMILAR)


def levels(n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(sets, level, number of parts, largest difference from a linked set) where sets of these sizes take part.

    A level joins the sets of one band with each other and with those sets of the band below that
    are not too small. It has about one part for two elements of its largest sets.
    """
    own = np.searchsorted(BANDS, n, side="right") - 1
    for step in (0, 1):
        sets = np.flatnonzero(OF * n >= SIMILAR * BANDS[own + step]) if step else np.arange(len(n))
        level, size = own[sets] + step, n[sets]
        top = BANDS[level + 1] - 1
        yield sets, level, top // 2 + 8, most_different(size, np.minimum(top, size * OF // SIMILAR))


def sketch_bits(size: int) -> int:
    """Bits of the sketch of a set: a power of two, some eight times the difference that matters."""
    return 1 << max(6, (8 * max(1, most_different(size, size * OF // SIMILAR))).bit_length())


def bit_sketch(h: np.ndarray) -> bytes:
    """Parity of the number of elements at every residue of the hash."""
    bits = sketch_bits(len(h))
    count = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").tobytes()


class Seen:
    """How often the most frequent shingles were seen."""

    def __init__(self, shingles: np.ndarray, times: np.ndarray):
        self.shingles, self.times = shingles, times
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[self.cells(shingles)] = True

    def cells(self, h: np.ndarray) -> np.ndarray:
        return (h & np.uint64(len(self.maybe) - 1)).astype(np.int64)

    def of(self, h: np.ndarray) -> np.ndarray:
        """The count of every shingle; 0 where it is not listed."""
        out = np.zeros(len(h), dtype=np.int64)
        some = np.flatnonzero(self.maybe[self.cells(h)])
        if len(some):
            at = np.minimum(np.searchsorted(self.shingles, h[some]), len(self.shingles) - 1)
            out[some] = np.where(self.shingles[at] == h[some], self.times[at], 0)
        return out


def parts_of(h: np.ndarray, n: np.ndarray, seen: Seen | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, parity, label) of the parts that sorted sets show; an empty part has parity 0.

    ``h`` holds sets of the sizes ``n`` one after the other. Of its parts that are not empty a set shows
    the first d + 1, in order of how often the rarest shingle of a part was seen. Parts of a linked set
    with other shingles are d at most, so the first one with the same shingles is shown by both. A set of
    no more than d such parts shows the empty ones too: where all that two linked sets have in common is
    empty, both are such sets.
    """
    times = seen.of(h) if seen else np.zeros(len(h), dtype=np.int64)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for sets, level, parts, d in levels(n):
        if not len(sets):
            continue
        size = n[sets]
        mine = np.repeat(np.isin(np.arange(len(n)), sets), n)
        x, x_times, of = h[mine], times[mine], np.repeat(np.arange(len(sets)), size)
        # The high 32 bits choose the part, in order, so that a part is a stretch of the sorted set.
        part = ((x >> np.uint64(32)) * parts.astype(np.uint64)[of]) >> np.uint64(32)
        at = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (of[1:] != of[:-1]))))
        parity, part, of, x_times = np.bitwise_xor.reduceat(x, at), part[at], of[at], np.minimum.reduceat(x_times, at)
        full = np.bincount(of, minlength=len(sets))
        new = x_times == 0
        place = np.cumsum(new)
        first = np.cumsum(full) - full
        shown = new & (place - (place - new)[first][of] <= d[of] + 1)
        # Few sets need parts that were seen before.
        short = np.flatnonzero((np.bincount(of[new], minlength=len(sets)) <= d)[of])
        short = short[np.lexsort((x_times[short], of[short]))]
        start = np.concatenate(([True], of[short][1:] != of[short][:-1]))[:len(short)]
        place = np.arange(len(short)) - np.maximum.accumulate(np.where(start, np.arange(len(short)), 0))
        shown[short[place <= d[of[short]]]] = True
        out.append((sets[of[shown]], parity[shown], (level.astype(np.uint64) << np.uint64(40))[of[shown]] + part[shown]))
        for k in np.flatnonzero(full <= d).tolist():
            empty = np.setdiff1d(np.arange(parts[k]).astype(np.uint64), part[first[k]:first[k] + full[k]])
            out.append((np.full(len(empty), sets[k]), np.zeros(len(empty), dtype=np.uint64),
                        (np.uint64(int(level[k]) << 40) + empty)))
    own, parity, label = (np.concatenate(c) for c in zip(*out))
    return own, parity, label


def part_keys(parity: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Keys of parts: equal keys mean the same level, part and parity."""
    return mix(parity ^ mix(label))


def part_parities(h: np.ndarray, seen: Seen | None = None) -> np.ndarray:
    """Keys of all parts that one sorted set shows."""
    return part_keys(*parts_of(h, np.array([len(h)]), seen)[1:])


def shingle_sets(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(index, sorted distinct shingle hashes) of every text that has words."""
    for first, raw, bounds in chunks(texts):
        data = LOWER[raw]
        starts, ends = word_spans(data, WHITE)
        word = span_hashes(data, starts, ends)
        cut = np.searchsorted(starts, bounds)
        n = max(len(word) - SHINGLE + 1, 0)
        run = np.zeros(n, dtype=np.uint64)
        for k in range(SHINGLE):
            run += word[k:k + n] * np.uint64(2 * (0x632BE59BD9B4E019 * (k + 1) % (1 << 62)) + 1)
        run = mix(run)
        for i in range(len(bounds) - 1):
            a, b = int(cut[i]), int(cut[i + 1])
            if b - a >= SHINGLE:
                h = np.sort(run[a:b - SHINGLE + 1])
                yield first + i, h[np.concatenate(([True], h[1:] != h[:-1]))]
            elif b > a:
                whole = np.uint64(b - a)
                for w in word[a:b]:
                    whole = mix(np.array([whole]) * np.uint64(3) + w)[0]
                yield first + i, np.array([whole], dtype=np.uint64)


def stacked_sets(column: pa.Array) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]]:
    """(indexes, sets, key, key2) of some texts at a time; the keys are 128 bits that name a set."""
    index: list[int] = []
    sets: list[np.ndarray] = []

    def stack() -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        h, n = np.concatenate(sets), np.array([len(x) for x in sets])
        start, size = np.cumsum(n) - n, n.astype(np.uint64)
        # Elements are mixed hashes already: their sum, and one sum that is not linear in them.
        two = (np.add.reduceat(h, start), np.add.reduceat((h >> np.uint64(32)) * (h | np.uint64(1)), start))
        return np.array(index), sets, *(mix(x + size).view(np.int64) for x in two)

    held = 0
    # Not all texts of a batch are copied at once.
    for at in range(0, len(column), 1000):
        for i, h in shingle_sets(texts_of(column.slice(at, 1000))):
            index.append(at + i)
            sets.append(h)
            held += len(h)
            if held >= STACK:
                yield stack()
                index, sets, held = [], [], 0
    if sets:
        yield stack()


def repeated(run: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, number of sets) of the shingles that several sets of a run have. The run is emptied."""
    h = np.concatenate(run)
    run.clear()
    h.sort()
    again = h[1:][h[1:] == h[:-1]]
    at = np.flatnonzero(np.concatenate(([True], again[1:] != again[:-1]))[:len(again)])
    return again[at], np.diff(np.append(at, len(again))) + 1


SETS = "doc_id long, n long, key long, key2 long, sketch binary"


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text, and rows of n = -1: a shingle (key) and its number of classes in a run (key2)."""
    run: list[np.ndarray] = []
    known: set[int] = set()

    def counts() -> Iterator[pa.RecordBatch]:
        h, times = repeated(run)
        known.clear()
        for k in range(0, len(h), 200_000):
            some, often = h[k:k + 200_000].view(np.int64), times[k:k + 200_000]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(some), pa.int64()), pa.array(np.full(len(some), -1)), pa.array(some), pa.array(often),
                 pa.nulls(len(some), pa.binary())], ["doc_id", "n", "key", "key2", "sketch"])

    held = 0
    for batch in batches:
        n, key, key2 = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
        sketch: list[bytes | None] = [None] * batch.num_rows
        for index, some, first, second in stacked_sets(batch.column("text")):
            key[index], key2[index] = first, second
            for i, h, k in zip(index.tolist(), some, first.tolist()):
                n[i] = len(h)
                sketch[i] = bit_sketch(h)
                if k not in known:
                    known.add(k)
                    run.append(h)
                    held += len(h)
            if held >= RUN:
                held = 0
                yield from counts()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n), pa.array(key), pa.array(key2),
             pa.array(sketch, pa.binary())], ["doc_id", "n", "key", "key2", "sketch"])
    if run:
        yield from counts()


def often_seen(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, count) of the ``LISTED`` most frequent shingles of ``counted`` at most, by shingle.

    Runs are counted apart, so a shingle that no run has twice is missing, and so are runs that have it once.
    """
    bits = F.length(F.bin("times"))
    sums = stored(counted.groupBy("key").agg(F.sum("key2").alias("times")))
    least, listed = 64, 0
    for k, shingles in sorted(sums.groupBy(bits).count().collect(), reverse=True):
        listed += shingles
        if listed > LISTED:
            break
        least = k
    top = sums.where(bits >= least).toArrow()
    shingles, times = top["key"].to_numpy().view(np.uint64), top["times"].to_numpy()
    order = np.argsort(shingles)
    return shingles[order], times[order]


PACKED = "pack int, part binary, key binary, leader binary"


def packed(pack: np.ndarray, bounds: np.ndarray, *columns: np.ndarray | None) -> pa.RecordBatch:
    """A row per stretch of ``columns`` between ``bounds``: its numbers as bytes."""
    offsets = pa.py_buffer((8 * bounds).astype(np.int32))
    blobs = [pa.nulls(len(pack), pa.binary()) if c is None else
             pa.Array.from_buffers(pa.binary(), len(pack), [None, offsets, pa.py_buffer(np.ascontiguousarray(c))])
             for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(pack.astype(np.int32)), *blobs], ["pack", "part", "key", "leader"])


def parities_of(seen: Broadcast):
    """Gives the parts of all classes, packed.

    The smallest and the largest class of a batch that have a part meet those of other batches. All
    between them need no meeting: they follow the smallest one, and spread.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = Seen(*seen.value)
        for batch in batches:
            met: set[int] = set()
            keys, owners = [], []
            for _, sets, key, _ in stacked_sets(batch.column("text")):
                fresh = [i for i, k in enumerate(key.tolist()) if not (k in met or met.add(k))]
                if fresh:
                    some = [sets[i] for i in fresh]
                    own, parity, label = parts_of(np.concatenate(some), np.array([len(h) for h in some]), often)
                    keys.append(part_keys(parity, label))
                    owners.append(key[fresh][own])
            if not owners:
                continue
            part, owner = np.concatenate(keys), np.concatenate(owners)
            order = np.lexsort((owner, part))
            part, owner = part[order], owner[order]
            new = np.concatenate(([True], part[1:] != part[:-1]))
            meets = new | np.append(new[1:], True)
            if not meets.all():
                rest, at = np.flatnonzero(~meets), np.flatnonzero(new)
                head = owner[at][np.cumsum(new)[rest] - 1]
                bounds = np.append(np.arange(0, len(rest), 4096), len(rest))
                yield packed(mix(part[rest[bounds[:-1]]]) % np.uint64(PACKS), bounds, part[rest], owner[rest], head)
            part, owner = part[meets], owner[meets]
            pack = part // np.uint64((1 << 64) // PACKS)
            at = np.flatnonzero(np.concatenate(([True], pack[1:] != pack[:-1])))
            yield packed(pack[at], np.append(at, len(part)), part, owner, None)

    return run


def _leaders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, key, leader) of packed rows in order of pack, of the parts that several classes have."""
    def numbers(column: Iterable[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(column), dtype=np.int64)

    def rows(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "key", "leader"])

    def met(parts: list[bytes], keys: list[bytes]) -> pa.RecordBatch:
        part, key = numbers(parts), numbers(keys)
        order = np.lexsort((key, part))
        part, key = part[order], key[order]
        at = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        size = np.diff(np.append(at, len(part)))
        shared = np.repeat(key[at] < key[at + size - 1], size)
        return rows(part[shared], key[shared], np.repeat(key[at], size)[shared])

    now, parts, keys = -1, [], []
    for batch in batches:
        alone = batch.filter(batch.column("leader").is_valid())
        if alone.num_rows:
            yield rows(*(numbers(alone.column(c).to_pylist()) for c in ("part", "key", "leader")))
        batch = batch.filter(batch.column("leader").is_null())
        for pack, part, key in zip(*(batch.column(c).to_pylist() for c in ("pack", "part", "key"))):
            if pack != now and parts:
                yield met(parts, keys)
                parts, keys = [], []
            now = pack
            parts.append(part)
            keys.append(key)
    if parts:
        yield met(parts, keys)


def shared_parts(docs: DataFrame, seen: Broadcast) -> DataFrame:
    """(part, key, leader): every class of every part that at least two classes show.

    ``leader`` is another class with the part, or the class itself where it is the smallest.
    """
    # A part that very many classes share is two numbers per batch here.
    rows = docs.select("text").mapInArrow(parities_of(seen), PACKED).repartition("pack").sortWithinPartitions("pack")
    return rows.mapInArrow(_leaders, "part long, key long, leader long")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    if OF * min(len(a), len(b)) < SIMILAR * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= SIMILAR * (len(a) + len(b) - both)


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of a batch whose texts are linked."""
    few = (batch.slice(at, 256) for batch in batches for at in range(0, batch.num_rows, 256))
    for batch in few:
        left, right = texts_of(batch.column("text_a")), texts_of(batch.column("text_b"))
        texts = list(dict.fromkeys([*left, *right]))
        sets = {texts[i]: h for i, h in shingle_sets(texts)}
        yes = [x in sets and y in sets and linked(sets[x], sets[y]) for x, y in zip(left, right)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(
            pa.array(yes, pa.bool_()))


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) of doc_ids those whose whole texts are linked."""
    # Most texts are in no pair: they need not move. There are at most as many rows here as buckets.
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).alias("bucket")
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    wanted = F.broadcast(ids.select(bucket).distinct())
    text = docs.select("doc_id", "text", bucket).join(wanted, "bucket", "left_semi").drop("bucket")
    both = (pairs.join(text.toDF("b", "text_b"), "b")
            .join(text.toDF("a", "text_a"), "a").select("a", "b", "text_a", "text_b"))
    return both.mapInArrow(_verify, "a long, b long")


class Sketches:
    """The bit sketches of many sets side by side, as words of 64 bits."""

    def __init__(self, n: np.ndarray, sketches: list[bytes]):
        self.n = n
        self.width = np.fromiter((len(x) // 8 for x in sketches), dtype=np.int64, count=len(sketches))
        self.start = np.cumsum(self.width) - self.width
        self.words = np.frombuffer(b"".join(sketches), dtype=np.uint64)
        # The XOR of all words is the sketch of 64 bits.
        self.short = np.bitwise_xor.reduceat(self.words, self.start) if len(sketches) else self.words

    def folded(self, rows: np.ndarray, width: int, low: int, high: int) -> np.ndarray:
        """Words ``low`` to ``high`` of the sketches of ``rows`` in ``width`` words."""
        out = np.empty((len(rows), high - low), dtype=np.uint64)
        own = self.width[rows]
        for w in np.unique(own):
            at = np.flatnonzero(own == w)
            start = self.start[rows[at]]
            # Folding to this width is the XOR of all stretches of it.
            x = self.words[start[:, None] + np.arange(low, high)]
            for k in range(width, int(w), width):
                x ^= self.words[start[:, None] + np.arange(low + k, high + k)]
            out[at] = x
        return out

    def fits(self, i: np.ndarray, j: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Whether sets at this distance may be linked, by their sizes and by what may differ."""
        a, b = self.n[i], self.n[j]
        return ((OF * np.minimum(a, b) >= SIMILAR * np.maximum(a, b))
                & (distance * (OF + SIMILAR) <= (a + b) * (OF - SIMILAR)))

    def likely(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """What sizes and short sketches do not rule out."""
        return self.fits(i, j, np.bitwise_count(self.short[i] ^ self.short[j]).astype(np.int64))

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, distance) of the pairs that the whole sketches do not rule out."""
        width = np.minimum(self.width[i], self.width[j])
        distance = np.zeros(len(i), dtype=np.int64)
        for w in np.unique(width).tolist():
            left = np.flatnonzero(width == w)
            # The distance of a stretch is a bound already; most pairs go after the first quarter.
            for low, high in ((0, w // 4), (w // 4, w)):
                step = max(1, AT_ONCE // w)
                for k in range(0, len(left) if low < high else 0, step):
                    s = left[k:k + step]
                    both = self.folded(i[s], w, low, high) ^ self.folded(j[s], w, low, high)
                    distance[s] += np.bitwise_count(both).sum(axis=1, dtype=np.int64)
                left = left[self.fits(i[left], j[left], distance[left])]
        yes = self.fits(i, j, distance)
        return i[yes], j[yes], distance[yes]


def _possible(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that the bit sketches do not rule out."""
    for batch in batches:
        m = batch.num_rows
        n = np.concatenate([batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b")])
        sets = Sketches(n, batch.column("sketch_a").to_pylist() + batch.column("sketch_b").to_pylist())
        i, _, _ = sets.near(np.arange(m), np.arange(m, 2 * m))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).take(
            pa.array(np.sort(i)))


POSSIBLE = "part long, doc long, far double, a long, b long"
DEALT = ["part", "block_a", "block_b", "block", "doc", "component", "n", "sketch"]


def firsts(*keys: np.ndarray, of: int) -> np.ndarray:
    """Positions of the first row of each value of the first ``of`` keys, ordered by all keys."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys[:of]:
        new[1:] |= k[order][1:] != k[order][:-1]
    return order[new]


def compare_blocks(closest: bool):
    """Compares classes of different components inside (part, block, block) groups.

    Rows come sorted by group; some thousand rows of whole groups are compared at a time, each with
    the row k places on in order of size, for every k up to the first set that is too large. With ``closest`` every class of a part gives
    the one pair to its nearest class of another component, else every possible pair is given.
    """
    def pairs_of(table: pa.Table) -> pa.RecordBatch:
        part, low, high, block, doc, component, n = (table[c].to_numpy() for c in DEALT[:-1])
        new = np.concatenate(([True], (part[1:] != part[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
        # By size inside each group: from the first set that is too large for a set, all are.
        order = np.lexsort((n, np.cumsum(new)))
        part, low, high, block, doc, component, n = (c[order] for c in (part, low, high, block, doc, component, n))
        sketch = table["sketch"].to_pylist()
        sets = Sketches(n, [sketch[k] for k in order.tolist()])
        bounds = np.append(np.flatnonzero(new), len(part))
        end = np.repeat(bounds[1:], np.diff(bounds))
        found: list[tuple] = [(np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int64))]
        waiting: list[tuple] = []

        def settle() -> None:
            i, j, distance = sets.near(*(np.concatenate(c) for c in zip(*waiting)))
            waiting.clear()
            far = distance / (n[i] + n[j])
            row, far, mate = np.concatenate((i, j)), np.concatenate((far, far)), np.concatenate((j, i))
            if closest:
                keep = firsts(row, far, doc[mate], of=1)
                row, far, mate = row[keep], far[keep], mate[keep]
            else:
                row, far, mate = i, far[:len(i)], j
            found.append((row, far, mate))

        i, k = np.arange(len(part)), 0
        while len(i):
            k += 1
            i = i[i + k < end[i]]
            i = i[OF * n[i] >= SIMILAR * n[i + k]]
            j = i + k
            # Two rows of one block meet in the group of that block with itself.
            yes = (component[i] != component[j]) & ((low[i] == high[i]) | (block[i] != block[j]))
            a, b = i[yes], j[yes]
            yes = sets.likely(a, b)
            if yes.any():
                waiting.append((a[yes], b[yes]))
            if sum(len(x) for x, _ in waiting) > AT_ONCE // 8:
                settle()
        if waiting:
            settle()
        row, far, mate = (np.concatenate(c) for c in zip(*found))
        a, b = np.minimum(doc[row], doc[mate]), np.maximum(doc[row], doc[mate])
        keep = firsts(row, far, a, b, of=1) if closest else firsts(a, b, of=2)
        return pa.RecordBatch.from_arrays(
            [pa.array(c[keep]) for c in (part[row], doc[row], far, a, b)], ["part", "doc", "far", "a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch.select(DEALT))
            if sum(x.num_rows for x in held) < 8 * BLOCK:
                continue
            table = pa.Table.from_batches(held)
            # The last group may go on in the next batch.
            before = np.logical_or.reduce([c != c[-1] for c in (table[x].to_numpy() for x in DEALT[:3])])
            if before.any():
                cut = int(np.flatnonzero(before)[-1]) + 1
                yield pairs_of(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held and sum(x.num_rows for x in held):
            yield pairs_of(pa.Table.from_batches(held))

    return run


def across_components(members: DataFrame, labels: DataFrame, closest: bool) -> DataFrame:
    """Possible pairs (a, b) of classes that share a part and are of different components.

    ``members``: (part, doc) once each; ``labels``: (doc, component, n, sketch). Large groups are dealt
    as pairs of blocks. Each row names a class and a part where it has such a pair. Components only
    grow, so a class without one in a part gets none there later.
    """
    # The group's span of components, summed map-side; groups of one component are done.
    rows = members.join(labels.select("doc", "component"), "doc")
    mixed = (rows.groupBy("part").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                      F.count(F.lit(1)).alias("members"))
             .where("low < high").select("part", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = (rows.join(mixed, "part").withColumn("block", block).select("*", other)
             .withColumn("block_a", F.least("block", "other")).withColumn("block_b", F.greatest("block", "other"))
             .join(labels.select("doc", "n", "sketch"), "doc")
             .repartition("part", "block_a", "block_b").sortWithinPartitions("part", "block_a", "block_b"))
    return dealt.select(*DEALT).mapInArrow(compare_blocks(closest), POSSIBLE)


def similar_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links. Documents without words (null and
    empty texts among them) have no shingles and are alone; documents of one to four words are one
    shingle. Rows with equal texts are linked; a row that repeats comes out as often. Rows without
    doc_id have no component. An empty table gives no rows. Other columns are never read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = stored(docs.mapInArrow(_sets, SETS))
    sets = counted.where("n >= 0")
    seen = docs.sparkSession.sparkContext.broadcast(often_seen(counted.where("n < 0")))
    classes = stored(sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("key", "key2").agg(
        F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    shared = stored(shared_parts(docs.where("doc_id IS NOT NULL"), seen))
    seen.destroy()

    votes = shared.where("key <> leader").groupBy("key", "leader").agg(F.count(F.lit(1)).alias("parts"))
    best = votes.groupBy("key").agg(F.max_by("leader", F.struct("parts", "leader")).alias("leader"))
    own = classes.select("key", "doc", "n", "sketch")
    first = (best.join(own.toDF("key", "a", "n_a", "sketch_a"), "key")
             .join(own.toDF("leader", "b", "n_b", "sketch_b"), "leader")
             .select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(_possible, "a long, b long"))
    links = stored(verified(stored(first), docs))
    named = components(links)
    members = stored(shared.join(classes.select("key", "doc"), "key").select("part", "doc").distinct())
    # Merging rounds only save work: the last round looks at every possible pair that is left.
    for closest in [True] * MERGING_ROUNDS + [False]:
        labelled = stored(classes.join(named.withColumnRenamed("node", "doc"), "doc", "left").select(
            "doc", F.coalesce("component", "doc").alias("component"), "n", "sketch"))
        found = stored(across_components(members, labelled, closest))
        if found.isEmpty():
            break
        members = found.select("part", "doc").distinct()
        nearest = found.groupBy("doc").agg(F.min(F.struct("far", "a", "b")).alias("p")).select("p.*")
        more = stored(verified((nearest if closest else found).select("a", "b").distinct(), docs))
        if not more.isEmpty():
            # What hung together before is as many links as it has classes.
            named = components(more.unionByName(named.toDF("a", "b")))
    groups = classes.join(named.withColumnRenamed("node", "doc"), "doc", "left").select(
        "key", "key2", F.coalesce("component", "doc").alias("component_id"))
    out = sets.join(groups, ["key", "key2"], "left")
    alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), alone).alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with the smallest doc_id of every group alone; columns unchanged.

    Rows are judged one by one. Rows without doc_id and further rows of a repeated doc_id are compared
    like all others and come last: one stays where its group has no other row.
    """
    rows = keyed_rows(docs)
    return rows_with(rows, similar_groups(judged_rows(rows)).where("doc_id = component_id"))
