"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

A document is its token ids and one end id. Longer ones are cut into full sequences, with the short
piece first. Full pieces are sequences of their own. The rest is dealt into demes of a few thousand
pieces by a hash. Each deme lives on several islands. An individual is a partition of the deme's
pieces into bins; crossover injects whole well-filled bins of one parent into the other, removes the
bins that now hold a piece twice, and puts their other pieces back by best fit. After each epoch the
elite of every island migrates to its neighbour island of the same deme, and the best individual of
all islands is the deme's packing. A deme wastes about its last bin, so the loss does not grow with
the table.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressline.llm.storage import stored

CAPACITY = 1024
END_ID = 2
DEME_PIECES = 4096
ISLANDS, EPOCHS = 2, 2
POPULATION, GENERATIONS = 4, 8
SPECIAL = "<|endoftext|>"
LONG_RUN = 100_000
"""White space of this length in a row is more than the pattern engine of the fast library can walk back."""
_SPACES = re.compile(r"\s+")


def tokenizer_files() -> tuple[str, str, str]:
    """Vocabulary as JSON, the same as ranks, and its split pattern; the installed package names them."""
    import public_tokenizers
    return (public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


class Encoder:
    """Ids of the JSON vocabulary. Its ranks are read by the faster of two libraries, which gives the
    same ids; a text with a special string or very long white space goes to the library that the JSON
    file is made for."""

    def __init__(self, files: tuple[str, str, str]) -> None:
        import tiktoken
        self.json, ranks, pattern = files
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=pattern, mergeable_ranks=table,
                                      special_tokens={})
        self.whole = None

    def __call__(self, text: str) -> list[int]:
        if SPECIAL not in text and (len(text) < LONG_RUN or all(
                m.end() - m.start() < LONG_RUN for m in _SPACES.finditer(text))):
            return self.fast.encode_ordinary(text)
        if self.whole is None:
            from tokenizers import Tokenizer
            self.whole = Tokenizer.from_file(self.json)
        return self.whole.encode(text, add_special_tokens=False).ids


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; a short piece comes first."""
    first = n % capacity if n > capacity else n
    edges = ([0, first] if first else [0]) + list(range(first + capacity, n + 1, capacity))
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def pieces(docs: DataFrame, files: tuple[str, str, str], capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document (schema ``PIECES``), from one scan."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(files)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.array([*encode(text.as_py() or ""), END_ID], dtype="<u4")
                rows += [(doc_id, k, a, n, zlib.crc32(ids[a:a + n].tobytes()))
                         for k, (a, n) in enumerate(cut(len(ids), capacity))]
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


# --- one deme ---------------------------------------------------------------------------------------

def best_fit(sizes: np.ndarray, order: np.ndarray, bins: np.ndarray, room: list[int],
             capacity: int) -> None:
    """Put the pieces of ``order`` one by one into the fullest bin that takes them; changes all."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0
    for k, r in enumerate(room):
        if r > 0:
            by_room[r].append(k)
            open_rooms |= 1 << r
    for i in order.tolist():
        size = int(sizes[i])
        fits = open_rooms >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            k = by_room[r].pop()
            if not by_room[r]:
                open_rooms &= ~(1 << r)
        else:
            r, k = capacity, len(room)
            room.append(capacity)
        r -= size
        bins[i], room[k] = k, r
        if r:
            by_room[r].append(k)
            open_rooms |= 1 << r


def fresh(sizes: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    """A packing of all pieces by best fit in the given order."""
    bins = np.full(len(sizes), -1, dtype=np.int32)
    best_fit(sizes, order, bins, [], capacity)
    return bins


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins are better; of equally many, those with the more uneven fill."""
    fill = np.bincount(bins, weights=sizes) / capacity
    fill = fill[fill > 0]
    return -len(fill), float((fill ** 2).sum())


def crossover(sizes: np.ndarray, taker: np.ndarray, giver: np.ndarray, capacity: int,
              rng: np.random.Generator) -> np.ndarray:
    """``taker`` with some well-filled bins of ``giver`` in it."""
    fill = np.bincount(giver, weights=sizes)
    full = np.flatnonzero(fill >= 0.98 * capacity)
    if not len(full):
        full = np.array([fill.argmax()])
    chosen = np.zeros(len(fill), dtype=bool)
    chosen[rng.choice(full, max(1, len(full) // 4), replace=False)] = True
    injected = chosen[giver]
    hit = np.zeros(taker.max() + 1, dtype=bool)
    hit[taker[injected]] = True
    # The worst bins go too, so that best fit has something to work with.
    own = np.bincount(taker, weights=sizes)
    hit[np.argsort(own)[:max(1, len(own) // 50)]] = True
    loose = hit[taker] & ~injected
    label = np.where(injected, len(hit) + giver, taker)
    label[loose] = -1
    placed = label >= 0
    out = np.full(len(sizes), -1, dtype=np.int32)
    _, out[placed] = np.unique(label[placed], return_inverse=True)
    room = (capacity - np.bincount(out[placed], weights=sizes[placed])).astype(int).tolist()
    order = np.flatnonzero(loose)
    best_fit(sizes, order[np.argsort(-sizes[order], kind="stable")], out, room, capacity)
    return out


def evolve(sizes: np.ndarray, seed: int, settlers: list[np.ndarray], capacity: int) -> np.ndarray:
    """One epoch of one island; the elite (the first, never worse than any settler) comes back."""
    rng = np.random.default_rng(seed)
    people = list(settlers)
    if not people:
        people.append(fresh(sizes, np.argsort(-sizes, kind="stable"), capacity))
    while len(people) < POPULATION:
        order = np.argsort(-sizes * rng.uniform(0.9, 1.1, len(sizes)), kind="stable")
        people.append(fresh(sizes, order, capacity))
    people.sort(key=lambda b: fitness(sizes, b, capacity), reverse=True)
    bound = -(-int(sizes.sum()) // capacity)
    for _ in range(GENERATIONS):
        if -fitness(sizes, people[0], capacity)[0] <= bound:
            break
        a, b = sorted(rng.choice(len(people), 2, replace=False))
        taker, giver = (people[a], people[b]) if rng.random() < 0.5 else (people[b], people[a])
        people.append(crossover(sizes, taker, giver, capacity, rng))
        people.sort(key=lambda x: fitness(sizes, x, capacity), reverse=True)
        del people[POPULATION:]
    return people[0]


# --- demes and islands as Spark jobs ------------------------------------------------------------------

ORDER = ["length", "doc_id", "piece", "start", "ids_crc32"]
ELITE = "deme long, island int, bins binary, score_bins long, score_fill double"


def island_step(epoch: int, capacity: int):
    """A cogroup function: the pieces of a deme and the settlers of one island give one elite row."""
    def run(key: tuple, rows: pd.DataFrame, settlers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=["deme", "island", "bins", "score_bins", "score_fill"])
        sizes = rows.sort_values(ORDER)["length"].to_numpy(np.int64)
        own = [np.frombuffer(x, dtype=np.int32) for x in settlers.get("bins", [])]
        deme, island = int(key[0]), int(key[1])
        bins = evolve(sizes, (deme * ISLANDS + island) * EPOCHS + epoch, own, capacity)
        n, fill = fitness(sizes, bins, capacity)
        return pd.DataFrame({"deme": [deme], "island": [island],
                             "bins": [bins.astype(np.int32).tobytes()],
                             "score_bins": [-n], "score_fill": [fill]})
    return run


PACKED = PIECES + ", sequence_id long, offset long"


def _settle(key: tuple, rows: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(ORDER)
    rows["bin"] = np.frombuffer(best["bins"].iloc[0], dtype=np.int32)
    rows = rows.sort_values(["bin", *ORDER])
    before = rows.groupby("bin")["length"].cumsum() - rows["length"]
    return rows.drop(columns=["deme", "bin"]).assign(
        sequence_id=int(key[0]) * (DEME_PIECES * 4) + rows["bin"].to_numpy(np.int64),
        offset=before.to_numpy(np.int64))


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` of pieces (stored, schema ``PIECES``) with sequence_id and offset."""
    small = rows.where(F.col("length") < capacity)
    total = small.count()
    demes = max(1, total // DEME_PIECES)
    deme = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(demes))
    # Rows that repeat would all meet in one deme; their own number spreads them.
    deme = F.pmod(deme + F.shiftright(F.monotonically_increasing_id(), 4), F.lit(demes))
    dealt = stored(small.withColumn("deme", deme))
    elite = None
    for epoch in range(EPOCHS):
        islands = dealt.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
        if elite is None:
            settlers = dealt.sparkSession.createDataFrame([], ELITE)
        else:
            away = elite.withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)))
            settlers = elite.unionByName(away)
        elite = stored(islands.groupBy("deme", "island").cogroup(settlers.groupBy("deme", "island"))
                       .applyInPandas(island_step(epoch, capacity), ELITE))
    best = elite.groupBy("deme").agg(F.min_by("bins", F.struct(
        "score_bins", -F.col("score_fill"), "island")).alias("bins"))
    packed = dealt.groupBy("deme").cogroup(best.groupBy("deme")).applyInPandas(_settle, PACKED)
    alone = rows.where(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def packed_documents(docs: DataFrame, files: tuple[str, str, str] | None = None,
                     capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is an empty one, which is its end id alone. Rows that repeat are packed as often as
    they come, rows without doc_id too. An empty table gives no rows. Other columns are never read.
    """
    return pack(stored(pieces(docs, files or tokenizer_files(), capacity)), capacity)
