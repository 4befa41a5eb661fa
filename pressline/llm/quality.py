"""Quality classifier: random-indexing word vectors, pooled per document, and a small numpy network.

A text is read as tokens: words without case, runs of equal marks, and signs of form (a word in
capitals, a word in capitals at its start, the word before once more). A token is known by its 64-bit
hash, and the hash alone gives its sparse ternary index vector, so the vocabulary has no fixed size.
A word's vector is the sum of the index vectors of its neighbours over all documents of the corpus,
added up per group of documents first and per range of hashes in Spark then, which sends the sums
back to the groups that hold the words, never by broadcast. A document is the mean and the spread of its tokens'
vectors, with the shares of the signs and its length. A network of two layers, trained on labelled
rows, maps that to a logit, and one temperature, fitted on labelled rows that the training has not
seen, calibrates it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pressline.llm.hashing import chunks, mix, span_hashes, texts_of, word_spans, LOWER
from pressline.llm.storage import folders_noted, freed, judged_rows, keyed_rows, rows_with, stored
from pressline.llm.toxicity import remainder

SIZE, NONZERO = 24, 4
SIGNS = 4
"""The keys 0 to 3 belong to the signs: capitals, capital at start, repeat, line end."""
REACH = 2
FEATURES = 2 * SIZE + SIGNS + 2
GROUP_BYTES = 32 << 20
"""Documents share one list of words up to about this many bytes; it only sets how often a word is sent."""
RUN_BYTES = 1 << 18
"""Texts are read in runs of about this many bytes; one longer text is a run."""
BUCKET_BITS = 10
"""Words whose hashes share their first bits are added up together; this only sets the size of one step."""
SAMPLE_ROWS = 40_000
"""At most this many labelled rows are fitted, chosen by a hash of their id."""


def index_vectors(keys: np.ndarray) -> np.ndarray:
    """One sparse random vector of +1 and -1 per key, the same everywhere."""
    salts = mix(np.arange(1, SIZE + 1, dtype=np.uint64))
    order = mix(mix(keys)[:, None] ^ salts)
    places = np.argpartition(order, NONZERO, axis=1)[:, :NONZERO]
    out = np.zeros((len(keys), SIZE), dtype=np.int8)
    signs = (np.take_along_axis(order, places, axis=1) & np.uint64(1)).astype(np.int8) * 2 - 1
    np.put_along_axis(out, places, signs, axis=1)
    return out


def _classes() -> np.ndarray:
    """byte -> 0 white, 1 word, 2 mark."""
    out = np.full(256, 2, dtype=np.uint8)
    out[:33] = 0
    out[48:58] = out[65:91] = out[97:123] = 1
    out[128:] = 1
    return out


CLASSES = _classes()


def tokens(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, key of every token, text of every token), chunk by chunk."""
    for first, data, bounds in chunks(texts):
        kind = CLASSES[data]
        starts, ends = word_spans(data, CLASSES != 1)
        lower = LOWER[data]
        key = span_hashes(lower, starts, ends)
        upper = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
        capitals = upper[ends] - upper[starts]
        first_up = (upper[starts + 1] - upper[starts]) if len(starts) else capitals
        mark_new = (kind == 2) & (np.concatenate(([0], data[:-1])) != data)
        marks = np.flatnonzero(mark_new)
        mark_key = mix(data[marks].astype(np.uint64) + np.uint64(7))
        lines = np.flatnonzero(data == 10)
        same = np.zeros(len(key), dtype=bool)
        same[1:] = key[1:] == key[:-1]
        all_up = (capitals > 1) & (capitals * 2 > ends - starts)
        title = (first_up == 1) & ~all_up
        # A sign stands just before its word: places are doubled to make room.
        place = np.concatenate([starts * 4 + 3, starts[all_up] * 4 + 1, starts[title] * 4 + 1,
                                starts[same] * 4 + 2, marks * 4 + 3, lines * 4])
        sign = np.repeat(np.arange(SIGNS, dtype=np.uint64), [all_up.sum(), title.sum(), same.sum(), len(lines)])
        early = len(sign) - len(lines)
        value = np.concatenate([key, sign[:early], mark_key, sign[early:]])
        order = np.argsort(place, kind="stable")
        owner = np.searchsorted(bounds, place[order] // 4, side="right") - 1
        yield first, value[order], owner


def neighbour_sums(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, sum of the index vectors of all their neighbours, distinct key of every token)."""
    words, local = np.unique(key, return_inverse=True)
    own = index_vectors(words)[local]
    near = np.zeros_like(own)
    for k in range(1, min(REACH, len(key) - 1) + 1):
        one = (owner[k:] == owner[:-k])[:, None].astype(np.int8)
        near[:-k] += own[k:] * one
        near[k:] += own[:-k] * one
    n = np.bincount(local, minlength=len(words))
    sums = np.add.reduceat(near[np.argsort(local, kind="stable")], np.cumsum(n) - n, axis=0, dtype=np.int32)
    return words, sums, local


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers of any size, exactly: bytes of the same place lie together and are coded by frequency."""
    x = numbers.astype(np.int64).ravel()
    folded = (x << 1) ^ (x >> 63)
    width = max(1, (int(folded.view(np.uint64).max(initial=0)).bit_length() + 7) // 8)
    planes = folded.view(np.uint8).reshape(-1, 8)[:, :width].T
    coder = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return bytes([width]) + coder.compress(planes.tobytes()) + coder.flush()


def unpacked(data: bytes) -> np.ndarray:
    """The numbers of ``packed``."""
    planes = np.frombuffer(zlib.decompress(memoryview(data)[1:]), dtype=np.uint8).reshape(data[0], -1)
    folded = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    folded[:, :data[0]] = planes.T
    x = folded.view(np.uint64).ravel()
    return (x >> np.uint64(1)).view(np.int64) ^ -(x & np.uint64(1)).view(np.int64)


def lowest_key(bucket: int | np.ndarray) -> np.ndarray:
    """The lowest key of a bucket."""
    return np.asarray(bucket).astype(np.uint64) << np.uint64(64 - BUCKET_BITS)


WORDS_AND_TEXTS = ("part long, bucket int, keys binary, sums binary, ids array<long>, sizes binary, "
                   "lengths binary, words binary, counts binary, first binary")


def words_and_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of some texts each: a row per bucket of its distinct words with their sums, and rows of texts.

    A bucket holds the sorted keys that begin with its bits, written as steps. A text has the numbers of its distinct words
    among the sorted keys of the part, written as steps, and counts; ``first`` has the first keys.
    """
    part = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    ids, sizes, found, held = [], [], [], 0
    names = [c.split()[0] for c in WORDS_AND_TEXTS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), *[pa.binary()] * 5]

    def record(n: int, **columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds)], names)

    def flush() -> Iterator[pa.RecordBatch]:
        every = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *[f[0] for f in found]]))
        sums = np.zeros((len(every), SIZE), dtype=np.int32)
        lists = [[np.zeros(0, dtype=np.uint32)] for _ in range(3)]
        found.reverse()
        while found:
            key, near, *own = found.pop()
            to = np.searchsorted(every, key)
            sums[to] += near
            own[1] = to.astype(np.uint32)[own[1]]
            for x, y in zip(lists, own):
                x.append(y)
        owner, flat, n = map(np.concatenate, lists)
        cut = np.append(np.searchsorted(every, lowest_key(np.arange(1 << BUCKET_BITS))), len(every))
        full = np.flatnonzero(np.diff(cut))
        spans = [slice(*cut[b:b + 2]) for b in full]
        yield record(len(full), part=[part] * len(full), bucket=full,
                     keys=[packed(np.diff(every[x], prepend=lowest_key(b))) for b, x in zip(full, spans)],
                     sums=[packed(sums[x]) for x in spans])
        ends = np.searchsorted(owner, np.arange(len(sizes) + 1, dtype=np.uint32))
        for at in range(0, len(sizes), 1000):
            to = min(at + 1000, len(sizes))
            x = slice(ends[at], ends[to])
            yield record(1, part=[part], ids=[ids[at:to]], sizes=[packed(np.array(sizes[at:to]))],
                         lengths=[packed(np.diff(ends[at:to + 1]))],
                         words=[packed(np.diff(flat[x].astype(np.int64), prepend=0))],
                         counts=[packed(n[x])], first=[every[:SIGNS].tobytes()])

    for batch in batches:
        texts, own = texts_of(batch.column("text")), batch.column("doc_id").to_pylist()
        done = 0
        # A part may end inside a batch, so texts are taken in runs.
        while done < len(texts):
            stop, n = done, 0
            while stop < len(texts) and (n == 0 or n + len(texts[stop]) <= RUN_BYTES):
                n += len(texts[stop]) + 1
                stop += 1
            for first, key, owner in tokens(texts[done:stop]):
                if len(key):
                    words, near, local = neighbour_sums(key, owner)
                    code, count = np.unique((len(sizes) + first + owner).astype(np.uint64) << np.uint64(32)
                                            | local.astype(np.uint64), return_counts=True)
                    small = np.abs(near).max() < 1 << 15
                    found.append((words, near.astype(np.int16) if small else near,
                                  (code >> np.uint64(32)).astype(np.uint32), code.astype(np.uint32),
                                  count.astype(np.uint32)))
            ids.extend(own[done:stop])
            sizes.extend(len(x) for x in texts[done:stop])
            held, done = held + n, stop
            if held > GROUP_BYTES:
                yield from flush()
                part, held = part + 1, 0
                for x in (ids, sizes):
                    x.clear()
    if sizes:
        yield from flush()


def added_up(parts: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(distinct keys, their sums over all rows, places of each row's keys) of the rows of one bucket."""
    low = lowest_key(parts.column("bucket")[0].as_py())
    keys = [low + np.cumsum(unpacked(k)).astype(np.uint64) for k in parts.column("keys").to_pylist()]
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros((len(every), SIZE), dtype=np.int64)
    places = np.split(at, np.cumsum([len(k) for k in keys])[:-1])
    for to, own in zip(places, parts.column("sums").to_pylist()):
        sums[to] += unpacked(own).reshape(-1, SIZE)
    return every, sums, places


def word_vectors(parts: DataFrame) -> DataFrame:
    """(key, vector): the neighbour sums of every distinct word of the corpus."""
    def run(rows: pa.Table) -> pa.Table:
        every, sums, _ = added_up(rows)
        flat = pa.array(sums.ravel().astype(np.float32))
        vectors = pa.ListArray.from_arrays(np.arange(len(every) + 1, dtype=np.int32) * SIZE, flat)
        return pa.table({"key": every.view(np.int64), "vector": vectors})

    return parts.where("bucket IS NOT NULL").select("bucket", "keys", "sums").groupBy("bucket").applyInArrow(
        run, "key long, vector array<float>")


def sent_back(words: DataFrame) -> DataFrame:
    """(part, bucket, vectors): for each bucket of a part the corpus sums of its words, in the order of their keys."""
    def run(rows: pa.Table) -> pa.Table:
        _, sums, places = added_up(rows)
        return pa.table({"part": rows.column("part"), "bucket": rows.column("bucket"),
                         "vectors": pa.array([packed(sums[to]) for to in places], pa.binary())})

    return words.select("part", "bucket", "keys", "sums").groupBy("bucket").applyInArrow(
        run, "part long, bucket int, vectors binary")


def pooled(texts: pa.Table, table: pa.Table) -> pa.Table:
    """Mean and standard deviation of the token vectors, sign shares, log length, tokens per byte.

    ``texts`` and ``table`` are the texts and the words of one part; a text without tokens is zero.
    """
    blobs = table.column("vectors").to_pylist()
    parts = [unpacked(blobs[i]).astype(np.float32) for i in np.argsort(table.column("bucket").to_numpy())]
    vectors = np.concatenate([np.zeros(0, dtype=np.float32), *parts]).reshape(-1, SIZE)
    del parts, blobs
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    both = np.zeros((len(vectors), 2 * SIZE + SIGNS), dtype=np.float32)
    np.divide(vectors, np.where(norm > 0, norm, 1), out=both[:, :SIZE])
    del vectors
    np.square(both[:, :SIZE], out=both[:, SIZE:2 * SIZE])
    ids, out = [], []
    for block in texts.to_pylist():
        first = np.frombuffer(block["first"], dtype=np.uint64)
        both[:len(first), 2 * SIZE:] = first[:, None] == np.arange(SIGNS, dtype=np.uint64)
        sizes, lengths, steps, counts = (unpacked(block[c]) for c in ("sizes", "lengths", "words", "counts"))
        words, ends = np.cumsum(steps), np.cumsum(lengths)
        some = np.zeros((len(sizes), FEATURES), dtype=np.float32)
        for i in np.flatnonzero(lengths):
            x = slice(ends[i] - lengths[i], ends[i])
            n = counts[x].astype(np.float32)
            total = n.sum(dtype=np.float64)
            sums = (n @ both[words[x]]) / np.float32(total)
            mean = sums[:SIZE]
            some[i, :SIZE] = mean
            some[i, SIZE:2 * SIZE] = np.sqrt(np.maximum(sums[SIZE:2 * SIZE] - mean ** 2, 0))
            some[i, 2 * SIZE:-2] = sums[2 * SIZE:]
            some[i, -2:] = np.log1p(total), total / max(sizes[i], 1)
        ids.extend(block["ids"])
        out.append(some)
    flat = np.concatenate([np.zeros((0, FEATURES), dtype=np.float32), *out])
    rows = pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * FEATURES, pa.array(flat.ravel()))
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "features": rows})


@dataclass
class QualityModel:
    """Scaling, both layers and the temperature."""

    centre: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        hidden = np.maximum(((x - self.centre) / self.spread) @ w1 + b1, 0)
        return (hidden @ w2 + b2)[:, 0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60,
                seed: int = 5) -> QualityModel:
    """Two layers, Adam on the log loss, small weight decay."""
    spread = x.std(axis=0) if len(x) else np.ones(x.shape[1])
    model = QualityModel(x.mean(axis=0) if len(x) else np.zeros(x.shape[1]),
                         np.where(spread > 1e-9, spread, 1), [])
    rng = np.random.default_rng(seed)
    model.layers = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden),
                    rng.normal(0, hidden ** -0.5, (hidden, 1)), np.zeros(1)]
    if len(x) == 0:
        model.layers[2][:] = 0
        return model
    scaled = (x - model.centre) / model.spread
    first, second = ([np.zeros_like(p) for p in model.layers] for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at:at + 256]
            w1, b1, w2, b2 = model.layers
            pre = scaled[rows] @ w1 + b1
            h = np.maximum(pre, 0)
            p = 1 / (1 + np.exp(-np.clip((h @ w2 + b2)[:, 0], -30, 30)))
            out = ((p - y[rows]) / len(rows))[:, None]
            back = (out @ w2.T) * (pre > 0)
            grads = [scaled[rows].T @ back + 1e-4 * w1, back.sum(axis=0),
                     h.T @ out + 1e-4 * w2, out.sum(axis=0)]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.layers[k] = model.layers[k] - 3e-3 * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on unseen rows."""
    if not len(y):
        return 1.0
    def loss(t: float) -> float:
        z = logits / t
        return float(np.mean(np.logaddexp(0, z) - y * z))
    return float(min(np.geomspace(0.25, 8, 61), key=loss))


def document_vectors(docs: DataFrame) -> DataFrame:
    """(doc_id, features) of every row: each part's texts meet the vectors of the words they hold."""
    rows = docs.select("doc_id", "text").mapInArrow(words_and_texts, WORDS_AND_TEXTS)
    with folders_noted() as made:
        parts = stored(rows.withColumn("is_word", F.col("bucket").isNotNull()), by="is_word")
    table = stored(sent_back(parts.where("is_word")))
    # The sums of the parts are in the table now; they are the largest thing stored here.
    freed(docs.sparkSession, [f"{made[0]}/is_word=true"])
    texts = parts.where("NOT is_word").select("part", "ids", "sizes", "lengths", "words", "counts", "first")
    return texts.groupBy("part").cogroup(table.groupBy("part")).applyInArrow(
        pooled, "doc_id long, features array<float>")


def train(features: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    """Fit on at most SAMPLE_ROWS labelled rows of remainder 1 to 4; remainder 4 sets the temperature."""
    own = (labels.where(f"{label} IS NOT NULL AND doc_id IS NOT NULL")
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    rows = (features.join(own, "doc_id").withColumn("r", remainder(F.col("doc_id"))).where("r <> 0")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
            .select("features", "label", "r").toArrow())
    x = np.array(rows.column("features").to_pylist(), dtype=np.float64).reshape(-1, FEATURES)
    y = rows.column("label").to_numpy().astype(float)
    unseen = rows.column("r").to_numpy() == 4
    model = fit_network(x[~unseen], y[~unseen])
    model.temperature = fit_temperature(model.logits(x[unseen]), y[unseen])
    return model


def scored(features: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) from stored features."""
    shared = features.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            p = shared.value.probabilities(flat.reshape(-1, FEATURES).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    return features.mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; predicted is score >= 0.3.

    Null and empty texts have the features of a text without tokens. Repeated rows and rows without
    doc_id (held out) are scored like all others. Without labelled rows every score is 0.5. Other
    columns of ``docs`` are never read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    features = stored(document_vectors(docs))
    out = scored(features, train(features, labels, label))
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(True)).alias("held_out"),
                      "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def drop_poor(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``docs`` without the documents that the classifier rejects; columns unchanged.

    Every row is kept or rejected by its own score, whether its doc_id is missing or repeated or not.
    """
    rows = keyed_rows(docs, labels)
    return rows_with(rows, quality(judged_rows(rows), labels, label).where("predicted = 1"))
