"""Language of every document by averaged hashed subword embeddings and a linear softmax.

A text is the bag of the byte n-grams (one to four bytes) of its words, with the word borders as marks.
Every n-gram is hashed to one of BUCKETS embeddings, the embeddings are averaged over the whole text, and
a linear layer with softmax gives a probability per language. Embeddings and layer are trained together
by stochastic gradient descent in numpy on a bounded sample of labelled rows. A temperature, fitted on
sampled rows that the training has not seen, calibrates the probabilities, and on the same rows the
least score is found from which on the answers are as right as wanted: below it an answer is rejected.

Averaging and the layer are both linear, so for scoring the layer is applied to the embeddings once: a
text is the mean of one row of logits per n-gram. Counting n-grams never leaves the task of the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressline.llm.hashing import LOWER, chunks, texts_of

BUCKETS, SIZE, ORDERS = 1 << 15, 16, (1, 2, 3, 4)
SAMPLE_ROWS = 3_000
"""About this many labelled rows are fitted, in equal parts of all languages, chosen by a hash of their id."""
LANGUAGES = 400
"""The most frequent languages that are learned; a bound on what the model and the driver hold."""
UNKNOWN = "und"
RIGHT = 0.995
"""Share of right answers among accepted ones on the calibration rows."""


def _letters() -> np.ndarray:
    """byte -> 0 for word borders, else a code above 0: ASCII letters and all bytes beyond ASCII."""
    out = np.zeros(256, dtype=np.uint32)
    out[97:123] = np.arange(1, 27)
    out[128:] = np.arange(27, 155)
    return out


LETTERS = _letters()


def subwords(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, buckets) of the n-grams of each order; a border stands only at the ends of an n-gram."""
    code = LETTERS[LOWER[data]]
    inner = code > 0
    value = np.zeros(len(code), dtype=np.uint32)
    fits = np.ones(len(code), dtype=bool)
    for order in range(1, max(ORDERS) + 1):
        # One code more: the last one so far is inside now, unless it is the first.
        value = value[:len(code) - order + 1] * np.uint32(0x01000193) + code[order - 1:] + np.uint32(1)
        fits = fits[:len(code) - order + 1]
        if order > 2:
            fits = fits & inner[order - 2:len(code) - 1]
        if order in ORDERS:
            some = inner if order == 1 else fits & (inner[:len(fits)] | inner[order - 1:])
            at = np.flatnonzero(some)
            h = value[at] + np.uint32(order * 0x3C6EF372 & 0xFFFFFFFF)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            h ^= h >> np.uint32(12)
            h *= np.uint32(0x297A2D39)
            yield at, (h >> np.uint32(17)).astype(np.int32) & (BUCKETS - 1)


def bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, salt, buckets, counts) of each text: its distinct buckets and how often each comes."""
    for batch in batches:
        lang, salt = batch.column("lang").to_pylist(), batch.column("salt").to_pylist()
        for k, text in enumerate(texts_of(batch.column("text"))):
            data = np.frombuffer(b" " + text + b" ", dtype=np.uint8)
            n = np.bincount(np.concatenate([b for _, b in subwords(data)]), minlength=BUCKETS)
            own = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang[k]]), pa.array([salt[k]], pa.int64()),
                 pa.array([own.astype(np.uint16).tobytes()]), pa.array([n[own].astype(np.uint32).tobytes()])],
                ["lang", "salt", "buckets", "counts"])


@dataclass
class LanguageModel:
    """The languages, the logits of every bucket, the temperature and the least accepted score."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        z = (means + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_classes: int, epochs: int = 6,
        rate: float = 4.0, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embeddings, layer, bias) after stochastic gradient descent on the log loss of averaged embeddings."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32)
    layer = rng.normal(0, 0.1, (SIZE, n_classes)).astype(np.float32)
    bias = np.zeros(n_classes, dtype=np.float32)
    some = [k for k, (buckets, _) in enumerate(texts) if len(buckets)]
    steps, step = epochs * -(-len(some) // 8), 0
    for _ in range(epochs):
        order = rng.permutation(some)
        for at in range(0, len(order), 8):
            rows = order[at:at + 8]
            pace = np.float32(rate * (1 - step / steps) + 0.01)
            step += 1
            index = [texts[k][0] for k in rows]
            share = [(texts[k][1] / texts[k][1].sum())[:, None].astype(np.float32) for k in rows]
            mean = np.stack([(s * embed[i]).sum(axis=0) for i, s in zip(index, share)])
            z = mean @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            back = p @ layer.T
            layer -= pace / len(rows) * (mean.T @ p)
            bias -= np.float32(0.1) * pace / len(rows) * p.sum(axis=0)
            for i, s, b in zip(index, share, back):
                # Buckets of one text are distinct, so plain indexing adds each once.
                embed[i] -= pace * s * b
    return embed, layer, bias


def fit_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on unseen rows."""
    def loss(t: float) -> float:
        s = z / t
        top = s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s - top).sum(axis=1)) + top[:, 0] - s[np.arange(len(y)), y]))
    return float(min(np.geomspace(0.02, 8, 61), key=loss)) if len(y) else 1.0


def least_score(score: np.ndarray, right: np.ndarray, wanted: float) -> float:
    """The least score such that of the answers from it on the wanted share is right; 0 if all may stay."""
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    # Equal scores are accepted together.
    ends = np.flatnonzero(np.concatenate((score[order][1:] != score[order][:-1], [True]))) if len(order) else []
    good = [e for e in ends if share[e] >= wanted]
    if not len(order) or good and good[-1] == len(order) - 1:
        return 0.0
    return float(score[order][good[-1]]) if good else float(np.nextafter(score.max(), 2))


def train(docs: DataFrame) -> LanguageModel | None:
    """Fit on about SAMPLE_ROWS rows of ``docs`` (doc_id, text, lang); None if no row has a language.

    Of the sampled rows every fifth, by the hash, sets the temperature and the least accepted score.
    """
    labelled = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    counts = (labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect())
    if not counts:
        return None
    languages = sorted(r["lang"] for r in counts)
    quota = max(1, SAMPLE_ROWS // len(languages))
    unit = 1 << 40
    below = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(unit, unit * quota // r["n"] + 1))])
    sample = (labelled.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(unit)))
              .where(F.col("salt") < F.try_element_at(below, F.col("lang")))
              .select("doc_id", "lang", "salt", "text").dropDuplicates(["doc_id"]))
    rows = sample.select("lang", "salt", "text").mapInArrow(
        bags, "lang string, salt long, buckets binary, counts binary").limit(4 * SAMPLE_ROWS).toArrow()
    order = np.lexsort((np.array(rows.column("lang").to_pylist(), dtype=object).astype(str),
                        rows.column("salt").to_numpy()))
    number = {x: k for k, x in enumerate(languages)}
    texts = [(np.frombuffer(rows.column("buckets")[int(k)].as_py(), dtype=np.uint16).astype(np.int64),
              np.frombuffer(rows.column("counts")[int(k)].as_py(), dtype=np.uint32)) for k in order]
    y = np.array([number[rows.column("lang")[int(k)].as_py()] for k in order], dtype=np.int64)
    unseen = np.arange(len(y)) % 5 == 4
    embed, layer, bias = fit([t for t, u in zip(texts, unseen) if not u], y[~unseen], len(languages))
    model = LanguageModel(languages, embed @ layer, bias)
    calm = [(t, c) for t, c, u in zip(texts, y, unseen) if u and len(t[0])]
    z = np.array([(n[:, None] / n.sum() * model.logits[b]).sum(axis=0) + bias for (b, n), _ in calm]).reshape(
        -1, len(languages))
    own = np.array([c for _, c in calm], dtype=np.int64)
    model.temperature = fit_temperature(z, own)
    p = model.probabilities(z - bias) if len(z) else z
    model.least = least_score(p.max(axis=1), p.argmax(axis=1) == own, RIGHT) if len(z) else 0.0
    return model


def score_batch(model: LanguageModel, texts: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language, score) of each text; UNKNOWN and 0 where ``letters`` is False."""
    table, names = model.logits.astype(np.float32), np.array(model.languages, dtype=object)
    step = max(1, (1 << 22) // len(names))
    sums, total = np.zeros((len(texts), len(names))), np.zeros(len(texts))
    for first, data, bounds in chunks(texts_of(texts)):
        # The space behind each text parts it from the next; one is put before the first.
        data = np.concatenate((np.array([32], dtype=np.uint8), data))
        for at, bucket in subwords(data):
            owner = np.searchsorted(bounds, np.maximum(at - 1, 0), side="right") - 1
            # An n-gram that begins with the space between two texts belongs to the second one.
            owner += (at == bounds[owner + 1]) & (at > 0)
            for a in range(0, len(owner), step):
                own = owner[a:a + step]
                cut = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                who = first + own[cut]
                sums[who] += np.add.reduceat(table[bucket[a:a + step]], cut, axis=0, dtype=np.float64)
                total[who] += np.diff(np.append(cut, len(own)))
    p = model.probabilities(sums / np.maximum(total, 1)[:, None])
    return np.where(letters, names[p.argmax(axis=1)], UNKNOWN), np.where(letters, p.max(axis=1), 0.0)


def scored(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) from (doc_id, text, letters)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            name, score = score_batch(shared.value, batch.column("text"), letters)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(name, pa.string()), pa.array(score),
                 pa.array(letters & (score >= shared.value.least))], ["doc_id", "lang_pred", "score", "accepted"])

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")


def remainder(doc_id: Column, parts: int = 3) -> Column:
    return F.crc32(doc_id.cast("string")) % parts


def language_id(docs: DataFrame, reject: bool = True, held_out: int = 1, parts: int = 3) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) for every row of ``docs`` (doc_id, text, lang).

    Rows whose CRC leaves ``held_out`` are never learned from. A text without a letter, an empty or null
    one, and every text where nothing could be learned is "und" with score 0. With ``reject`` so is,
    keeping its score, each answer below the calibrated least score; without, ``accepted`` alone says so.
    Repeated rows and rows without doc_id (held out) are judged each by itself. Other columns are never read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    part = remainder(F.col("doc_id"), parts)
    model = train(docs.where(part != held_out))
    rows = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if model is None:
        out = rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                          F.lit(False).alias("accepted"))
    else:
        out = scored(rows, model)
    name = F.when(F.col("accepted"), F.col("lang_pred")).otherwise(UNKNOWN) if reject else F.col("lang_pred")
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id"), parts) == held_out, F.lit(True)).alias(
        "held_out"), name.alias("lang_pred"), "score", "accepted")
