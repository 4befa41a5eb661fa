"""Toxicity by two Kneser-Ney letter models that share their lower orders.

Texts become strings of 32 symbols (letters without case, one symbol for everything between words,
digits, marks, and folded bytes beyond ASCII). A toxic and an ordinary model of order five are
counted from labelled rows. Both back off to the same Kneser-Ney model of orders one to four, made
from the continuation counts of all documents, so an expression that neither class has seen says
nothing, and a rare one says little. A text's evidence is the difference of both log-likelihoods per
symbol; a logistic curve that was fitted on labelled rows which the counts have not seen turns it
into a score.

The models hold at most 32**5 entries whatever the corpus, which bounds what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressline.llm.hashing import chunks, texts_of

ORDER = 5
BITS = 5
GRAMS = 1 << (ORDER * BITS)
FOLDS = 5
STRETCH = 12
PLAIN_CURVE = np.array([1.0, 1.0, 0.0, 0.0])
BROADCAST_LABELS = 2_000_000
"""Label tables up to this many rows are broadcast; larger ones are joined by a shuffle."""


def _symbols() -> np.ndarray:
    """byte -> symbol: 0 between words, 1-26 letters, 27 digits, 28 marks, 29-31 lead bytes."""
    out = np.zeros(256, dtype=np.uint8)
    out[33:127] = 28
    out[48:58] = 27
    out[65:91] = out[97:123] = np.arange(1, 27)
    out[0x80:0xC0] = 1 + np.arange(64) * 11 % 26
    out[0xC0:] = 29 + np.arange(64) % 3
    return out


SYMBOLS = _symbols()


def grams(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, order-five gram of every symbol, text of every symbol), chunk by chunk.

    Each text is read after four symbols 0, and one symbol 0 ends it.
    """
    pad = b" " * (ORDER - 1)
    padded = [pad + t for t in texts]
    for first, data, bounds in chunks(padded):
        s = SYMBOLS[data].astype(np.uint32)
        n = len(s) - (ORDER - 1)
        g = np.zeros(max(n, 0), dtype=np.uint32)
        for k in range(ORDER):
            g = (g << np.uint32(BITS)) | s[k:k + len(g)]
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(sizes)), sizes)[:len(g)]
        inside = np.arange(len(g)) + (ORDER - 1) < bounds[owner + 1]
        yield first, g[inside], owner[inside]


def count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, toxic, ordinary, other): how often each gram stands in texts of each class."""
    kept = [np.zeros(0, dtype=np.uint32), np.zeros((0, 3), dtype=np.int64)]
    fresh: list[np.ndarray] = []

    def settle() -> None:
        if not fresh:
            return
        keys = np.concatenate(fresh)
        fresh.clear()
        keys, n = np.unique(keys, return_counts=True)
        gram, kind = (keys >> np.uint64(2)).astype(np.uint32), (keys & np.uint64(3)).astype(int)
        every = np.union1d(kept[0], gram)
        sums = np.zeros((len(every), 3), dtype=np.int64)
        sums[np.searchsorted(every, kept[0])] = kept[1]
        np.add.at(sums, (np.searchsorted(every, gram), kind), n)
        kept[:] = [every, sums]

    held = 0
    for batch in batches:
        kind = np.array(batch.column("kind").to_pylist(), dtype=np.uint64)
        texts = texts_of(batch.column("text"))
        for first, g, owner in grams(texts):
            fresh.append((g.astype(np.uint64) << np.uint64(2)) | kind[first + owner])
            held += len(g)
            if held > 4_000_000:
                settle()
                held = 0
    settle()
    for at in range(0, len(kept[0]), 100_000):
        part = slice(at, at + 100_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept[0][part].astype(np.int64)), *[pa.array(np.ascontiguousarray(kept[1][part, k]))
                                                        for k in range(3)]],
            ["gram", "toxic", "ordinary", "other"])


COUNTS = "gram long, toxic long, ordinary long, other long"


def discount(counts: np.ndarray) -> float:
    """The usual estimate n1 / (n1 + 2 n2), kept away from 0 and 1."""
    one, two = (counts == 1).sum(), (counts == 2).sum()
    return float(np.clip(one / max(one + 2 * two, 1), 0.1, 0.9))


def shared_probabilities(gram: np.ndarray) -> np.ndarray:
    """Kneser-Ney probability of the last symbol of each distinct order-five gram, orders one to four.

    ``gram`` must be sorted and distinct. Lower orders count distinct continuations, not occurrences.
    """
    p = np.full(len(gram), 1 / 32)
    for order in range(1, ORDER):
        low = gram & np.uint32((1 << (order * BITS)) - 1)
        kinds, back, n = np.unique(low, return_inverse=True, return_counts=True)
        context = kinds >> np.uint32(BITS)
        _, of, types = np.unique(context, return_inverse=True, return_counts=True)
        total = np.bincount(of, weights=n)
        d = discount(n)
        own = np.maximum(n - d, 0) / total[of]
        weight = d * types[of] / total[of]
        p = own[back] + weight[back] * p
    return p


@dataclass
class ToxicityModel:
    """Evidence of grams that a class has seen, evidence of contexts alone, and the score curve."""

    gram: np.ndarray
    evidence: np.ndarray
    context: np.ndarray
    context_evidence: np.ndarray
    curve: np.ndarray = field(default_factory=PLAIN_CURVE.copy)
    _dense: list = field(default_factory=list, repr=False)

    def per_symbol(self, g: np.ndarray) -> np.ndarray:
        if not self._dense:
            table = np.zeros(1 << ((ORDER - 1) * BITS), dtype=np.float32)
            table[self.context] = self.context_evidence
            table = np.repeat(table, 1 << BITS)
            table[self.gram] = self.evidence
            self._dense.append(table)
        return self._dense[0][g]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_dense": []}


def fit_counts(gram: np.ndarray, counts: np.ndarray) -> ToxicityModel:
    """Models from sorted distinct grams and their (toxic, ordinary, other) counts."""
    shared = shared_probabilities(gram)
    context = gram >> np.uint32(BITS)
    contexts, of = np.unique(context, return_inverse=True)
    logs, lambdas = [], []
    for k in range(2):
        n = counts[:, k].astype(float)
        total = np.bincount(of, weights=n, minlength=len(contexts))
        types = np.bincount(of, weights=n > 0, minlength=len(contexts))
        d = discount(counts[:, k])
        weight = np.where(total > 0, d * types / np.maximum(total, 1), 1.0)
        own = np.maximum(n - d, 0) / np.maximum(total, 1)[of]
        logs.append(np.log(own + weight[of] * shared))
        lambdas.append(np.log(weight))
    seen = counts[:, :2].sum(axis=1) > 0
    return ToxicityModel(gram[seen], (logs[0] - logs[1])[seen].astype(np.float32), contexts,
                         (lambdas[0] - lambdas[1]).astype(np.float32))


def evidence_of(model: ToxicityModel, texts: list[bytes]) -> np.ndarray:
    """Per text: log-likelihood difference per symbol, the same of its worst stretch, log of length."""
    out = np.zeros((len(texts), 3))
    for first, g, owner in grams(texts):
        n = np.bincount(owner)
        stop = np.cumsum(n)
        total = np.concatenate(([0.0], np.cumsum(model.per_symbol(g), dtype=np.float64)))
        at = np.arange(len(g))
        stretch = total[np.minimum(at + STRETCH, stop[owner])] - total[at]
        worst = np.maximum.reduceat(stretch, stop - n) / STRETCH
        mean = (total[stop] - total[stop - n]) / n
        out[first:first + len(n)] = np.stack([mean, worst, np.log(n)], axis=1)
    return out


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and offset of a logistic curve (Newton steps with a little shrinkage)."""
    if len(x) == 0 or y.min() == y.max():
        return PLAIN_CURVE
    centre, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1.0
    design = np.concatenate([(x - centre) / spread, np.ones((len(x), 1))], axis=1)
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + 1e-2 * w
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(bend, slope)
    flat = w[:-1] / spread
    return np.append(flat, w[-1] - centre @ flat)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the folds; remainder 0 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Documents with their label; of several labels of one document the largest counts."""
    own = (labels.where(f"{label} IS NOT NULL AND doc_id IS NOT NULL")
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    if own.count() <= BROADCAST_LABELS:
        own = F.broadcast(own)
    return docs.select("doc_id", "text").join(own, "doc_id", "left")


def _collected(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = counts.toArrow()
    gram = table.column("gram").to_numpy().astype(np.uint32)
    n = np.stack([table.column(c).to_numpy() for c in ("toxic", "ordinary", "other")], axis=1)
    order = np.argsort(gram)
    return gram[order], n[order]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic",
          curve_rows: int = 50_000) -> ToxicityModel:
    """Counts from all documents; classes from labelled rows of remainder 1 to 3; curve from 4.

    Only the curve's four numbers are fitted on a sample: at most ``curve_rows`` labelled rows of
    remainder 4, chosen by a hash of their id. At most 32**5 summed counts reach the driver.
    """
    rows = labelled(docs, labels, label).withColumn("r", remainder(F.col("doc_id")))
    learn = F.col("label").isNotNull() & F.col("r").between(1, 3)
    kind = F.when(learn & (F.col("label") == 1), 0).when(learn, 1).otherwise(2)
    counted = rows.select("text", kind.alias("kind")).mapInArrow(count_grams, COUNTS)
    counts = counted.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("toxic", "ordinary", "other")])
    model = fit_counts(*_collected(counts))
    curve = rows.where("label IS NOT NULL AND r = 4").orderBy(F.xxhash64("doc_id")).limit(curve_rows)
    seen = scored(curve.select("doc_id", "text", "label"), model).select(*EVIDENCE, "label").toPandas()
    model.curve = fit_curve(seen[EVIDENCE].to_numpy(float), seen["label"].to_numpy(float))
    return model


EVIDENCE = ["evidence", "worst_stretch", "log_length"]


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` (without its text) plus the evidence columns and ``score``; more columns may come."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("text", "score", *EVIDENCE)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = evidence_of(shared.value, texts_of(batch.column("text")))
            p = 1 / (1 + np.exp(-np.clip(x @ shared.value.curve[:-1] + shared.value.curve[-1], -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], *[pa.array(np.ascontiguousarray(x[:, k]))
                                                     for k in range(3)], pa.array(p)],
                [*kept, *EVIDENCE, "score"])

    schema = docs.select(*kept).schema
    for c in (*EVIDENCE, "score"):
        schema = schema.add(c, "double")
    return docs.select(*kept, "text").mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, worst_stretch) for every row of ``docs``.

    A null text scores like an empty one. Rows that repeat, and rows without doc_id (held out, since
    no remainder can be told), are scored like all others. Without labels of both classes the curve
    stays the plain logistic one. Other columns of ``docs`` are never read.
    """
    docs = docs.select("doc_id", "text")
    out = scored(docs, train(docs, labels, label))
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(True)).alias("held_out"),
                      "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "worst_stretch")
