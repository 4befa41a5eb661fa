"""Removal of repeated byte strings by a sparse, range-partitioned suffix array.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller
doc_id. Instead of all suffixes, those at anchors are sorted. An anchor is the place of the smallest
hash among all grams of ``GRAM`` bytes in a string of ``LENGTH`` bytes (the leftmost of equal ones),
so equal strings have their anchors at equal places, and every string that is shared is found at the
anchor that belongs to it. Around an anchor stands its context: all strings that chose it.

1. Whole copies of a text are settled by its digest.
2. Anchors meet by their gram alone, which finds the few that more than one document has.
3. These get their contexts. A context that an earlier document has too is settled. What is left are
   equal grams in unequal contexts.
4. These contexts are cut from the texts as suffixes (what follows the anchor, then what precedes it,
   read backwards). Sampled splitters range-partition them by their leading bytes; every bucket sorts
   its own by multikey quicksort and finds, for each string, the smallest doc_id among equal ones.
   Strings whose run of equal leading bytes touches a border of the bucket may go on in its
   neighbours; they are compared across borders by one aggregate over the strings.
5. The settled strings of each document are laid over its text.

Copies are reduced to the smallest document per task before anything is shuffled, and no step needs
all suffixes of one gram in one task, so passages that most documents share cost no more than others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressline.llm.hashing import BYTE_CODES, _P, _P_INVERSE, mix, powers, texts_of
from pressline.llm.storage import stored

LENGTH = 50
GRAM = 20
OFFSETS = LENGTH - GRAM + 1
"""Strings that can choose one anchor: it may stand at 0 .. OFFSETS - 1 in them."""
ALL = (1 << OFFSETS) - 1
BUCKET_SUFFIXES = 30_000
REACH = OFFSETS - 1
"""Bytes of context before an anchor; after it, LENGTH bytes count."""


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the gram at every place of ``data``."""
    n = len(data)
    if n < GRAM:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODES[data] * powers(n, _P), out=total[1:])
    return mix((total[GRAM:] - total[:-GRAM]) * powers(n - GRAM + 1, _P_INVERSE))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def anchors(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, gram hashes) of the anchors of one text; none below LENGTH bytes."""
    h = gram_hashes(text)
    if len(text) < LENGTH:
        return np.zeros(0, dtype=np.int64), h[:0]
    # 40 bits of hash, then the place: the leftmost of equal hashes is the smallest.
    place = np.arange(len(h), dtype=np.uint64)
    cut = np.uint64(24)
    if len(h) < 1 << 24:
        low = sliding_min(((h >> cut) << cut) | place, OFFSETS)
        at = np.unique(low & np.uint64((1 << 24) - 1)).astype(np.int64)
    else:
        # Longer texts are anchored in overlapping stretches; a string lies in one of them whole.
        size = 1 << 23
        at = np.unique(np.concatenate([
            s + anchors(text[s:s + size + LENGTH - 1])[0] for s in range(0, len(text) - LENGTH + 1, size)]))
    return at, h[at]


def context_hashes(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the bytes around each anchor; the ends of the text are part of it."""
    padded = np.concatenate((np.full(REACH, 256), text, np.full(LENGTH, 257)))
    codes = np.append(BYTE_CODES, mix(np.array([901, 902], dtype=np.uint64)))[padded]
    n, size = len(padded), REACH + LENGTH
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(codes * powers(n, _P), out=total[1:])
    return mix((total[at + size] - total[at]) * powers(int(at[-1]) + 1, _P_INVERSE)[at]) if len(at) else (
        np.zeros(0, dtype=np.uint64))


def _leaders(texts: list[bytes], ids: np.ndarray) -> set[int]:
    """Of equal texts the index of the smallest document: the rest are copies, settled elsewhere."""
    best: dict[bytes, int] = {}
    for i, t in enumerate(texts):
        if t not in best or ids[i] < ids[best[t]]:
            best[t] = i
    return set(best.values())


HEAD, SHARED = 1, 2


def _anchor_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(deal, doc_id, tag) of every anchor; tag is its place times four, and HEAD and SHARED.

    Only the smallest document of a batch that has the gram goes on to meet the other batches by it
    (HEAD); the rest are known to be shared and spread.
    """
    for batch in batches:
        texts = texts_of(batch.column("text"))
        ids = batch.column("doc_id").to_numpy()
        leaders = _leaders(texts, ids)
        for few in groups_of(texts, 8 << 20):
            out = []
            for i in few:
                if i in leaders:
                    at, gram = anchors(np.frombuffer(texts[i], dtype=np.uint8))
                    out.append((gram, np.full(len(at), ids[i]), at))
            gram, doc, place = (np.concatenate(c) for c in zip(*out)) if out else [np.zeros(0)] * 3
            if not len(gram):
                continue
            order = np.lexsort((doc, gram))
            gram, doc, place = gram[order], doc[order], place[order]
            first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
            size = np.diff(np.append(first, len(doc)))
            head = doc == np.repeat(doc[first], size)
            shared = np.repeat(doc[first] != doc[first + size - 1], size)
            deal = np.where(head, gram, mix(gram ^ (doc * 64 + place).astype(np.uint64)))
            tag = place * 4 + head * HEAD + shared * SHARED
            for a in range(0, len(gram), 100_000):
                s = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(deal[s].view(np.int64)), pa.array(doc[s]), pa.array(tag[s])],
                    ["deal", "doc_id", "tag"])


def shared_anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, place) of the anchors whose gram more than one document has."""
    rows = docs.mapInArrow(_anchor_rows, "deal long, doc_id long, tag long")
    # Rows that are no heads have a deal of their own; should one meet a head's, it is kept in vain.
    low, high = (F.expr(f"{f}(doc_id) OVER (PARTITION BY deal)") for f in ("min", "max"))
    rows = rows.withColumn("low", low).withColumn("high", high)
    known = F.col("tag").bitwiseAND(F.lit(HEAD | SHARED)) != F.lit(HEAD)
    return rows.where(known | (F.col("low") < F.col("high"))).select(
        "doc_id", F.shiftright("tag", 2).cast("int").alias("place"))


def _context_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, context, doc_id, place, covered, deal) of every shared anchor.

    ``covered``: this batch has the context in a smaller document. Only the smallest goes on to meet
    the other batches by its gram; the rest spread.
    """
    for batch in batches:
        texts = texts_of(batch.column("text"))
        places = batch.column("places").to_pylist()
        ids = batch.column("doc_id").to_numpy()
        for few in groups_of(texts, 8 << 20):
            out = []
            for i in few:
                data = np.frombuffer(texts[i], dtype=np.uint8)
                at = np.unique(np.array(places[i], dtype=np.int64))
                out.append((gram_hashes(data)[at], context_hashes(data, at), np.full(len(at), ids[i]), at))
            gram, context, doc, place = (np.concatenate(c) for c in zip(*out))
            order = np.lexsort((place, doc, context, gram))
            gram, context, doc, place = gram[order], context[order], doc[order], place[order]
            new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])))
            first = np.flatnonzero(new)
            low = np.repeat(doc[first], np.diff(np.append(first, len(doc))))
            covered = doc > low
            deal = np.where(covered, mix(gram ^ (doc * 64 + place).astype(np.uint64)), gram)
            for a in range(0, len(gram), 100_000):
                s = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram[s].view(np.int64)), pa.array(context[s].view(np.int64)),
                     pa.array(doc[s]), pa.array(place[s].astype(np.int32)), pa.array(covered[s]),
                     pa.array(deal[s].view(np.int64))],
                    ["gram", "context", "doc_id", "place", "covered", "deal"])


def groups_of(texts: list[bytes], limit: int) -> Iterator[list[int]]:
    """Indices of texts in stretches of about ``limit`` bytes."""
    part: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        part.append(i)
        size += len(t)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def settle_contexts(docs: DataFrame) -> DataFrame:
    """(doc_id, place, settled): anchors that an earlier document has wholly
    (``settled``), and, once per context, those whose gram stands in other contexts too."""
    places = stored(shared_anchors(docs)).groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    rows = docs.join(places, "doc_id").select("doc_id", "text", "places").mapInArrow(
        _context_rows, "gram long, context long, doc_id long, place int, covered boolean, deal long")
    alike = "OVER (PARTITION BY deal, covered, gram, context)"
    same = "OVER (PARTITION BY deal, covered, gram)"
    rows = (rows.withColumn("first_doc", F.expr(f"min(doc_id) {alike}"))
            .withColumn("low", F.expr(f"min(doc_id) {same}")).withColumn("high", F.expr(f"max(doc_id) {same}"))
            .withColumn("other", F.expr(f"min(context) {same} <> max(context) {same}")))
    settled = F.col("covered") | (F.col("doc_id") > F.col("first_doc"))
    return rows.select("doc_id", "place", settled.alias("settled"), (
        F.col("other") & (F.col("low") < F.col("high"))).alias("open")).where("settled OR open").drop("open")


SUFFIX = "doc_id long, place int, suffix binary, before binary"


def _cut_suffixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What follows each wanted anchor and, backwards, what precedes it."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        places = batch.column("places").to_pylist()
        rows = []
        for doc, text, wanted in zip(ids, texts_of(batch.column("text")), places):
            rows += [(doc, p, text[p:p + LENGTH], text[max(0, p - REACH):p][::-1]) for p in wanted]
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         ["doc_id", "place", "suffix", "before"])


def multikey_quicksort(keys: np.ndarray) -> np.ndarray:
    """Order of rows of big-endian words: three-way partition by one word, equal rows by the next."""
    order = np.arange(len(keys))
    todo = [(0, len(keys), 0)]
    while todo:
        a, b, depth = todo.pop()
        if b - a < 2 or depth == keys.shape[1]:
            continue
        part = order[a:b]
        word = keys[part, depth]
        if b - a <= 64:
            part = part[np.lexsort(keys[part, depth:].T[::-1])]
            order[a:b] = part
            continue
        pivot = np.partition(word, (b - a) // 2)[(b - a) // 2]
        less, same = part[word < pivot], part[word == pivot]
        order[a:b] = np.concatenate((less, same, part[word > pivot]))
        todo += [(a, a + len(less), depth), (a + len(less), a + len(less) + len(same), depth + 1),
                 (a + len(less) + len(same), b, depth)]
    return order


def _matrix(column: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``size`` bytes (zeros behind the end) and their true lengths."""
    length = np.array([len(x) for x in column], dtype=np.int64)
    flat = b"".join(x.ljust(size, b"\0") for x in column)
    return np.frombuffer(flat, dtype=np.uint8).reshape(len(column), size), length


def shared_with_last(rows: np.ndarray) -> np.ndarray:
    """Leading bytes that each row but the first shares with the row before it."""
    differ = rows[1:] != rows[:-1]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])


def smallest_documents(follow: np.ndarray, n_follow: np.ndarray, before: np.ndarray, n_before: np.ndarray,
                       doc: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """For a bucket in suffix order: bit mask of the strings that an earlier document here has, and
    per offset the rows that are first here but whose string may go on beyond the bucket.

    Equal strings are found as neighbours. Rows that follow each other in suffix order and share the
    bytes behind the anchor form a stretch; what precedes the anchor, read backwards, is sorted the same
    way and forms stretches of its own. A string is a pair of stretches: bytes are compared, not hashes.
    """
    mask = np.zeros(len(doc), dtype=np.int64)
    ahead = shared_with_last(follow)
    padded = np.zeros((len(doc), -(-REACH // 8) * 8), dtype=np.uint8)
    padded[:, :REACH] = before
    back_order = multikey_quicksort(padded.view(">u8").astype(np.uint64))
    behind = shared_with_last(before[back_order])
    open_rows: dict[int, np.ndarray] = {}
    for a in range(OFFSETS):
        rows = np.flatnonzero((n_before >= a) & (n_follow >= LENGTH - a))
        if not len(rows):
            continue
        stretch = np.concatenate(([0], np.cumsum(ahead < LENGTH - a)))
        back = np.empty(len(doc), dtype=np.int64)
        back[back_order] = np.concatenate(([0], np.cumsum(behind < a)))
        string = (stretch * len(doc) + back)[rows]
        order = np.lexsort((doc[rows], string))
        rows, string = rows[order], string[order]
        first = np.flatnonzero(np.concatenate(([True], string[1:] != string[:-1])))
        later = doc[rows] > np.repeat(doc[rows][first], np.diff(np.append(first, len(rows))))
        mask[rows[later]] |= 1 << a
        rows = rows[~later]
        open_rows[a] = rows[(stretch[rows] == 0) | (stretch[rows] == stretch[-1])]
    return mask, open_rows


SORTED = "doc_id long, place int, mask long, offset int, string binary"


def _sort_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket of suffixes: rows with a mask, and rows (offset, string) of strings at the borders."""
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    suffix, n_follow = _matrix(table.column("suffix").to_pylist(), 56)
    before, n_before = _matrix(table.column("before").to_pylist(), 32)
    doc = table.column("doc_id").to_numpy()
    place = table.column("place").to_numpy()
    words = np.ascontiguousarray(np.concatenate((suffix, before), axis=1)).view(">u8").astype(np.uint64)
    order = multikey_quicksort(words)
    doc, place, follow, before = doc[order], place[order], suffix[order, :LENGTH], before[order, :REACH]
    mask, open_rows = smallest_documents(follow, n_follow[order], before, n_before[order], doc)
    yield sorted_rows(doc, place, mask, np.full(len(doc), -1), pa.nulls(len(doc), pa.binary()))
    for a, rows in open_rows.items():
        whole = np.ascontiguousarray(np.concatenate((before[rows, :a][:, ::-1], follow[rows, :LENGTH - a]), axis=1))
        strings = pa.FixedSizeBinaryArray.from_buffers(pa.binary(LENGTH), len(rows), [None, pa.py_buffer(whole)])
        yield sorted_rows(doc[rows], place[rows], np.zeros(len(rows), dtype=np.int64), np.full(len(rows), a),
                          strings.cast(pa.binary()))


def sorted_rows(doc, place, mask, offset, string) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(place.astype(np.int32)), pa.array(mask), pa.array(offset.astype(np.int32)), string],
        ["doc_id", "place", "mask", "offset", "string"])


def compared_suffixes(suffixes: DataFrame) -> DataFrame:
    """(doc_id, place, mask) of stored suffixes (``SUFFIX``) with strings that earlier documents have."""
    buckets = suffixes.count() // BUCKET_SUFFIXES + 1
    dealt = suffixes.repartitionByRange(buckets, "suffix", "before")
    done = stored(dealt.mapInArrow(_sort_bucket, SORTED))
    edge = done.where("offset >= 0")
    low = edge.groupBy("offset", "string").agg(F.min("doc_id").alias("low"))
    over = edge.join(low, ["offset", "string"]).where("low < doc_id").select(
        "doc_id", "place", F.expr("shiftleft(1L, offset)").alias("mask"))
    return done.where("mask <> 0").select("doc_id", "place", "mask").unionByName(over)


def remove_strings(size: int, places: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Which of ``size`` bytes lie in a settled string."""
    whole = masks == ALL
    row, bit = np.nonzero((masks[~whole, None] >> np.arange(OFFSETS)) & 1)
    start = places[~whole][row] - bit
    start = np.concatenate([start, np.maximum(places[whole] - REACH, 0)])
    stop = np.minimum(np.concatenate([start[:len(row)], places[whole]]) + LENGTH, size)
    steps = np.bincount(start, minlength=size + 1) - np.bincount(stop, minlength=size + 1)
    return np.cumsum(steps)[:-1] > 0


REMOVED = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
           "spans array<struct<start: long, stop: long>>")


def _removal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans and digest of what stays. A whole copy has no found strings, but ``copy`` set."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    few = (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512))
    for batch in few:
        rows = []
        found = batch.column("found")
        bounds = found.offsets.to_numpy()
        place, mask = (found.values.field(c).to_numpy().astype(np.int64) for c in ("place", "mask"))
        copies = batch.column("copy").to_pylist()
        for k, (text, copy) in enumerate(zip(texts_of(batch.column("text")), copies)):
            a, b = int(bounds[k]), int(bounds[k + 1])
            if copy or a == b:
                gone = np.full(len(text), bool(copy) and len(text) >= LENGTH)
            else:
                gone = remove_strings(len(text), place[a:b], mask[a:b])
            edge = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
            spans = [{"start": a, "stop": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(),
                                                             np.flatnonzero(edge == -1).tolist())]
            kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
            rows.append((len(text), int(gone.sum()), len(spans), sha256(kept).hexdigest(), spans))
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), kind]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def repeated_strings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for every row of ``docs``.

    Null texts are empty. Texts below 50 bytes lose nothing. A doc_id names one document: rows that
    repeat it with an equal text get equal results. Rows without doc_id have no place in the order:
    they lose nothing and take nothing from others. An empty table gives no rows. Other columns are
    never read.
    """
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    docs = every.where("doc_id IS NOT NULL")
    copies = stored(docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest")))
    first = copies.groupBy("digest").agg(F.min("doc_id").alias("first_doc"))
    copied = copies.join(first, "digest").groupBy("doc_id").agg(
        (F.min("first_doc") < F.col("doc_id")).alias("copy"))
    contexts = stored(settle_contexts(docs))
    wanted = contexts.where("NOT settled").groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    suffixes = stored(docs.join(wanted, "doc_id")
                      .select("doc_id", "text", "places").mapInArrow(_cut_suffixes, SUFFIX))
    found = contexts.where("settled").select("doc_id", "place", F.lit(ALL).cast("long").alias("mask")
                                             ).unionByName(compared_suffixes(suffixes))
    found = found.groupBy("doc_id").agg(F.collect_list(F.struct("place", "mask")).alias("found"))
    settled = stored(copied.join(found, "doc_id", "left"))
    rows = docs.join(settled, "doc_id").select("doc_id", "text", "found", "copy")
    none = F.lit(None).cast(rows.schema["found"].dataType).alias("found")
    rows = rows.unionByName(every.where("doc_id IS NULL").select(
        "doc_id", "text", none, F.lit(False).alias("copy")))
    return rows.mapInArrow(_removal, REMOVED)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text_bytes``, the bytes that stay (they may split a character)."""
    spans = repeated_strings(docs).select("doc_id", "spans").dropDuplicates(["doc_id"])
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    start = F.transform("spans", lambda s: s["start"])
    stop = F.transform("spans", lambda s: s["stop"])
    edges = F.arrays_zip(F.concat(F.array(F.lit(0).cast("long")), stop).alias("a"),
                         F.concat(start, F.array(F.octet_length(raw).cast("long"))).alias("b"))
    kept = F.aggregate(edges, F.lit(b""), lambda x, e: F.concat(
        x, F.substring(raw, e["a"].cast("int") + 1, (e["b"] - e["a"]).cast("int"))))
    return docs.join(spans, "doc_id").withColumn("text_bytes", kept).drop("spans")
