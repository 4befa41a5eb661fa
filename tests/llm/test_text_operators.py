"""Spelling variants, language and periodic runs against brute force and held-out accuracy, on odd and generated tables."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pressline.llm import language_id, periodic_runs, spelling, suffix_dedup
from pressline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
EXTRA = ["'x' AS n", "'y' AS word", "1.5D AS score", "'z' AS runs", "'q' AS block", "'f' AS form", "7 AS n_words",
         "'c' AS collapsed", "'p' AS part", "'s' AS salt", "'r' AS row_key", "'l' AS letters"]


def frame(spark, rows, columns="doc_id long, text string, lang string"):
    return spark.createDataFrame(rows, columns).selectExpr("*", *EXTRA).repartition(3)


# --- periodic runs ------------------------------------------------------------------------------------

def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, w):
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def all_runs(w, least=6, exponent=4):
    found, n = [], len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            e = i
            while e + q < n and w[e] == w[e + q]:
                e += 1
            length = e + q - i
            stretch = w[i:i + length]
            if e > i and length >= max(least, exponent * q) and not any(
                    stretch[d:] == stretch[:-d] for d in range(1, q)):
                found.append((i, length, q))
            i = max(e, i + 1)
    return sorted(found)


def digests(doc_id, w):
    runs = all_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def periodic_text(rng):
    out = []
    for _ in range(rng.randint(0, 5)):
        out += [rng.choice("abcé") for _ in range(rng.randint(0, 8))]
        unit = [rng.choice("abcé") for _ in range(rng.randint(1, 6))]
        stretch = unit * rng.randint(1, 9)
        out += stretch[rng.randint(0, len(unit) - 1):]
    return rng.choice([" ", "  ", "\n\t"]).join(out)


def test_runs_equal_brute_force_on_odd_rows(spark):
    rng = random.Random(4)
    texts = [None, "", " \t\n ", "a", "a a a a a", "a a a a a a", "a " * 7, "a b " * 4, "x" + " a b c" * 4 + " a b",
             "A a " * 9, "x  y\r\nx y x y x y\x0bx y", "é ß é ß é ß é ß", "a a a a a a b a a a a a a b " * 4,
             "\0 \0 \0 \0 \0 \0", "           "]
    texts += [periodic_text(rng) for _ in range(300)]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(7, "b b b b b b", None), (7, "b b b b b b", None),
                                                           (None, "c c c c c c c", None), (-3, "d " * 30, None)]
    docs = frame(spark, rows)
    got = periodic_runs.run_digests(periodic_runs.periodic_runs(docs, source=periodic_runs.planted_periods))
    want = [digests(d, planted(d, words_of(t)) if d is not None else words_of(t)) for d, t, _ in rows]
    assert sorted(map(str, [tuple(r) for r in got.select(*COLUMNS).collect()])) == sorted(map(str, want))
    plain = {(r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"]))) for r in periodic_runs.periodic_runs(docs).collect()}
    assert plain == {(d, len(words_of(t)), tuple(all_runs(words_of(t)))) for d, t, _ in rows}
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


@pytest.mark.parametrize("least,exponent", [(6, 4), (3, 3), (20, 5), (1, 3)])
def test_runs_of_arrays_equal_brute_force(least, exponent):
    rng = random.Random(9)
    for _ in range(60):
        docs = [words_of(periodic_text(rng)) for _ in range(rng.randint(1, 4))]
        number = np.array([1000 * d + ord(x[0]) for d, w in enumerate(docs) for x in w], dtype=np.int64)
        want, before = [], 0
        for w in docs:
            want += [[before + s, n, q] for s, n, q in all_runs(w, least, exponent)]
            before += len(w)
        assert periodic_runs.chunk_runs(number, least, exponent).tolist() == want


def test_runs_of_very_long_texts_take_linear_room(spark):
    texts = ["a " * 400_000, "a b c d e f g " * 60_000 + "h", "one two three four five six x%d ",
             "x" * 2_000_000, " " * 2_000_000 + "a"]
    texts[2] = " ".join(texts[2] % i for i in range(20_000))
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic_runs.periodic_runs(
        frame(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}
    assert got == {0: [(0, 400_000, 1)], 1: [(0, 420_000, 7)], 2: [], 3: [], 4: []}


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(periodic_runs, "span_hashes", lambda d, s, e: (e - s).astype(np.uint64))
    text = np.frombuffer(b"ab cd ab cd cd a ", dtype=np.uint8)
    starts, ends = periodic_runs.word_spans(text, periodic_runs.WHITE)
    n = periodic_runs.word_numbers(text, starts, ends, np.array([0, 0, 0, 0, 1, 1])).tolist()
    assert n[0] == n[2] and n[1] == n[3] and len(set(n)) == 4


@data
def test_periodic_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = {tuple(r) for r in QUERIES["op13_periodic_runs"](spark, FOLDER).select(*COLUMNS).collect()}
    assert got == {digests(r["doc_id"], planted(r["doc_id"], words_of(r["text"]))) for r in rows}


# --- spelling variants --------------------------------------------------------------------------------

def runs_of(doc_id, text, every=31):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        if doc_id is not None and every and h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        yield run


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(counts, ratio=10):
    around = {w: [o for o in counts if near(w, o)] for w in counts}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, counts[w], len(around[w]), form[w], counts[form[w]] if form[w] else None, root))
    return out


def counted(rows, every):
    counts = {}
    for d, t in rows:
        for w in runs_of(d, t, every):
            if len(w) >= 7:
                counts[w] = counts.get(w, 0) + 1
    return counts


WORD = ("word", "n", "n_near", "form", "form_n", "root")


@pytest.mark.parametrize("block", [2048, 3])
def test_variants_equal_brute_force(spark, monkeypatch, block):
    # Parts are cut inside tasks, so the bound travels with the function.
    import types
    cut = types.FunctionType(spelling.block_parts.__code__, {**vars(spelling), "BLOCK": block})
    monkeypatch.setattr(spelling, "block_parts", cut)
    rng = random.Random(6)
    base = ["".join(rng.choice("abcéÖx×ÿ") for _ in range(rng.randint(6, 11))) for _ in range(12)]
    words = {w: rng.choice([2, 3, 30, 31, 400, 5000]) for w in base}
    for w in base * 12:
        k, v = rng.randrange(len(w)), list(w)
        kind = rng.randrange(4)
        v[k:k + 1] = [[], [rng.choice("abcéÖ÷")], [v[k], rng.choice("abz")], [v[k]]][kind]
        if kind == 3:
            rng.shuffle(v)
        if len(v) >= 7:
            words["".join(v)] = rng.choice([2, 3, 20, 300, 3000])
    words |= {"a" * 40: 50, "a" * 41: 5, "a" * 42: 500, "lonely" * 9: 4, "b" * 3000: 3, "b" * 2999 + "c": 30}
    table = spark.createDataFrame(list(words.items()), "word string, n long").selectExpr(
        "*", "'x' AS block", "'y' AS form", "1 AS part", "2 AS other").repartition(3)
    got = {tuple(r) for r in spelling.spelling_variants(table).select(*WORD).collect()}
    assert got == variants(words)
    assert spelling.spelling_variants(table.where("n < 0")).count() == 0


def test_words_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", "short", "Straßenbahn STRASSENBAHN straßenbahn", "éééééé1ééééééé", "x" * 300_000 + " " + "y" * 90,
             "日本語テキスト abcdefgh", "İabcdefg Ã©Ã©abcde", "a" * 7 + "\0" + "b" * 8]
    texts += [" ".join("".join(rng.choice("abÉß") for _ in range(rng.randint(5, 9))) for _ in range(200)) for _ in range(40)]
    rows = [(i - 3, t) for i, t in enumerate(texts)] + [(None, "wordwithoutid " * 3), (5, texts[-1]), (5, texts[-1])]
    docs = frame(spark, [(d, t, None) for d, t in rows])
    for every in (31, 3, 0):
        got = {r["word"]: r["n"] for r in spelling.word_counts(docs, drop_every=every).collect()}
        assert got == counted(rows, every)


def test_crc_of_spans():
    text = np.frombuffer(b"abc de " + b"f" * 100 + b" ", dtype=np.uint8)
    starts, ends = np.array([0, 4, 7, 3]), np.array([3, 6, 107, 3])
    heads = np.array([zlib.crc32(x) for x in (b"1:", b"", b"22:", b"x")], dtype=np.uint32)
    want = [zlib.crc32(x) for x in (b"1:abc", b"de", b"22:" + b"f" * 100, b"x")]
    assert spelling.crc_after(heads, text, starts, ends).tolist() == want


@data
def test_spelling_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    counts = {w: n for w, n in counted(rows, 31).items() if n >= 2}
    got = {tuple(r) for r in QUERIES["op11_spelling_variants"](spark, FOLDER).select(*WORD).collect()}
    assert got == variants(counts)


# --- language -----------------------------------------------------------------------------------------

def test_language_of_odd_rows(spark):
    rng = random.Random(1)
    letters = {"de": "dereinschauß", "fr": "lesuneétàiquo", "el": "αβγδεζηικλ"}
    def text(lang, n):
        return " ".join("".join(rng.choice(letters[lang]) for _ in range(5)) for _ in range(n))
    rows = [(i, text(x, rng.randint(5, 60)), x) for i in range(400) for x in [rng.choice(list(letters))]]
    odd = [(1000, None, "de"), (1001, "", "fr"), (1002, "123 ... 456 ٠", "de"), (None, text("el", 20), None),
           (1003, text("de", 60_000), None), (1004, "日", None), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2])]
    docs = frame(spark, rows + odd)
    out = language_id.language_id(docs, reject=False)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score", "accepted"]
    got = out.collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in by.items() if d is not None)
    right = [by[d]["lang_pred"] == x for d, _, x in rows if by[d]["held_out"]]
    assert np.mean(right) > 0.97 and by[None]["lang_pred"] == "el" and by[None]["held_out"]
    assert [by[k]["lang_pred"] for k in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "de"]
    assert by[1004]["lang_pred"] in letters and all(0 <= r["score"] <= 1 for r in got)
    strict = {r["doc_id"]: r["lang_pred"] for r in language_id.language_id(docs).collect()}
    assert all(strict[d] == (r["lang_pred"] if r["accepted"] else "und") for d, r in by.items())


def test_language_without_anything_to_learn(spark):
    docs = frame(spark, [(1, "some text", None), (None, "more", "en"), (2, None, "de")])
    assert {tuple(r)[2:] for r in language_id.language_id(docs, reject=False).collect()} == {("und", 0.0, False)}
    assert language_id.language_id(docs.limit(0)).count() == 0


def test_texts_in_a_batch_score_as_alone():
    rng = random.Random(3)
    texts = ["", " a", "b", "ab cd é", *["".join(rng.choice("ab é1-") for _ in range(rng.randint(0, 40))) for _ in range(60)]]
    table = np.random.default_rng(0).normal(size=(language_id.BUCKETS, 3)).astype(np.float32)
    model = language_id.LanguageModel(["x", "y", "z"], table, np.zeros(3))
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": [None] * len(texts), "salt": [0] * len(texts)})
    alone = []
    for r in pa.Table.from_batches(language_id.bags([batch])).to_pylist():
        b, n = np.frombuffer(r["buckets"], dtype=np.uint16), np.frombuffer(r["counts"], dtype=np.uint32)
        alone.append((table[b] * n[:, None]).sum(axis=0, dtype=float) / max(n.sum(), 1))
    want = model.probabilities(np.array(alone)).max(axis=1)
    scored = language_id.score_batch(model, pa.array(texts), np.ones(len(texts), dtype=bool))
    assert np.allclose(scored[1], want, atol=1e-5)


def test_rejection_keeps_the_wanted_share():
    score = np.array([0.9, 0.8, 0.8, 0.7, 0.6, 0.5])
    right = np.array([True, True, True, False, True, False])
    assert language_id.least_score(score, right, 0.99) == 0.8
    assert language_id.least_score(score, right, 0.8) == 0.6
    assert language_id.least_score(score, right, 0.5) == 0.0
    assert language_id.least_score(score, ~right, 0.99) > 0.9


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data")
def test_held_out_languages(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op12_language_id"](spark, folder).where("held_out AND lang_pred <> 'und'").collect()
    right = [r["lang_pred"] == lang[r["doc_id"]] for r in got]
    assert len(right) > 200 and np.mean(right) > 0.95


# --- the suffix order of the string dedup ----------------------------------------------------------------

def bucket(rng, rows):
    follow = np.zeros((rows, suffix_dedup.LENGTH), dtype=np.uint8)
    before = np.zeros((rows, suffix_dedup.REACH), dtype=np.uint8)
    base = [(rng.integers(97, 100, suffix_dedup.LENGTH), rng.integers(97, 100, suffix_dedup.REACH)) for _ in range(6)]
    for k in range(rows):
        f, b = base[rng.integers(0, 6)]
        follow[k], before[k] = f, b
        follow[k, rng.integers(10, suffix_dedup.LENGTH):] += np.uint8(rng.integers(0, 2))
        before[k, rng.integers(0, suffix_dedup.REACH):] += np.uint8(rng.integers(0, 3))
    n_follow = np.where(rng.random(rows) < 0.1, rng.integers(20, 50, rows), 50)
    n_before = np.where(rng.random(rows) < 0.1, rng.integers(0, 30, rows), 30)
    for k in range(rows):
        follow[k, n_follow[k]:] = 0
        before[k, n_before[k]:] = 0
    return follow, n_follow, before, n_before, rng.integers(0, 40, rows)


def test_equal_strings_are_neighbours_in_suffix_order():
    rng = np.random.default_rng(3)
    follow, n_follow, before, n_before, doc = bucket(rng, 900)
    rows = list(zip(map(bytes, follow), map(bytes, before)))
    order = np.array(sorted(range(900), key=lambda k: rows[k]))
    mask, _ = suffix_dedup.smallest_documents(*(x[order] for x in (follow, n_follow, before, n_before, doc)))
    first, strings = {}, {}
    for k in range(900):
        for a in range(suffix_dedup.OFFSETS):
            if n_before[k] >= a and n_follow[k] >= suffix_dedup.LENGTH - a:
                strings[k, a] = (a, bytes(before[k, :a]), bytes(follow[k, :suffix_dedup.LENGTH - a]))
                first[strings[k, a]] = min(first.get(strings[k, a], 99), doc[k])
    want = [sum(1 << a for a in range(suffix_dedup.OFFSETS) if (k, a) in strings and first[strings[k, a]] < doc[k]) for k in range(900)]
    assert mask.tolist() == [want[k] for k in order]
    # The result comes from the order: without it neighbours are torn apart.
    middle = order.copy()
    middle[1:-1] = rng.permutation(order[1:-1])
    torn, _ = suffix_dedup.smallest_documents(*(x[middle] for x in (follow, n_follow, before, n_before, doc)))
    assert dict(zip(middle.tolist(), torn.tolist())) != dict(zip(order.tolist(), mask.tolist()))
