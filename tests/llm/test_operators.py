"""Every operator against brute force or its own promises, on odd tables and on generated ones."""

import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from pressline.llm import (decontamination, exact_dedup, html_text, jaccard_join, packing, quality,  # noqa: E402
                           sharding, suffix_dedup, toxicity, url_filters)
from pressline.llm.queries import ORACLES, QUERIES  # noqa: E402
from pressline.llm.storage import components, stored  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
EXTRA = ", 'x' AS n, 'y' AS key, 1.5D AS score, 'z' AS label, 'q' AS suffix, 'd' AS digest, 7 AS n_words, 'f' AS found"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_rows():
    """Nulls, empty and long texts, ties, copies, near copies, shared passages."""
    rng = random.Random(3)
    base, passage = prose(rng, 80), prose(rng, 30)
    words = base.split()
    rows = [(1, None), (2, ""), (3, "   \t\n"), (4, "one"), (5, "One"), (6, "a b c d"), (7, base),
            (8, base.upper()), (9, base), (10, " ".join(words[:-1] + ["other"])),
            (11, " ".join(words[1:])), (12, " ".join(words[:40])), (13, passage + " " + prose(rng, 50)),
            (14, prose(rng, 20) + " " + passage), (15, passage), (16, "ab " * 3000), (17, "ab " * 2999),
            (18, prose(rng, 9000)), (19, "x" * 49), (20, "x" * 50), (21, "x" * 51), (22, "\0\x01 é <|endoftext|> z")]
    for i in range(23, 40):
        w = list(words)
        w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
    return rows


ROWS = odd_rows()


def frame(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns).selectExpr("*", *EXTRA[2:].split(", "))


def rows_of(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_components_follow_long_chains(spark):
    edges = spark.range(200).selectExpr("id AS a", "id + 1 AS b").union(
        spark.range(5).selectExpr("1000 + id AS a", "1000 AS b"))
    got = rows_of(components(edges), "node", "component")
    assert got == {(i, 0) for i in range(201)} | {(1000 + i, 1000) for i in range(5)}
    assert components(edges.where("a < 0")).count() == 0


def test_near_copies_equal_brute_force(spark):
    got = rows_of(jaccard_join.similar_groups(frame(spark, ROWS)), "doc_id", "n_shingles", "component_id")
    assert got == {(d, *v) for d, v in brute.near_groups(ROWS).items()}


def test_near_copies_around_the_threshold(spark):
    rng = random.Random(8)
    rows = []
    for g in range(25):
        words = prose(rng, rng.randint(5, 120)).split()
        for _ in range(8):
            w = list(words)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice("pqrs")
            rows.append((len(rows), " ".join(w)))
    got = rows_of(jaccard_join.similar_groups(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == {(d, *v) for d, v in brute.near_groups(rows).items()}


def test_linked_sets_show_a_part_in_common_whatever_was_seen():
    rng = np.random.default_rng(7)
    pool = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    times = rng.integers(2, 50, len(pool))
    linked = 0
    for _ in range(1500):
        size = int(rng.integers(1, 9)) if rng.random() < 0.5 else int(rng.integers(9, 300))
        # Up to all shingles of a set are ones that were seen often, and by some counts only.
        own = rng.integers(0, 1 << 63, size).astype(np.uint64)
        a = np.unique(np.where(rng.random(size) < rng.random(), rng.choice(pool, size), own))
        gone = int(rng.integers(0, len(a) // 5 + 2))
        new = rng.integers(0, 1 << 63, int(rng.integers(0, 3)) if gone else 0).astype(np.uint64)
        b = np.unique(np.concatenate([rng.permutation(a)[gone:], new, rng.choice(pool, int(rng.integers(0, 3)))]))
        if len(b) and jaccard_join.linked(a, b):
            linked += 1
            for seen in (None, jaccard_join.Seen(pool, times), jaccard_join.Seen(pool[::7], times[::7])):
                shown = [jaccard_join.part_parities(x, seen) for x in (a, b)]
                assert set(shown[0]) & set(shown[1])
            n = np.array([len(a), len(b)])
            own, parity, label = jaccard_join.parts_of(np.concatenate([a, b]), n, seen)
            assert [set(jaccard_join.part_keys(parity[own == k], label[own == k])) for k in (0, 1)] == list(map(set, shown))
    assert linked > 500


def test_common_passages_make_no_groups_of_unlike_texts(spark, monkeypatch):
    rng = random.Random(4)
    common = [prose(rng, 8) for _ in range(12)]
    rows = []
    for i in range(400):
        rows.append((i, " ".join(x for line in rng.sample(common, 8) for x in (line, prose(rng, 10)))))
    rows += [(400 + i, rows[i][1] + " more") for i in range(20)]
    compare, pairs = jaccard_join.across_components, []

    def counted(members, labels, closest):
        per_part = members.groupBy("part").count().selectExpr("sum(count * (count - 1) / 2) AS pairs")
        pairs.append(per_part.first()[0] or 0)
        return compare(members, labels, closest)

    monkeypatch.setattr(jaccard_join, "across_components", counted)
    got = rows_of(jaccard_join.similar_groups(frame(spark, rows)), "doc_id", "component_id")
    assert got == {(i, i) for i in range(400)} | {(400 + i, i) for i in range(20)}
    # The copies alone share some fifty parts each.
    assert pairs[0] < 2000


def test_sketch_distance_never_exceeds_the_difference():
    rng = np.random.default_rng(1)
    for size in (6, 40, 700):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: size * 9 // 10], rng.integers(0, 1 << 63, size // 10 + 1).astype(np.uint64)]))
        sets = jaccard_join.Sketches(np.array([len(a), len(b)]), [jaccard_join.bit_sketch(x) for x in (a, b)])
        words = int(sets.width.min())
        x, y = (sets.folded(np.array([k]), words, 0, words)[0] for k in (0, 1))
        distance = int(np.bitwise_count(x ^ y).sum())
        assert distance <= len(np.setxor1d(a, b))
        one, other = np.array([0]), np.array([1])
        fits = bool(sets.fits(one, other, np.array([distance]))[0])
        assert [d.tolist() for d in sets.near(one, other)] == ([[0], [1], [distance]] if fits else [[], [], []])
        if jaccard_join.linked(a, b):
            assert fits and sets.likely(one, other)[0]
            assert set(jaccard_join.part_parities(a)) & set(jaccard_join.part_parities(b))


@pytest.mark.parametrize("closest", [True, False])
def test_blocks_give_the_pairs_of_all_groups(closest):
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64)) for size in (3, 40, 41, 700)]
    rows = []
    for part, size in enumerate((2, 1, 60, 5, 300, 7)):
        for at in range(size):
            h = base[rng.integers(0, 4)]
            h = np.sort(h[rng.permutation(len(h))[:max(1, len(h) - int(rng.integers(0, 4)))]])
            block = int(rng.integers(0, 2)) if size > 50 else 0
            row = (block, part * 1000 + at, int(rng.integers(0, 9)), len(h), jaccard_join.bit_sketch(h))
            for other in range(2 if size > 50 else 1):
                rows.append((part, min(block, other), max(block, other), *row))
    rows.sort(key=lambda r: r[:3])
    table = pa.table(dict(zip(jaccard_join.DEALT, map(pa.array, zip(*rows)))))
    out = pa.Table.from_batches(jaccard_join.compare_blocks(closest)(table.to_batches(max_chunksize=37))).to_pylist()
    unique = {(r[0], r[4]): r for r in rows}.values()
    sets = jaccard_join.Sketches(np.array([r[6] for r in unique]), [r[7] for r in unique])
    near: dict = {}
    for i, r in enumerate(unique):
        for j, q in enumerate(unique):
            if r[0] == q[0] and r[5] != q[5] and len(sets.near(np.array([i]), np.array([j]))[0]):
                far = sets.near(np.array([i]), np.array([j]))[2][0] / (r[6] + q[6])
                near.setdefault((r[0], r[4]), {})[min(r[4], q[4]), max(r[4], q[4])] = far
    assert near
    if closest:
        assert {(r["part"], r["doc"]) for r in out} == set(near)
        best: dict = {}
        for r in out:
            assert near[r["part"], r["doc"]][r["a"], r["b"]] == r["far"]
            best[r["part"], r["doc"]] = min(best.get((r["part"], r["doc"]), 2), r["far"])
        assert best == {k: min(v.values()) for k, v in near.items()}
    else:
        assert {(r["a"], r["b"]) for r in out} == {p for v in near.values() for p in v}


def test_perfect_hash_is_minimal_and_checks_bytes():
    words = np.random.default_rng(2).integers(0, 1 << 63, (3000, 4)).astype(np.uint64)
    levels = exact_dedup.build_perfect_hash(words[:2000])
    assert sorted(exact_dedup.slots(levels, words[:2000])) == list(range(2000))
    assert (exact_dedup.slots(levels, words[2000:]) < 2000).all()


def test_exact_groups_equal_brute_force(spark):
    got = rows_of(exact_dedup.exact_groups(frame(spark, ROWS)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute.exact_groups(ROWS)


def test_contamination_equals_brute_force(spark):
    long_item = ROWS[12][1]
    items = [(1, long_item), (2, "One"), (3, None), (4, "..."), (10, " ".join(ROWS[6][1].split()[:20]))]
    bench = frame(spark, items, "item_id long, text string")
    want = brute.hits(ROWS, items)
    for block in (1 << 20, 200):
        out = decontamination.contamination(frame(spark, ROWS), bench, block)
        assert rows_of(out, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    spans = decontamination.contamination(frame(spark, [(1, "So: ONE, two")]), bench).first()["spans"]
    assert [(s["start"], s["stop"]) for s in spans] == [(4, 7)]


def test_repeats_equal_brute_force(spark):
    rng = random.Random(5)
    rows = list(ROWS)
    stock = [prose(rng, 12) for _ in range(6)]
    for i in range(60):
        rows.append((100 + i, "".join(rng.choice(stock) if rng.random() < 0.6 else rng.choice("ab") * rng.randint(1, 70)
                                      for _ in range(rng.randint(1, 9)))))
    out = suffix_dedup.repeated_strings(frame(spark, rows))
    assert rows_of(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeats(rows)


def test_multikey_quicksort_sorts():
    keys = np.random.default_rng(4).integers(0, 3, (2000, 6)).astype(np.uint64)
    got = keys[suffix_dedup.multikey_quicksort(keys)]
    assert (got == keys[np.lexsort(keys.T[::-1])]).all()


def check_packing(out, docs, capacity=1024):
    encode = packing.Encoder(packing.tokenizer_files())
    by_doc, by_seq = {}, {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == {d for d, _ in docs}
    for d, text in docs:
        ids = np.array([*encode(text or ""), 2], dtype="<u4")
        at = 0
        for k, r in enumerate(sorted(by_doc[d], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            assert k == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_seq), sum(r["length"] for r in out)


def test_packing_is_gapless_and_round_trips(spark):
    check_packing(packing.packed_documents(frame(spark, ROWS)).collect(), ROWS)


@data
def test_packing_is_near_the_bound_and_ids_are_the_tokenizers(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    n, tokens = check_packing(packing.packed_documents(docs).collect(), rows)
    assert n <= -(-tokens // 1024) + 1
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(packing.tokenizer_files()[0])
    encode = packing.Encoder(packing.tokenizer_files())
    assert all(encode(t) == whole.encode(t, add_special_tokens=False).ids for _, t in rows + ROWS[6:] if t)
    for text in (" " * 2_000_000 + "a", "\n" * 2_000_000 + "a", "a" * 2_000_000, " \t" * 60_000 + "b c  d"):
        assert encode(text) == whole.encode(text, add_special_tokens=False).ids


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(9)
    sizes = rng.integers(1, 1024, 500)
    a, b = (packing.fresh(sizes, rng.permutation(500), 1024) for _ in range(2))
    for _ in range(20):
        a = packing.crossover(sizes, a, b, 1024, rng)
        assert (a >= 0).all() and np.bincount(a, weights=sizes).max() <= 1024


def brute_rule(url):
    import re
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = brute.lower(re.match(r"[^/?#]*", rest).group())
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    best = None
    for rule, _ in url_filters.RULES:
        domain, _, start = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            best = rule if best is None or len(rule) > len(best) else best
    return host, path, best


URLS = [None, "", "no scheme", "http://Example.ORG/es/1", "https://a.example.org/en/12?x=1", "http://example.org",
        "http://org/", "http://x.com/fr/", "http://x.com/de/a#b", "http://x.com", "ftp://notexample.org/es/",
        "http://x.net/?a=://b", "x://y://z/", "http://éx.org/%20", "http://x.com/fr/"]


def test_url_rules_equal_brute_force(spark):
    pages = frame(spark, list(enumerate(URLS)), "page_id long, url string")
    out = url_filters.filtered(pages).collect()
    verdicts = dict(url_filters.RULES)
    assert len(out) == len(URLS)
    for r in out:
        assert (r["host"], r["path"], r["rule"]) == brute_rule(URLS[r["page_id"]])
        assert r["verdict"] == verdicts.get(r["rule"], r["verdict"]) and r["verdict"] in ("allow", "block")
    one = url_filters.filtered(pages.where("page_id < 4")).collect()
    assert {r["verdict"] for r in one} == {"block"}


@data
def test_trees_agree_with_the_rules(spark):
    out = url_filters.filtered(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    judged = out.where("rule IS NOT NULL").selectExpr("verdict = 'block' AS y", "score >= 0.5 AS p").collect()
    assert sum(r["y"] == r["p"] for r in judged) >= 0.9 * len(judged)


def test_sharding_is_even_and_stable(spark):
    names = [f"s{i}" for i in range(10)]
    full, less = (sharding.filled_table(tuple(n), 10_007) for n in (names, names[:-1]))
    counts = np.bincount(full)
    assert counts.max() - counts.min() <= 1
    moved = sum(a != b for a, b in zip(full, less) if a != 9)
    assert moved < 0.15 * 10_007
    out = sharding.place(frame(spark, ROWS + [(None, "a"), (None, "b")]), "doc_id").collect()
    assert len(out) == len(ROWS) + 2
    import hashlib
    table = sharding.filled_table()
    for r in out:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r["slot"], r["shard"]) == (slot, sharding.SHARDS[table[slot]])


PAGE = """<html><head><title>x</title></head><body><h1>Head &amp; more</h1><p>One<p>Two <b>bold</b>text
<ul><li>a<li>b<ul><li>c</ul><li>d</ul><ol start=3><li>x<li>y</ol>
<table><tr><th>Name<th>Qty<tr><td>Apple<td>3<tr><td colspan=2>wide cell here<tr><td>Bananas<td>12</table>after
<div hidden>no</div><div style="display:none">no<p>no</div><pre>a
  b</pre><script>var a="<p>";</script>x<br>y</body></html>"""


def test_html_layout(spark):
    want = ("Head & more\n\nOne\n\nTwo boldtext\n\n- a\n- b\n  - c\n- d\n\n3. x\n4. y\n\n"
            "Name     Qty\nApple    3\nwide cell here\nBananas  12\n\nafter\n\na\n  b\n\nx\ny")
    odd = ["<", "<p", "<![foo[bar]]>a", "<!-- x", "a</b></p>c", "<td>x", '<a b="c>d', "<b>" * 3000 + "deep",
           "<table><table><tr><td>1</table>", "&bogus; &lt;", "<ul></ol></ul></ul>z", "\0", "<script>never"]
    rows = [(1, PAGE), (2, None), (3, ""), *enumerate(odd, 4), (1, PAGE)]
    out = html_text.page_texts(frame(spark, rows, "page_id long, html string")).collect()
    texts = {r["page_id"]: r["text"] for r in out}
    assert len(out) == len(rows) and texts[1] == want and texts[2] == texts[3] == ""
    assert texts[6] == "a" and texts[11] == "deep"


def learned(spark, operator, least):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = operator(docs, labels)
    column = "toxic" if operator is toxicity.toxicity else "quality"
    rows = out.join(labels, "doc_id").where("held_out").select("score", column).collect()
    cut = 0.5 if column == "toxic" else 0.3
    right = sum((r["score"] >= cut) == bool(r[column]) for r in rows)
    assert right >= least * len(rows) and all(0 <= r["score"] <= 1 for r in rows)


@data
@pytest.mark.parametrize("operator,least", [(toxicity.toxicity, 0.93), (quality.quality, 0.97)])
def test_held_out_accuracy(spark, operator, least):
    learned(spark, operator, least)


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality.quality])
def test_classifiers_take_odd_tables(spark, operator):
    column = "toxic" if operator is toxicity.toxicity else "quality"
    docs = frame(spark, ROWS + [(None, "no id"), (4, "one")])
    labels = spark.createDataFrame([(d, d % 2) for d in range(1, 40)] + [(None, 1), (7, None), (7, 1)],
                                   f"doc_id long, {column} int")
    out = operator(docs, labels).collect()
    assert len(out) == len(ROWS) + 2 and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert len(operator(docs, labels.where("doc_id < 0")).collect()) == len(ROWS) + 2


def test_empty_tables(spark):
    docs, labels = frame(spark, []), spark.createDataFrame([], "doc_id long, toxic int, quality int")
    bench = frame(spark, [], "item_id long, text string")
    pages = frame(spark, [], "page_id long, url string").withColumnRenamed("found", "html")
    for out in (jaccard_join.similar_groups(docs), exact_dedup.exact_groups(docs), suffix_dedup.repeated_strings(docs),
                decontamination.contamination(docs, bench), packing.packed_documents(docs),
                toxicity.toxicity(docs, labels), quality.quality(docs, labels), url_filters.filtered(pages),
                html_text.page_texts(pages), sharding.place(docs, "doc_id")):
        assert out.count() == 0


def test_rows_without_id_and_repeated_rows(spark):
    rows = [(None, ROWS[6][1]), (None, "lonely words without any copy here"), *ROWS[6:9], ROWS[6]]
    docs = frame(spark, rows)
    assert jaccard_join.similar_groups(docs).count() == len(rows)
    got = exact_dedup.exact_groups(docs)
    assert got.count() == len(rows)
    assert rows_of(got.where("doc_id IS NULL"), "keep_id") == {(9,), (None,)}
    assert suffix_dedup.repeated_strings(docs).where("doc_id IS NULL AND n_removed > 0").count() == 0
    assert decontamination.contamination(docs, frame(spark, [(None, "lonely"), (1, "")], "item_id long, text string")
                                         ).where("n_hit > 0").count() == 0
    assert packing.packed_documents(docs).where("piece = 0").count() == len(rows)
    kept = suffix_dedup.without_repeats(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))
    assert {r["doc_id"]: bytes(r["text_bytes"]) for r in kept.collect()}[9] == b""


@data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == sorted(df.columns)
    assert rows_of(df, *rel.columns) == {tuple(r) for r in rel.fetchall()}


def test_every_word_has_its_own_vector(spark, monkeypatch):
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(6000)}" for _ in range(60)) for _ in range(200)] + ["", None, "Ab, AB ab\n"]
    docs = frame(spark, [(i if i % 7 else None, t) for i, t in enumerate(texts)]).repartition(3)
    want, seen = {}, set()
    for _, key, owner in quality.tokens([(t or "").encode() for t in texts]):
        seen |= set(key.tolist())
        own = quality.index_vectors(key).astype(int)
        for i in range(len(key)):
            near = [j for j in range(i - 2, i + 3) if 0 <= j < len(key) and j != i and owner[j] == owner[i]]
            want[key[i]] = want.get(key[i], 0) + own[near].sum(axis=0)
    assert len(seen) > 5000
    for size in (quality.GROUP_BYTES, 500):
        monkeypatch.setattr(quality, "GROUP_BYTES", size)
        parts = docs.mapInArrow(quality.words_and_texts, quality.WORDS_AND_TEXTS)
        got = {r["key"] % 2**64: r["vector"] for r in quality.word_vectors(parts).collect()}
        assert got.keys() == {int(k) for k in want}
        assert all((np.array(got[int(k)]) == v).all() for k, v in want.items())
        assert quality.document_vectors(docs.select("doc_id", "text")).count() == len(texts)
    assert (quality.index_vectors(np.arange(9000, dtype=np.uint64)) != 0).sum(axis=1).tolist() == [quality.NONZERO] * 9000


def test_words_are_stored_in_few_bytes(spark):
    for numbers in ([], [0], [-1, 1, 127, -128, 300], [2**63 - 1, -2**63, 0, 5]):
        assert quality.unpacked(quality.packed(np.array(numbers, dtype=np.int64))).tolist() == numbers
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(100)) for _ in range(400)]
    docs = frame(spark, list(enumerate(texts))).coalesce(1)
    parts = stored(docs.mapInArrow(quality.words_and_texts, quality.WORDS_AND_TEXTS))
    used = sum(os.path.getsize(f.removeprefix("file://")) for f in parts.inputFiles())
    # Some 40,000 words: key, 24 sums and place in a text.
    assert 40_000 * 8 < used < 40_000 * 22


@pytest.mark.parametrize("page,want", [
    ('<a href="x"">text</a> <a href="y">more</a> end "q"', 'text more end "q"'),
    ("<a title=Bob's>text</a> it's all here", "text it's all here"),
    ("<p class=a\"b>one</p><p '>two</p><p a='>'b=\"'>\">three</p><i =x>four</i>", "one\n\ntwo\n\nthree\n\nfour"),
    ("</b \">kept</b> \"x\"", 'kept "x"'),
    ('<a b="c>d', "d"),
    ("<svg><title>no</title><defs/><text>in</text><text>side</text><desc>no</desc><title/></svg> after", "in\nside\nafter"),
    ("x <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> y", "x a=2 y"),
    ("is <select><option>a<option selected>b c<option>d</select> end", "is b c end"),
    ("is <select><option disabled>a<optgroup><option>b<option>c</select> end", "is b end"),
    ("<select multiple><option>a<option>b</select>", "a\nb"), ("<option>a</option>", "a"),
    ("<select><option>a<table><tr><td>b</table></select>c<select>", "a bc"),
    ("a <svg/><b/>b</b> <svg><foreignObject>c<br/>d</foreignObject></svg>", "a b c\nd")])
def test_html_attributes_and_foreign_text(page, want):
    assert html_text.render(page) == want


def test_contamination_judges_every_row_at_every_benchmark_size(spark):
    words = ROWS[6][1].split()
    items = [(i, " ".join(words[i * 13:i * 13 + 15])) for i in range(5)] + [(9, ROWS[12][1])]
    rows = [(None, ROWS[6][1]), (None, "clean words alone"), (None, None), (7, ROWS[6][1]), (7, ROWS[6][1]),
            (7, "other words " + " ".join(words[10:40])), (8, ""), (8, ROWS[12][1])]
    bench = frame(spark, items, "item_id long, text string")
    one = [(i, text) for i, (_, text) in enumerate(rows)]
    want = sorted((str(rows[r[0]][0]), *r[1:]) for r in brute.hits(one, items))
    for block in (1 << 20, 200):
        out = decontamination.contamination(frame(spark, rows).repartition(3), bench, block)
        got = out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == want
