"""The pipeline's stages, each against brute force over what the stage before kept."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from pressline.llm import decontamination, exact_dedup, jaccard_join, quality  # noqa: E402
from pressline.llm.storage import stored  # noqa: E402
from test_operators import check_packing, prose  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    labels, bench = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    want = {
        "quality_classifier": lambda rows: {r["doc_id"] for r in quality.quality(docs, labels).collect() if r["predicted"]},
        "exact_dedup": lambda rows: {r[0] for r in brute.exact_groups(rows) if r[3]},
        "ngram_jaccard_join": lambda rows: {d for d, (_, c) in brute.near_groups(rows).items() if c == d},
        "benchmark_decontamination": lambda rows: {r[0] for r in brute.hits(rows, items) if not r[5]}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        kept = stored(stage(spark, docs, FOLDER))
        assert kept.columns == columns
        assert {r["doc_id"] for r in kept.collect()} == want[name](rows), name
        docs = kept
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect(), rows)
    assert corpus_pipeline.run(spark, FOLDER).count() >= len(rows)


def test_stages_keep_rows_without_id(spark, monkeypatch):
    rng = random.Random(21)
    text = [prose(rng, 60) for _ in range(6)]
    near = text[3].rsplit(" ", 1)[0] + " other"
    rows = [(None, text[0]), (None, text[0].replace("a", "A")), (5, text[1]), (None, text[1]), (None, text[2]),
            (6, text[3]), (None, near), (None, text[4]), (None, text[4].rsplit(" ", 1)[0] + " other"),
            (7, text[5]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS lang").repartition(3)
    labels = spark.createDataFrame([(5, 1), (8, 0)], "doc_id long, quality int")

    def kept(df):
        assert df.columns == docs.columns
        return sorted([(r["doc_id"] or 0, (r["text"] or "").lower()) for r in df.collect()])

    def want(*places):
        return sorted((rows[i][0] or 0, (rows[i][1] or "").lower()) for i in places)

    assert kept(exact_dedup.drop_copies(docs)) == want(0, 2, 4, 5, 6, 7, 8, 9, 10)
    groups = exact_dedup.exact_groups(docs)
    assert groups.where("kept AND doc_id IS NULL").count() == 6 and groups.count() == len(rows)
    ends = kept(jaccard_join.drop_near_copies(docs))
    assert ends in (want(0, 2, 4, 5, 7, 9, 10), want(0, 2, 4, 5, 8, 9, 10))
    bench = spark.createDataFrame([(1, text[2]), (2, text[5])], "item_id long, text string")
    assert kept(decontamination.drop_contaminated(docs, bench)) == want(0, 1, 2, 3, 5, 6, 7, 8, 10)
    scores = quality.quality(docs, labels)
    assert kept(quality.drop_poor(docs, labels)) == want(*range(len(rows)))  # without a model all have 0.5
    monkeypatch.setattr(quality, "quality", lambda d, *_: d.selectExpr("doc_id", "cast(length(text) % 2 = 0 as int) AS predicted"))
    assert kept(quality.drop_poor(docs, labels)) == want(*[i for i, r in enumerate(rows) if r[1] and len(r[1]) % 2 == 0])
    assert scores.count() == len(rows)


def test_stages_free_what_the_stage_before_stored(spark, tmp_path):
    from pressline.llm.storage import stored as keep
    made = []

    @corpus_pipeline.tidy
    def stage(spark, docs, sf_dir):
        out = keep(docs)
        made.append(out.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0])
        return out.selectExpr("*")

    docs = spark.range(5)
    first = stage(spark, docs, "")
    second = stage(spark, first, "")  # not written: what it reads stays
    assert os.path.isdir(made[0]) and second.count() == 5
    second.write.parquet(f"{tmp_path}/out")
    third = stage(spark, spark.read.parquet(f"{tmp_path}/out"), "")
    assert not os.path.isdir(made[0]) and not os.path.isdir(made[1]) and third.count() == 5


def test_stages_decide_by_row(spark, monkeypatch):
    rng = random.Random(31)
    text = [prose(rng, 60) for _ in range(5)]
    near = text[2].rsplit(" ", 1)[0] + " other"
    # One id with three texts, equal rows, a near copy and a contaminated text under a repeated id.
    rows = [(5, text[0]), (5, text[1]), (5, text[1]), (6, text[2]), (6, near), (7, text[3]), (7, text[3]), (8, text[1].replace("a", "A")),
            (6, text[4]), (None, text[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'mine' AS row_key", "'k' AS kept", "1 AS place", "2 AS first").repartition(3)
    labels = spark.createDataFrame([(5, 1), (8, 0)], "doc_id long, quality int")

    def kept(df):
        assert df.columns == docs.columns and {r["row_key"] for r in df.collect()} <= {"mine"}
        return sorted([(r["doc_id"] or 0, (r["text"] or "").lower()) for r in df.collect()])

    def rows_at(*places):
        return sorted((rows[i][0] or 0, rows[i][1].lower()) for i in places)

    exact = kept(exact_dedup.drop_copies(docs))
    assert sorted(t for _, t in exact) == sorted(x.lower() for x in (text[0], text[1], text[2], near, text[3], text[4]))
    ends = kept(jaccard_join.drop_near_copies(docs))
    assert len(ends) == 5 and {t for _, t in ends} >= {text[0].lower(), text[1].lower(), text[3].lower(), text[4].lower()}
    bench = spark.createDataFrame([(1, text[1]), (2, text[4])], "item_id long, text string")
    assert kept(decontamination.drop_contaminated(docs, bench)) == rows_at(0, 3, 4, 5, 6)
    monkeypatch.setattr(quality, "quality", lambda d, *_: d.selectExpr("doc_id", "cast(length(text) % 2 = 0 as int) AS predicted"))
    assert kept(quality.drop_poor(docs, labels)) == rows_at(*[i for i, r in enumerate(rows) if len(r[1]) % 2 == 0])


def test_notes_of_nested_makers_are_kept_apart(spark):
    from pressline.llm.storage import folders_noted
    with folders_noted() as outer:
        with folders_noted() as inner:
            stored(spark.range(3))
        stored(spark.range(3))
    assert len(inner) == 1 and len(outer) == 2 and outer[0] == inner[0]
