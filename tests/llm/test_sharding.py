"""The lookup table and the placement against a table that is built here, from whole permutations."""

import os
from hashlib import md5

import pytest

from pressline.llm import sharding
from pressline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def number(text, bound):
    return int(md5(text.encode()).hexdigest(), 16) % bound


def built(shards, slots):
    """Every shard's order of preference is written out; in turn each takes its first free slot."""
    orders = []
    for s in shards:
        first, step = number(f"start {s}", slots), number(f"step {s}", slots - 1) + 1
        order = [(first + k * step) % slots for k in range(slots)]
        assert sorted(order) == list(range(slots))
        orders.append(iter(order))
    owner = {}
    while len(owner) < slots:
        for k, order in enumerate(orders):
            if len(owner) == slots:
                break
            owner[next(x for x in order if x not in owner)] = k
    return [owner[x] for x in range(slots)]


@pytest.mark.parametrize("n, slots", [(1, 7), (3, 7), (7, 7), (10, 211), (64, 10_007)])
def test_table_equals_whole_permutations(n, slots):
    shards = tuple(f"shard-{i}" for i in range(n))
    assert sharding.filled_table(shards, slots) == built(shards, slots)


@pytest.mark.parametrize("shards, slots", [((), 7), (("a", "a"), 7), (("a",), 8), (tuple("abcdefgh"), 7)])
def test_bad_tables_are_refused(shards, slots):
    with pytest.raises(ValueError):
        sharding.filled_table(shards, slots)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_sharding_query(spark):
    table = built(sharding.SHARDS, sharding.SLOTS)
    rows = QUERIES["op10_sharding"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for r in rows:
        slot = int(md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r["slot"], r["shard"]) == (slot, sharding.SHARDS[table[slot]])
