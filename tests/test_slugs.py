"""Slug assignment against the sequential rule."""

import random

import pytest

from pressline.operators import slugs
from pressline.operators.slugs import assign_slugs


def base_of(title):
    out = "".join(c if c.isascii() and (c.isalnum()) else "-" for c in title.lower())
    while "--" in out:
        out = out.replace("--", "-")
    return out.strip("-") or "item"


def sequential(rows, frozen):
    taken, out = set(frozen), {}
    for i, title in sorted(rows):
        base = base_of(title)
        slug, n = base, 2
        while slug in taken:
            slug, n = f"{base}-{n}", n + 1
        taken.add(slug)
        out[i] = slug
    return out


def run(spark, rows, frozen):
    new = spark.createDataFrame(rows, "id long, title string")
    old = spark.createDataFrame([(s,) for s in frozen], "slug string")
    got = {r.id: r.slug for r in assign_slugs(new, old, "id", "title").collect()}
    assert got == sequential(rows, frozen)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_related_titles_and_frozen_gaps(spark, seed):
    rng = random.Random(seed)
    titles = ["a", "A!", "a 2", "a 3", "a 2 2", "a-2-3", "b", "b 7", "a 02", "", "item 2", "c 2 2 2"]
    frozen = rng.sample(["a", "a-2", "a-4", "a-5", "b-2", "a-2-2", "b-7", "item", "x", "a-2-3"], 4)
    rows = [(i, rng.choice(titles)) for i in rng.sample(range(1000), 70)]
    run(spark, rows, frozen)


def test_one_hot_title(spark):
    rows = [(i * 3, "Daily digest" if i % 3 else f"Daily digest {i % 20}") for i in range(240)]
    run(spark, rows, ["daily-digest", "daily-digest-4", "daily-digest-90"])


def test_nothing_frozen_and_no_collision(spark):
    run(spark, [(1, "One"), (2, "Two")], ["three"])


def test_many_numbered_titles_compete_for_slots(spark, monkeypatch):
    # Short stretches, so that maps of several stretches are applied one after the other.
    monkeypatch.setattr(slugs.won_claims, "__defaults__", (7,))
    rng = random.Random(12)
    rows = [(i, "Episode" if rng.random() < 0.5 else f"Episode {rng.randint(1, 160)}") for i in range(400)]
    run(spark, rows, [f"episode-{k}" for k in rng.sample(range(2, 200), 25)])


def test_folded_maps_equal_single_steps():
    rng = random.Random(5)
    for _ in range(200):
        limits = [rng.randint(-3, 30) for _ in range(rng.randint(0, 40))]
        found = slugs._thresholds(limits)
        for start in range(35):
            won = start
            for c in limits:
                won += won <= c
            assert won == start + sum(t >= start for t in found)
