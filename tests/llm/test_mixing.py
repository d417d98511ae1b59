"""Targets against a plain sharing of the budget, thresholds against a sort."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cohortflow.llm import mixing


def plain_targets(sizes, weights, most, budget):
    """Share by weight, cut at the limits, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_ones, target = Fraction(budget), set(names), {}
    while open_ones:
        total = sum(weight[s] for s in open_ones)
        above = {s for s in open_ones if left * weight[s] / total > most * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in open_ones}
        for s in above:
            target[s] = Fraction(most * sizes[s])
        left -= sum(target[s] for s in above)
        open_ones -= above
    return target


def documents(spark, seed, sources, n=400):
    draw = random.Random(seed)
    rows = [(i, draw.choice(sources), " ".join("w" * draw.randint(1, 3) for _ in range(draw.choice([0, 1, 5, 40, 200])))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string")


@pytest.mark.parametrize(
    "sources",
    [["a", "b", "c"], ["only"], ["a", "B", "é", "z", None, "", "zz", "𝒳", "￿"], ["hot"] * 20 + ["a", "b", "c", "d"], [f"s{i}" for i in range(300)]],
)
def test_targets_and_taken(spark, sources):
    rows, df = documents(spark, len(sources), sources)
    out = mixing.mix(df).collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = plain_targets(sizes, (5, 2, 1), 3, sum(sizes.values()))
    source = {i: s for i, s, _ in rows}
    size = {i: len(t.split()) for i, _, t in rows}
    largest = {s: max(size[i] for i in source if source[i] == s) for s in sizes}
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[s])
        assert r.targets[0] == pytest.approx(float(want[s]), rel=1e-12)
        assert 0 <= r.taken[0] <= 3 * r.size and (r.size == 0 or r.taken[0] % r.size == 0)
        taken[s] += r.taken[0]
    assert len(out) == len(rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2


def test_larger_budgets_take_all_that_smaller_ones_take(spark):
    _, df = documents(spark, 5, ["a", "b", "c", "d"])
    out = mixing.mix(df, budgets=(0.05, 0.3, 1.0, 2.0, 3.0, 5.0)).collect()
    assert all(list(r.taken) == sorted(r.taken) and len(r.taken) == 6 for r in out)
    assert all(r.taken[4] == r.taken[5] == 3 * r.size for r in out)


def test_the_edge_is_found_however_deep(spark, monkeypatch):
    """One digit a level: many refinements give the same rows as one."""
    _, df = documents(spark, 6, ["a", "b", "c", None])
    want = sorted(map(tuple, mixing.mix(df, budgets=(0.4, 1.0)).collect()))
    monkeypatch.setattr(mixing, "DIGITS", 1)
    assert sorted(map(tuple, mixing.mix(df, budgets=(0.4, 1.0)).collect())) == want


def test_shuffle_join_gives_the_same(spark, monkeypatch):
    _, df = documents(spark, 8, ["a", "b", None])
    want = sorted(map(tuple, mixing.mix(df).collect()))
    monkeypatch.setattr(mixing, "is_small", lambda _: False)
    again = mixing.mix(df.repartition(5))
    assert sorted(map(tuple, again.collect())) == want


def test_repeated_rows_and_texts_without_words(spark):
    rows = [(1, "a", "x y"), (1, "a", "x y"), (2, "a", None), (3, "a", ""), (4, "a", " \t\n"), (None, "b", "x"), (None, None, None), (5, "b", "p q r s t u")]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("hash", F.lit("extra"))).collect()
    assert len(out) == 8
    assert len({r.taken[0] for r in out if r.doc_id == 1}) == 1
    assert all(r.taken[0] == 0 for r in out if r.size == 0)
    empty = mixing.mix(spark.createDataFrame([], "doc_id long, source string, text string"))
    assert empty.collect() == []
