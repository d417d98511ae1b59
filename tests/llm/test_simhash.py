import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortflow.llm import simhash as S
from cohortflow.llm.queries import QUERIES
from tests.llm.conftest import odd_documents


def brute_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\x20\x09\x0a\x0b\x0c\x0d":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(prints))]


def expected(rows):
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i is not None, i), f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, roots, strict=True))


def shown(rows):
    return sorted(((r["doc_id"] is not None, r["doc_id"]), r["fingerprint"], r["component_id"]) for r in rows)


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert shown(QUERIES["op7_simhash"](spark, sf_dir).collect()) == expected(rows)


def test_odd_documents(spark, odd_dir):
    assert shown(QUERIES["op7_simhash"](spark, odd_dir).collect()) == expected([(i, t) for i, t, _ in odd_documents()])


@pytest.mark.parametrize("seed", range(3))
def test_forest_spans_all_links(seed):
    rng = random.Random(seed)
    values = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 8)):
            values.add(x)
            for _ in range(rng.randrange(1, 6)):  # chains: each near the one before
                x ^= 1 << rng.randrange(64)
    values = sorted(values)
    label = list(range(len(values)))
    for a, b in S.forest(values, 4):
        assert (values[a] ^ values[b]).bit_count() <= 4
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = [new if x == old else x for x in label]
    assert label == brute_components(values)


@pytest.mark.parametrize("mean", [200, 1])
def test_hot_shards_are_cut(spark, mean, monkeypatch):
    """A dense group larger than a task's share, in few and in many segments."""
    monkeypatch.setattr(S, "MEAN_SHARD", mean)
    rng = random.Random(5)
    centre, values = rng.getrandbits(64), set()
    while len(values) < 150:
        values.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    while len(values) < 300:
        values.add(rng.getrandbits(64))
    values = sorted(values)
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    links = S.shard_links(spark.createDataFrame(signed, "fp long"), 4, shard_rows=20)
    got = {r["node"]: r["component"] for r in S.components(links).collect()}
    groups = [got.get(f, f) for (f,) in signed]
    want = brute_components(values)
    assert len(set(zip(groups, want, strict=True))) == len(set(groups)) == len(set(want))


def test_long_chain_of_links(spark):
    links = spark.range(1, 400).select((F.col("id") * 7 % 400).alias("a"), ((F.col("id") + 1) * 7 % 400).alias("b"))
    rows = S.components(links).collect()
    assert {r["component"] for r in rows} == {0} and len(rows) == 400


@pytest.mark.parametrize("order", ["rising", "zigzag"])
def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch, order):
    """Names that rise along a chain, and ones of which every other is small."""
    n, rounds, plain = 10_000, [], S.stored
    monkeypatch.setattr(S, "stored", lambda df, name: rounds.append(name) or plain(df, name))
    name = (lambda c: c) if order == "rising" else (lambda c: F.when(c % 2 == 0, c / 2).otherwise(n + c).cast("long"))
    links = spark.range(n - 1).select(name(F.col("id")).alias("a"), name(F.col("id") + 1).alias("b"))
    rows = S.components(links)
    assert rows.agg(F.min("component"), F.max("component"), F.count("*")).first()[:] == (0, 0, n)
    assert rounds.count("labels") <= 20 and len(rounds) <= 60


def test_segments():
    assert S.segments(64, 5)[-1] == (51, 13) and sum(w for _, w in S.segments(64, 7)) == 64
    assert S.parts_for(10, 4) == 5 < S.parts_for(10**8, 4)


def test_one_of_each_group_stays(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = expected([(i, t) for i, t, _ in odd_documents()])
    heads = {c for _, _, c in want if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(heads)
