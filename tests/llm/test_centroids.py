"""Clusters against plain whole-number k-means, and the bounds that rule centroids out."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from cohortflow.llm import centroids

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def plain(rows, k, rounds, scale=64):
    """{(id, vector): (cluster, distance, centroid)} with Python numbers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, vs in groups.items():
            centres[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    return sorted((str(i), near(v)[1], near(v)[0], tuple(centres[near(v)[1]])) for i, v in kept)


def got(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, tuple(r.components)) for r in df.collect())


def blobs(n, dimensions, seed, spread=0.1):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(5, dimensions))
    return [(i, [float(np.float32(x)) for x in middle[i % 5] + draw.normal(size=dimensions) * spread]) for i in range(n)]


@pytest.mark.parametrize(("n", "dimensions", "k", "pivots"), [(300, 8, 16, 4), (120, 3, 7, 8), (40, 1, 5, 2), (9, 4, 16, 1), (200, 20, 3, 30)])
def test_equal_to_plain_search(spark, n, dimensions, k, pivots):
    rows = blobs(n, dimensions, n)
    rows += [(n + i, rows[0][1]) for i in range(n // 3)]  # a group of copies
    found = centroids.cluster(spark.createDataFrame(rows, SCHEMA), k=k, rounds=3, dimensions=dimensions, pivots=pivots)
    assert got(found) == plain(rows, k, 3)


def test_sums_over_clusters(spark):
    rows = blobs(100, 4, 2)
    found = centroids.cluster(spark.createDataFrame(rows, SCHEMA), k=4, rounds=2, dimensions=4).collect()
    for r in found:
        assert r.cluster_inertia == sum(o.distance for o in found if o.cluster == r.cluster)
        assert r.inertia == sum(o.distance for o in found)


def test_odd_vectors(spark):
    """Wrong sizes, nulls and non-finite components have no result; huge ones stop at the limit; ids may be null or repeated."""
    good = [(None, [1.0, 2.0]), (1, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [-0.001, 0.5]), (3, [3e38, -3e38])]
    bad = [(4, None), (5, []), (6, [1.0]), (7, [1.0, 2.0, 3.0]), (8, [None, 1.0]), (9, [math.nan, 1.0]), (10, [math.inf, 0.0]), (11, [0.0, -math.inf])]
    found = centroids.cluster(spark.createDataFrame(good + bad, SCHEMA), k=2, rounds=1, dimensions=2)
    rows = found.collect()
    assert sorted(str(r.vec_id) for r in rows) == ["1", "1", "2", "3", "None"]
    limit = centroids.largest_component(2)
    assert all(r.distance >= 0 for r in rows) and (2 * limit) ** 2 * 2 < 1 << 63
    assert centroids.cluster(spark.createDataFrame(bad, SCHEMA), dimensions=2).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_rule_out(seed):
    draw = np.random.default_rng(seed)
    middle = draw.integers(-500, 500, (16, 64))
    vectors = middle[draw.integers(0, 16, 2000)] + draw.integers(-20, 20, (2000, 64))
    simplex = centroids.choose_pivots(vectors[:64], 8)
    seen, targets = centroids.apexes(vectors, simplex), centroids.apexes(middle, simplex)
    exact = ((vectors[:, None, :] - middle[None]) ** 2).sum(2)
    a, c = seen.place, targets.place
    lower = ((a[:, None] - c[None]) ** 2).sum(2)
    upper = lower + 4 * np.outer(a[:, -1], c[:, -1])
    slack = 1e-6 * exact.max()
    assert (lower <= exact + slack).all() and (upper >= exact - slack).all()
    flags = centroids.possible(seen, targets)
    assert flags[np.arange(2000), exact.argmin(1)].all()
    assert flags.mean() < 0.5  # even of centroids that are all as far apart, most are not compared exactly
    cluster, distance = centroids.nearest(vectors, seen, middle, targets)
    assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()


def test_pivots_on_a_line_or_in_one_point():
    same = np.ones((10, 3), np.int64)
    assert len(centroids.choose_pivots(same, 5).pivots) == 1
    line = np.outer(np.arange(10), np.ones(3, np.int64))
    simplex = centroids.choose_pivots(line, 5)
    assert len(simplex.pivots) == 2
    cluster, distance = centroids.nearest(line, centroids.apexes(line, simplex), line[::3], centroids.apexes(line[::3], simplex))
    assert cluster.tolist() == [0, 0, 1, 1, 1, 2, 2, 2, 3, 3] and distance.tolist() == [0, 3, 3, 0, 3, 3, 0, 3, 3, 0]


def test_repeated_pivot_distances_and_ties():
    """A vector midway between two centroids goes to the smaller number."""
    centres = np.array([[4, 0], [0, 0], [4, 0]])
    vectors = np.array([[2, 0], [2, 7], [4, 0]])
    simplex = centroids.choose_pivots(centres, 3)
    cluster, _ = centroids.nearest(vectors, centroids.apexes(vectors, simplex), centres, centroids.apexes(centres, simplex))
    assert cluster.tolist() == [0, 0, 0]
