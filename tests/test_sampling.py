"""Splits, folds, nearest neighbours, oversampling and synthetic rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortflow.operators import balance, ranking
from cohortflow.operators.balance import smote_balance, smote_rows
from cohortflow.operators import neighbors as N
from cohortflow.operators.neighbors import knn_classify, knn_join, neighbor_rows
from cohortflow.operators.ranking import hash_rank, largest_remainder, running_totals
from cohortflow.operators.split import cv_folds, group_split, stratified_split
from cohortflow.operators.synth import append_synthetic, fit_copula, infer_kinds, sample_copula


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(1003).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("y"))


@pytest.fixture(scope="module")
def copies(spark):
    """A third of the rows are the same row."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v"), (F.col("id") % 2).cast("int").alias("y")
    )


def quotas(spark, counts, share):
    table = spark.createDataFrame(list(counts.items()), "y int, count long")
    return {r["y"]: r["quota"] for r in largest_remainder(table, "y", share).collect()}


def test_quotas(spark):
    assert quotas(spark, {0: 7, 1: 3}, 0.3) == {0: 2, 1: 1}
    assert sum(quotas(spark, {0: 333, 1: 333, 2: 334}, 0.2).values()) == 200
    assert quotas(spark, {None: 4, 1: 6}, 0.5) == {None: 2, 1: 3}


def test_null_labels_and_groups_stay(spark):
    """A null label is a class, rows without a group are one group: no row is lost."""
    df = spark.range(100).select(
        "id", F.when(F.col("id") % 10 != 0, (F.col("id") % 3 == 0).cast("int")).alias("y"), F.when(F.col("id") % 8 != 0, F.col("id") % 9).alias("g")
    )
    for key in (["id"], None):
        parts = stratified_split(df, "y", 0.3, key=key)
        assert parts.count() == 100 and parts.filter("is_test").count() == 30
        assert parts.filter("y is null and is_test").count() == 3
        folds = cv_folds(df, "y", 5, key=key)
        assert folds.count() == 100 and folds.filter("y is null").groupBy("fold").count().filter("count <> 2").count() == 0
    grouped = group_split(df, "y", "g", 0.3)
    assert grouped.drop("is_test").exceptAll(df).count() == 0 and grouped.count() == 100
    assert grouped.filter("g is null").select("is_test").distinct().count() == 1


@pytest.mark.parametrize("rows", [1, 10, 300])
def test_ranks_over_several_levels_of_buckets(spark, labelled, copies, rows, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", rows)
    monkeypatch.setattr(ranking, "BROADCAST_OFFSETS", 16)
    monkeypatch.setattr(ranking, "COARSE_DIGITS", 1)
    ranked = hash_rank(labelled, "y", 42, ["k"])
    assert ranked.groupBy("y").agg(F.count_distinct("class_rank").alias("n"), F.max("class_rank").alias("m")).filter("n <> m").count() == 0
    monkeypatch.undo()
    assert ranked.exceptAll(hash_rank(labelled, "y", 42, ["k"])).count() == 0


def test_many_classes(spark):
    df = spark.range(6000).select("id", (F.col("id") % 1500).alias("y"))
    parts = stratified_split(df, "y", 0.25, key=["id"])
    assert parts.filter("is_test").groupBy("y").count().filter("count <> 1").count() == 0
    assert parts.filter("is_test").count() == 1500


def test_new_rows_stay_in_their_class(spark):
    """Three classes whose ranks coincide: neighbours come from the same class."""
    rows = [(c, float(c * 1000 + i)) for c, n in ((0, 60), (1, 20), (2, 12)) for i in range(n)] + [(None, 5.0)]
    df = spark.createDataFrame(rows, "y int, x double")
    new = smote_rows(df, "y", ["x"], k=3)
    assert {r["y"]: r["count"] for r in new.groupBy("y").count().collect()} == {1: 40, 2: 48}
    assert new.filter((F.col("x") < F.col("y") * 1000) | (F.col("x") > F.col("y") * 1000 + 20)).count() == 0


def test_categories_without_number(spark):
    """A text column with more values than the driver is given."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "common").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("c"), (F.col("id") % 10).cast("double").alias("x")
    )
    spec = fit_copula(df)
    assert list(spec.wide) == ["c"]
    made = sample_copula(spark, spec, 900)
    rows = made.groupBy(F.col("c") == "common").count().collect()
    assert made.count() == 900 and made.filter("c is null").count() == 0
    assert abs({r[0]: r["count"] for r in rows}[True] / 900 - 1 / 3) < 0.06
    assert made.join(df.select("c").distinct(), "c", "left_anti").count() == 0


@pytest.mark.parametrize("share", [0.0, 0.2, 0.3, 1.0])
def test_split_is_exact_and_repeatable(labelled, share):
    once = stratified_split(labelled, "y", share, key=["k"])
    counts = {(r["y"], r["is_test"]): r["count"] for r in once.groupBy("y", "is_test").count().collect()}
    want = quotas(labelled.sparkSession, {0: 859, 1: 144}, share)
    assert {c: counts.get((c, True), 0) for c in (0, 1)} == want
    assert sum(counts.values()) == 1003
    again = stratified_split(labelled.repartition(5), "y", share, key=["k"])
    assert once.exceptAll(again).count() == 0


def test_split_with_many_copies_is_exact(copies):
    parts = stratified_split(copies, "y", 0.3)
    counts = {(r["y"], r["is_test"]): r["count"] for r in parts.groupBy("y", "is_test").count().collect()}
    assert counts == {(0, True): 450, (0, False): 1050, (1, True): 450, (1, False): 1050}
    assert parts.drop("is_test").exceptAll(copies).count() == 0


def test_rank_counts_every_row_once(copies):
    ranked = hash_rank(copies, "y", 42)
    per = ranked.groupBy("y").agg(F.count("*"), F.count_distinct("class_rank"), F.min("class_rank"), F.max("class_rank"))
    assert sorted(tuple(r) for r in per.collect()) == [(0, 1500, 1500, 1, 1500), (1, 1500, 1500, 1, 1500)]


def test_folds_are_even(labelled):
    sizes = {(r["y"], r["fold"]): r["count"] for r in cv_folds(labelled, "y", 5, key=["k"]).groupBy("y", "fold").count().collect()}
    for c in (0, 1):
        per = [sizes[(c, f)] for f in range(5)]
        assert max(per) - min(per) <= 1


def test_groups_stay_together(spark):
    df = spark.range(2000).select((F.col("id") % 90).alias("g"), (F.col("id") % 11 == 0).cast("int").alias("y"))
    parts = group_split(df, "y", "g", 0.3)
    assert parts.groupBy("g").agg(F.count_distinct("is_test").alias("n")).filter("n > 1").count() == 0
    assert parts.count() == 2000 and 0 < parts.filter("is_test").count() < 2000


def test_running_totals(spark):
    df = spark.range(500).select((F.col("id") * 1.0).alias("s"), (F.col("id") % 5).alias("n"))
    rows = running_totals(df, "s", ["n"], buckets=16).orderBy(F.desc("s")).collect()
    total = 0
    for r in rows:
        assert r["n_above"] == total
        total += r["n"]


def brute(q, p, k, same):
    out = {}
    for i, v in q.items():
        d = sorted((round(float(np.linalg.norm(v - w)), 9), j) for j, w in p.items() if not (same and i == j))
        out[i] = [j for _, j in d[:k]]
    return out


def points(spark, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in vectors.items()], "id long, vector array<double>")


@pytest.mark.parametrize(("pivots", "levels"), [(1, 1), (7, 1), (40, 1), (40, 2), (90, 2)])
def test_knn_self_join_equals_brute_force(spark, pivots, levels):
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(6, 3)) * 10
    vectors = {i: centers[i % 6] + rng.normal(size=3) for i in range(400)}
    vectors |= {1000 + i: np.array([1.0, 2.0, 3.0]) for i in range(200)}  # a third are copies
    vectors |= {2000 + i: np.round(rng.normal(size=3)) for i in range(60)}  # many ties
    found = {r["id"]: [n["id"] for n in r["neighbors"]] for r in knn_join(points(spark, vectors), None, 5, pivots=pivots, levels=levels).collect()}
    assert found == brute(vectors, vectors, 5, True)


@pytest.mark.parametrize(("pivots", "levels"), [(1, 1), (9, 1), (16, 2)])
def test_knn_between_two_sets(spark, pivots, levels):
    rng = np.random.default_rng(12)
    p, q = ({i: rng.normal(size=4) for i in range(n)} for n in (300, 80))
    q |= {500 + i: np.zeros(4) for i in range(50)}
    found = {r["id"]: [n["id"] for n in r["neighbors"]] for r in knn_join(points(spark, q), points(spark, p), 3, pivots=pivots, levels=levels, share=0.05, min_rows=5).collect()}
    assert found == brute(q, p, 3, False)


def test_cells_of_queries_are_looked_for_once(spark, monkeypatch):
    rng = np.random.default_rng(14)
    vectors = {i: rng.normal(size=3) for i in range(300)}
    calls, labels, kept, cells = [], [], N.materialize, N._home_cells
    monkeypatch.setattr(N, "materialize", lambda df, label: labels.append(label) or kept(df, label))
    monkeypatch.setattr(N, "_home_cells", lambda df, pivots: calls.append(df) or cells(df, pivots))
    asked = points(spark, {i: v for i, v in vectors.items() if i % 2})
    found = knn_join(asked, points(spark, vectors), 4, pivots=12, levels=1, own=True)
    assert len(calls) == 2 and "knn_asked" in labels  # written before several jobs read it
    monkeypatch.undo()
    want = brute({i: v for i, v in vectors.items() if i % 2}, vectors, 4, True)
    assert {r["id"]: [n["id"] for n in r["neighbors"]] for r in found.collect()} == want


def test_knn_stays_inside_class_and_small_classes_have_fewer(spark):
    df = points(spark, {i: np.array([float(i)]) for i in range(12)}).withColumn("c", F.when(F.col("id") < 3, "a").otherwise("b"))
    rows = neighbor_rows(knn_join(df, None, 5, by="c"), ["id", "c"]).collect()
    assert {r["neighbor_id"] for r in rows if r["c"] == "a"} == {0, 1, 2}
    assert sum(r["id"] == 0 for r in rows) == 2 and sum(r["id"] == 5 for r in rows) == 5


def test_two_levels_keep_classes_apart_and_cells_small(spark):
    rng = np.random.default_rng(13)
    vectors = {i: rng.normal(size=2) for i in range(900)}
    df = points(spark, vectors).withColumn("c", F.when(F.col("id") < 4, "rare").when(F.col("id") % 3 == 0, "a").otherwise("b"))
    one, two = ({(r["id"], r["rank"]): r["neighbor_id"] for r in neighbor_rows(knn_join(df, None, 5, by="c", pivots=60, levels=n), ["id", "c"]).collect()} for n in (1, 2))
    assert one == two
    prepared = N._prepared(df, "id", "vector", None, None)
    upper, levels = N._pivots(prepared, 60, 2)
    assert levels == 2 and len(upper) == 7
    cells = N._home_cells(prepared, upper)
    placed = N._lower_cells(cells, N._lower_pivots(cells, upper, 15))
    assert placed.count() == 900 and placed.groupBy("cell").count().agg(F.max("count")).first()[0] < 100


def test_knn_votes(spark):
    train = points(spark, {i: np.array([float(i)]) for i in range(10)}).withColumn("y", (F.col("id") >= 5).cast("int"))
    got = {r["id"]: (r["probability"], r["prediction"]) for r in knn_classify(train, points(spark, {1: np.array([0.0]), 2: np.array([9.0]), 3: np.array([4.6])}), "y").collect()}
    assert got == {1: (0.0, 0), 2: (1.0, 1), 3: (0.6, 1)}


def test_smote_balances_on_segments(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": range(120), "a": rng.normal(size=120), "b": rng.normal(size=120), "y": [1] * 20 + [0] * 100})
    df = spark.createDataFrame(pdf)
    new = smote_rows(df, "y", ["a", "b"], key=["k"]).toPandas()
    assert len(new) == 80 and (new["y"] == 1).all()
    old = pdf[pdf["y"] == 1][["a", "b"]].to_numpy()
    for row in new[["a", "b"]].to_numpy():
        gaps = np.linalg.norm(old[:, None] - old[None], axis=2) - (np.linalg.norm(old - row, axis=1)[:, None] + np.linalg.norm(old - row, axis=1)[None])
        np.fill_diagonal(gaps, -np.inf)
        assert gaps.max() == pytest.approx(0, abs=1e-9)
    balanced = smote_balance(df, "y", ["a", "b"], key=["k"]).groupBy("y").count().collect()
    assert {r["count"] for r in balanced} == {100}


def test_smote_without_key_and_with_copies(spark):
    df = spark.createDataFrame([(1.0, 1)] * 4 + [(2.0, 1)] * 2 + [(float(i), 0) for i in range(30)], "a double, y int")
    new = smote_rows(df, "y", ["a"])
    assert new.count() == 24 and new.filter("a < 1 or a > 2").count() == 0


def test_smote_needs_two_rows(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 0), (3.0, 0)], "a double, y int")
    with pytest.raises(ValueError, match="single row"):
        smote_rows(df, "y", ["a"])


def test_copula_keeps_shape(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=3000)
    pdf = pd.DataFrame({"x": x, "twin": 2 * x + rng.normal(scale=0.3, size=3000), "n": rng.integers(1, 6, 3000), "s": np.where(x > 0.8, "high", "low")})
    real = spark.createDataFrame(pdf)
    fake = sample_copula(spark, fit_copula(real, real.columns), 3000)
    got = fake.toPandas()
    assert dict(fake.dtypes) == dict(real.dtypes)
    assert got["x"].between(pdf["x"].min(), pdf["x"].max()).all()
    assert got["x"].corr(got["twin"]) > 0.95
    assert set(got["n"]) <= {1, 2, 3, 4, 5} and (got["s"] == "high").mean() == pytest.approx((pdf["s"] == "high").mean(), abs=0.03)
    assert fake.exceptAll(sample_copula(spark, fit_copula(real, real.columns), 3000)).count() == 0
    both = append_synthetic(real, fake)
    assert both.filter("is_synthetic").count() == 3000 and both.count() == 6000


def test_kinds(spark):
    df = spark.range(200).select("id", (F.col("id") % 3).alias("code"), F.lit("a").alias("s"), F.current_date().alias("d"), F.lit(True).alias("b"), F.rand().alias("x"))
    assert infer_kinds(df) == {"id": "id", "code": "numerical", "s": "categorical", "d": "datetime", "b": "boolean", "x": "numerical"}


def test_best_border_considers_every_value(spark):
    """The border of a rare narrow signal among 30,000 distinct values: no sample of borders need hold it."""
    rng = np.random.default_rng(8)
    x = rng.permutation(30_000).astype(float)
    y = np.where(x >= 29_970, 1, rng.random(30_000) < 0.3).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    order = np.argsort(x)
    left, n, p = np.arange(1, 30_000), 30_000, y.sum()
    lp = np.cumsum(y[order])[:-1]
    weighted = 2 * lp * (1 - lp / left) + 2 * (p - lp) * (1 - (p - lp) / (n - left))
    assert ranking.best_border(df, "x", "y") == x[order][weighted.argmin() + 1] == 29_970
    assert ranking.best_border(df.filter("x < 1"), "x", "y") is None and ranking.best_border(df.limit(0), "x", "y") is None


def test_running_totals_make_their_input_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(v):
        made.add(1)
        return float(v)

    df = spark.range(100).select(F.udf(counted, "double")("id").alias("v"), F.lit(1).alias("n"))
    assert running_totals(df, "v", ["n"]).filter("n_above = 99 - v").count() == 100
    assert made.value == 100


def test_copula_scores_are_made_once(spark, monkeypatch):
    """The correlation reads its scores twice: they are stored, not made anew in each pass."""
    from cohortflow.operators import synth

    kept, stored = [], synth.materialize
    monkeypatch.setattr(synth, "materialize", lambda df, label: kept.append(label) or stored(df, label))
    rows = spark.range(50).selectExpr("cast(id as double) AS a", "cast(id * id % 17 as double) AS b")
    synth.fit_copula(rows, ["a", "b"])
    assert kept == ["copula_input", "copula_scores"]


def _brute(vectors, labels, ids, k):
    out = {}
    for i in ids:
        d = np.round(np.sqrt(((vectors - vectors[i]) ** 2).sum(1)), 9)
        d[(labels != labels[i]) | (np.arange(len(d)) == i)] = np.inf
        order = np.lexsort((np.arange(len(d)), d))[:k]
        out[i] = [int(j) for j in order if np.isfinite(d[j])]
    return out


def _labelled_points(spark, vectors, labels):
    return spark.createDataFrame([(i, [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(vectors, labels, strict=True))], "id long, vector array<double>, c int")


@pytest.mark.parametrize("cells", [False, True])
def test_vectors_that_no_bound_parts_meet_in_packed_blocks(spark, monkeypatch, cells):
    rng = np.random.default_rng(21)
    vectors, labels = rng.normal(size=(500, 24)), rng.integers(0, 3, 500)
    vectors[50:90], labels[:4] = vectors[0], 9
    for name, value in {"ONE_BLOCK": 40, "PACKED_NUMBERS": 24 * 30, "PACKED_QUERIES": 24 * 20, "PART_BYTES": 20_000}.items():
        monkeypatch.setattr(N, name, value)
    if cells:
        monkeypatch.setattr(N, "ONE_CELL", 100)
        monkeypatch.setattr(N, "POINTS_PER_CELL", 20)
    calls, packed = [], N._scan_packed
    monkeypatch.setattr(N, "_scan_packed", lambda *a: calls.append(1) or packed(*a))
    found = knn_join(_labelled_points(spark, vectors, labels), None, 5, by="c").collect()
    assert {r["id"]: [n["id"] for n in r["neighbors"]] for r in found} == _brute(vectors, labels, range(500), 5)
    assert calls == [1]


def test_some_of_the_points_may_ask(spark):
    rng = np.random.default_rng(22)
    vectors, labels = np.round(rng.normal(size=(200, 2)), 1), rng.integers(0, 2, 200)
    df = _labelled_points(spark, vectors, labels)
    found = knn_join(df.filter("id % 4 = 0"), df, 5, by="c", own=True).collect()
    assert {r["id"]: [n["id"] for n in r["neighbors"]] for r in found} == _brute(vectors, labels, range(0, 200, 4), 5)


def test_smote_searches_only_for_rows_that_it_starts_from(spark, monkeypatch):
    asked = []
    search = balance.knn_join
    monkeypatch.setattr(balance, "knn_join", lambda q, *a, **k: asked.append(q.count()) or search(q, *a, **k))
    df = spark.range(400).selectExpr("id", "cast(id % 37 as double) x", "cast(id % 11 as double) z", "cast(id < 210 as int) y")
    assert smote_rows(df, "y", ["x", "z"], key=["id"]).count() == 20
    assert 0 < asked[0] <= 20
