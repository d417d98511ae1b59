import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortflow.functions.expressions import AGE_EDGES, AGE_LABELS
from cohortflow.operators import preprocess as P
from cohortflow.operators import profile, scorers
from cohortflow.operators.binning import with_interpolation, with_steps
from cohortflow.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(
        {
            "smooth": rng.normal(size=4000),
            "ties": rng.integers(0, 4, 4000).astype(float),
            "hot": np.where(rng.random(4000) < 0.4, 7.0, rng.exponential(5, 4000)),
            "gaps": np.where(rng.random(4000) < 0.3, np.nan, rng.random(4000)),
            "flat": 3.0,
        }
    )
    df = spark.createDataFrame(pdf)
    return pdf, df.withColumn("gaps", F.when(~F.isnan("gaps"), F.col("gaps")))


@pytest.mark.parametrize(("inner", "error"), [(5000, 1 / 2000), (40, 1 / 50), (3, 1 / 20)])
def test_quantiles_are_exact_however_small_the_gaps(numbers, inner, error):
    pdf, df = numbers
    probs = [0, 0.001, 0.25, 0.5, 0.75, 0.9999, 1]
    got = exact_quantiles(df, list(pdf.columns), probs, inner_rows=inner, error=error)
    for c in pdf.columns:
        assert got[c] == pytest.approx(pdf[c].quantile(probs).tolist(), rel=1e-12, abs=1e-12), c


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(empty, ["x"], [0.5]) == {"x": [None]}


def test_steps_and_interpolation(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (0.5,), (1.0,), (3.0,), (9.0,)], "x double")
    steps = with_steps(with_steps(df, {"x": [0, 1, 3]}, "le"), {"x": [0, 1, 3]}, "lt", strict=True)
    assert [tuple(r)[1:] for r in steps.collect()] == [(None, None), (0, 0), (1, 0), (1, 1), (2, 1), (3, 2), (3, 3)]
    line = with_interpolation(df, {"x": ([0, 1, 3], [10, 20, 0])}, "y")
    assert [r["xy"] for r in line.collect()] == [None, 10, 10, 15, 20, 0, 0]


def test_moments_match_pandas(numbers):
    pdf, df = numbers
    rows = {r["column_name"]: r for r in profile.moments(df, list(pdf.columns)).collect()}
    for c in pdf.columns:
        x = pdf[c].dropna()
        assert rows[c]["n"] == len(x)
        assert rows[c]["std"] == pytest.approx(x.std(), abs=1e-12)
        if c != "flat":
            z = (x - x.mean()) / x.std(ddof=0)
            assert rows[c]["skewness"] == pytest.approx((z**3).mean())
    assert rows["flat"]["skewness"] is None


def test_describe(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", None), (None, 4.0)], "s string, x double")
    rows = {r["column_name"]: r for r in profile.describe_all(df).collect()}
    assert (rows["s"]["count"], rows["s"]["unique"], rows["s"]["top"], rows["s"]["freq"]) == (3, 2, "b", 2)
    assert (rows["x"]["count"], rows["x"]["p50"], rows["x"]["max"], rows["x"]["top"]) == (3, 2.0, 4.0, None)


def test_empty_bins_are_reported(spark):
    rows = profile.binned_counts(spark.createDataFrame([(20,), (150,), (None,)], "age int"), "age", AGE_EDGES, AGE_LABELS).collect()
    assert [r["count"] for r in rows] == [0, 1, 0, 0, 0, 0, 0, 0, 0, 0]


def test_correlation_of_constant_is_null(numbers):
    pdf, df = numbers
    rows = {r["feature"]: r["correlation"] for r in profile.corr_with_target(df, ["smooth", "gaps", "flat"], "hot").collect()}
    assert rows["flat"] is None
    assert rows["gaps"] == pytest.approx(pdf["gaps"].corr(pdf["hot"]))
    matrix = {(r[0], r[1]): r[2] for r in profile.corr_matrix(df, ["smooth", "gaps", "hot"], pairs_per_job=2).collect()}
    assert len(matrix) == 9 and matrix[("hot", "gaps")] == pytest.approx(pdf["gaps"].corr(pdf["hot"]))


def test_histogram_matches_numpy(numbers):
    pdf, df = numbers
    got = [r["count"] for r in profile.histogram(df, "smooth", 13).orderBy("bin_idx").collect()]
    assert got == np.histogram(pdf["smooth"], 13)[0].tolist()


def test_outlier_branches(numbers):
    _, df = numbers
    bounds = P.fit_outlier_bounds(df, ["smooth", "hot", "flat"])
    assert [bounds[c]["method"] for c in ("smooth", "hot", "flat")] == ["zscore", "iqr", "zscore"]
    assert bounds["flat"]["lower"] == bounds["flat"]["upper"] == 3.0
    once = P.clip_columns(df, bounds)
    assert once.exceptAll(P.clip_columns(once, bounds)).count() == 0


def test_power_lambda_is_the_likelihood_maximum(numbers):
    pdf, df = numbers
    x = pdf["hot"].to_numpy()

    def loglik(lam):
        y = np.log1p(x) if lam == 0 else ((1 + x) ** lam - 1) / lam
        return -len(x) / 2 * np.log(y.var()) + (lam - 1) * np.log1p(x).sum()

    lam = P.fit_power(df, ["hot"], {"hot": float(x.mean())})["hot"]
    assert loglik(lam) >= max(loglik(g) for g in np.arange(-2, 2, 0.01)) - 1e-2


def test_power_grid_moves_past_its_end(spark):
    x = np.exp(np.linspace(0.1, 3, 500)) ** -1  # best lambda far below -2
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    assert P.fit_power(df, ["x"], {"x": float(x.mean())})["x"] < -2


def test_shaping_lands_in_unit_interval_and_survives_saving(spark, numbers, tmp_path):
    _, df = numbers
    spec = P.fit_shaping(df, ["smooth", "hot", "flat", "absent"])
    shaped = spec.shape(df)
    ends = shaped.agg(*[f(c) for c in ("smooth", "hot", "flat") for f in (F.min, F.max)]).first()
    assert list(ends) == pytest.approx([0, 1, 0, 1, 0, 0], abs=1e-9)
    spec.save(spark, str(tmp_path / "spec"))
    again = P.PreprocessSpec.load(spark, str(tmp_path / "spec"))
    assert again == spec
    assert shaped.exceptAll(again.shape(df)).count() == 0


def test_scaling_of_constant_columns(numbers):
    _, df = numbers
    assert P.apply_min_max(df, P.fit_min_max(df, ["flat"])).agg(F.max("flat")).first()[0] == 0
    assert P.apply_z_score(df, P.fit_z_score(df, ["flat"])).agg(F.max("flat")).first()[0] == 0


def test_one_hot(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x"), ("c", None)], "s string, single string")
    levels = P.fit_levels(df)
    assert levels == {"s": ["a", "b", "c"], "single": ["x"]}
    assert [tuple(r) for r in P.one_hot(df, levels).collect()] == [(1, 0), (0, 0), (0, 0), (0, 1)]
    unseen = spark.createDataFrame([("zzz", "y")], "s string, single string")
    assert tuple(P.one_hot(unseen, levels).first()) == (0, 0)
    with pytest.raises(ValueError, match="levels"):
        P.fit_levels(df, max_levels=2)


def test_one_hot_vector_agrees_with_columns(spark):
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([("b",), ("a",), ("c",)], "s string")
    model = P.one_hot_vector(df, ["s"])
    more = df.unionByName(spark.createDataFrame([("new",), (None,)], "s string"))
    got = {r["s"]: r["v"] for r in model.transform(more).select("s", vector_to_array("dummies").alias("v")).collect()}
    assert got == {"a": [0, 0], "b": [0, 1], "c": [1, 0], "new": [0, 0], None: [0, 0]}


def test_anova_and_information(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 500)
    pdf = pd.DataFrame({"y": y, "good": y + rng.normal(size=500), "noise": rng.normal(size=500), "flat": 1.0, "copy": y.astype(float)})
    df = spark.createDataFrame(pdf)
    f = {r["feature"]: r["score"] for r in scorers.anova_f(df, ["good", "noise", "flat", "copy"], "y").collect()}
    groups = [pdf["good"][y == c] for c in (0, 1)]
    between = sum(len(g) * (g.mean() - pdf["good"].mean()) ** 2 for g in groups)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / 498
    assert f["good"] == pytest.approx(between / within)
    assert f["flat"] is None and f["copy"] is None
    mi = {r["feature"]: r["score"] for r in scorers.mutual_information(df, ["good", "noise", "flat", "copy"], "y").collect()}
    p = y.mean()
    assert mi["copy"] == pytest.approx(-p * np.log(p) - (1 - p) * np.log(1 - p))
    assert mi["flat"] == pytest.approx(0, abs=1e-12) and mi["good"] > mi["noise"]


def test_union_of_top_features(spark):
    a = spark.createDataFrame([("x", 3.0), ("y", 2.0), ("z", None)], "feature string, score double")
    b = spark.createDataFrame([("z", 1.0), ("x", 1.0), ("y", 0.0)], "feature string, score double")
    ranked = scorers.ranked_scores({"A": a, "B": b})
    assert [(r["feature"], r["scorers"]) for r in scorers.union_top_k(ranked, 2).collect()] == [("x", 2), ("y", 1), ("z", 1)]
