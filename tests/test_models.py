"""Evaluation against hand-computed values, model fits, training and scoring round trip."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortflow.operators import evaluate as E
from cohortflow.operators import models as M
from cohortflow.operators.balance import smote_balance
from cohortflow.operators.split import cv_folds
from cohortflow.plans.workflow import (
    Scorer,
    TrainingRun,
    add_synthetic_rows,
    choose_features,
    clean_and_shape,
    encode_features,
    score_file,
)
from cohortflow.sources.artifacts import publish_artifacts, write_csv
from cohortflow.streaming.scoring import score_landing_folder

SCORES = [(1, 1, 0.9), (0, 1, 0.8), (1, 1, 0.8), (1, 0, 0.4), (0, 0, 0.4), (0, 0, 0.1)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(SCORES, "y int, p int, s double")


def test_metrics(scored):
    got = {r["metric"]: r["value"] for r in E.all_metrics(scored, "y", "p", "s").collect()}
    assert got == pytest.approx({"Accuracy": 4 / 6, "Precision": 2 / 3, "Recall": 2 / 3, "F1-score": 2 / 3, "ROC AUC": 7 / 9})


def test_report_and_confusion(scored):
    report = {r["class"]: r for r in E.classification_report(scored, "y", "p").collect()}
    assert report["0"]["support"] == 3 and report["macro avg"]["f1_score"] == pytest.approx(2 / 3)
    assert {tuple(r) for r in E.confusion_matrix(scored, "y", "p").collect()} == {(0, 0, 2), (0, 1, 1), (1, 0, 1), (1, 1, 2)}


def test_roc_groups_ties(scored):
    points = sorted(((r["threshold"] or 2.0, r["fpr"], r["tpr"]) for r in E.roc_points(scored, "y", "s").collect()), reverse=True)
    want = [(2.0, 0, 0), (0.9, 0, 1 / 3), (0.8, 1 / 3, 2 / 3), (0.4, 2 / 3, 1), (0.1, 1, 1)]
    assert [list(p) for p in points] == [pytest.approx(list(w)) for w in want]


def test_empty_denominators(spark):
    none = spark.createDataFrame([(1, 0, 0.2), (1, 0, 0.3)], "y int, p int, s double")
    got = {r["metric"]: r["value"] for r in E.all_metrics(none, "y", "p", "s").collect()}
    assert got == {"Accuracy": 0.0, "Precision": 0.0, "Recall": 0.0, "F1-score": 0.0, "ROC AUC": None}


def test_auc_of_many_scores(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 3000)
    s = np.round(y * 0.5 + rng.normal(size=3000), 2)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    assert E.roc_auc(df, "y", "s").first()[0] == pytest.approx(want)


@pytest.fixture(scope="module")
def cohort(spark):
    rng = np.random.default_rng(9)
    n = 600
    los = rng.exponential(4, n)
    pdf = pd.DataFrame(
        {
            "subject_id": rng.integers(0, 150, n), "hadm_id": np.arange(n), "icustay_id": np.arange(n) + 5,
            "age": rng.integers(20, 95, n), "gender": rng.choice(["F", "M"], n), "religion": rng.choice(["a", "b", "c"], n),
            "los": los, "diagnosis_count": rng.integers(1, 9, n), "avg_chart_val": rng.normal(50, 9, n), "avg_lab_val": rng.normal(7, 1, n),
            "hospital_expire_flag": (rng.random(n) < np.where(los > 6, 0.8, 0.1)).astype(int),
        }
    )
    return spark.createDataFrame(pdf)


@pytest.fixture(scope="module")
def trained(spark, cohort, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("model"))
    spec, shaped = clean_and_shape(cohort)
    extended = add_synthetic_rows(shaped, 50)
    encoded, levels, features = encode_features(extended)
    chosen, _ = choose_features(encoded, features, trees=5, k=6)
    data = encoded.select(*[F.col(f"`{c}`") for c in chosen], "hospital_expire_flag", "is_synthetic")
    run = TrainingRun(spark, data, levels=levels)
    report = run.run(folder, M.gradient_boosting(trees=10), spec)
    return folder, run, report, shaped


def test_training_learns_and_tests_on_real_rows(trained):
    _, run, report, _ = trained
    metrics = {r["metric"]: r["value"] for r in report["metrics"].collect()}
    assert metrics["ROC AUC"] > 0.7
    per_class = {r["label"]: r["count"] for r in run.train.groupBy("label").count().collect()}
    assert per_class[0.0] == per_class[1.0]
    assert "is_synthetic" not in run.features and "religion_count" in [*run.features, "religion_count"]
    assert run.test.count() <= round(0.3 * 650) + 1


def test_saved_model_scores_the_same(spark, trained, tmp_path):
    folder, run, _, shaped = trained
    scorer = Scorer.load(spark, folder)
    once = scorer.score(shaped)
    assert once.columns == [*shaped.columns, "predicted_label", "predicted_probability"]
    assert once.count() == shaped.count() and once.select(shaped.columns).exceptAll(shaped).count() == 0
    again = Scorer.load(spark, folder).score(shaped)
    assert once.exceptAll(again).count() == 0
    assert {r["name"] for r in publish_artifacts(spark, folder, "demo/model", (".parquet",)).collect()}


def test_scoring_text_input_equals_typed_input(spark, trained, tmp_path):
    folder, _, _, shaped = trained
    scorer = Scorer.load(spark, folder)
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    write_csv(shaped, landing)
    report = score_file(spark, scorer, landing, out)
    assert {"metrics", "report", "confusion", "roc"} == set(report)
    text = spark.read.option("header", True).csv(out)
    typed = scorer.score(shaped)
    a = sorted(round(float(r[0]), 9) for r in text.select("predicted_probability").collect())
    b = sorted(round(float(r[0]), 9) for r in typed.select("predicted_probability").collect())
    assert a == b


def test_no_truth_no_evaluation(spark, trained):
    folder, _, _, shaped = trained
    scored, report = Scorer.load(spark, folder).score_and_evaluate(shaped.drop("hospital_expire_flag"))
    assert report == {} and "predicted_label" in scored.columns


def test_scoring_needs_no_shuffle_and_no_python(spark, trained):
    folder, _, _, shaped = trained
    plan = Scorer.load(spark, folder).score(shaped)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_scoring_unseen_and_missing_levels(spark, trained):
    folder, _, _, shaped = trained
    odd = shaped.limit(3).withColumn("gender", F.lit("X")).drop("religion")
    assert Scorer.load(spark, folder).score(odd).filter("predicted_probability is not null").count() == 3


def test_stream_scores_each_file_once(spark, trained, tmp_path):
    folder, _, _, shaped = trained
    landing, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    write_csv(shaped, landing)
    for _ in range(2):
        score_landing_folder(spark, Scorer.load(spark, folder), landing, shaped.columns, out, progress).awaitTermination(120)
    assert spark.read.parquet(out).count() == shaped.count()


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] ** 2 + x[:, 1] ** 2 < 1.2).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"k": range(300), "a": x[:, 0], "b": x[:, 1], "y": y}))
    return df, M.assemble(df, ["a", "b"], "y", keep=["k"])


def test_kernel_svm_bends(vectors):
    _, ready = vectors
    _, scored = M.fit_predict(M.kernel_svm(gamma=1.0, width=64, iterations=20), ready, ready)
    assert scored.filter("prediction = label").count() / 300 > 0.9
    assert scored.filter("probability between 0 and 1").count() == 300


def test_logistic_matches_ridge_solution(vectors):
    df, ready = vectors
    model, scored = M.fit_predict(M.logistic(300), ready, ready)
    x = np.array([r["features"].toArray() for r in ready.orderBy("k").collect()])
    y = np.array([r["label"] for r in ready.orderBy("k").collect()])
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    # at the optimum of 0.5 |w|^2 + sum of losses, w equals the summed residual gradient
    assert model.coefficients.toArray() == pytest.approx(x.T @ (y - p), abs=1e-3)


def test_grid_search_with_fold_wise_balancing(vectors):
    df, ready = vectors
    folded = cv_folds(df, "y", 3, key=["k"])
    ready = M.assemble(folded, ["a", "b"], "y", keep=["k", "fold"])

    def balance(train):
        from pyspark.ml.functions import vector_to_array

        flat = train.select("label", *[vector_to_array("features")[i].alias(n) for i, n in enumerate("ab")])
        return M.assemble(smote_balance(flat, "label", ["a", "b"]), ["a", "b"], "label")

    for chosen in (None, balance):
        best, table = M.grid_search(ready, M.random_forest(), {"numTrees": [3], "maxDepth": [1, 5]}, 3, balance=chosen)
        rows = table.collect()
        assert len(rows) == 2 and sum(r["best"] for r in rows) == 1
        assert [r["best"] for r in rows if "maxDepth=5" in r["params"]] == [True]
        assert best.getNumTrees == 3


def test_kernel_svm_keeps_rows_as_they_came(vectors, monkeypatch):
    """Fitted without a stored copy of the wide features; its sums are those of the plain objective."""
    from pyspark.ml.functions import vector_to_array

    _, ready = vectors
    width, kept, tried = 32, [], []
    monkeypatch.setattr(M, "materialize", lambda df, label: kept.append(df.columns) or df)
    monkeypatch.setattr(M, "minimised", lambda loss, w, n: tried.append((loss(w + 0.5), w + 0.5)) or w + 0.5)
    model = M.FourierSVM(width=width, gamma=1.0, regParam=1e-2).fit(ready.coalesce(2))
    assert kept == [["x", "y"]]
    loss, z = hinge_objective(ready, width)
    (value, gradient), w = tried[0]
    assert value == pytest.approx(loss(w)[0], abs=1e-5) and gradient == pytest.approx(loss(w)[1], abs=1e-4)
    held = model.getOrDefault(model.weights)
    margins = model.transform(ready).orderBy("k").select(vector_to_array("margin")[0]).collect()
    assert [r[0] for r in margins] == pytest.approx(z @ held[:-1] + held[-1], abs=1e-4)


def hinge_objective(ready, width):
    rows = ready.orderBy("k").collect()
    x, sign = np.array([r["features"].toArray() for r in rows]), 2 * np.array([r["label"] for r in rows]) - 1
    weights, shift = M.fourier_weights(42, 1.0, 2, width)
    z = np.sqrt(2.0 / width) * np.cos(x @ weights + shift)
    scaled = z / z.std(0, ddof=1)

    def loss(w):
        miss = 1 - sign * (scaled @ w[:-1] + w[-1])
        pull = np.where(miss > 0, -sign, 0.0)
        return np.maximum(miss, 0).mean() + 0.005 * (w[:-1] @ w[:-1]), np.append(pull @ scaled / len(x) + 0.01 * w[:-1], pull.mean())

    return loss, z


def test_hinge_loss_is_minimised(vectors):
    """As low as a long plain descent, within two per cent."""
    loss, _ = hinge_objective(vectors[1], 32)
    w, least = np.zeros(33), np.inf
    for t in range(20_000):
        value, gradient = loss(w)
        least = min(least, value)
        w = w - gradient / (0.01 * t + 20)
    assert loss(M.minimised(loss, np.zeros(33), 50))[0] <= 1.02 * least
