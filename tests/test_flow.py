"""The command line from source files to scores: wide text columns, saved preprocessing, patient-wise split, no tables left."""

import os
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.operators import models as M
from cohortflow.operators.cohort import build_cohort
from cohortflow.operators.preprocess import PreprocessSpec, fit_levels, strongest_levels
from cohortflow.operators.scorers import forest_importance, select_union, with_dummies
from cohortflow.plans import cli, workflow
from cohortflow.plans.workflow import Scorer
from cohortflow.sources.scratch import ScratchScope, materialize, shared_folder
from cohortflow.sources.tables import read_source_tables

N = 3200


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Admissions with a free-text column of 3100 values, one of which decides the outcome for its rows."""
    folder, rng = tmp_path_factory.mktemp("tables"), np.random.default_rng(4)
    los = rng.exponential(4, N).round(3)
    note = ["sepsis" if i % 30 == 0 else f"note {i}" for i in range(N)]
    dead = [(note[i] == "sepsis") or (rng.random() < (0.5 if los[i] > 6 else 0.05)) for i in range(N)]
    who = rng.integers(0, 400, N)

    def put(name, head, rows):
        (folder / f"{name}.csv").write_text("\n".join([head, *rows]) + "\n")

    put("ADMISSIONS", "row_id,subject_id,hadm_id,admittime,discharge_location,religion,ethnicity,diagnosis,hospital_expire_flag",
        [f"{i},{who[i]},{i},2020-01-01 05:00:00,HOME,{'AB'[i % 2]},X,{note[i]},{int(dead[i])}" for i in range(N)])
    put("PATIENTS", "subject_id,gender,dob", [f"{i},{'MF'[i % 2]},{1930 + i % 60}-01-01 00:00:00" for i in range(400)])
    put("ICUSTAYS", "row_id,subject_id,hadm_id,icustay_id,first_wardid,last_wardid,intime,outtime,los", [f"{i},{who[i]},{i},{i},5,5,,,{los[i]}" for i in range(N)])
    put("CHARTEVENTS", "subject_id,hadm_id,valuenum,valueuom", [f"{who[i]},{i},{rng.normal(50, 9):.3f},mm" for i in range(N)])
    put("LABEVENTS", "subject_id,hadm_id,valuenum", [f"{who[i]},{i},{rng.lognormal(1, 1):.3f}" for i in range(N)])
    put("DIAGNOSES_ICD", "subject_id,hadm_id,icd9_code", [f"{who[i]},{i},E{i % 7}" for i in range(N)])
    return str(folder)


@pytest.fixture(scope="module")
def trained(spark, tables, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out") / "model")
    before = set(_scratch(spark))
    patch = pytest.MonkeyPatch()
    patch.setattr(workflow, "gradient_boosting", partial(M.gradient_boosting, trees=10))
    patch.setattr(cli, "choose_features", partial(workflow.choose_features, trees=10, k=6))
    sides = {}
    original = workflow.TrainingRun.preprocess_data

    def watched(run):
        original(run)
        sides["columns"] = run.df.columns
        parts = workflow.group_split(run.df, run.target, run.group, run.test_share, run.seed)
        sides["divided"] = parts.groupBy("subject_id").agg(F.count_distinct("is_test").alias("n")).filter("n > 1").count()

    patch.setattr(workflow.TrainingRun, "preprocess_data", watched)
    cli.train(spark, cli.parser().parse_args(["train", "--tables", tables, "--output", out, "--synthetic", "200", "--group", "subject_id"]))
    patch.undo()
    return out, sides, set(_scratch(spark)) - before


def _scratch(spark):
    root = shared_folder(spark).removeprefix("file:")
    return [os.path.join(d, f) for d, _, files in os.walk(os.path.join(root, "cohortflow")) for f in files if f.endswith(".parquet")]


def test_a_level_of_the_wide_column_is_chosen(spark, trained):
    scorer = Scorer.load(spark, trained[0])
    assert "diagnosis_sepsis" in scorer.spec.features
    assert scorer.spec.levels["diagnosis"][1:] and len(scorer.spec.levels["diagnosis"]) < 30
    assert scorer.spec.preprocess


def test_patients_stay_on_one_side(trained):
    assert trained[1]["divided"] == 0 and "subject_id" in trained[1]["columns"]


def test_no_tables_are_left(trained):
    assert trained[2] == set()


def test_raw_rows_score_as_shaped_rows(spark, tables, trained):
    cohort = build_cohort(read_source_tables(spark, tables)).limit(300)
    rows = materialize(cohort, "raw")
    spec = PreprocessSpec.load(spark, f"{trained[0]}/preprocess")
    raw = Scorer.load(spark, trained[0]).score(rows)
    shaped = Scorer.load(spark, trained[0], shaped=True).score(spec.transform(rows, keep=["hadm_id"], drop_rows=False))
    a = {r["hadm_id"]: r["predicted_probability"] for r in raw.collect()}
    b = {r["hadm_id"]: r["predicted_probability"] for r in shaped.collect()}
    assert a.keys() == b.keys() and len(a) == 300
    assert all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)
    assert raw.select(rows.columns).exceptAll(rows).count() == 0


def test_score_from_the_command_line(spark, tables, trained, tmp_path):
    rows = build_cohort(read_source_tables(spark, tables)).limit(120)
    rows.write.option("header", True).csv(str(tmp_path / "in"))
    folder = trained[0]
    args = ["score", "--model", f"{folder}/model", "--features", f"{folder}/feature_columns", "--scaler", f"{folder}/feature_spec",
            "--preprocess", f"{folder}/preprocess", "--input_csv", str(tmp_path / "in"), "--output", str(tmp_path / "out")]
    cli.score(spark, cli.parser().parse_args(args))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).filter("predicted_label is not null").count() == 120


def test_wide_columns_are_named_not_refused(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    wide = []
    assert fit_levels(df, wide=wide) == {"b": ["x"]} and wide == ["a"]
    with pytest.raises(ValueError, match="more than"):
        fit_levels(df)


def test_strongest_levels_are_those_of_the_scorers(spark):
    from cohortflow.operators.scorers import anova_f, mutual_information

    df = spark.range(900).select((F.col("id") % 23).cast("string").alias("c"), ((F.col("id") % 23 < 3) | (F.col("id") % 5 == 0)).cast("int").alias("y"))
    levels = sorted(r[0] for r in df.select("c").distinct().collect())[1:]
    wide = df.select("y", *[(F.col("c") == v).cast("int").alias(f"c_{v}") for v in levels])
    names = [f"c_{v}" for v in levels]
    want = set()
    for scores in (anova_f(wide, names, "y"), mutual_information(wide, names, "y")):
        want |= {r["feature"] for r in scores.orderBy(F.round("score", 9).desc(), "feature").limit(4).collect()}
    assert {f"c_{v}" for v in strongest_levels(df, ["c"], "y", 4)["c"]} == want


def test_scope_deletes_only_its_own(spark):
    kept = materialize(spark.range(3), "kept")
    scope = ScratchScope(spark)
    with scope:
        gone = materialize(spark.range(5), "gone")
        assert gone.count() == 5
    scope.delete()
    assert kept.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|not found|no such file"):
        gone.count()


def test_cohort_aggregates_without_sorting(spark, tables):
    plan = build_cohort(read_source_tables(spark, tables))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_describe_covers_every_kind(spark):
    from cohortflow.operators.profile import describe_all, profile

    df = spark.range(4).select(
        "id", F.to_date(F.lit("2020-01-02")).alias("d"), F.array(F.col("id") % 2).alias("a"), (F.col("id") > 1).alias("b"), F.lit(None).cast("string").alias("n")
    )
    rows = {r["column_name"]: r for r in describe_all(df).collect()}
    assert set(rows) == set(df.columns)
    assert rows["d"]["top"] == "2020-01-02" and rows["d"]["freq"] == 4 and rows["a"]["unique"] == 2 and rows["n"]["count"] == 0
    assert set(profile(df, "b")) == {"shape", "summary", "nulls", "correlations", "boxes", "histograms", "classes"}


@pytest.mark.parametrize("levels", [1990, 2010])
def test_a_level_that_only_the_forest_ranks_high_is_chosen_at_any_width(spark, levels):
    """Of frequent level "zz" the label follows x, elsewhere it is drawn: alone it tells nothing, after x it does."""
    rng = np.random.default_rng(3)
    n = 3 * levels
    name = [f"v{i % levels}" if i < levels else "zz" for i in range(n)]
    x = rng.normal(size=n)
    y = [int(x[i] > 0) if name[i] == "zz" else i % 2 for i in range(n)]
    df = spark.createDataFrame([(name[i], float(x[i]), y[i]) for i in range(n)], "name string, x double, y int")
    wide = []
    fit_levels(df, wide=wide)
    assert wide == (["name"] if levels > 2000 else [])
    assert "zz" not in strongest_levels(df, ["name"], "y", 2).get("name", [])
    chosen, scores = select_union(df, ["x"], "y", 2, trees=60, wide=["name"])
    assert {"x", "name_zz"} <= set(chosen)
    assert {r.feature for r in scores.where("scorer = 'RF' AND rank <= 2").collect()} == {"x", "name_zz"}


def test_sparse_levels_score_as_columns_of_their_own(spark):
    rng = np.random.default_rng(4)
    rows = [(f"l{rng.integers(30):02d}", float(rng.normal()), int(rng.integers(2))) for _ in range(600)]
    df = spark.createDataFrame(rows, "c string, x double, y int").coalesce(1)
    levels = sorted({r[0] for r in rows}, reverse=True)[:-1]
    dense = with_dummies(df, {f"c_{v}": ("c", v) for v in levels})
    got = {r.feature: r.score for r in forest_importance(df, ["x"], "y", 5, 6, wide=["c"]).collect()}
    want = {r.feature: r.score for r in forest_importance(dense, ["x", *[f"c_{v}" for v in levels]], "y", 5, 6).collect()}
    assert got == pytest.approx({f: s for f, s in want.items() if f == "x" or s > 0})


def test_levels_numbered_as_a_table_give_the_encoder_s_vectors(spark):
    from cohortflow.operators.preprocess import one_hot_sparse, one_hot_vector

    rows = [(i, None if i % 50 == 7 else f"v{i % 37}") for i in range(600)]
    df = spark.createDataFrame(rows, "k int, c string").repartition(5)
    want = {r["k"]: r["dummies"] for r in one_hot_vector(df, ["c"]).transform(df).collect()}
    got = {r["k"]: r["dummies"] for r in one_hot_sparse(df, "c").collect()}
    assert got == want and {v.size for v in got.values()} == {36}
    assert one_hot_sparse(df.limit(0), "c").count() == 0


def test_whole_numbers_are_loaded_without_parsing(spark, monkeypatch):
    schema = "k int, x double, n int, t string, hospital_expire_flag int"
    rows = [(1, 1.0, 2, "7", 1), (2, float("nan"), 3, "7", 0), (3, 4.0, None, "7", 1), (4, 5.0, 6, "8", None), (5, 5.0, 6, None, 1)]
    plans, kept = [], workflow.materialize
    monkeypatch.setattr(workflow, "materialize", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or kept(df, *a))
    loaded = workflow.TrainingRun(spark, spark.createDataFrame(rows, schema), key=["k"]).load_data()
    assert [tuple(r) for r in loaded.orderBy("k").collect()] == [(1, 1.0, 2.0, 7.0, 1), (4, 5.0, 6.0, 8.0, 0)]
    assert "RLIKE" not in plans[0] and "atleastnnonnulls" not in plans[0]
    text = spark.createDataFrame([("1",), ("x",), (None,), ("0",)], "hospital_expire_flag string").withColumn("x", F.lit(1.0))
    assert [r[0] for r in workflow.TrainingRun(spark, text).load_data().select("hospital_expire_flag").orderBy("hospital_expire_flag").collect()] == [0, 0, 0, 1]
