import math

import pytest
from pyspark.sql import functions as F

from cohortflow.functions import columns as C
from cohortflow.functions import expressions as X


def one(spark, value, ddl, column):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(column).first()[0]


@pytest.mark.parametrize(
    ("born", "admitted", "age"),
    [("2000-01-01", "2020-01-01", 20), ("2000-01-01", "2019-12-31", 19), ("1980-06-15", "2020-06-14", 39), ("1700-01-01", "2000-01-01", 120),
     ("2020-05-01", "2020-01-01", 0), (None, "2020-01-01", None)],
)
def test_age(spark, born, admitted, age):
    df = spark.createDataFrame([(born, admitted)], "b string, a string")
    assert df.select(X.age_years(F.to_date("a"), F.to_date("b"))).first()[0] == age


@pytest.mark.parametrize(
    ("text", "number"),
    [(" 1.5 ", 1.5), ("datamiss", None), ("", None), ("1d", None), ("NaN", None), ("inf", None), ("-3e2", -300.0), (None, None)],
)
def test_parse_number(spark, text, number):
    assert one(spark, text, "string", X.parse_number("v")) == number
    assert one(spark, text, "string", X.number_or_zero("v")) == (number or 0.0)


def test_finite_or_null(spark):
    rows = [(math.nan,), (math.inf,), (-math.inf,), (None,), (2.0,)]
    got = [r[0] for r in spark.createDataFrame(rows, "v double").select(X.finite_or_null("v")).collect()]
    assert got == [None, None, None, None, 2.0]


def test_clip_keeps_null_and_ignores_null_bound(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (5.0,), (0.5,)], "v double")
    assert [r[0] for r in df.select(X.clip("v", 0.0, 1.0)).collect()] == [None, 0.0, 1.0, 0.5]
    assert [r[0] for r in df.select(X.clip("v", None, 1.0)).collect()] == [None, -5.0, 1.0, 0.5]


def test_bins_are_half_open(spark):
    df = spark.createDataFrame([(v,) for v in (0, 19, 20, 100, 120, 149, 150, -1, None)], "v int")
    got = [r[0] for r in df.select(X.bin_label("v", X.AGE_EDGES, X.AGE_LABELS)).collect()]
    assert got == ["0-20", "0-20", "20-30", "100+", "100+", "100+", None, None, None]
    index = [r[0] for r in df.select(X.bin_index("v", X.AGE_EDGES)).collect()]
    assert index == [0, 0, 1, 9, 9, 9, None, None, None]


@pytest.mark.parametrize("lam", [-1.3, 0.0, 0.5, 1.0, 2.0, 3.1])
def test_yeo_johnson(spark, lam):
    from cohortflow.operators.preprocess import transform_value

    def plain(x):
        if x >= 0:
            return math.log1p(x) if lam == 0 else ((1 + x) ** lam - 1) / lam
        return -math.log1p(-x) if lam == 2 else -(((1 - x) ** (2 - lam)) - 1) / (2 - lam)

    values = [-2.5, -0.1, 0.0, 0.7, 9.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(X.yeo_johnson("v", lam)).collect()]
    assert got == pytest.approx([plain(v) for v in values])
    assert [transform_value(v, lam) for v in values] == pytest.approx(got)


def test_uniform_is_repeatable_and_even(spark):
    df = spark.range(20000).select(X.uniform(1, "id").alias("u"), X.standard_normal(1, "id").alias("g"))
    row = df.agg(F.min("u"), F.max("u"), F.avg("u"), F.avg("g"), F.stddev("g")).first()
    assert 0 <= row[0] and row[1] < 1 and row[2] == pytest.approx(0.5, abs=0.02)
    assert row[3] == pytest.approx(0, abs=0.03) and row[4] == pytest.approx(1, abs=0.03)
    assert df.exceptAll(spark.range(20000).repartition(3).select(X.uniform(1, "id"), X.standard_normal(1, "id"))).count() == 0


def test_name_rules():
    names = ["SUBJECT_ID", "row_id.1", "Admittime", "first_wardid", "los", "icustay_id", "gender", "dob"]
    assert C.unusable_names(names) == ["SUBJECT_ID", "row_id.1", "Admittime", "first_wardid", "icustay_id", "dob"]


def test_sparse_rows_follow_whole_number_threshold(spark):
    # five columns: int(0.8 * 5) = 4 missing cells drop a row, three do not
    df = spark.createDataFrame([(1, None, None, None, None), (1, 2, None, None, None)], "a int, b int, c int, d int, e int")
    assert [r["b"] for r in C.drop_sparse_rows(df).collect()] == [2]


def test_fill_missing_by_type(spark):
    df = spark.createDataFrame([(None, None, None, None)], "s string, i int, d double, b boolean")
    assert tuple(C.fill_missing(df).first()) == ("datamiss", 0, 0.0, False)


def test_complete_rows(spark):
    df = spark.createDataFrame([(1.0, 1), (math.nan, 2), (math.inf, 3), (None, 4), (5.0, None)], "x double, y int")
    assert [tuple(r) for r in C.complete_rows(df).collect()] == [(1.0, 1)]


def test_complete_rows_are_found_by_one_plain_test_per_column(spark):
    df = spark.createDataFrame([(1.0, 1, math.nan), (-math.inf, 2, 1.0), (math.nan, 3, 1.0), (2.0, None, 1.0), (3.0, 4, None)], "x double, y int, z double")
    found = C.complete_rows(df, ["x", "y"])
    assert [r["y"] for r in found.orderBy("y").collect()] == [1, 4]
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "atleastnnonnulls" not in plan and "case when" not in plan


def test_align_and_family_sum(spark):
    df = spark.createDataFrame([(1, 0, 1, 7)], "k int, religion_a int, religion_b int, extra int")
    aligned = C.align_to(df, ["z", "religion_b"], keep=["k"])
    assert aligned.columns == ["k", "z", "religion_b"] and tuple(aligned.first()) == (1, 0.0, 1.0)
    assert C.add_family_sum(df).first()["religion_count"] == 1.0
    assert C.add_family_sum(df.drop("religion_a", "religion_b")).columns == ["k", "extra"]


def test_drop_listed_ignores_absent(spark):
    df = spark.createDataFrame([(1, 2)], "subject_id int, los int")
    assert C.drop_listed(df).columns == ["los"]
