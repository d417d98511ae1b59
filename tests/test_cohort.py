"""Cohort joins on hand-made source files, with the edge cases of real exports."""

import pytest
from pyspark.sql import functions as F

from cohortflow.operators.cohort import build_cohort
from cohortflow.operators.joins import fanout_left_join, hot_key_hashes, lookup_join
from cohortflow.sources.tables import SOURCE_COLUMNS, ingest_folder, list_files, read_csv_typed, read_source_tables

FILES = {
    "ADMISSIONS": """row_id,SUBJECT_ID,hadm_id,admittime,dischtime,deathtime,discharge_location,religion,ethnicity,hospital_expire_flag
1,1,10,2020-01-01 05:00:00,,,HOME,A,X,0
2,1,11,2021-01-01 05:00:00,,,DEAD,A,X,1
3,2,20,2020-06-01 00:00:00,,,HOME,,X,0
4,3,30,2020-06-01 00:00:00,,,HOME,B,X,oops
""",
    "PATIENTS": """subject_id,gender,dob
1,M,1980-01-01 00:00:00
2,F,1700-01-01 00:00:00
""",
    "ICUSTAYS": """row_id,subject_id,hadm_id,icustay_id,first_wardid,last_wardid,intime,outtime,los
7,1,10,100,5,5,,,1.5
8,1,11,101,5,5,,,2
9,1,11,102,5,5,,,100
10,1,11,103,5,5,,,
""",
    "CHARTEVENTS": """subject_id,hadm_id,valuenum,valueuom
1,10,,mmHg
1,11,1,
1,11,2,b
1,11,6,a
2,20,NaN,x
""",
    "LABEVENTS": """subject_id,hadm_id,valuenum
1,10,4
1,10,5
""",
    "DIAGNOSES_ICD": """subject_id,hadm_id,icd9_code
1,10,E1
1,10,E1
1,10,E2
2,20,
""",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_cohort(spark, folder):
    rows = build_cohort(read_source_tables(spark, folder)).orderBy("hadm_id", "icustay_id").collect()
    got = [(r.hadm_id, r.icustay_id, r.age, r.gender, r.avg_chart_val, r.valueuom, r.avg_lab_val, r.diagnosis_count, r.los) for r in rows]
    assert got == [
        (10, 100, 40, "M", None, None, 4.5, 2, 1.5),
        (11, 101, 41, "M", 3.0, "a", None, None, 2.0),
        (11, 102, 41, "M", 3.0, "a", None, None, 100.0),
        (11, 103, 41, "M", 3.0, "a", None, None, None),
        (20, None, 120, "F", None, None, None, 0, None),
        (30, None, None, None, None, None, None, None, None),
    ]
    assert rows[-1].hospital_expire_flag is None
    assert len(set(rows[0].asDict())) == len(rows[0])


def test_typed_reader_adds_and_matches_columns(spark, folder):
    df = read_csv_typed(spark, f"{folder}/ADMISSIONS.csv", SOURCE_COLUMNS["admissions"])
    types = dict(df.dtypes)
    assert types["subject_id"] == "bigint" and types["edregtime"] == "timestamp"
    assert df.filter(F.col("edregtime").isNotNull()).count() == 0


def test_listing_and_ingest(spark, folder, tmp_path):
    assert {r["name"] for r in list_files(spark, folder, "*.csv").collect()} == {f"{n}.csv" for n in FILES}
    target = str(tmp_path / "tables")
    for _ in range(2):  # the second run overwrites
        ingest_folder(spark, folder, target, {"patients": SOURCE_COLUMNS["patients"]})
    assert spark.read.parquet(f"{target}/patients").count() == 2


@pytest.fixture
def skewed(spark):
    left = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("l"))
    left = left.unionByName(spark.createDataFrame([(None, -1), (77, -2)], "k long, l long"))
    many = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id") % 900).cast("long").alias("k"), F.col("id").alias("r"))
    return left, many.unionByName(spark.createDataFrame([(None, -9)], "k long, r long"))


def same(a, b):
    order = sorted(a.columns)
    return sorted(map(str, a.select(order).collect())) == sorted(map(str, b.select(order).collect()))


def test_hot_key_is_found(spark, skewed):
    _, many = skewed
    hot = spark.createDataFrame([(77,)], "k long").select(F.xxhash64("k")).first()[0]
    assert hot_key_hashes(many, ["k"], share=0.05, min_rows=10) == [hot]
    assert hot_key_hashes(many, ["k"]) == []


def test_fanout_join_with_hot_key_equals_left_join(skewed):
    left, many = skewed
    assert same(fanout_left_join(left, many, ["k"], share=0.05, min_rows=10), left.join(many, ["k"], "left"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_with_hot_key_equals_plain_join(skewed, how):
    left, many = skewed
    unique = left.filter("l >= 0 and k % 2 = 1")
    assert same(lookup_join(many, unique, ["k"], how, share=0.05, min_rows=10), many.join(unique, ["k"], how))
