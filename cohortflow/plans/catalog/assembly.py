"""Cohort joins and pre-aggregates."""

from pyspark.sql import functions as F

from cohortflow.functions.expressions import age_years
from cohortflow.operators.cohort import chart_summary, diagnosis_summary, lab_summary, with_demographics
from cohortflow.operators.joins import fanout_left_join, lookup_join
from cohortflow.plans import stand_ins as S
from cohortflow.plans.catalog.registry import query
from cohortflow.plans.stand_ins import sql_with


def rounded(name, digits=6):
    return F.round(name, digits).alias(name)


@query(
    "cohort_assembly",
    sql_with("""
SELECT subject_id, hadm_id, CAST(admittime AS VARCHAR) AS admittime, discharge_location, hospital_expire_flag,
       CAST(dob AS VARCHAR) AS dob, gender, age, round(avg_chart_val, 6) AS avg_chart_val, valueuom, diagnosis_count,
       round(avg_lab_val, 6) AS avg_lab_val, icustay_id, first_wardid, round(los, 6) AS los
FROM cohort"""),
)
def cohort_assembly(spark, sf_dir):
    c = S.cohort(spark, sf_dir)
    shown = {
        "admittime": F.col("admittime").cast("string"), "dob": F.col("dob").cast("string"),
        "avg_chart_val": F.round("avg_chart_val", 6), "avg_lab_val": F.round("avg_lab_val", 6), "los": F.round("los", 6),
    }
    return c.withColumns(shown)


@query(
    "age_years_capped",
    sql_with("SELECT hadm_id, CAST(dob AS VARCHAR) AS dob, age FROM aged"),
)
def age_years_capped(spark, sf_dir):
    pairs = S.admissions(spark, sf_dir).join(S.patients(spark, sf_dir), "subject_id", "left")
    return pairs.select(
        "hadm_id", F.col("dob").cast("string").alias("dob"), age_years(F.to_date("admittime"), F.col("dob")).alias("age")
    )


@query(
    "left_join_demographics",
    sql_with("SELECT subject_id, hadm_id, gender, age, hospital_expire_flag FROM aged"),
)
def left_join_demographics(spark, sf_dir):
    return with_demographics(S.admissions(spark, sf_dir), S.patients(spark, sf_dir)).select(
        "subject_id", "hadm_id", "gender", "age", "hospital_expire_flag"
    )


@query(
    "stay_fanout_join",
    sql_with("""
SELECT adm.subject_id, adm.hadm_id, icustay_id, round(los, 6) AS los
FROM adm LEFT JOIN stay ON stay.hadm_id = adm.hadm_id"""),
)
def stay_fanout_join(spark, sf_dir):
    joined = fanout_left_join(S.admissions(spark, sf_dir), S.icustays(spark, sf_dir), S.STAY_KEYS)
    return joined.select("subject_id", "hadm_id", "icustay_id", rounded("los"))


@query(
    "preagg_star_join",
    sql_with("""
SELECT adm.hadm_id, round(avg_chart_val, 6) AS avg_chart_val, valueuom, diagnosis_count, round(avg_lab_val, 6) AS avg_lab_val
FROM adm LEFT JOIN chart_agg ON chart_agg.hadm_id = adm.hadm_id
     LEFT JOIN lab_agg ON lab_agg.subject_id = adm.subject_id LEFT JOIN diag_agg ON diag_agg.hadm_id = adm.hadm_id"""),
)
def preagg_star_join(spark, sf_dir):
    wide = S.admissions(spark, sf_dir).select("subject_id", "hadm_id")
    wide = wide.join(chart_summary(S.chartevents(spark, sf_dir), S.STAY_KEYS), S.STAY_KEYS, "left")
    wide = wide.join(diagnosis_summary(S.diagnoses(spark, sf_dir), S.STAY_KEYS), S.STAY_KEYS, "left")
    wide = lookup_join(wide, lab_summary(S.labevents(spark, sf_dir), S.LAB_KEYS), S.LAB_KEYS)
    return wide.select("hadm_id", rounded("avg_chart_val"), "valueuom", "diagnosis_count", rounded("avg_lab_val"))


@query("grouped_mean", sql_with("SELECT subject_id, round(avg_lab_val, 6) AS avg_lab_val FROM lab_agg"))
def grouped_mean(spark, sf_dir):
    return lab_summary(S.labevents(spark, sf_dir), S.LAB_KEYS).select("subject_id", rounded("avg_lab_val"))


@query("grouped_first_deterministic", sql_with("SELECT hadm_id, valueuom FROM chart_agg"))
def grouped_first_deterministic(spark, sf_dir):
    return chart_summary(S.chartevents(spark, sf_dir), S.STAY_KEYS).select("hadm_id", "valueuom")


@query("grouped_count_distinct", sql_with("SELECT hadm_id, diagnosis_count FROM diag_agg"))
def grouped_count_distinct(spark, sf_dir):
    return diagnosis_summary(S.diagnoses(spark, sf_dir), S.STAY_KEYS)
