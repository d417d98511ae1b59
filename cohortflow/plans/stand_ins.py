"""The six clinical source tables, played by the order tables of a test folder.

orders are admissions, customers patients, line items stays, chart events and diagnoses,
and events are lab results known per patient only. Each frame has its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.operators.cohort import build_cohort, chart_summary, diagnosis_summary, lab_summary, with_demographics
from cohortflow.operators.joins import lookup_join

STAY_KEYS = ["hadm_id"]
LAB_KEYS = ["subject_id"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderdate").alias("admittime"),
        F.col("o_orderpriority").alias("discharge_location"),
        (F.col("o_orderstatus") == "F").cast("int").alias("hospital_expire_flag"),
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = ((F.col("c_custkey") * 37) % 60000).cast("int")
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("subject_id"),
        F.date_add(F.lit("1820-01-01").cast("date"), days).alias("dob"),
        F.col("c_mktsegment").alias("gender"),
    )


def icustays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_partkey").alias("icustay_id"),
        F.col("l_suppkey").alias("first_wardid"),
        (F.col("l_quantity") * 0.8).alias("los"),
    )


def chartevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("hadm_id"),
        F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice")).alias("valuenum"),
        F.col("l_returnflag").alias("valueuom"),
    )


def labevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("subject_id"), F.col("value").alias("valuenum"))


def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("hadm_id"), F.col("l_partkey").cast("string").alias("icd9_code")
    )


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "admissions": admissions(spark, sf_dir), "patients": patients(spark, sf_dir),
        "icustays": icustays(spark, sf_dir), "chartevents": chartevents(spark, sf_dir),
        "labevents": labevents(spark, sf_dir), "diagnoses_icd": diagnoses(spark, sf_dir),
    }


COHORT_COLUMNS = [
    "subject_id", "hadm_id", "admittime", "discharge_location", "hospital_expire_flag", "dob", "gender", "age",
    "avg_chart_val", "valueuom", "diagnosis_count", "avg_lab_val", "icustay_id", "first_wardid", "los",
]


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per stay."""
    return build_cohort(tables(spark, sf_dir), STAY_KEYS, LAB_KEYS).select(*COHORT_COLUMNS)


def admission_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per admission with the outcome and the patient and event summaries, nulls filled."""
    wide = with_demographics(admissions(spark, sf_dir), patients(spark, sf_dir))
    wide = wide.join(chart_summary(chartevents(spark, sf_dir), STAY_KEYS), STAY_KEYS, "left")
    wide = wide.join(diagnosis_summary(diagnoses(spark, sf_dir), STAY_KEYS), STAY_KEYS, "left")
    wide = lookup_join(wide, lab_summary(labevents(spark, sf_dir), LAB_KEYS), LAB_KEYS)
    price = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("hadm_id"), F.col("o_totalprice").alias("charges"))
    wide = wide.join(price, STAY_KEYS, "left").na.fill("datamiss").na.fill(0)
    return wide.select(
        "hadm_id", "subject_id", "hospital_expire_flag", "gender", "discharge_location", "valueuom",
        F.col("age").cast("double").alias("age"), "avg_chart_val", "avg_lab_val",
        F.col("diagnosis_count").cast("double").alias("diagnosis_count"), "charges",
    )


FEATURES = ["age", "avg_chart_val", "avg_lab_val", "diagnosis_count", "charges"]

# ---- SQL twins ------------------------------------------------------------

SQL_TABLES = """
adm AS (SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, CAST(o_orderdate AS DATE) AS admittime,
               o_orderpriority AS discharge_location,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS hospital_expire_flag FROM orders),
pat AS (SELECT c_custkey AS subject_id, DATE '1820-01-01' + CAST((c_custkey * 37) % 60000 AS INTEGER) AS dob,
               c_mktsegment AS gender FROM customer),
stay AS (SELECT l_orderkey AS hadm_id, l_partkey AS icustay_id, l_suppkey AS first_wardid,
                l_quantity * 0.8e0 AS los FROM lineitem),
chart AS (SELECT l_orderkey AS hadm_id, CASE WHEN l_linenumber <> 7 THEN l_extendedprice END AS valuenum,
                 l_returnflag AS valueuom FROM lineitem),
lab AS (SELECT user_id AS subject_id, value AS valuenum FROM events),
diag AS (SELECT l_orderkey AS hadm_id, CAST(l_partkey AS VARCHAR) AS icd9_code FROM lineitem),
chart_agg AS (SELECT hadm_id, avg(valuenum) AS avg_chart_val, min(valueuom) AS valueuom
              FROM chart WHERE valuenum IS NOT NULL GROUP BY hadm_id),
lab_agg AS (SELECT subject_id, avg(valuenum) AS avg_lab_val FROM lab WHERE valuenum IS NOT NULL GROUP BY subject_id),
diag_agg AS (SELECT hadm_id, count(DISTINCT icd9_code) AS diagnosis_count FROM diag GROUP BY hadm_id),
aged AS (SELECT adm.*, pat.dob, pat.gender,
                LEAST(CAST(trunc(date_diff('day', pat.dob, adm.admittime) / 365.25e0) AS INTEGER), 120) AS age
         FROM adm LEFT JOIN pat USING (subject_id)),
cohort AS MATERIALIZED (SELECT aged.*, chart_agg.avg_chart_val, chart_agg.valueuom, diag_agg.diagnosis_count, lab_agg.avg_lab_val,
                  stay.icustay_id, stay.first_wardid, stay.los
           FROM aged LEFT JOIN stay ON stay.hadm_id = aged.hadm_id
                LEFT JOIN chart_agg ON chart_agg.hadm_id = aged.hadm_id
                LEFT JOIN lab_agg ON lab_agg.subject_id = aged.subject_id
                LEFT JOIN diag_agg ON diag_agg.hadm_id = aged.hadm_id),
feat AS MATERIALIZED (SELECT aged.hadm_id, aged.subject_id, hospital_expire_flag, coalesce(gender, 'datamiss') AS gender,
                discharge_location, coalesce(valueuom, 'datamiss') AS valueuom,
                coalesce(CAST(age AS DOUBLE), 0) AS age, coalesce(avg_chart_val, 0) AS avg_chart_val,
                coalesce(avg_lab_val, 0) AS avg_lab_val,
                coalesce(CAST(diagnosis_count AS DOUBLE), 0) AS diagnosis_count, o_totalprice AS charges
         FROM aged LEFT JOIN chart_agg ON chart_agg.hadm_id = aged.hadm_id
              LEFT JOIN lab_agg ON lab_agg.subject_id = aged.subject_id
              LEFT JOIN diag_agg ON diag_agg.hadm_id = aged.hadm_id
              JOIN orders ON o_orderkey = aged.hadm_id)
"""


def sql_with(body: str, extra: str = "") -> str:
    """A query over the stand-in tables, with further named subqueries if needed."""
    return f"WITH {SQL_TABLES.strip()}{', ' + extra.strip() if extra else ''}\n{body.strip()}"
