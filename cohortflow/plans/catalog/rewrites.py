"""Column and row rewrites."""

from pyspark.sql import functions as F

from cohortflow.functions.columns import (
    add_family_sum,
    align_to,
    complete_rows,
    drop_by_name_rule,
    drop_listed,
    drop_sparse_rows,
    fill_missing,
    non_finite_to_null,
    select_features,
)
from cohortflow.functions.expressions import number_or_zero, target_flag
from cohortflow.operators.cohort import chart_summary, diagnosis_summary, lab_summary
from cohortflow.operators.joins import lookup_join
from cohortflow.operators.preprocess import fit_levels, one_hot
from cohortflow.operators.synth import append_synthetic, kinds_table
from cohortflow.plans import stand_ins as S
from cohortflow.plans.catalog.assembly import rounded
from cohortflow.plans.catalog.registry import query
from cohortflow.plans.stand_ins import read, sql_with

SUMMARY_SQL = """
wide AS (SELECT adm.hadm_id, avg_chart_val, valueuom, diagnosis_count, avg_lab_val
         FROM adm LEFT JOIN chart_agg ON chart_agg.hadm_id = adm.hadm_id
              LEFT JOIN lab_agg ON lab_agg.subject_id = adm.subject_id
              LEFT JOIN diag_agg ON diag_agg.hadm_id = adm.hadm_id)"""


def summaries(spark, sf_dir):
    """Admissions with their summaries; null where an admission has no events."""
    wide = S.admissions(spark, sf_dir).select("subject_id", "hadm_id")
    wide = wide.join(chart_summary(S.chartevents(spark, sf_dir), S.STAY_KEYS), S.STAY_KEYS, "left")
    wide = wide.join(diagnosis_summary(S.diagnoses(spark, sf_dir), S.STAY_KEYS), S.STAY_KEYS, "left")
    wide = lookup_join(wide, lab_summary(S.labevents(spark, sf_dir), S.LAB_KEYS), S.LAB_KEYS)
    return wide.select("hadm_id", "avg_chart_val", "valueuom", "diagnosis_count", "avg_lab_val")


@query(
    "null_share_filter",
    sql_with(
        """
SELECT hadm_id, round(avg_chart_val, 6) AS avg_chart_val, valueuom, diagnosis_count, round(avg_lab_val, 6) AS avg_lab_val
FROM wide
WHERE CAST(avg_chart_val IS NULL AS INT) + CAST(valueuom IS NULL AS INT) + CAST(diagnosis_count IS NULL AS INT)
      + CAST(avg_lab_val IS NULL AS INT) + CAST(hadm_id IS NULL AS INT) < 4""",
        SUMMARY_SQL,
    ),
)
def null_share_filter(spark, sf_dir):
    kept = drop_sparse_rows(summaries(spark, sf_dir))
    return kept.select("hadm_id", rounded("avg_chart_val"), "valueuom", "diagnosis_count", rounded("avg_lab_val"))


@query(
    "typed_null_fill",
    sql_with(
        """
SELECT hadm_id, round(coalesce(avg_chart_val, 0), 6) AS avg_chart_val, coalesce(valueuom, 'datamiss') AS valueuom,
       coalesce(diagnosis_count, 0) AS diagnosis_count, round(coalesce(avg_lab_val, 0), 6) AS avg_lab_val
FROM wide""",
        SUMMARY_SQL,
    ),
)
def typed_null_fill(spark, sf_dir):
    filled = fill_missing(summaries(spark, sf_dir))
    return filled.select("hadm_id", rounded("avg_chart_val"), "valueuom", "diagnosis_count", rounded("avg_lab_val"))


def spoiled_events(spark, sf_dir):
    """Event values of which three event types are NaN or infinite."""
    kind = F.col("event_type")
    value = (
        F.when(kind == "error", F.lit(float("nan"))).when(kind == "signup", F.lit(float("inf")))
        .when(kind == "view", F.lit(float("-inf"))).otherwise(F.col("value"))
    )
    return read(spark, sf_dir, "events").select("event_id", value.alias("value"))


SPOILED_SQL = """
WITH spoiled AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'nan'::DOUBLE WHEN 'signup' THEN 'inf'::DOUBLE
                        WHEN 'view' THEN '-inf'::DOUBLE ELSE value END AS value FROM events)
"""


@query("inf_to_null", SPOILED_SQL + "SELECT event_id, CASE WHEN isfinite(value) THEN value END AS value FROM spoiled")
def inf_to_null(spark, sf_dir):
    return non_finite_to_null(spoiled_events(spark, sf_dir))


@query("complete_cases", SPOILED_SQL + "SELECT event_id, value FROM spoiled WHERE isfinite(value)")
def complete_cases(spark, sf_dir):
    return complete_rows(spoiled_events(spark, sf_dir))


@query(
    "numeric_coercion",
    """
SELECT event_id, coalesce(TRY_CAST(trim(CASE event_type WHEN 'error' THEN 'datamiss' WHEN 'signup' THEN ''
       WHEN 'view' THEN ' ' || CAST(value AS VARCHAR) || ' ' ELSE CAST(value AS VARCHAR) END) AS DOUBLE), 0) AS value,
       coalesce(TRY_CAST(props AS DOUBLE), 0) AS props_number
FROM events""",
)
def numeric_coercion(spark, sf_dir):
    kind, text = F.col("event_type"), F.col("value").cast("string")
    mixed = (
        F.when(kind == "error", "datamiss").when(kind == "signup", "")
        .when(kind == "view", F.concat(F.lit(" "), text, F.lit(" "))).otherwise(text)
    )
    return read(spark, sf_dir, "events").select(
        "event_id", number_or_zero(mixed).alias("value"), number_or_zero("props").alias("props_number")
    )


@query(
    "target_normalise",
    """
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS INTEGER) AS target FROM orders""",
)
def target_normalise(spark, sf_dir):
    status = F.col("o_orderstatus")
    text = F.when(status == "F", "1.0").when(status == "O", "0").when(status == "P", "pending")
    return read(spark, sf_dir, "orders").select("o_orderkey", target_flag(text).alias("target"))


@query(
    "drop_listed_columns",
    sql_with("""
SELECT discharge_location, hospital_expire_flag, gender, age, round(avg_chart_val, 6) AS avg_chart_val, valueuom,
       diagnosis_count, round(avg_lab_val, 6) AS avg_lab_val, first_wardid, round(los, 6) AS los FROM cohort"""),
)
def drop_listed_columns(spark, sf_dir):
    kept = drop_listed(S.cohort(spark, sf_dir))
    return kept.withColumns({c: F.round(c, 6) for c in ("avg_chart_val", "avg_lab_val", "los")})


@query(
    "drop_by_name_rule",
    sql_with("""
SELECT discharge_location, hospital_expire_flag, gender, age, round(avg_chart_val, 6) AS avg_chart_val, valueuom,
       diagnosis_count, round(avg_lab_val, 6) AS avg_lab_val, round(los, 6) AS los FROM cohort"""),
)
def drop_by_name(spark, sf_dir):
    kept = drop_by_name_rule(S.cohort(spark, sf_dir))
    return kept.withColumns({c: F.round(c, 6) for c in ("avg_chart_val", "avg_lab_val", "los")})


@query("select_features", sql_with("SELECT age, round(los, 6) AS los, hospital_expire_flag FROM cohort"))
def select_feature_columns(spark, sf_dir):
    return select_features(S.cohort(spark, sf_dir), ["age", "los"]).withColumn("los", F.round("los", 6))


TYPES_SQL = """
SELECT p_partkey, p_size,
       CAST(p_type = 'LARGE' AS INTEGER) AS p_type_LARGE, CAST(p_type = 'MEDIUM' AS INTEGER) AS p_type_MEDIUM,
       CAST(p_type = 'PROMO' AS INTEGER) AS p_type_PROMO, CAST(p_type = 'SMALL' AS INTEGER) AS p_type_SMALL,
       CAST(p_type = 'STANDARD' AS INTEGER) AS p_type_STANDARD
FROM part"""


@query("one_hot_drop_first", TYPES_SQL)
def one_hot_drop_first(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    return one_hot(parts, fit_levels(parts))


@query(
    "align_features",
    """
SELECT p_partkey, CAST(CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS DOUBLE) AS p_type_PROMO,
       CAST(0 AS DOUBLE) AS p_type_UNKNOWN, CAST(p_size AS DOUBLE) AS p_size FROM part""",
)
def align_features(spark, sf_dir):
    encoded = one_hot_drop_first(spark, sf_dir)
    return align_to(encoded, ["p_type_PROMO", "p_type_UNKNOWN", "p_size"], keep=["p_partkey"])


@query(
    "family_row_sum",
    """
SELECT p_partkey, CAST(CASE WHEN p_type = (SELECT min(p_type) FROM part) THEN 0 ELSE 1 END AS DOUBLE) AS religion_count
FROM part""",
)
def family_row_sum(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("religion"))
    return add_family_sum(one_hot(parts, fit_levels(parts))).select("p_partkey", "religion_count")


@query(
    "append_synthetic",
    """
SELECT c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment, FALSE AS is_synthetic FROM customer
UNION ALL SELECT s_nationkey, s_acctbal, NULL, TRUE FROM supplier""",
)
def append_rows(spark, sf_dir):
    real = read(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment")
    )
    other = read(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal")
    )
    return append_synthetic(real, other)


@query(
    "infer_column_kinds",
    """
SELECT 'o_orderkey' AS column_name, CASE WHEN count(DISTINCT o_orderkey) >= 0.9 * count(*) THEN 'id' ELSE 'numerical' END AS kind FROM orders
UNION ALL SELECT 'o_custkey', CASE WHEN count(DISTINCT o_custkey) >= 0.9 * count(*) THEN 'id' ELSE 'numerical' END FROM orders
UNION ALL SELECT 'o_orderstatus', CASE WHEN count(DISTINCT o_orderstatus) >= 0.9 * count(*) THEN 'id' ELSE 'categorical' END FROM orders
UNION ALL SELECT 'o_totalprice', 'numerical'
UNION ALL SELECT 'o_orderdate', 'datetime'
UNION ALL SELECT 'o_orderpriority', CASE WHEN count(DISTINCT o_orderpriority) >= 0.9 * count(*) THEN 'id' ELSE 'categorical' END FROM orders""",
)
def infer_column_kinds(spark, sf_dir):
    return kinds_table(read(spark, sf_dir, "orders"))
