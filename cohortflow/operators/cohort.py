"""Cohort table: one row per stay (or per admission without a stay)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.expressions import age_years, as_column
from cohortflow.operators.joins import HOT_ROWS, HOT_SHARE, fanout_left_join, lookup_join

ADMISSION_KEYS = ("subject_id", "hadm_id")


def measured(events: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    """Only events with a measured value, only the needed columns."""
    return events.filter(F.col("valuenum").isNotNull()).select(*keys, *columns)


def chart_summary(chartevents: DataFrame, keys: Sequence[str] = ADMISSION_KEYS) -> DataFrame:
    """Mean value and one unit of measure per admission.

    "First unit seen" depends on row order; the smallest one is the same on every run."""
    # sums per unit first: a smallest text beside a mean would sort the events, here both steps hash
    units = measured(chartevents, keys, "valuenum", "valueuom").groupBy(*keys, "valueuom").agg(
        F.sum("valuenum").alias("total"), F.count("valuenum").alias("n")
    )
    means = units.groupBy(*keys).agg((F.sum("total") / F.sum("n")).alias("avg_chart_val"), F.array_min(F.collect_set("valueuom")).alias("valueuom"))
    return means


def lab_summary(labevents: DataFrame, keys: Sequence[str] = ADMISSION_KEYS) -> DataFrame:
    return measured(labevents, keys, "valuenum").groupBy(*keys).agg(F.avg("valuenum").alias("avg_lab_val"))


def diagnosis_summary(diagnoses: DataFrame, keys: Sequence[str] = ADMISSION_KEYS) -> DataFrame:
    return diagnoses.groupBy(*keys).agg(F.count_distinct("icd9_code").alias("diagnosis_count"))


def with_demographics(
    admissions: DataFrame, patients: DataFrame, share: float = HOT_SHARE, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Admissions with birth date, gender and age at admission."""
    people = patients.select("subject_id", F.to_date("dob").alias("dob"), "gender")
    dated = admissions.withColumn("admittime", F.to_date("admittime"))
    return lookup_join(dated, people, ["subject_id"], "left", share, min_rows).withColumn(
        "age", age_years("admittime", "dob")
    )


def build_cohort(
    tables: Mapping[str, DataFrame],
    keys: Sequence[str] = ADMISSION_KEYS,
    lab_keys: Sequence[str] | None = None,
    stay_keys: Sequence[str] | None = None,
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join the six tables into the modelling table.

    The three event tables are aggregated below the joins. They meet the admissions
    before the stays do: the result is the same, but the fan-out to stays then
    happens once, at the end, on rows that are already complete."""
    keys = list(keys)
    wide = with_demographics(tables["admissions"], tables["patients"], share, min_rows)
    wide = wide.join(chart_summary(tables["chartevents"], keys), keys, "left")
    wide = wide.join(diagnosis_summary(tables["diagnoses_icd"], keys), keys, "left")
    by_lab = list(lab_keys or keys)
    wide = lookup_join(wide, lab_summary(tables["labevents"], by_lab), by_lab, "left", share, min_rows)
    stays = tables["icustays"]
    on = list(stay_keys or keys)
    clashes = [c for c in stays.columns if c not in on and c in wide.columns]
    stays = stays.drop(*clashes)  # the row counter of the stays file carries no information
    return fanout_left_join(wide, stays, on, share, min_rows)
