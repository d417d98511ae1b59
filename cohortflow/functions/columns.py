"""Column choice and column-set rewrites. The rules look only at names and types."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.expressions import as_column, finite_or_null, null_count, quoted, row_sum

MISSING_TEXT = "datamiss"
TARGET = "hospital_expire_flag"

# Columns removed after the cohort join, and before feature work.
CLEANING_DROPS = (
    "subject_id", "hadm_id", "row_id", "admittime", "dischtime", "deathtime",
    "edregtime", "edouttime", "dob", "dod", "dod_hosp", "dod_ssn",
    "intime", "outtime", "ethnicity", "row_id_x", "row_id_y", "icustay_id",
)
FEATURE_DROPS = ("subject_id", "hadm_id", "row_id", "first_wardid", "last_wardid", "row_id.1", "dob")
SHAPED_COLUMNS = ("los", "diagnosis_count", "avg_chart_val", "avg_lab_val")


def is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.StringType, T.CharType, T.VarcharType))


def is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.NumericType, T.BooleanType))


def text_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if is_text(f) and f.name not in set(skip)]


def number_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if is_number(f) and f.name not in set(skip)]


def drop_listed(df: DataFrame, names: Iterable[str] = CLEANING_DROPS) -> DataFrame:
    """Drop the named columns; names the frame lacks are no error."""
    return df.drop(*[quoted(n) if "." in n else n for n in names if n in df.columns])


def unusable_names(names: Iterable[str], exact: Iterable[str] = FEATURE_DROPS) -> list[str]:
    """Names that carry identity or time: listed, ending in _id, or containing 'time'."""
    listed = {e.lower() for e in exact}
    return [n for n in names if n.lower() in listed or n.lower().endswith("_id") or "time" in n.lower()]


def drop_by_name_rule(df: DataFrame, exact: Iterable[str] = FEATURE_DROPS) -> DataFrame:
    return drop_listed(df, unusable_names(df.columns, exact))


def drop_sparse_rows(df: DataFrame, share: float = 0.8) -> DataFrame:
    """Keep rows whose number of missing cells is below int(share * columns)."""
    return df.filter(null_count(df.columns) < int(share * len(df.columns)))


def fill_missing(df: DataFrame, text: str = MISSING_TEXT, number: float = 0) -> DataFrame:
    """Text columns take the marker, number columns take zero."""
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    out = df.na.fill(text).na.fill(number)
    return out.na.fill(bool(number), subset=flags) if flags else out


def non_finite_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN and infinities in floating columns become null."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    chosen = floating if columns is None else floating & set(columns)
    return df.select(
        *[finite_or_null(c).alias(c) if c in chosen else as_column(c) for c in df.columns]
    )


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Only rows in which every (chosen) cell is a finite value.

    One plain test per column: replacing values and counting nulls over all columns makes code too long for the JVM to compile."""
    chosen = set(columns) if columns else set(df.columns)
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    for c in df.columns:
        if c in chosen:
            df = df.filter(F.abs(as_column(c)) < F.lit(math.inf) if c in floating else as_column(c).isNotNull())  # NaN is above infinity
    return df


def select_features(df: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    return df.select(*[as_column(c) for c in [*features, target]])


def align_to(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the listed features in order; absent ones are 0. `keep` columns pass in front."""
    present = set(df.columns)
    aligned = [
        as_column(f).cast("double").alias(f) if f in present else F.lit(0.0).alias(f) for f in features
    ]
    return df.select(*[as_column(k) for k in keep], *aligned)


def add_family_sum(df: DataFrame, prefix: str = "religion_", name: str = "religion_count") -> DataFrame:
    """Row sum over the columns of one dummy family; unchanged when there are none."""
    family = [c for c in df.columns if c.startswith(prefix) and c != name]
    return df.withColumn(name, row_sum(family)) if family else df
