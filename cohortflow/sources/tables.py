"""Table schemas, readers, landing-folder ingest and listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.expressions import as_column, parse_number
from cohortflow.sources.inference import inferred

# The columns of the six source tables that the cohort needs.
SOURCE_COLUMNS: dict[str, dict[str, str]] = {
    "admissions": {
        "row_id": "bigint", "subject_id": "bigint", "hadm_id": "bigint", "admittime": "timestamp",
        "dischtime": "timestamp", "deathtime": "timestamp", "discharge_location": "string",
        "religion": "string", "ethnicity": "string", "edregtime": "timestamp",
        "edouttime": "timestamp", "hospital_expire_flag": "int",
    },
    "patients": {"subject_id": "bigint", "gender": "string", "dob": "timestamp"},
    "icustays": {
        "row_id": "bigint", "subject_id": "bigint", "hadm_id": "bigint", "icustay_id": "bigint",
        "first_wardid": "bigint", "last_wardid": "bigint", "intime": "timestamp",
        "outtime": "timestamp", "los": "double",
    },
    "chartevents": {"subject_id": "bigint", "hadm_id": "bigint", "valuenum": "double", "valueuom": "string"},
    "labevents": {"subject_id": "bigint", "hadm_id": "bigint", "valuenum": "double"},
    "diagnoses_icd": {"subject_id": "bigint", "hadm_id": "bigint", "icd9_code": "string"},
}


def schema_of(columns: Mapping[str, str]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in columns.items()))


def read_csv_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Headered CSV, every column text."""
    return spark.read.option("header", True).option("escape", '"').csv(path)


def typed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Cast text columns to their declared types; cells that do not parse become null.

    Columns are matched by name without case; undeclared ones pass as they are and
    declared ones the file lacks are added as null."""
    found = {c.lower(): c for c in df.columns}
    wanted = {n.lower(): (n, t) for n, t in columns.items()}
    out = []
    for c in df.columns:
        if c.lower() in wanted:
            name, kind = wanted[c.lower()]
            out.append(_parse(as_column(c), kind).alias(name))
        else:
            out.append(as_column(c))
    for key, (name, kind) in wanted.items():
        if key not in found:
            out.append(F.lit(None).cast(kind).alias(name))
    return df.select(*out)


def _parse(c, kind: str):
    if kind in ("double", "float"):
        return parse_number(c).cast(kind)
    if kind in ("int", "bigint", "smallint"):
        # "3.0" is how a column with missing cells is often exported
        return F.coalesce(F.trim(c).try_cast(kind), parse_number(c).try_cast(kind))
    return c.try_cast(kind)


def read_csv_typed(spark: SparkSession, path: str | Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Headered CSV against a declared schema: one scan, no inference pass."""
    return typed(read_csv_text(spark, path), columns)


def read_csv_inferred(spark: SparkSession, path: str | Sequence[str], declared: Mapping[str, str] | None = None) -> DataFrame:
    """Headered CSV: declared columns by their declared types, the others by their cells, which costs a pass over those."""
    rows = read_csv_text(spark, path)
    return inferred(typed(rows, declared) if declared else rows, list(declared or {}))


def read_source_tables(spark: SparkSession, folder: str, infer: bool = True) -> dict[str, DataFrame]:
    """The six source tables from NAME.csv files in one folder. Columns beyond the declared ones get the types of their
    cells, or stay text without `infer`."""
    read = read_csv_inferred if infer else read_csv_typed
    return {name: read(spark, f"{folder}/{name.upper()}.csv", columns) for name, columns in SOURCE_COLUMNS.items()}


def list_files(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """Name, size and time of the files in a folder; contents are never read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    files = reader.load(folder)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length", "modificationTime"
    )


def table_inventory(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """Rows per landed Parquet table, from file footers."""
    parts = [
        spark.read.parquet(f"{folder}/{n}.parquet").agg(
            F.lit(f"{n}.parquet").alias("file_name"), F.count(F.lit(1)).alias("row_count")
        )
        for n in names
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ingest_folder(
    spark: SparkSession,
    landing: str,
    destination: str,
    schemas: Mapping[str, Mapping[str, str]],
) -> dict[str, str]:
    """Rewrite each landed CSV table as a Parquet table, overwriting older copies."""
    written = {}
    for name, columns in schemas.items():
        target = f"{destination.rstrip('/')}/{name}"
        read_csv_typed(spark, f"{landing.rstrip('/')}/{name.upper()}.csv", columns).write.mode(
            "overwrite"
        ).parquet(target)
        written[name] = target
    return written


def configure_storage(spark: SparkSession, settings: Mapping[str, str]) -> None:
    """Apply storage access settings given by the caller; nothing is stored in code."""
    for key, value in settings.items():
        spark.conf.set(key, value)
