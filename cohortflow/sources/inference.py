"""Column types from the cells of text columns.

Types form a lattice: a cell is of every type it parses as, and a column of the narrowest type that all its cells
share. Each task counts the cells that parse per column and type and the counts are added up, so one aggregate over
all rows decides, not a sample. Blank cells are missing and of every type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.expressions import as_column

COLUMNS_PER_JOB = 64
# narrow to wide
TYPES = ("boolean", "bigint", "double", "date", "timestamp", "string")
INTEGER = r"^[+-]?[0-9]{1,19}$"
DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"


def _cell(c: Column) -> Column:
    trimmed = F.trim(c.cast("string"))
    return F.when(trimmed != "", trimmed)


def parsed(cell: Column, kind: str) -> Column:
    """The cell as a value of the type, null if it is none."""
    if kind == "boolean":
        return F.when(F.lower(cell).isin("true", "false"), F.lower(cell) == "true")
    pattern = {"bigint": INTEGER, "double": DECIMAL, "date": DATE, "timestamp": TIMESTAMP}.get(kind)
    return F.when(cell.rlike(pattern), cell.try_cast(kind)) if pattern else cell


def type_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, type, cells, forced_by): the type, how many cells are not blank, and the smallest cell that does not
    parse as the next narrower type that some cells have; null where all cells agree. Columns without cells are string."""
    names = list(df.columns if columns is None else columns)
    rows = []
    for at in range(0, len(names), COLUMNS_PER_JOB):
        some = names[at : at + COLUMNS_PER_JOB]
        cells = df.select(*[_cell(as_column(c)).alias(f"c{i}") for i, c in enumerate(some)])
        parts = []
        for i in range(len(some)):
            cell = F.col(f"c{i}")
            parts.append(F.count(cell).alias(f"n{i}"))
            for k, kind in enumerate(TYPES[:-1]):
                fits = parsed(cell, kind).isNotNull()
                parts += [F.count_if(fits).alias(f"f{i}_{k}"), F.min(F.when(~fits, cell)).alias(f"m{i}_{k}")]
        found = cells.agg(*parts).first()
        for i, c in enumerate(some):
            n = found[f"n{i}"]
            fits = [found[f"f{i}_{k}"] for k in range(len(TYPES) - 1)]
            narrowest = next((k for k, f in enumerate(fits) if n and f == n), len(TYPES) - 1)
            partly = [k for k in range(narrowest) if 0 < fits[k] < n]
            rows.append((c, TYPES[narrowest], n, found[f"m{i}_{partly[-1]}"] if partly else None))
    return df.sparkSession.createDataFrame(rows, "column_name string, type string, cells long, forced_by string")


def inferred(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns with the types of their cells; those named in `keep`, without case, stay as they are."""
    kept = {k.lower() for k in keep}
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name.lower() not in kept]
    kinds = {r["column_name"]: r["type"] for r in type_report(df, text).collect()}
    return df.select(*[parsed(_cell(as_column(c)), kinds[c]).alias(c) if kinds.get(c, "string") != "string" else as_column(c) for c in df.columns])
