"""Reading the corpus tables and storing what several jobs read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.sources.scratch import materialize

#: Rows, and characters of their values, that may be broadcast; larger frames are joined by a shuffle.
BROADCAST_ROWS, BROADCAST_CHARACTERS = 1_000_000, 64 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: lineage ends here, a lost executor costs a re-read."""
    return materialize(df, label)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Few enough rows to broadcast, and few enough characters if their values were written out."""
    size = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("size")).first()
    return row["n"] <= rows and (row["size"] or 0) <= BROADCAST_CHARACTERS


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored frame with a broadcast hint if it is small enough, else for a shuffle join."""
    return F.broadcast(df) if is_small(df, rows) else df


def labelled(crc_of: str, divisor: int, remainder: int) -> Column:
    """Whether crc32 of a column as text has this remainder."""
    return F.crc32(F.col(crc_of).cast("string").cast("binary")) % divisor == remainder
