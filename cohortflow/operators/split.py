"""Exact stratified splits and folds in seeded hash order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.expressions import as_column
from cohortflow.operators.joins import lookup_join
from cohortflow.operators.ranking import class_counts, hash_rank, largest_remainder, take_per_class

SEED = 42


def stratified_split(
    df: DataFrame, label: str, test_share: float, seed: int = SEED, key: Sequence[str] | None = None
) -> DataFrame:
    """Add is_test: exactly ceil(share * rows) rows, classes in proportion.

    key: columns that identify a row; without it whole rows are the key and copies
    of a row are told apart by number."""
    quotas = largest_remainder(class_counts(df, label), label, test_share)
    return take_per_class(df, label, quotas, seed, key, "is_test")


def group_split(df: DataFrame, label: str, group: str, test_share: float, seed: int = SEED) -> DataFrame:
    """Add is_test so that all rows of one group (patient) fall on the same side.

    Groups are stratified by whether they hold any positive row."""
    groups = df.groupBy(group).agg(F.max(F.col(label).cast("int")).alias("__any"))
    chosen = stratified_split(groups, "__any", test_share, seed, [group])
    known = lookup_join(df.filter(as_column(group).isNotNull()), chosen.filter(as_column(group).isNotNull()).select(group, "is_test"), [group], "inner")
    # rows without a group are one group
    alone = chosen.filter(as_column(group).isNull()).select("is_test")
    side = alone.first()
    if side is not None:
        known = known.unionByName(df.filter(as_column(group).isNull()).withColumn("is_test", F.lit(side["is_test"])))
    return known.select(*[as_column(c) for c in df.columns], "is_test")


def cv_folds(
    df: DataFrame, label: str, folds: int = 5, seed: int = SEED, key: Sequence[str] | None = None, name: str = "fold"
) -> DataFrame:
    """Add a fold number; class sizes differ by at most one row between folds."""
    ranked = hash_rank(df, label, seed, key, "__rank")
    return ranked.withColumn(name, ((F.col("__rank") - 1) % folds).cast("int")).drop("__rank")
