"""Shapes of distributions: density curves of single columns, joint counts of pairs by class."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.expressions import as_column, finite_or_null
from cohortflow.operators.profile import corr_with_target

POINTS = 200
NODES = 1024
CUT = 3.0  # bandwidths that a curve goes on beyond the ends
PAIR_BINS = 10


def density_curves(df: DataFrame, columns: Sequence[str], points: int = POINTS, nodes: int = NODES) -> DataFrame:
    """(column_name, x, density): Gaussian kernel density, bandwidth n^(-1/5) standard deviations, at equally spaced points.

    A row's weight is dealt linearly to the two nodes beside it, so one pass over the rows gives columns x nodes sums, and
    the kernel is applied to those. Columns without two different finite values have no curve; nulls and NaN are left out."""
    names = {c: f"x{i}" for i, c in enumerate(columns)}
    data = df.select(*[finite_or_null(c).alias(x) for c, x in names.items()])
    parts = [f(x).alias(f"{t}_{x}") for x in names.values() for t, f in (("n", F.count), ("s", F.stddev_samp), ("lo", F.min), ("hi", F.max))]
    ends = data.agg(*parts).first() if columns else {}
    frames = {}
    for c, x in names.items():
        width = (ends[f"s_{x}"] or 0.0) * max(ends[f"n_{x}"], 1) ** -0.2
        if width > 0:
            frames[c] = (ends[f"lo_{x}"] - CUT * width, ends[f"hi_{x}"] + CUT * width, width, ends[f"n_{x}"])
    spark = df.sparkSession
    schema = "column_name string, x double, density double"
    if not frames:
        return spark.createDataFrame([], schema)
    cells = []
    for c, (lo, hi, _, _) in frames.items():
        place = (F.col(names[c]) - F.lit(lo)) / F.lit((hi - lo) / (nodes - 1))
        cells.append(F.struct(F.lit(c).alias("column_name"), F.floor(place).cast("int").alias("node"), (place - F.floor(place)).alias("over")))
    long = data.select(F.inline(F.array(*cells))).where("node IS NOT NULL")
    sums = long.groupBy("column_name", "node").agg(F.sum(1 - F.col("over")).alias("left"), F.sum("over").alias("right")).collect()
    weights = {c: np.zeros(nodes + 1) for c in frames}
    for r in sums:
        weights[r["column_name"]][r["node"]] += r["left"]
        weights[r["column_name"]][r["node"] + 1] += r["right"]
    rows = []
    for c, (lo, hi, width, n) in frames.items():
        at, node = lo + np.arange(points) * ((hi - lo) / (points - 1)), lo + np.arange(nodes) * ((hi - lo) / (nodes - 1))
        kernel = np.exp(-0.5 * ((at[:, None] - node[None, :]) / width) ** 2)
        rows += [(c, float(x), float(d)) for x, d in zip(at, kernel @ weights[c][:nodes] / (n * width * math.sqrt(2 * math.pi)), strict=True)]
    return spark.createDataFrame(rows, schema)


def _bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    # least would give the last bin for a missing value
    return F.when(x.isNotNull(), F.least(F.floor((x - F.lit(lo)) / F.lit((hi - lo) / bins)), F.lit(bins - 1)).cast("int"))


def pair_counts(df: DataFrame, features: Sequence[str], label: str, bins: int = PAIR_BINS) -> DataFrame:
    """(feature_a, feature_b, bin_a, bin_b, label, count): joint equal-width histograms of all pairs of features by class.

    One pass for the ends and one for all pairs: each row adds a cell per pair, counted on the map side, so at most
    pairs x bins x bins x classes counts per task are shuffled. A row counts for the pairs of which it has both values."""
    numbers = {f: finite_or_null(f) for f in features}
    ends = df.agg(*[g(x).alias(f"{t}{i}") for i, x in enumerate(numbers.values()) for t, g in (("lo", F.min), ("hi", F.max))]).first()
    known = [f for i, f in enumerate(features) if ends[f"lo{i}"] is not None]
    places = [_bin(numbers[f], ends[f"lo{i}"], ends[f"hi{i}"], bins).alias(f"b{i}") for i, f in enumerate(features) if f in known]
    at = {f: f"b{i}" for i, f in enumerate(features) if f in known}
    pairs = list(combinations(known, 2))
    schema = f"feature_a string, feature_b string, bin_a int, bin_b int, label {df.select(as_column(label)).schema[0].dataType.simpleString()}, count long"
    if not pairs:
        return df.sparkSession.createDataFrame([], schema)
    binned = df.select(as_column(label).alias("label"), *places)
    cells = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(at[a]).alias("bin_a"), F.col(at[b]).alias("bin_b")) for a, b in pairs]
    long = binned.select("label", F.inline(F.array(*cells))).where("bin_a IS NOT NULL AND bin_b IS NOT NULL")
    return long.groupBy("feature_a", "feature_b", "bin_a", "bin_b", "label").agg(F.count(F.lit(1)).alias("count"))


def strongest_pairs(df: DataFrame, features: Sequence[str], target: str, n: int = 6, bins: int = PAIR_BINS) -> DataFrame:
    """pair_counts of the n features that correlate most with the target, whatever the sign; equal ones by name. NaN and
    infinities count as missing."""
    df = df.select(as_column(target), *[finite_or_null(f).alias(f) for f in features])
    found = corr_with_target(df, features, target).where("correlation IS NOT NULL")
    top = [r["feature"] for r in found.orderBy(F.desc(F.abs("correlation")), "feature").limit(n).collect()]
    return pair_counts(df, top, target, bins)
