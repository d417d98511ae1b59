"""Data profile: counts, distributions, summary statistics, correlations."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.functions.columns import number_columns
from cohortflow.functions.expressions import as_column, bin_index
from cohortflow.operators.quantiles import exact_quantiles
from cohortflow.sources.scratch import materialize, spread

PAIRS_PER_JOB = 200


def long_rows(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn the single row of a wide aggregate into one row per struct."""
    return df.select(F.inline(F.array(*structs)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first, ties in value order."""
    c = as_column(column)
    return (
        df.filter(c.isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), c)
    )


def class_shares(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    everything = Window.partitionBy(F.lit(0))  # one row per class
    return counts.withColumn("share", F.col("count") / F.sum("count").over(everything))


def binned_counts(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Rows per bin in bin order; a bin without rows reports 0."""
    bins = df.sparkSession.createDataFrame(list(enumerate(labels)), "bin_idx int, label string")
    counts = (
        df.select(bin_index(column, edges).alias("bin_idx"))
        .filter(F.col("bin_idx").isNotNull())
        .groupBy("bin_idx")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return (
        bins.join(counts, "bin_idx", "left")
        .select("bin_idx", "label", F.coalesce("count", F.lit(0)).alias("count"))
        .orderBy("bin_idx")
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, mean, sample and population deviation, population skewness, extremes.

    One pass for all columns. A constant column has no skewness (null)."""
    parts, structs = [], []
    numbers = spread(df.select(*[as_column(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]))
    for i, c in enumerate(columns):
        x, n = F.col(f"x{i}"), F.col(f"n{i}")
        parts += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"),
            F.skewness(x).alias(f"k{i}"), F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}"),
        ]
        sample_variance = F.when(n > 1, F.col(f"v{i}") * n / (n - 1))
        structs.append(
            F.struct(
                F.lit(c).alias("column_name"), n.alias("n"), F.col(f"m{i}").alias("mean"),
                F.sqrt(sample_variance).alias("std"), F.sqrt(f"v{i}").alias("std_pop"), F.col(f"k{i}").alias("skewness"),
                F.col(f"a{i}").alias("min"), F.col(f"b{i}").alias("max"),
            )
        )
    return long_rows(numbers.agg(*parts), structs)


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    found = exact_quantiles(df, columns, probs)
    rows = [(c, *found[c]) for c in columns]
    ddl = ", ".join(["column_name string", *[f"{n} double" for n in names]])
    return df.sparkSession.createDataFrame(rows, ddl)


def describe_all(df: DataFrame) -> DataFrame:
    """One row per column: count; unique, top, freq for text and all other kinds (as text); mean, std, min, quartiles, max for numbers."""
    numbers = number_columns(df)
    texts = [c for c in df.columns if c not in set(numbers)]
    frames = []
    if texts:
        long = df.select(*[as_column(c).cast("string").alias(c) for c in texts]).unpivot([], texts, "column_name", "value")
        per_value = materialize(
            long.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")), "value_counts"
        )
        # sums hash; only the few values of the highest frequency are compared as text
        sums = per_value.groupBy("column_name").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq"))
        most = per_value.join(F.broadcast(sums.select("column_name", F.col("freq").alias("n"))), ["column_name", "n"])
        top = most.groupBy("column_name").agg(F.min("value").alias("top"))
        names = df.sparkSession.createDataFrame([(c,) for c in texts], "column_name string")
        empty = {"count": F.coalesce("count", F.lit(0)), "unique": F.coalesce("unique", F.lit(0))}
        frames.append(
            names.join(F.broadcast(sums), "column_name", "left").join(F.broadcast(top), "column_name", "left").withColumns(empty)
            .select("column_name", "count", "unique", "top", "freq")
        )
    if numbers:
        quartiles = quantile_table(df, numbers, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
        stats = moments(df, numbers).select("column_name", F.col("n").alias("count"), "mean", "std", "min", "max")
        frames.append(stats.join(F.broadcast(quartiles), "column_name"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    order = ["column_name", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max"]
    return out.select(*[c if c in out.columns else F.lit(None).alias(c) for c in order])


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What a box plot draws: quartiles, 1.5 IQR fences, whisker ends, rows outside the fences."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    parts, structs = [], []
    for i, c in enumerate(columns):
        q1, q2, q3 = quartiles[c]
        x = as_column(c).cast("double")
        low = None if q1 is None else q1 - 1.5 * (q3 - q1)
        high = None if q1 is None else q3 + 1.5 * (q3 - q1)
        inside = F.when((x >= F.lit(low)) & (x <= F.lit(high)), x)
        parts += [
            F.min(inside).alias(f"a{i}"), F.max(inside).alias(f"b{i}"),
            F.count_if((x < F.lit(low)) | (x > F.lit(high))).alias(f"o{i}"),
        ]
        fixed = {"q1": q1, "median": q2, "q3": q3, "lower_fence": low, "upper_fence": high}
        structs.append(
            F.struct(
                F.lit(c).alias("column_name"), *[F.lit(v).cast("double").alias(k) for k, v in fixed.items()],
                F.col(f"a{i}").alias("whisker_low"), F.col(f"b{i}").alias("whisker_high"),
                F.col(f"o{i}").alias("outliers"),
            )
        )
    return long_rows(df.agg(*parts), structs)


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins report 0."""
    x = as_column(column).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    spark = df.sparkSession
    if ends["lo"] is None:
        return spark.createDataFrame([], "bin_idx int, bin_start double, bin_end double, count long")
    lo, hi = ends["lo"], ends["hi"]
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    place = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(place.alias("bin_idx")).agg(F.count(F.lit(1)).alias("count"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin_idx"))
    return grid.join(F.broadcast(counts), "bin_idx", "left").select(
        "bin_idx",
        (F.lit(lo) + F.col("bin_idx") * F.lit(width)).alias("bin_start"),
        (F.lit(lo) + (F.col("bin_idx") + 1) * F.lit(width)).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def _correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are present; null for a constant column."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))


def corr_with_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Correlation of each feature with the outcome, all in one pass."""
    y = as_column(target).cast("double")
    wide = df.agg(*[_correlation(as_column(f).cast("double"), y).alias(f"c{i}") for i, f in enumerate(features)])
    return long_rows(
        wide,
        [F.struct(F.lit(f).alias("feature"), F.col(f"c{i}").alias("correlation")) for i, f in enumerate(features)],
    )


def top_correlated(df: DataFrame, features: Sequence[str], target: str, n: int) -> DataFrame:
    found = corr_with_target(df, features, target)
    return found.orderBy(F.desc_nulls_last("correlation"), "feature").limit(n)


def corr_matrix(df: DataFrame, columns: Sequence[str], pairs_per_job: int = PAIRS_PER_JOB) -> DataFrame:
    """Pairwise correlations in long form (column_a, column_b, correlation), each over the rows where both are present.

    Without missing cells one pass over row vectors gives the whole matrix; columns with
    missing cells are then compared pair by pair, several pairs a job."""
    cols = {c: as_column(c).cast("double") for c in columns}
    parts = [f(x).alias(f"{t}{i}") for i, x in enumerate(cols.values()) for t, f in (("c", F.count), ("s", F.stddev_pop))]
    found = df.agg(F.count(F.lit(1)).alias("n"), *parts).first()
    whole = [c for i, c in enumerate(columns) if found["n"] and found[f"c{i}"] == found["n"]]
    rows = _full_correlations(df, whole, {c for i, c in enumerate(columns) if not found[f"s{i}"]})
    partial = set(columns) - set(whole)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:] if a in partial or b in partial]
    for at in range(0, len(pairs), pairs_per_job):
        some = pairs[at : at + pairs_per_job]
        wide = df.agg(*[_correlation(cols[a], cols[b]).alias(f"c{i}") for i, (a, b) in enumerate(some)]).first()
        rows += [(a, b, wide[f"c{i}"]) for i, (a, b) in enumerate(some)]
    rows += [(b, a, r) for a, b, r in rows if a != b]
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, correlation double")


def _full_correlations(df: DataFrame, columns: Sequence[str], flat: set[str]) -> list[tuple[str, str, float | None]]:
    """Upper triangle for columns without missing cells; null beside a constant (flat) column."""
    if not columns:
        return []
    numbers = df.select(*[as_column(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    vectors = VectorAssembler(inputCols=numbers.columns, outputCol="v").transform(numbers).select("v")
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    return [
        (a, b, None if a in flat or b in flat or math.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
        if j >= i
    ]


def profile(df: DataFrame, target: str | None = None, bins: int = 20) -> dict[str, DataFrame]:
    """Everything a first look at a table shows: shape, summary, null counts, correlations, histograms and box
    numbers of the numeric columns, and class shares of the target."""
    numbers = number_columns(df)
    nulls = df.agg(*[F.count_if(as_column(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    out = {
        "shape": shape(df),
        "summary": describe_all(df),
        "nulls": long_rows(nulls, [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(df.columns)]),
    }
    if numbers:
        out |= {"correlations": corr_matrix(df, numbers), "boxes": box_stats(df, numbers)}
        charts = [histogram(df, c, bins).withColumn("column_name", F.lit(c)) for c in numbers]
        out["histograms"] = reduce(DataFrame.unionByName, charts)
    if target is not None:
        out["classes"] = class_shares(df, target)
    return out


def before_and_after(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Box numbers and skewness of the same columns around a treatment (clipping, power transform), told apart by `stage`."""
    def one(df: DataFrame, stage: str) -> DataFrame:
        skew = moments(df, columns).select("column_name", "skewness", "min", "max")
        return box_stats(df, columns).join(F.broadcast(skew), "column_name").withColumn("stage", F.lit(stage))

    return one(before, "before").unionByName(one(after, "after"))
