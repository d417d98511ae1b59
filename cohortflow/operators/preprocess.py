"""Fitted preprocessing: outlier limits, power transform, scaling, dummy columns.

Every step has a fit that reads statistics of all columns in one job and returns a small
specification, and a transform that is a plain projection."""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions.columns import (
    CLEANING_DROPS,
    MISSING_TEXT,
    SHAPED_COLUMNS,
    drop_listed,
    drop_sparse_rows,
    fill_missing,
    non_finite_to_null,
    text_columns,
)
from cohortflow.functions.expressions import as_column, clip, finite_or_null, number_or_zero, yeo_johnson
from cohortflow.operators.joins import lookup_join
from cohortflow.operators.profile import long_rows, moments
from cohortflow.operators.quantiles import exact_quantiles
from cohortflow.sources.artifacts import load_json, save_json
from cohortflow.sources.scratch import materialize, shared_scan, spread

SKEW_LIMIT = 0.5
MAX_LEVELS = 2000
COLUMNS_PER_JOB = 2
LAMBDA_LIMIT = 20.0
COARSE_GRID = tuple(round(-2 + 0.1 * i, 3) for i in range(41))


# ---- outlier limits -------------------------------------------------------


def fit_outlier_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """Per column: quartile fences when the data are skewed, else mean +/- 3 deviations."""
    stats = {r["column_name"]: r for r in moments(df, columns).collect()}
    skewed = [c for c in columns if abs(stats[c]["skewness"] or 0.0) > SKEW_LIMIT]
    quartiles = exact_quantiles(df, skewed, [0.25, 0.75]) if skewed else {}
    out = {}
    for c in columns:
        s = stats[c]
        if s["n"] == 0:
            low = high = None
            method = "none"
        elif c in quartiles:
            q1, q3 = quartiles[c]
            method, low, high = "iqr", q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        else:
            spread = 3 * (s["std"] or 0.0)
            method, low, high = "zscore", s["mean"] - spread, s["mean"] + spread
        out[c] = {"method": method, "lower": low, "upper": high, "skewness": s["skewness"],
                  "min": s["min"], "max": s["max"]}
    return out


def bounds_table(spark: SparkSession, bounds: dict[str, dict]) -> DataFrame:
    rows = [(c, b["method"], b["lower"], b["upper"]) for c, b in bounds.items()]
    return spark.createDataFrame(rows, "column_name string, method string, lower double, upper double")


def clip_columns(df: DataFrame, bounds: dict[str, dict]) -> DataFrame:
    return df.withColumns({c: clip(as_column(c).cast("double"), b["lower"], b["upper"]) for c, b in bounds.items()})


# ---- power transform ------------------------------------------------------


def power_likelihood(
    df: DataFrame, columns: Sequence[str], grids: dict[str, Sequence[float]], centers: dict[str, float]
) -> DataFrame:
    """Log-likelihood of each candidate lambda of each column: (column_name, lam, loglik).

    One aggregate holds two sums per candidate of a few columns, so a row is read once and
    never repeated. Sums are taken around the transformed centre to keep the variance accurate."""
    out = None
    for at in range(0, len(columns), COLUMNS_PER_JOB):
        some = columns[at : at + COLUMNS_PER_JOB]
        part = long_rows(*_likelihood_sums(df, some, grids, centers))
        out = part if out is None else out.unionByName(part)
    variance = (F.col("ss") - F.col("s") * F.col("s") / F.col("n")) / F.col("n")
    likelihood = -F.col("n") / 2 * F.log(variance) + (F.col("lam") - 1) * F.col("j")
    return out.select("column_name", "lam", F.when(variance > 0, likelihood).alias("loglik"))


def _likelihood_sums(df: DataFrame, columns: Sequence[str], grids: dict, centers: dict) -> tuple[DataFrame, list]:
    """One row with the sums of all candidates of some columns, and the structs that name them."""
    cells = spread(df.select(*[as_column(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]))
    sized = cells.select(*[e for i in range(len(columns)) for e in (F.log1p(F.abs(f"x{i}")).alias(f"z{i}"), (F.col(f"x{i}") >= 0).alias(f"up{i}"))])
    sums, structs = [], []
    for i, c in enumerate(columns):
        z, up = F.col(f"z{i}"), F.col(f"up{i}")
        sums += [F.count(z).alias(f"n{i}"), F.sum(F.when(up, z).otherwise(-z)).alias(f"j{i}")]
        for k, lam in enumerate(grids[c]):
            y = F.when(up, _power_of(z, lam)).otherwise(-_power_of(z, 2.0 - lam)) - F.lit(transform_value(centers[c], lam))
            sums += [F.sum(y).alias(f"s{i}_{k}"), F.sum(y * y).alias(f"q{i}_{k}")]
            structs.append(
                F.struct(
                    F.lit(c).alias("column_name"), F.lit(float(lam)).alias("lam"), F.col(f"n{i}").alias("n"),
                    F.col(f"s{i}_{k}").alias("s"), F.col(f"q{i}_{k}").alias("ss"), F.col(f"j{i}").alias("j"),
                )
            )
    return sized.agg(*sums), structs


def _power_of(size, power: float):
    return size if abs(power) < 1e-12 else F.expm1(F.lit(power) * size) / F.lit(power)


def _best(rows, columns) -> dict[str, float]:
    best: dict[str, tuple] = {}
    for r in rows:
        if r["loglik"] is not None:
            key = (-r["loglik"], r["lam"])
            best[r["column_name"]] = min(best.get(r["column_name"], key), key)
    return {c: best[c][1] if c in best else 1.0 for c in columns}


def fit_power(df: DataFrame, columns: Sequence[str], centers: dict[str, float]) -> dict[str, float]:
    """Maximum-likelihood lambda per column: grid of step 0.1, then 0.005 around the best.

    When the best candidate is the end of the grid, the grid moves on beyond it until the
    maximum is inside; a column whose likelihood still grows at LAMBDA_LIMIT is reported."""
    grids = {c: list(COARSE_GRID) for c in columns}
    best: dict[str, float] = {}
    open_columns = list(columns)
    while open_columns:
        found = _best(power_likelihood(df, open_columns, grids, centers).collect(), open_columns)
        best |= found
        on_edge = [c for c in open_columns if found[c] in (grids[c][0], grids[c][-1])]
        for c in on_edge:
            step = -1 if found[c] == grids[c][0] else 1
            grids[c] = sorted(round(found[c] + step * 0.1 * i, 3) for i in range(41))
        open_columns = [c for c in on_edge if abs(found[c]) < LAMBDA_LIMIT]
        for c in on_edge:
            if c not in open_columns:
                warnings.warn(f"{c}: the power likelihood still grows at lambda {found[c]}", stacklevel=2)
    fine = {c: [round(best[c] - 0.1 + 0.005 * i, 4) for i in range(41)] for c in columns}
    return _best(power_likelihood(df, columns, fine, centers).collect(), columns)


def apply_power(df: DataFrame, lambdas: dict[str, float]) -> DataFrame:
    return df.withColumns({c: yeo_johnson(as_column(c).cast("double"), lam) for c, lam in lambdas.items()})


# ---- scaling --------------------------------------------------------------


def fit_min_max(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    row = df.agg(
        *[f(as_column(c).cast("double")).alias(f"{t}{i}") for i, c in enumerate(columns) for t, f in (("a", F.min), ("b", F.max))]
    ).first()
    return {c: [row[f"a{i}"], row[f"b{i}"]] for i, c in enumerate(columns)}


def apply_min_max(df: DataFrame, limits: dict[str, list[float]]) -> DataFrame:
    """To [0, 1]; a constant column becomes 0."""
    out = {}
    for c, (low, high) in limits.items():
        width = (high - low) if low is not None and high != low else 1.0
        out[c] = (as_column(c).cast("double") - F.lit(low)) / F.lit(width)
    return df.withColumns(out)


def fit_z_score(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Mean and population deviation per column."""
    parts = []
    for i, c in enumerate(columns):
        x = as_column(c).cast("double")
        parts += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = df.agg(*parts).first()
    return {c: [row[f"m{i}"], row[f"s{i}"]] for i, c in enumerate(columns)}


def apply_z_score(df: DataFrame, stats: dict[str, list[float]]) -> DataFrame:
    """Subtract the mean, divide by the deviation; a constant column is only centred."""
    out = []
    for c in df.columns:
        if c in stats:
            mean, deviation = stats[c]
            out.append(((as_column(c).cast("double") - F.lit(mean)) / F.lit(deviation or 1.0)).alias(c))
        else:
            out.append(as_column(c))
    return df.select(*out)


# ---- dummy columns --------------------------------------------------------


def fit_levels(
    df: DataFrame, columns: Sequence[str] | None = None, max_levels: int = MAX_LEVELS, wide: list[str] | None = None
) -> dict[str, list[str]]:
    """Sorted distinct values of each text column, all columns in one job.

    One output column per level needs a bounded number of levels. Columns with more than
    `max_levels` are named in the list `wide` if one is given, else they are an error."""
    names = list(columns) if columns is not None else text_columns(df)
    if not names:
        return {}
    long = df.select(*[as_column(c).cast("string").alias(c) for c in names]).unpivot([], names, "name", "level")
    distinct = long.filter(F.col("level").isNotNull()).distinct()
    sizes = {r["name"]: r["count"] for r in distinct.groupBy("name").count().collect()}
    many = [c for c in names if sizes.get(c, 0) > max_levels]
    if many and wide is None:
        raise ValueError(f"more than {max_levels} levels in {many}: drop them, or use one_hot_vector or the list `wide`")
    if many:
        wide += many
        distinct = distinct.filter(~F.col("name").isin(many))
    levels: dict[str, list[str]] = {c: [] for c in names if c not in set(many)}
    for r in distinct.collect():
        levels[r["name"]].append(r["level"])
    return {c: sorted(v) for c, v in levels.items()}


def strongest_levels(df: DataFrame, columns: Sequence[str], target: str, k: int) -> dict[str, list[str]]:
    """Of all 0/1 columns that the levels of wide text columns would give, the k best by ANOVA F and the k best
    by mutual information with a 0/1 target; the first level of a column has no dummy.

    Levels are counted in long form, so no column and no list of levels is ever made of them."""
    y = as_column(target).cast("long")
    total = df.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("p")).first()
    n, p = total["n"], total["p"] or 0
    if not columns or p in (0, n):
        return {}
    long = df.select(y.alias("__y"), *[as_column(c).cast("string").alias(c) for c in columns]).unpivot(["__y"], list(columns), "name", "level")
    counts = long.filter(F.col("level").isNotNull()).groupBy("name", "level").agg(F.count(F.lit(1)).cast("double").alias("k"), F.sum("__y").cast("double").alias("kp"))
    firsts = long.groupBy("name").agg(F.min("level").alias("first"))
    counts = counts.join(F.broadcast(firsts), "name").filter(F.col("level") > F.col("first"))
    k1, k0, n1, n0 = F.col("kp"), F.col("k") - F.col("kp"), float(p), float(n - p)
    mean, a, b = F.col("k") / n, k1 / n1, k0 / n0
    between = n1 * (a - mean) * (a - mean) + n0 * (b - mean) * (b - mean)
    within = n1 * a * (1 - a) + n0 * b * (1 - b)
    f = F.when(within > 0, between / within * (n - 2)).otherwise(F.lit(float("inf")))

    def term(cell, row, side):
        return F.when(cell > 0, cell / n * F.log(cell * n / (row * side))).otherwise(0.0)

    rest = F.lit(float(n)) - F.col("k")
    information = term(k1, F.col("k"), n1) + term(k0, F.col("k"), n0) + term(n1 - k1, rest, n1) + term(n0 - k0, rest, n0)
    out: dict[str, list[str]] = {}
    for score in (F.round(f, 9), F.round(information, 12)):  # equal cells tie whatever the order of the sums
        for r in counts.orderBy(score.desc(), "name", "level").limit(k).select("name", "level").collect():
            if r["level"] not in out.setdefault(r["name"], []):
                out[r["name"]].append(r["level"])
    return out


def one_hot(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """0/1 column per level but the first; null and unseen values are 0 everywhere."""
    dummies = [
        F.coalesce((as_column(c) == F.lit(level)).cast("int"), F.lit(0)).alias(f"{c}_{level}")
        for c, values in levels.items()
        if c in df.columns
        for level in values[1:]
    ]
    return df.select(*[as_column(c) for c in df.columns if c not in levels], *dummies)


def one_hot_vector(df: DataFrame, columns: Sequence[str], output: str = "dummies"):
    """Fitted stages that give one sparse vector, for columns with very many levels.

    Descending level order puts the first level last, where the encoder drops it;
    unseen values and nulls are moved to that same all-zero place."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler

    indexed, capped, encoded = ([f"{c}__{t}" for c in columns] for t in ("idx", "cap", "vec"))
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=indexed, stringOrderType="alphabetDesc", handleInvalid="keep"
    ).fit(df)
    lasts = [len(labels) - 1 for labels in indexer.labelsArray]
    capping = ", ".join(f"least(`{i}`, {last}D) AS `{c}`" for i, last, c in zip(indexed, lasts, capped, strict=True))
    cap = SQLTransformer(statement=f"SELECT *, {capping} FROM __THIS__")
    encoder = OneHotEncoder(inputCols=capped, outputCols=encoded, dropLast=True).fit(cap.transform(indexer.transform(df)))
    return PipelineModel([indexer, cap, encoder, VectorAssembler(inputCols=encoded, outputCol=output)])


def one_hot_sparse(df: DataFrame, column: str, output: str = "dummies") -> DataFrame:
    """The vector of one_hot_vector for a column of any number of levels, which are numbered and looked up as tables.

    The driver holds one count per sorted partition of the levels."""
    from pyspark.ml.linalg import Vectors, VectorUDT

    levels = df.select(as_column(column).alias(column)).filter(as_column(column).isNotNull()).distinct()
    ordered = materialize(levels.orderBy(as_column(column).desc()).withColumn("__m", F.monotonically_increasing_id()), "levels")
    part, place = F.shiftright("__m", 33), F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    offsets, width = [], -1  # the first level, last in this order, has no place
    for r in sorted(ordered.groupBy(part.alias("part")).count().collect()):
        offsets.append((r["part"], width + 1))
        width += r["count"]
    width = max(0, width)
    known = df.sparkSession.createDataFrame(offsets, "__part long, __offset long")
    coded = ordered.join(F.broadcast(known), part == F.col("__part")).select(as_column(column), (F.col("__offset") + place).alias("__code"))

    @F.udf(VectorUDT())
    def vector(code):
        inside = code is not None and code < width
        return Vectors.sparse(width, [code] if inside else [], [1.0] if inside else [])

    return lookup_join(df, coded, [column]).withColumn(output, vector("__code")).drop("__code")


# ---- the whole specification ----------------------------------------------


@dataclass
class PreprocessSpec:
    """Everything learnt from training data that scoring data must be put through unchanged."""

    drops: list[str] = field(default_factory=lambda: list(CLEANING_DROPS))
    sparse_share: float = 0.8
    bounds: dict[str, dict] = field(default_factory=dict)
    lambdas: dict[str, float] = field(default_factory=dict)
    limits: dict[str, list[float]] = field(default_factory=dict)

    def save(self, spark: SparkSession, path: str) -> None:
        save_json(spark, asdict(self), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PreprocessSpec:
        return cls(**load_json(spark, path))

    def clean(self, df: DataFrame, keep: Sequence[str] = (), drop_rows: bool = True) -> DataFrame:
        """Drop sparse rows and listed columns, then fill what is missing.

        `keep` protects identifying columns that a caller needs further on."""
        rows = drop_sparse_rows(df, self.sparse_share) if drop_rows else df
        kept = drop_listed(rows, [d for d in self.drops if d not in set(keep)])
        return fill_missing(non_finite_to_null(kept), MISSING_TEXT, 0)

    def shape(self, df: DataFrame) -> DataFrame:
        """Clip, power-transform and scale the fitted columns that are present."""
        out = {}
        for c in self.bounds:
            if c in df.columns:
                b, (low, high) = self.bounds[c], self.limits[c]
                text = dict(df.dtypes)[c] == "string"
                x = number_or_zero(c) if text else F.coalesce(finite_or_null(c), F.lit(0.0))
                y = yeo_johnson(clip(x, b["lower"], b["upper"]), self.lambdas[c])
                width = high - low if high != low else 1.0
                out[c] = (y - F.lit(low)) / F.lit(width)
        return df.withColumns(out) if out else df

    def transform(self, df: DataFrame, keep: Sequence[str] = (), drop_rows: bool = True) -> DataFrame:
        return self.shape(self.clean(df, keep, drop_rows))


def fit_shaping(df: DataFrame, columns: Sequence[str] = SHAPED_COLUMNS, spec: PreprocessSpec | None = None) -> PreprocessSpec:
    """Learn limits, lambdas and scaling on cleaned data; columns the frame lacks are skipped.

    Both the clip and the power transform keep order, so the extremes after them are
    the transformed extremes before them and the scaling needs no further pass."""
    spec = spec or PreprocessSpec()
    present = [c for c in columns if c in df.columns]
    with shared_scan(df.select(*[F.coalesce(finite_or_null(c), F.lit(0.0)).alias(c) for c in present])) as numbers:
        spec.bounds = fit_outlier_bounds(numbers, present)
        centers = {}
        for c in present:
            b = spec.bounds[c]
            if b["method"] == "none":  # no rows to learn from
                b["lower"], b["upper"], b["min"], b["max"] = 0.0, 0.0, 0.0, 0.0
            centers[c] = (max(b["min"], b["lower"]) + min(b["max"], b["upper"])) / 2
        spec.lambdas = fit_power(clip_columns(numbers, spec.bounds), present, centers)
    spec.limits = {}
    for c in present:
        b = spec.bounds[c]
        ends = [min(max(v, b["lower"]), b["upper"]) for v in (b["min"], b["max"])]
        spec.limits[c] = [transform_value(v, spec.lambdas[c]) for v in ends]
    return spec


def transform_value(x: float, lam: float) -> float:
    """The power transform of one number on the driver."""
    power = lam if x >= 0 else 2.0 - lam
    size = math.log1p(abs(x))
    if abs(power) >= 1e-12:
        size = math.expm1(power * size) / power
    return size if x >= 0 else -size
