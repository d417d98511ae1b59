"""Synthetic rows from a Gaussian copula fitted to a table.

Each column is mapped to normal scores through its own distribution, the correlation of
the scores is measured, and new rows are drawn from that normal distribution and mapped
back. Numbers use a 101-point quantile table, categories their cumulative shares."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.columns import is_text
from cohortflow.functions.expressions import as_column, standard_normal, uniform
from cohortflow.operators.binning import with_interpolation, with_steps
from cohortflow.operators.quantiles import exact_quantiles
from cohortflow.operators.joins import lookup_join
from cohortflow.operators.ranking import hash_rank
from cohortflow.sources.scratch import materialize, scratch_path

SYNTHETIC_ROWS = 5000
KNOTS = 101
MAX_CATEGORIES = 1000
ID_SHARE = 0.9
_EDGE = 0.001  # probability given to the extreme knots, whose own would be 0 and 1


def infer_kinds(df: DataFrame) -> dict[str, str]:
    """numerical, categorical, boolean, datetime or id per column, from type, name and distinct share."""
    fields = df.schema.fields
    checked = [f for f in fields if is_text(f) or isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType))]
    sizes = (
        df.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.approx_count_distinct(as_column(f.name), 0.02).alias(f"d{i}") for i, f in enumerate(checked)],
        ).first()
        if checked
        else None
    )
    distinct = {f.name: sizes[f"d{i}"] / max(sizes["n"], 1) for i, f in enumerate(checked)}
    out = {}
    for f in fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out[f.name] = "datetime"
        elif isinstance(f.dataType, T.BooleanType):
            out[f.name] = "boolean"
        elif distinct.get(f.name, 0.0) >= ID_SHARE:
            out[f.name] = "id"
        elif is_text(f):
            out[f.name] = "categorical"
        else:
            out[f.name] = "numerical"
    return out


def kinds_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(list(infer_kinds(df).items()), "column_name string, kind string")


@dataclass
class CopulaSpec:
    columns: list[str]
    types: dict[str, str]
    knots: dict[str, list]  # numbers: [values, scores]
    levels: dict[str, list]  # categories: [values, score borders, score of each value]
    null_share: dict[str, float]
    root: list[list[float]]  # lower triangular factor of the score correlation
    wide: dict[str, str] = field(default_factory=dict)  # categories with very many values: the stored table of their intervals


def fit_copula(df: DataFrame, columns: Sequence[str] | None = None) -> CopulaSpec:
    """Marginal tables and score correlation. Id and datetime columns are left out.

    The driver receives only these tables: 101 numbers per numeric column, the level
    counts of a category and one square matrix. A category with more than MAX_CATEGORIES values
    keeps its table in the shared folder and meets rows and draws by joins."""
    if columns is None:
        columns = [c for c, kind in infer_kinds(df).items() if kind not in ("id", "datetime")]
    columns = list(columns)
    df = materialize(df.select(*[as_column(c) for c in columns]), "copula_input")  # read by several jobs
    kinds = {f.name: f for f in df.schema.fields}
    categories = [c for c in columns if is_text(kinds[c]) or isinstance(kinds[c].dataType, T.BooleanType)]
    numbers = [c for c in columns if c not in categories]
    n_and_nulls = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(as_column(c)).alias(f"c{i}") for i, c in enumerate(columns)]
    ).first()
    total = n_and_nulls["n"]
    null_share = {c: 1 - n_and_nulls[f"c{i}"] / max(total, 1) for i, c in enumerate(columns)}
    normal = NormalDist()
    probs = [i / (KNOTS - 1) for i in range(KNOTS)]
    scores = [normal.inv_cdf(min(max(p, _EDGE), 1 - _EDGE)) for p in probs]
    tables = exact_quantiles(df, numbers, probs) if numbers else {}
    knots = {c: [tables[c], scores] for c in numbers if tables[c][0] is not None}
    levels, wide = _category_tables(df, categories)
    usable = [c for c in columns if c in knots or c in levels or c in wide]
    coded = materialize(_to_scores(df, usable, knots, levels, wide), "copula_scores")  # the correlation reads them twice
    assembled = VectorAssembler(inputCols=coded.columns, outputCol="z").transform(coded).select("z")
    matrix = Correlation.corr(assembled, "z").first()[0].toArray()
    return CopulaSpec(
        usable, {c: kinds[c].dataType.simpleString() for c in usable}, knots, levels, null_share, _factor(matrix).tolist(), wide
    )


def _category_tables(df: DataFrame, categories: Sequence[str]) -> tuple[dict[str, list], dict[str, str]]:
    """Tables of the categories, and the stored tables of those with very many values."""
    if not categories:
        return {}, {}
    text = [as_column(c).cast("string").alias(c) for c in categories]
    long = df.select(*text).unpivot([], list(categories), "name", "level").filter(F.col("level").isNotNull())
    counts = long.groupBy("name", "level").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["name"]: r["count"] for r in counts.groupBy("name").count().collect()}
    many = [c for c, size in sizes.items() if size > MAX_CATEGORIES]
    wide = {c: _interval_table(counts.filter(F.col("name") == c).select("level", "n")) for c in many}
    found: dict[str, list] = {c: [] for c in categories if c not in wide}
    for r in counts.filter(~F.col("name").isin(many)).collect() if many else counts.collect():
        # equal frequencies go by the same hash as in hash_rank, so that a value's place does not depend on how many there are
        found[r["name"]].append((-r["n"], hashlib.md5(f"42|{r['level']}".encode()).hexdigest(), r["level"]))
    normal, out = NormalDist(), {}
    for c, pairs in found.items():
        if not pairs:
            continue
        pairs.sort()
        shares = np.array([-n for n, _, _ in pairs], dtype=float)
        upper = np.cumsum(shares / shares.sum())
        middle = upper - shares / shares.sum() / 2
        borders = [normal.inv_cdf(min(max(u, 1e-9), 1 - 1e-9)) for u in upper[:-1]]
        out[c] = [[v for _, _, v in pairs], borders, [normal.inv_cdf(float(m)) for m in middle]]
    return out, wide


def _interval_table(counts: DataFrame) -> str:
    """Store (level, low, mid, high): each value's interval of normal scores, the most frequent values first.

    Values of equal frequency are ranked in hash order inside buckets, and the sums over the
    frequencies have one row per frequency, so no task sees all values."""
    spark = counts.sparkSession
    ranked = hash_rank(counts, "n", 42, ["level"], "rank")
    per_n = counts.groupBy("n").agg((F.sum("n")).alias("rows"))
    total = per_n.agg(F.sum("rows")).first()[0]
    before = Window.partitionBy(F.lit(0)).orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    bases = per_n.select("n", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    placed = ranked.join(bases, "n").select("level", (F.col("base") + (F.col("rank") - 1) * F.col("n")).alias("first"), "n")

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        normal = NormalDist()

        def score(share: float) -> float:
            return -np.inf if share <= 0 else np.inf if share >= 1 else normal.inv_cdf(share)

        for b in batches:
            lows, sizes = b["first"].to_numpy() / total, b["n"].to_numpy() / total
            yield pd.DataFrame({
                "level": b["level"], "low": [score(x) for x in lows], "mid": [score(x) for x in lows + sizes / 2],
                "high": [score(x) for x in (b["first"] + b["n"]).to_numpy() / total],
            })

    path = scratch_path(spark, "category")
    placed.mapInPandas(scores, "level string, low double, mid double, high double").write.parquet(path)
    return path


def _score_cell(score: Column) -> Column:
    """Scores in cells of a thousandth, the ends open."""
    return F.floor(F.greatest(F.least(score, F.lit(7.0)), F.lit(-7.0)) * 1000).cast("int")


def _levels_at(df: DataFrame, score: str, path: str, output: str) -> DataFrame:
    """Add the value whose interval holds the score: the intervals tile the line, cells bring them together."""
    table = df.sparkSession.read.parquet(path).select("level", "low", "high")
    cells = table.select("level", "low", "high", F.explode(F.sequence(_score_cell(F.col("low")), _score_cell(F.col("high")))).alias("__cell"))
    met = df.withColumn("__cell", _score_cell(F.col(score))).join(cells, "__cell")
    return met.filter((F.col("low") <= F.col(score)) & (F.col(score) < F.col("high"))).withColumnRenamed("level", output).drop("__cell", "low", "high")


def _to_scores(df: DataFrame, columns: Sequence[str], knots: dict, levels: dict, wide: dict[str, str]) -> DataFrame:
    """Normal scores z0, z1, ...; a missing cell scores 0."""
    position = {c: i for i, c in enumerate(columns)}
    shown = [
        (as_column(c).cast("double") if c in knots else as_column(c).cast("string")).alias(f"x{i}") for c, i in position.items()
    ]
    numbers = df.select(*shown)
    for c, i in position.items():
        if c in knots:
            continue
        if c in wide:
            table = df.sparkSession.read.parquet(wide[c]).select(F.col("level").alias(f"x{i}"), F.col("mid").alias(f"m{i}"))
            numbers = lookup_join(numbers, table, [f"x{i}"])
        else:
            table = df.sparkSession.createDataFrame(list(zip(levels[c][0], levels[c][2], strict=True)), f"x{i} string, m{i} double")
            numbers = numbers.join(F.broadcast(table), f"x{i}", "left")  # at most MAX_CATEGORIES rows
        numbers = numbers.drop(f"x{i}").withColumnRenamed(f"m{i}", f"x{i}")
    tables = {}
    for c in knots:
        grouped: dict[float, list[float]] = {}
        for v, s in zip(*knots[c], strict=True):
            grouped.setdefault(v, []).append(s)
        x = sorted(grouped)
        tables[f"x{position[c]}"] = (x, [sum(grouped[v]) / len(grouped[v]) for v in x])
    scored = with_interpolation(numbers, tables, "s") if tables else numbers
    return scored.select(
        *[F.coalesce(F.col(f"x{i}s" if c in knots else f"x{i}"), F.lit(0.0)).alias(f"z{i}") for c, i in position.items()]
    )


def _factor(matrix: np.ndarray) -> np.ndarray:
    """Cholesky factor; undefined correlations (constant columns) count as 0.

    Rounding removes the last digits, which depend on the order of summation."""
    matrix = np.round(np.where(np.isnan(matrix), 0.0, matrix), 9)
    np.fill_diagonal(matrix, 1.0)
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    fixed = vectors @ np.diag(np.maximum(values, 1e-8)) @ vectors.T
    scale = np.sqrt(np.diag(fixed))
    return np.linalg.cholesky(fixed / np.outer(scale, scale))


def sample_copula(spark: SparkSession, spec: CopulaSpec, n: int = SYNTHETIC_ROWS, seed: int = 42) -> DataFrame:
    """n synthetic rows. Each row depends only on the seed and its number."""
    row = F.col("id")
    ids = spark.range(n)
    draws = ids.select(row, F.array(*[standard_normal(f"{seed}.{i}", row) for i in range(len(spec.columns))]).alias("g"))
    scored = draws.select(
        row,
        *[
            _dot(weights[: i + 1]).alias(f"z{i}")
            for i, weights in enumerate(spec.root)
        ],
    )
    position = {c: f"z{i}" for i, c in enumerate(spec.columns)}
    tables = {position[c]: (spec.knots[c][1], spec.knots[c][0]) for c in spec.knots}
    mapped = with_interpolation(scored, tables, "v") if tables else scored
    borders = {position[c]: spec.levels[c][1] for c in spec.levels}
    mapped = with_steps(mapped, borders, "v") if borders else mapped
    for c, path in spec.wide.items():
        mapped = _levels_at(mapped, position[c], path, f"{position[c]}v")
    out = []
    for i, c in enumerate(spec.columns):
        value, kind = F.col(f"z{i}v"), spec.types[c]
        if c in spec.levels:
            value = F.element_at(F.array(*[F.lit(v) for v in spec.levels[c][0]]), value + 1)
        elif kind in ("int", "bigint", "smallint", "tinyint"):
            value = F.round(value)
        value = value.cast(kind)
        if spec.null_share[c] > 0:
            value = F.when(uniform(f"{seed}null{i}", row) >= spec.null_share[c], value)
        out.append(value.alias(c))
    return mapped.select(*out)


def _dot(weights: Sequence[float]) -> Column:
    """Product of the drawn vector g with a row of weights, as one fold whatever its length."""
    pairs = F.zip_with(F.col("g"), F.array(*[F.lit(float(w)) for w in weights]), lambda a, w: F.coalesce(a * w, F.lit(0.0)))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def append_synthetic(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Real rows followed by synthetic ones, told apart by is_synthetic; columns matched by name."""
    return real.withColumn("is_synthetic", F.lit(False)).unionByName(
        synthetic.withColumn("is_synthetic", F.lit(True)), allowMissingColumns=True
    )
