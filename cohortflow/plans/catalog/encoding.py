"""Outlier limits, power transform, scaling and the fitted preprocessing."""

from pyspark.sql import functions as F

from cohortflow.functions.columns import SHAPED_COLUMNS
from cohortflow.operators import preprocess as P
from cohortflow.plans import stand_ins as S
from cohortflow.plans.catalog.profiling import LINE_NUMBERS, rounded_all
from cohortflow.plans.catalog.registry import query
from cohortflow.plans.stand_ins import read, sql_with
from cohortflow.sources.scratch import materialize


def _bounds_sql(column, table):
    return f"""
SELECT '{column}' AS column_name, CASE WHEN abs(coalesce(skew, 0)) > 0.5e0 THEN 'iqr' ELSE 'zscore' END AS method,
       CASE WHEN abs(coalesce(skew, 0)) > 0.5e0 THEN q1 - 1.5e0 * (q3 - q1) ELSE m - 3 * sd END AS lower,
       CASE WHEN abs(coalesce(skew, 0)) > 0.5e0 THEN q3 + 1.5e0 * (q3 - q1) ELSE m + 3 * sd END AS upper
FROM (SELECT avg(x) AS m, stddev_samp(x) AS sd, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3,
             sum(pow(x - mm, 3)) / count(*) / pow(sum(pow(x - mm, 2)) / count(*), 1.5e0) AS skew
      FROM (SELECT coalesce(CAST({column} AS DOUBLE), 0) AS x, avg(coalesce(CAST({column} AS DOUBLE), 0)) OVER () AS mm FROM {table}))"""


_COHORT_BOUNDS = " UNION ALL ".join(_bounds_sql(c, "cohort") for c in SHAPED_COLUMNS)


def shaped_input(spark, sf_dir):
    """The cleaned cohort, stored because fitting reads it several times."""
    return materialize(P.PreprocessSpec().clean(S.cohort(spark, sf_dir), drop_rows=False), "cleaned")


@query(
    "adaptive_outlier_bounds",
    sql_with(f"SELECT column_name, method, round(lower, 5) AS lower, round(upper, 5) AS upper FROM ({_COHORT_BOUNDS})"),
)
def adaptive_outlier_bounds(spark, sf_dir):
    return rounded_all(P.bounds_table(spark, P.fit_outlier_bounds(shaped_input(spark, sf_dir), SHAPED_COLUMNS)), 5)


def _winsorised(df, key, column):
    return P.clip_columns(df.select(key, column), P.fit_outlier_bounds(df, [column])).select(key, F.round(column, 5).alias(column))


def _winsor_sql(table, key, column):
    return f"""
WITH bounds AS MATERIALIZED ({_bounds_sql(column, table)})
SELECT {key}, round(least(greatest({column}, lower), upper), 5) AS {column} FROM {table}, bounds"""


@query("winsorise_iqr", _winsor_sql("events", "event_id", "value"))
def winsorise_iqr(spark, sf_dir):
    return _winsorised(read(spark, sf_dir, "events"), "event_id", "value")


@query("winsorise_zscore", _winsor_sql("orders", "o_orderkey", "o_totalprice"))
def winsorise_zscore(spark, sf_dir):
    return _winsorised(read(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice")


def _yj_sql(x, lam):
    return f"""CASE WHEN {x} >= 0 THEN CASE WHEN abs({lam}) < 1e-12 THEN ln(1 + {x}) ELSE (pow(1 + {x}, {lam}) - 1) / {lam} END
     ELSE CASE WHEN abs(2 - {lam}) < 1e-12 THEN -ln(1 - {x}) ELSE -(pow(1 - {x}, 2 - {lam}) - 1) / (2 - {lam}) END END"""


def _likelihood_sql(source, grid):
    """Log-likelihood per lambda of `grid` (column lam) for the column x of `source`."""
    return f"""
SELECT lam, -count(*) / 2.0e0 * ln(var_pop(y)) + (lam - 1) * sum(sign(x) * ln(1 + abs(x))) AS ll
FROM (SELECT lam, x, {_yj_sql("x", "lam")} AS y FROM {source} CROSS JOIN {grid}) GROUP BY lam"""


# account balances have both signs, event values are positive and skewed
_POWER_INPUTS = {"value": ("events", "value"), "acctbal": ("customer", "c_acctbal / 1000.0e0")}
_COARSE = "coarse AS (SELECT round(-2 + 0.1e0 * i, 3) AS lam FROM range(41) AS r(i))"


def _power_inputs(spark, sf_dir):
    return {
        "value": read(spark, sf_dir, "events").select("value"),
        "acctbal": read(spark, sf_dir, "customer").select((F.col("c_acctbal") / 1000.0).alias("acctbal")),
    }


def _with_sources(*more):
    sources = [f"{c}_src AS MATERIALIZED (SELECT {e} AS x FROM {t})" for c, (t, e) in _POWER_INPUTS.items()]
    return "WITH " + ", ".join([*sources, _COARSE, *more])


@query(
    "yeo_johnson_grid",
    _with_sources()
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, lam, round(ll, 3) AS loglik FROM ({_likelihood_sql(f'{c}_src', 'coarse')})" for c in _POWER_INPUTS
    ),
)
def yeo_johnson_grid(spark, sf_dir):
    out = None
    for c, df in _power_inputs(spark, sf_dir).items():
        middle = df.agg(F.avg(c)).first()[0]
        part = P.power_likelihood(df, [c], {c: P.COARSE_GRID}, {c: middle})
        out = part if out is None else out.unionByName(part)
    return out.withColumn("loglik", F.round("loglik", 3))


def _best_lambda(c):
    return [
        f"{c}_first AS MATERIALIZED (SELECT lam AS best FROM ({_likelihood_sql(f'{c}_src', 'coarse')}) ORDER BY ll DESC, lam LIMIT 1)",
        f"{c}_fine AS MATERIALIZED (SELECT round(best - 0.1e0 + 0.005e0 * i, 4) AS lam FROM {c}_first, range(41) AS r(i))",
        f"{c}_best AS MATERIALIZED (SELECT lam FROM ({_likelihood_sql(f'{c}_src', f'{c}_fine')}) ORDER BY ll DESC, lam LIMIT 1)",
    ]


def _fitted_lambdas(spark, sf_dir):
    out = {}
    for c, df in _power_inputs(spark, sf_dir).items():
        out |= P.fit_power(df, [c], {c: df.agg(F.avg(c)).first()[0]})
    return out


@query(
    "yeo_johnson_lambda",
    _with_sources(*_best_lambda("value"), *_best_lambda("acctbal"))
    + " SELECT 'value' AS column_name, lam FROM value_best UNION ALL SELECT 'acctbal', lam FROM acctbal_best",
)
def yeo_johnson_lambda(spark, sf_dir):
    return spark.createDataFrame(list(_fitted_lambdas(spark, sf_dir).items()), "column_name string, lam double")


@query(
    "yeo_johnson_apply",
    _with_sources(*_best_lambda("acctbal"))
    + f""" SELECT c_custkey, round({_yj_sql("x", "lam")}, 6) AS acctbal
FROM (SELECT c_custkey, c_acctbal / 1000.0e0 AS x FROM customer), acctbal_best""",
)
def yeo_johnson_apply(spark, sf_dir):
    df = read(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") / 1000.0).alias("acctbal"))
    lambdas = P.fit_power(df, ["acctbal"], {"acctbal": df.agg(F.avg("acctbal")).first()[0]})
    return P.apply_power(df, lambdas).withColumn("acctbal", F.round("acctbal", 6))


@query(
    "minmax_scale",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in LINE_NUMBERS)
    + " FROM lineitem",
)
def minmax_scale(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *LINE_NUMBERS)
    return rounded_all(P.apply_min_max(lines, P.fit_min_max(lines, LINE_NUMBERS)))


@query(
    "zscore_scale",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in LINE_NUMBERS)
    + " FROM lineitem",
)
def zscore_scale(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *LINE_NUMBERS)
    return rounded_all(P.apply_z_score(lines, P.fit_z_score(lines, LINE_NUMBERS)))


def _applied_sql():
    """Bounds, best lambda and scaling of los and avg_chart_val, then their transform."""
    steps, shown = [], []
    for c in ("los", "avg_chart_val"):
        steps += [
            f"{c}_bounds AS MATERIALIZED ({_bounds_sql(c, 'cohort')})",
            f"{c}_src AS MATERIALIZED (SELECT least(greatest(coalesce({c}, 0), lower), upper) AS x FROM cohort, {c}_bounds)",
            *_best_lambda(c),
            f"{c}_ends AS MATERIALIZED (SELECT min({_yj_sql('x', 'lam')}) AS lo, max({_yj_sql('x', 'lam')}) AS hi FROM {c}_src, {c}_best)",
        ]
        clipped = f"least(greatest(coalesce({c}, 0), (SELECT lower FROM {c}_bounds)), (SELECT upper FROM {c}_bounds))"
        value = _yj_sql(clipped, f"(SELECT lam FROM {c}_best)")
        shown.append(f"round(({value} - (SELECT lo FROM {c}_ends)) / ((SELECT hi FROM {c}_ends) - (SELECT lo FROM {c}_ends)), 5) AS {c}")
    body = f"SELECT discharge_location, hospital_expire_flag, age, {', '.join(shown)} FROM cohort"
    return sql_with(body, ", ".join([_COARSE, *steps]))


@query("preprocess_apply", _applied_sql())
def preprocess_apply(spark, sf_dir):
    cleaned = shaped_input(spark, sf_dir)
    spec = P.fit_shaping(cleaned, ("los", "avg_chart_val"))
    shaped = spec.shape(cleaned).select("discharge_location", "hospital_expire_flag", "age", "los", "avg_chart_val")
    return rounded_all(shaped, 5)
