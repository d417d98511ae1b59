"""Counts, distributions, summary statistics, correlations."""

from pyspark.sql import functions as F

from cohortflow.functions.columns import SHAPED_COLUMNS, fill_missing
from cohortflow.functions.expressions import AGE_EDGES, AGE_LABELS, LOS_EDGES, LOS_LABELS
from cohortflow.operators import profile, shapes
from cohortflow.operators.preprocess import clip_columns
from cohortflow.plans import stand_ins as S
from cohortflow.plans.catalog.registry import query
from cohortflow.plans.stand_ins import read, sql_with

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded_all(df, digits=6, skip=()):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes])


def _bins_sql(column, edges, labels):
    rows = ", ".join(f"({i}, '{label}', {lo}, {hi})" for i, (label, lo, hi) in enumerate(zip(labels, edges[:-1], edges[1:], strict=True)))
    return sql_with(f"""
SELECT bin_idx, label, count({column}) AS count
FROM (VALUES {rows}) AS bins(bin_idx, label, lo, hi) LEFT JOIN cohort ON {column} >= lo AND {column} < hi
GROUP BY bin_idx, label""")


@query("age_bins", _bins_sql("age", AGE_EDGES, AGE_LABELS))
def age_bins(spark, sf_dir):
    return profile.binned_counts(S.cohort(spark, sf_dir), "age", AGE_EDGES, AGE_LABELS)


@query("los_bins", _bins_sql("los", LOS_EDGES, LOS_LABELS))
def los_bins(spark, sf_dir):
    return profile.binned_counts(S.cohort(spark, sf_dir), "los", LOS_EDGES, LOS_LABELS)


@query(
    "value_counts_status",
    sql_with("""
SELECT 'discharge_location' AS column_name, discharge_location AS value, count(*) AS count FROM cohort GROUP BY 2
UNION ALL SELECT 'gender', gender, count(*) FROM cohort WHERE gender IS NOT NULL GROUP BY 2
UNION ALL SELECT 'hospital_expire_flag', CAST(hospital_expire_flag AS VARCHAR), count(*) FROM cohort GROUP BY 2"""),
)
def value_counts_status(spark, sf_dir):
    cohort = S.cohort(spark, sf_dir)
    out = None
    for c in ("discharge_location", "gender", "hospital_expire_flag"):
        part = profile.value_counts(cohort, c).select(
            F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), "count"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "class_shares",
    """
SELECT toxic, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labels GROUP BY toxic""",
)
def class_shares(spark, sf_dir):
    return rounded_all(profile.class_shares(read(spark, sf_dir, "labels"), "toxic"))


@query(
    "shape",
    sql_with("SELECT count(*) AS n_rows, 15 AS n_columns FROM cohort"),
)
def shape(spark, sf_dir):
    return profile.shape(S.cohort(spark, sf_dir))


def _describe_sql(table, texts, numbers):
    parts = []
    for c in texts:
        parts.append(f"""
SELECT '{c}' AS column_name, count({c}) AS count, count(DISTINCT {c}) AS "unique",
       (SELECT CAST({c} AS VARCHAR) FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1) AS top,
       (SELECT count(*) FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq,
       CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS p25,
       CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p75, CAST(NULL AS DOUBLE) AS max FROM {table}""")
    for c in numbers:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""
SELECT '{c}', count({c}), NULL, NULL, NULL, round(avg({x}), 4), round(stddev_samp({x}), 4), min({x}),
       round(quantile_cont({x}, 0.25), 6), round(quantile_cont({x}, 0.5), 6), round(quantile_cont({x}, 0.75), 6), max({x}) FROM {table}""")
    return " UNION ALL ".join(parts)


@query(
    "describe_all",
    _describe_sql("lineitem", ["l_returnflag", "l_linestatus", "l_shipdate"], ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LINE_NUMBERS]),
)
def describe_all(spark, sf_dir):
    out = profile.describe_all(read(spark, sf_dir, "lineitem"))
    return out.withColumns({**{c: F.round(c, 4) for c in ("mean", "std")}, **{c: F.round(c, 6) for c in ("p25", "p50", "p75")}})


def _skew_sql(column, table):
    return f"""
SELECT '{column}' AS column_name, round(sum(pow({column} - m, 3)) / count(*) / pow(sum(pow({column} - m, 2)) / count(*), 1.5e0), 6) AS skewness
FROM {table}, (SELECT avg({column}) AS m FROM {table})"""


@query("skewness_cols", " UNION ALL ".join(_skew_sql(c, "lineitem") for c in LINE_NUMBERS))
def skewness_cols(spark, sf_dir):
    return rounded_all(profile.moments(read(spark, sf_dir, "lineitem"), LINE_NUMBERS).select("column_name", "skewness"))


@query(
    "quartiles_cols",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median, "
        f"round(quantile_cont({c}, 0.75), 6) AS q3 FROM lineitem"
        for c in LINE_NUMBERS
    ),
)
def quartiles_cols(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    return rounded_all(profile.quantile_table(lines, LINE_NUMBERS, [0.25, 0.5, 0.75], ["q1", "median", "q3"]))


@query(
    "mean_std_cols",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std, "
        f"round(stddev_pop({c}), 5) AS std_pop, min({c}) AS min, max({c}) AS max FROM lineitem"
        for c in LINE_NUMBERS
    ),
)
def mean_std_cols(spark, sf_dir):
    stats = profile.moments(read(spark, sf_dir, "lineitem"), LINE_NUMBERS).drop("skewness")
    return rounded_all(stats, 5)


@query(
    "box_stats",
    " UNION ALL ".join(
        f"""
SELECT '{c}' AS column_name, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3,
       round(any_value(q1 - 1.5e0 * (q3 - q1)), 6) AS lower_fence, round(any_value(q3 + 1.5e0 * (q3 - q1)), 6) AS upper_fence,
       min({c}) FILTER ({c} BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS whisker_low,
       max({c}) FILTER ({c} BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS whisker_high,
       count(*) FILTER ({c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) AS outliers
FROM {t}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3 FROM {t})"""
        for c, t in (("value", "events"),)
    ),
)
def box_stats(spark, sf_dir):
    return rounded_all(profile.box_stats(read(spark, sf_dir, "events"), ["value"]), skip=("whisker_low", "whisker_high"))


@query(
    "histogram",
    """
WITH ends AS (SELECT min(value) AS lo, (max(value) - min(value)) / 20 AS w FROM events),
counts AS (SELECT least(CAST(floor((value - lo) / w) AS INTEGER), 19) AS bin_idx, count(*) AS n FROM events, ends GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin_idx, round(lo + i * w, 6) AS bin_start, round(lo + (i + 1) * w, 6) AS bin_end, coalesce(n, 0) AS count
FROM range(20) AS grid(i) CROSS JOIN ends LEFT JOIN counts ON counts.bin_idx = i""",
)
def histogram(spark, sf_dir):
    return rounded_all(profile.histogram(read(spark, sf_dir, "events"), "value", 20))


_NODES, _POINTS = 256, 50


@query(
    "density_curve",
    f"""
WITH ends AS (SELECT count(value) AS n, stddev_samp(value) * pow(count(value), -0.2e0) AS w, min(value) AS a, max(value) AS b FROM events),
frame AS (SELECT n, w, a - 3 * w AS lo, (b + 3 * w - (a - 3 * w)) / {_NODES - 1} AS step, (b + 3 * w - (a - 3 * w)) / {_POINTS - 1} AS stride FROM ends),
placed AS (SELECT (value - lo) / step AS p FROM events, frame WHERE value IS NOT NULL),
weights AS (SELECT node, sum(weight) AS weight FROM (
  SELECT CAST(floor(p) AS INTEGER) AS node, 1 - (p - floor(p)) AS weight FROM placed UNION ALL SELECT CAST(floor(p) AS INTEGER) + 1, p - floor(p) FROM placed) GROUP BY node)
SELECT 'value' AS column_name, round(lo + i * stride, 6) AS x,
  round(sum(weight * exp(-0.5e0 * pow((lo + i * stride - (lo + node * step)) / w, 2))) / any_value(n * w * sqrt(2 * pi())), 8) AS density
FROM weights, frame, range({_POINTS}) AS g(i) GROUP BY i, lo, stride""",
)
def density_curve(spark, sf_dir):
    found = shapes.density_curves(read(spark, sf_dir, "events"), ["value"], _POINTS, _NODES)
    return found.select("column_name", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


TARGET_FEATURES = [*SHAPED_COLUMNS, "age"]


def filled_cohort(spark, sf_dir):
    return fill_missing(S.cohort(spark, sf_dir).select(*TARGET_FEATURES, "hospital_expire_flag"))


_FILLED = "filled AS (SELECT " + ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in TARGET_FEATURES) + ", hospital_expire_flag FROM cohort)"


@query(
    "corr_with_target",
    sql_with(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, CASE WHEN stddev_pop({c}) > 0 THEN round(corr({c}, hospital_expire_flag), 6) END AS correlation FROM filled" for c in TARGET_FEATURES
        ),
        _FILLED,
    ),
)
def corr_with_target(spark, sf_dir):
    return rounded_all(profile.corr_with_target(filled_cohort(spark, sf_dir), TARGET_FEATURES, "hospital_expire_flag"))


def _pairs_sql():
    pairs = [(a, b) for i, a in enumerate(TARGET_FEATURES) for b in TARGET_FEATURES[i + 1 :]]
    # a constant column lies in the middle of a range of 1
    end = "CASE WHEN max({0}) = min({0}) THEN min({0}) - 0.5e0 ELSE min({0}) END AS lo_{0}, CASE WHEN max({0}) = min({0}) THEN 1e0 ELSE max({0}) - min({0}) END / 10 AS w_{0}"
    ends = ", ".join(end.format(c) for c in TARGET_FEATURES)
    place = "CAST(least(floor(({0} - lo_{0}) / w_{0}), 9) AS INTEGER)"
    one = "SELECT '{a}' AS feature_a, '{b}' AS feature_b, {x} AS bin_a, {y} AS bin_b, hospital_expire_flag AS label, count(*) AS count FROM filled, ends GROUP BY ALL"
    return sql_with(
        " UNION ALL ".join(one.format(a=a, b=b, x=place.format(a), y=place.format(b)) for a, b in pairs), f"{_FILLED}, ends AS (SELECT {ends} FROM filled)"
    )


@query("pair_counts", _pairs_sql())
def pair_counts(spark, sf_dir):
    return shapes.pair_counts(filled_cohort(spark, sf_dir), TARGET_FEATURES, "hospital_expire_flag")


@query(
    "top_correlated",
    sql_with(
        "SELECT feature, round(correlation, 6) AS correlation FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, CASE WHEN stddev_pop({c}) > 0 THEN corr({c}, hospital_expire_flag) END AS correlation FROM filled" for c in TARGET_FEATURES
        )
        + ") ORDER BY correlation DESC NULLS LAST, feature LIMIT 3",
        _FILLED,
    ),
)
def top_correlated(spark, sf_dir):
    return rounded_all(profile.top_correlated(filled_cohort(spark, sf_dir), TARGET_FEATURES, "hospital_expire_flag", 3))


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
        for a in LINE_NUMBERS
        for b in LINE_NUMBERS
    ),
)
def corr_matrix(spark, sf_dir):
    return rounded_all(profile.corr_matrix(read(spark, sf_dir, "lineitem"), LINE_NUMBERS))


_BOTH_STAGES = " UNION ALL ".join(
    f"""
SELECT 'value' AS column_name, '{stage}' AS stage, round(any_value(q1), 4) AS q1, round(any_value(med), 4) AS median, round(any_value(q3), 4) AS q3,
       count(*) FILTER (x < q1 - 1.5e0 * (q3 - q1) - 1e-9 OR x > q3 + 1.5e0 * (q3 - q1) + 1e-9) AS outliers,
       round(sum(pow(x - m, 3)) / count(*) / pow(sum(pow(x - m, 2)) / count(*), 1.5e0), 4) AS skewness, round(min(x), 4) AS min, round(max(x), 4) AS max
FROM {source}, (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3, avg(x) AS m FROM {source})"""
    for stage, source in (("before", "raw"), ("after", "clipped"))
)


@query(
    "before_after_clipping",
    f"""
WITH raw AS (SELECT value AS x FROM events),
q AS (SELECT quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.75) AS b FROM raw),
clipped AS (SELECT least(greatest(x, a - 1.5e0 * (b - a)), b + 1.5e0 * (b - a)) AS x FROM raw, q)
SELECT * FROM ({_BOTH_STAGES})""",
)
def before_after_clipping(spark, sf_dir):
    """Box numbers and skewness of a skewed column around clipping to its fences."""
    raw = read(spark, sf_dir, "events").select("value")
    bounds = clip_bounds(raw)
    both = profile.before_and_after(raw, clip_columns(raw, bounds), ["value"])
    shown = both.select("column_name", "stage", "q1", "median", "q3", "outliers", "skewness", "min", "max")
    return rounded_all(shown, 4)


def clip_bounds(df):
    found = profile.quantile_table(df, ["value"], [0.25, 0.75], ["q1", "q3"]).first()
    spread = 1.5 * (found["q3"] - found["q1"])
    return {"value": {"lower": found["q1"] - spread, "upper": found["q3"] + spread}}


@query(
    "profile_customer",
    """
WITH n AS (SELECT count(*) AS n FROM customer)
SELECT column_name, nulls, n AS n_rows FROM n, (
  SELECT 'c_custkey' AS column_name, count(*) - count(c_custkey) AS nulls FROM customer UNION ALL SELECT 'c_name', count(*) - count(c_name) FROM customer
  UNION ALL SELECT 'c_nationkey', count(*) - count(c_nationkey) FROM customer UNION ALL SELECT 'c_acctbal', count(*) - count(c_acctbal) FROM customer
  UNION ALL SELECT 'c_mktsegment', count(*) - count(c_mktsegment) FROM customer)""",
)
def profile_customer(spark, sf_dir):
    """The whole profile in one call; shown are its null counts and, once per numeric column and bin, that histograms add up."""
    found = profile.profile(read(spark, sf_dir, "customer"), "c_mktsegment")
    rows = found["shape"].first()["n_rows"]
    counted = {r["n"] for r in found["histograms"].groupBy("column_name").agg(F.sum("count").alias("n")).collect()}
    if counted != {rows} or found["classes"].agg(F.sum("count")).first()[0] != rows:
        raise ValueError("histograms or classes do not add up to the rows")
    return found["nulls"].withColumn("n_rows", F.lit(rows))
