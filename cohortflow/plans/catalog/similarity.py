"""Splits, folds, nearest neighbours and oversampling."""

from pyspark.sql import functions as F

from cohortflow.operators.balance import smote_rows
from cohortflow.operators.neighbors import knn_classify, knn_join, neighbor_rows
from cohortflow.operators.split import cv_folds, group_split, stratified_split
from cohortflow.operators.synth import fit_copula, sample_copula
from cohortflow.plans import stand_ins as S
from cohortflow.plans.catalog.profiling import rounded_all
from cohortflow.plans.catalog.registry import query
from cohortflow.plans.stand_ins import read, sql_with
from cohortflow.sources.scratch import materialize

WIDTH = 64

_ORDERS = "src AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders)"


def _orders(spark, sf_dir):
    return S.admissions(spark, sf_dir).select(F.col("hadm_id").alias("k"), F.col("hospital_expire_flag").alias("y"))


def _quota_sql(share, source="src"):
    return f"""
sizes AS (SELECT y, count(*) AS n, {share} * count(*) AS want FROM {source} GROUP BY y),
quota AS (SELECT y, floor(round(want, 9)) + CASE WHEN row_number() OVER (ORDER BY round(want - floor(round(want, 9)), 9) DESC, CAST(y AS VARCHAR))
                 <= ceil(round({share} * (SELECT sum(n) FROM sizes), 9)) - (SELECT sum(floor(round(want, 9))) FROM sizes) THEN 1 ELSE 0 END AS q FROM sizes)"""


_GAPS = "src AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders)"


def _orders_with_gaps(spark, sf_dir):
    return _orders(spark, sf_dir).withColumn("y", F.when(F.col("k") % 10 != 0, F.col("y")))


@query(
    "split_null_labels",
    f"""
WITH {_GAPS}, {_quota_sql("0.3e0").replace("CAST(y AS VARCHAR)", "coalesce(CAST(y AS VARCHAR), 'None')")},
ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42|' || k), k) AS r FROM src)
SELECT k, ranked.y, r <= q AS is_test FROM ranked JOIN quota ON quota.y IS NOT DISTINCT FROM ranked.y""",
)
def split_null_labels(spark, sf_dir):
    return stratified_split(_orders_with_gaps(spark, sf_dir), "y", 0.3, key=["k"])


@query(
    "cv_folds_null_labels",
    f"""
WITH {_GAPS}
SELECT k, y, CAST((row_number() OVER (PARTITION BY y ORDER BY md5('42|' || k), k) - 1) % 5 AS INTEGER) AS fold FROM src""",
)
def cv_folds_null_labels(spark, sf_dir):
    return cv_folds(_orders_with_gaps(spark, sf_dir), "y", 5, key=["k"])


@query(
    "stratified_split",
    f"""
WITH {_ORDERS}, {_quota_sql("0.3e0")},
ranked AS (SELECT k, y, row_number() OVER (PARTITION BY y ORDER BY md5('42|' || k), k) AS r FROM src)
SELECT k, ranked.y AS y, r <= q AS is_test FROM ranked JOIN quota ON quota.y = ranked.y""",
)
def split_rows(spark, sf_dir):
    return stratified_split(_orders(spark, sf_dir), "y", 0.3, key=["k"])


@query(
    "group_split",
    f"""
WITH src AS (SELECT o_custkey AS k, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS y FROM orders GROUP BY 1), {_quota_sql("0.3e0")},
ranked AS (SELECT k, y, row_number() OVER (PARTITION BY y ORDER BY md5('42|' || k), k) AS r FROM src),
side AS (SELECT k, r <= q AS is_test FROM ranked JOIN quota ON quota.y = ranked.y)
SELECT o_orderkey AS hadm_id, o_custkey AS subject_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS hospital_expire_flag, is_test
FROM orders JOIN side ON side.k = o_custkey""",
)
def split_groups(spark, sf_dir):
    rows = S.admissions(spark, sf_dir).select("hadm_id", "subject_id", "hospital_expire_flag")
    return group_split(rows, "hospital_expire_flag", "subject_id", 0.3)


@query(
    "cv_folds",
    f"""
WITH {_ORDERS}
SELECT k, y, CAST((row_number() OVER (PARTITION BY y ORDER BY md5('42|' || k), k) - 1) % 5 AS INTEGER) AS fold FROM src""",
)
def fold_rows(spark, sf_dir):
    return cv_folds(_orders(spark, sf_dir), "y", 5, key=["k"])


_VECTORS = "v AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"


def _vectors(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("vector")
    )


@query(
    "knn_neighbors",
    f"""
WITH {_VECTORS},
pairs AS (SELECT a.id, a.label, b.id AS neighbor_id, list_distance(a.vec, b.vec) AS d FROM v a JOIN v b ON a.label = b.label AND a.id <> b.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(d, 9), neighbor_id) AS r FROM pairs)
SELECT id, label, CAST(r AS INTEGER) AS rank, neighbor_id, round(d, 6) AS distance FROM ranked WHERE r <= 5""",
)
def knn_neighbors(spark, sf_dir):
    found = knn_join(_vectors(spark, sf_dir), None, 5, by="label")
    return rounded_all(neighbor_rows(found, ["id", "label"]))


@query(
    "knn_classify",
    f"""
WITH {_VECTORS},
src AS (SELECT id AS k, CASE WHEN label < 5 THEN 1 ELSE 0 END AS y, vec FROM v), {_quota_sql("0.3e0")},
ranked AS (SELECT k, y, vec, row_number() OVER (PARTITION BY y ORDER BY md5('42|' || k), k) AS r FROM src),
parts AS (SELECT k, ranked.y AS y, vec, r <= q AS is_test FROM ranked JOIN quota ON quota.y = ranked.y),
pairs AS (SELECT a.k, b.y, row_number() OVER (PARTITION BY a.k ORDER BY round(list_distance(a.vec, b.vec), 9), b.k) AS r
          FROM parts a JOIN parts b ON a.is_test AND NOT b.is_test)
SELECT k AS id, avg(y) AS probability, CAST(CASE WHEN avg(y) > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction
FROM pairs WHERE r <= 5 GROUP BY k""",
)
def knn_votes(spark, sf_dir):
    rows = _vectors(spark, sf_dir).withColumn("y", (F.col("label") < 5).cast("int"))
    sides = stratified_split(rows.select("id", "y"), "y", 0.3, key=["id"]).select("id", "is_test")
    parts = rows.join(sides, "id")
    return knn_classify(parts.filter(~F.col("is_test")), parts.filter("is_test"), "y")


_POINTS = ", ".join(f"round(b.vec[{i + 1}] + gap * (m.vec[{i + 1}] - b.vec[{i + 1}]), 6) AS e{i}" for i in range(WIDTH))


def _u(tag):
    return f"(('0x' || substr(md5('42{tag}|' || label || '|' || draw), 1, 13))::BIGINT / 4503599627370496.0e0)"


@query(
    "smote_balance",
    f"""
WITH {_VECTORS},
base AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || id), id) AS r FROM v),
sizes AS (SELECT label, count(*) AS n, (SELECT max(c) FROM (SELECT count(*) AS c FROM v GROUP BY label)) - count(*) AS need FROM v GROUP BY label),
draws AS (SELECT label, n, unnest(range(need)) AS draw FROM sizes),
drawn AS (SELECT label, draw, floor({_u("b")} * n) + 1 AS base_rank, floor({_u("n")} * least(5, n - 1)) + 1 AS neighbor_rank, {_u("g")} AS gap FROM draws),
pairs AS (SELECT a.label, a.r, b.r AS mate, row_number() OVER (PARTITION BY a.label, a.r ORDER BY round(list_distance(a.vec, b.vec), 9), b.r) AS nr
          FROM base a JOIN base b ON a.label = b.label AND a.r <> b.r)
SELECT drawn.label AS label, drawn.draw AS draw, CAST(base_rank AS BIGINT) AS base_rank, CAST(neighbor_rank AS BIGINT) AS neighbor_rank, {_POINTS}
FROM drawn JOIN pairs p ON p.label = drawn.label AND p.r = base_rank AND p.nr = neighbor_rank
     JOIN base b ON b.label = drawn.label AND b.r = base_rank JOIN base m ON m.label = drawn.label AND m.r = p.mate""",
)
def smote_new_rows(spark, sf_dir):
    features = [f"e{i}" for i in range(WIDTH)]
    wide = _vectors(spark, sf_dir).select("id", "label", *[F.col("vector")[i].alias(f) for i, f in enumerate(features)])
    return rounded_all(smote_rows(wide, "label", features, key=["id"]))


_SYNTH_TEXT, _SYNTH_NUMBERS = ("gender", "discharge_location", "valueuom"), ("hospital_expire_flag", *S.FEATURES)


@query(
    "synth_copula",
    sql_with(
        " UNION ALL ".join(
            [f"SELECT '{c}' AS column_name, 5000 AS n_rows, count(DISTINCT {c}) AS levels, true AS alike FROM feat" for c in _SYNTH_TEXT]
            + [f"SELECT '{c}', 5000, NULL, true" for c in _SYNTH_NUMBERS]
        )
    ),
)
def synth_copula(spark, sf_dir):
    """Synthetic rows against the real ones: the same categories with about the same shares, and quartiles and
    range of numbers within a twentieth of the real range."""
    real = materialize(S.admission_features(spark, sf_dir).drop("hadm_id", "subject_id"), "admissions")
    made = materialize(sample_copula(spark, fit_copula(real, real.columns)), "synthetic")
    n, n_made = real.count(), made.count()
    out = []
    for c in _SYNTH_TEXT:
        shares = real.groupBy(c).agg((F.count(F.lit(1)) / n).alias("a")).join(made.groupBy(c).agg((F.count(F.lit(1)) / n_made).alias("b")), c, "full")
        found = shares.agg(F.count("b").alias("levels"), F.max(F.abs(F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0)))).alias("off")).first()
        out.append((c, n_made, found["levels"], found["off"] < 0.05))
    numbers, probs = list(_SYNTH_NUMBERS), [0.25, 0.5, 0.75]
    # one pass for the ends of all columns and one for their quartiles
    ends = real.agg(*[e(c).alias(f"{e.__name__}{i}") for i, c in enumerate(numbers) for e in (F.min, F.max)]).first()
    quartiles = [df.select(*[F.col(c).cast("double").alias(c) for c in numbers]).approxQuantile(numbers, probs, 0.002) for df in (real, made)]
    beyond = made.agg(*[F.count_if((F.col(c) < ends[f"min{i}"] - 1e-9) | (F.col(c) > ends[f"max{i}"] + 1e-9)).alias(f"n{i}") for i, c in enumerate(numbers)]).first()
    for i, c in enumerate(numbers):
        width = max(float(ends[f"max{i}"]) - float(ends[f"min{i}"]), 1e-12)
        a, b = quartiles[0][i], quartiles[1][i]
        near = all(abs(x - y) <= 0.05 * width for x, y in zip(a, b, strict=True)) or set(a) | set(b) <= {0.0, 1.0}
        out.append((c, n_made, None, beyond[f"n{i}"] == 0 and near))
    return spark.createDataFrame(out, "column_name string, n_rows long, levels long, alike boolean")
