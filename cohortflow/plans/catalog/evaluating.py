"""Evaluation of a deterministic score: the outcome against the order value."""

from pyspark.sql import functions as F

from cohortflow.operators import evaluate as E
from cohortflow.plans.catalog.profiling import rounded_all
from cohortflow.plans.catalog.registry import query
from cohortflow.plans.stand_ins import read

_SCORED = """
WITH scored AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
                       (o_orderkey * 7919 % 1000) / 1000.0e0 AS score FROM orders),
judged AS (SELECT label, score, CASE WHEN score > 0.6e0 THEN 1 ELSE 0 END AS prediction FROM scored),
cells AS (SELECT CAST(sum(label * prediction) AS BIGINT) AS tp, CAST(sum((1 - label) * prediction) AS BIGINT) AS fp,
                 CAST(sum(label * (1 - prediction)) AS BIGINT) AS fn, CAST(sum((1 - label) * (1 - prediction)) AS BIGINT) AS tn FROM judged)
"""


def scored(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    score = (F.col("o_orderkey") * 7919 % 1000) / 1000.0
    return orders.select((F.col("o_orderstatus") == "F").cast("int").alias("label"), score.alias("score")).withColumn(
        "prediction", (F.col("score") > 0.6).cast("int")
    )


@query(
    "binary_metrics",
    _SCORED
    + """
SELECT 'Accuracy' AS metric, round((tp + tn) / (tp + fp + fn + tn), 6) AS value FROM cells
UNION ALL SELECT 'Precision', round(tp / (tp + fp), 6) FROM cells
UNION ALL SELECT 'Recall', round(tp / (tp + fn), 6) FROM cells
UNION ALL SELECT 'F1-score', round(2 * tp / (2 * tp + fp + fn), 6) FROM cells""",
)
def binary_metrics(spark, sf_dir):
    return rounded_all(E.binary_metrics(scored(spark, sf_dir), "label", "prediction"))


@query(
    "classification_report",
    _SCORED
    + """
, parts AS (SELECT tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fp + fn) AS f0, tn + fp AS s0,
                   tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS s1,
                   tp + fp + fn + tn AS n, (tp + tn) / (tp + fp + fn + tn) AS acc FROM cells)
SELECT '0' AS class, round(p0, 6) AS "precision", round(r0, 6) AS recall, round(f0, 6) AS f1_score, s0 AS support FROM parts
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM parts
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n FROM parts
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM parts
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
                 round((f0 * s0 + f1 * s1) / n, 6), n FROM parts""",
)
def classification_report(spark, sf_dir):
    return rounded_all(E.classification_report(scored(spark, sf_dir), "label", "prediction"))


@query(
    "confusion_matrix",
    _SCORED
    + """
SELECT l.v AS label, p.v AS prediction, count(judged.label) AS count
FROM (VALUES (0), (1)) AS l(v) CROSS JOIN (VALUES (0), (1)) AS p(v)
     LEFT JOIN judged ON judged.label = l.v AND judged.prediction = p.v GROUP BY l.v, p.v""",
)
def confusion_matrix(spark, sf_dir):
    return E.confusion_matrix(scored(spark, sf_dir), "label", "prediction")


_GROUPS = """
, per AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM judged GROUP BY score),
cum AS (SELECT score, pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER () AS p, sum(neg) OVER () AS n
        FROM per WINDOW w AS (ORDER BY score DESC))
"""


@query(
    "roc_points",
    _SCORED
    + _GROUPS
    + """
SELECT score AS threshold, round(cn / n, 6) AS fpr, round(cp / p, 6) AS tpr FROM cum
UNION ALL SELECT NULL, 0, 0""",
)
def roc_points(spark, sf_dir):
    return rounded_all(E.roc_points(scored(spark, sf_dir), "label", "score"), skip=("threshold",))


@query("roc_auc", _SCORED + _GROUPS + "SELECT round(sum(neg * (cp - pos / 2)) / (any_value(p) * any_value(n)), 6) AS auc FROM cum")
def roc_auc(spark, sf_dir):
    return rounded_all(E.roc_auc(scored(spark, sf_dir), "label", "score"))


@query(
    "metrics_table",
    _SCORED
    + _GROUPS
    + """
SELECT 'by score' AS model, 'Accuracy' AS metric, round((tp + tn) / (tp + fp + fn + tn), 6) AS value FROM cells
UNION ALL SELECT 'by score', 'Precision', round(tp / (tp + fp), 6) FROM cells
UNION ALL SELECT 'by score', 'Recall', round(tp / (tp + fn), 6) FROM cells
UNION ALL SELECT 'by score', 'F1-score', round(2 * tp / (2 * tp + fp + fn), 6) FROM cells
UNION ALL SELECT 'by score', 'ROC AUC', round(sum(neg * (cp - pos / 2)) / (any_value(p) * any_value(n)), 6) FROM cum""",
)
def metrics_table(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return rounded_all(E.evaluate_models({"by score": rows}, "label", "prediction", "score"))
