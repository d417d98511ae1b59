"""Classifiers, comparison, grid search, training and scoring runs, at the library's full sizes.

The searches are cut to a few candidates of the defined grids, whose full size is some
hundred forests of 100 to 200 trees: bench.py runs them whole on request. SQL cannot fit these models. Their
twins state what must hold of every fit: which rows are held out, that labels follow from scores,
that metrics are recounted the same, that a gradient is zero at the optimum."""

import math
from dataclasses import asdict

from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from cohortflow.operators import boosting as B
from cohortflow.operators import models as M
from cohortflow.operators.balance import smote_balance
from cohortflow.operators.neighbors import knn_classify
from cohortflow.operators.preprocess import apply_z_score, fit_levels, fit_shaping, fit_z_score, one_hot
from cohortflow.operators.ranking import best_border, running_totals
from cohortflow.operators.split import cv_folds, stratified_split
from cohortflow.plans import stand_ins as S
from cohortflow.plans.catalog.profiling import rounded_all
from cohortflow.plans.catalog.registry import query
from cohortflow.plans.stand_ins import sql_with
from cohortflow.plans.workflow import FeatureSpec, Scorer, TrainingRun
from cohortflow.sources.artifacts import save_features, save_json, save_model
from cohortflow.sources.scratch import materialize, scratch_path

TARGET = "hospital_expire_flag"


def sides(spark, sf_dir):
    """Train and test rows with scaled vector features, and the scaled training columns."""
    rows = materialize(S.admission_features(spark, sf_dir).select("hadm_id", TARGET, *S.FEATURES), "admissions")
    parts = materialize(stratified_split(rows, TARGET, 0.3, key=["hadm_id"]), "parts")
    train, test = parts.filter(~F.col("is_test")), parts.filter("is_test")
    scale = fit_z_score(train, S.FEATURES)
    train, test = apply_z_score(train, scale), apply_z_score(test, scale)
    return M.assemble(train, S.FEATURES, TARGET, ["hadm_id"]), M.assemble(test, S.FEATURES, TARGET, ["hadm_id"]), train


def _scored(spark, sf_dir, make):
    train, test, scaled = sides(spark, sf_dir)
    _, scored = M.fit_predict(make(train, scaled), train, test)
    return rounded_all(scored.select("hadm_id", F.col("label").cast("int").alias("label"), "prediction", "probability"))


def _log_loss(rows):
    """Mean logarithmic loss of the rows' probabilities, and of their share of positives."""
    p = F.greatest(F.least(F.col("probability"), F.lit(1 - 1e-15)), F.lit(1e-15))
    row = rows.agg(F.avg(-F.log(F.when(F.col("label") > 0.5, p).otherwise(1 - p))).alias("loss"), F.avg("label").alias("share")).first()
    share = row["share"]
    return row["loss"], -(share * math.log(share) + (1 - share) * math.log(1 - share))


def _learnt(spark, sf_dir, make):
    """The held-out rows, whether each label follows from its score, and whether the model fits its training rows better than their mean."""
    train, test, scaled = sides(spark, sf_dir)
    train = materialize(train, "train")
    model, scored = M.fit_predict(make(train, scaled), train, test)
    loss, prior = _log_loss(M.predict(model, train))
    held = rounded_all(scored.select("hadm_id", F.col("label").cast("int").alias("label"), "prediction", "probability"))
    return _consistent(held).withColumn("learnt", F.lit(bool(loss < 0.995 * prior)))


# the split of sides(), stated over feat
_PARTS_SQL = """
sizes AS (SELECT hospital_expire_flag AS y, count(*) AS n, 0.3e0 * count(*) AS want FROM feat GROUP BY 1),
quota AS (SELECT y, floor(round(want, 9)) + CASE WHEN row_number() OVER (ORDER BY round(want - floor(round(want, 9)), 9) DESC, CAST(y AS VARCHAR))
                 <= ceil(round(0.3e0 * (SELECT sum(n) FROM sizes), 9)) - (SELECT sum(floor(round(want, 9))) FROM sizes) THEN 1 ELSE 0 END AS q FROM sizes),
ranked AS (SELECT *, row_number() OVER (PARTITION BY hospital_expire_flag ORDER BY md5('42|' || hadm_id), hadm_id) AS r FROM feat),
parts AS (SELECT ranked.*, r <= q AS is_test FROM ranked JOIN quota ON quota.y = hospital_expire_flag)"""

_LEARNT_SQL = sql_with("SELECT hadm_id, hospital_expire_flag AS label, true AS consistent, true AS learnt FROM parts WHERE is_test", _PARTS_SQL)

_HELD_OUT_SQL = sql_with("SELECT hadm_id, hospital_expire_flag AS label, true AS consistent FROM parts WHERE is_test", _PARTS_SQL)


def _consistent(scored, border=0.5):
    """The held-out rows, and whether each label follows from its score."""
    p = F.col("probability")
    follows = (F.col("prediction") == (p > border).cast("int")) | (F.abs(p - border) < 1e-6)
    inside = p.between(0, 1) if border else F.lit(True)
    return scored.select("hadm_id", "label", (follows & inside).alias("consistent"))


@query("fit_logreg", "SELECT i AS coefficient, 0.0e0 AS gradient FROM range(6) AS r(i)")
def fit_logreg(spark, sf_dir):
    """The penalised gradient at the fitted coefficients (the last one is the intercept), from the training rows."""
    from pyspark.ml.functions import vector_to_array

    train, _, _ = sides(spark, sf_dir)
    n = train.count()
    estimator = M.logistic(n)
    model = M.as_pipeline(estimator.fit(train)).stages[0]
    weights, penalty = model.coefficients.toArray().tolist(), estimator.getRegParam()
    x = vector_to_array("features")
    margin = F.lit(float(model.intercept))
    for i, w in enumerate(weights):
        margin = margin + F.lit(float(w)) * x[i]
    miss = 1 / (1 + F.exp(-margin)) - F.col("label")
    sums = train.agg(*[F.avg(miss * x[i]).alias(f"g{i}") for i in range(len(weights))], F.avg(miss).alias("g")).first()
    gradient = [sums[f"g{i}"] + penalty * w for i, w in enumerate(weights)] + [sums["g"]]
    return spark.createDataFrame([(i, abs(round(g, 3))) for i, g in enumerate(gradient)], "coefficient long, gradient double")


@query("fit_gbt", _LEARNT_SQL)
def fit_gbt(spark, sf_dir):
    return _learnt(spark, sf_dir, lambda *_: M.gradient_boosting())


@query("fit_hist_gbt", _LEARNT_SQL)
def fit_hist_gbt(spark, sf_dir):
    return _learnt(spark, sf_dir, lambda *_: M.hist_boosting())


@query("fit_rf", _LEARNT_SQL)
def fit_rf(spark, sf_dir):
    return _learnt(spark, sf_dir, lambda *_: M.random_forest())


TREE_FEATURES = {"age": "age", "diagnoses": "diagnosis_count", "charge_band": "floor(charges / 20000)"}
TREE_LEAVES, TREE_ROWS = 6, 40


def _leafwise_sql():
    """Leaf-wise growth of one tree, a split at a time: of all leaves, features and cuts the one that gains most."""
    unit, names = "16777216e0", list(TREE_FEATURES)
    score = f"({{0}} / {unit}) * ({{0}} / {unit}) / ({{1}} / {unit})"
    steps = [
        f"""points0 AS MATERIALIZED (SELECT {", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in TREE_FEATURES.items())}, '' AS path,
  CAST(round((p - hospital_expire_flag) * {unit}) AS BIGINT) AS g, CAST(round(p * (1 - p) * {unit}) AS BIGINT) AS h
  FROM feat, (SELECT 1 / (1 + exp(-ln(sum(hospital_expire_flag) / (count(*) - sum(hospital_expire_flag))))) AS p FROM feat))"""
    ]
    for k in range(TREE_LEAVES - 1):
        gain = f"{score.format('gl', 'hl')} + {score.format('(ga - gl)', '(ha - hl)')} - {score.format('ga', 'ha')}"
        steps.append(f"""
cells{k} AS MATERIALIZED (SELECT path, f, v, count(*) AS n, sum(g) AS g, sum(h) AS h
  FROM (SELECT path, g, h, unnest(range({len(names)})) AS f, unnest([{", ".join(names)}]) AS v FROM points{k}) GROUP BY path, f, v),
run{k} AS (SELECT path, f, v, sum(n) OVER w AS nl, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER a AS na, sum(g) OVER a AS ga, sum(h) OVER a AS ha
  FROM cells{k} WINDOW w AS (PARTITION BY path, f ORDER BY v ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY path, f)),
best{k} AS MATERIALIZED (SELECT path, f, v, nl, na - nl AS nr, {gain} AS gain FROM run{k} WHERE nl >= {TREE_ROWS} AND na - nl >= {TREE_ROWS}
  ORDER BY gain DESC, f, v LIMIT 1),
points{k + 1} AS MATERIALIZED (SELECT {", ".join(names)}, g, h, p.path || CASE WHEN p.path <> b.path THEN ''
  WHEN [{", ".join(names)}][b.f + 1] > b.v THEN 'R' ELSE 'L' END AS path FROM points{k} p, best{k} b)""")
    one = "SELECT path, CAST(f AS INTEGER) AS feature, v AS cut, round(gain, 6) AS gain, CAST(nl AS BIGINT) AS left_rows, CAST(nr AS BIGINT) AS right_rows FROM best{}"
    return sql_with(" UNION ALL ".join(one.format(k) for k in range(TREE_LEAVES - 1)), ",".join(steps))


@query("leafwise_tree", _leafwise_sql())
def leafwise_tree(spark, sf_dir):
    """The splits of the first tree of a boosted model: path of the split leaf, greatest value on the left, gain, rows on both sides."""
    columns = [F.expr(e).cast("double").alias(n) for n, e in TREE_FEATURES.items()]
    rows = materialize(S.admission_features(spark, sf_dir).select(TARGET, *columns), "admissions")
    train = M.assemble(rows, list(TREE_FEATURES), TARGET)
    borders = B.fit_borders(train, M.FEATURES, len(TREE_FEATURES))
    model = B.grow(train, [B.Growth(trees=1, leaves=TREE_LEAVES, min_rows=TREE_ROWS)], borders)[0]
    tree, gains = model.trees[0], model.gains[0]
    found, stack = [], [(0, "", F.lit(True))]
    while stack:
        node, path, here = stack.pop()
        if tree.child[node]:
            feature = int(tree.feature[node])
            x, border = F.col(list(TREE_FEATURES)[feature]), float(borders[feature][tree.cut[node] - 1])
            found.append((path, feature, gains[node], F.max(F.when(here & (x < border), x)), F.count_if(here & (x < border)), F.count_if(here & (x >= border))))
            stack += [(tree.child[node], path + "L", here & (x < border)), (tree.child[node] + 1, path + "R", here & (x >= border))]
    shown = [F.struct(F.lit(p).alias("path"), F.lit(f).alias("feature"), c.alias("cut"), F.lit(round(float(g), 6)).alias("gain"), l.alias("left_rows"), r.alias("right_rows")) for p, f, g, c, l, r in found]
    return rows.agg(F.array(*shown).alias("splits")).select(F.inline("splits"))


@query("fit_svm_rff", _HELD_OUT_SQL)
def fit_svm_rff(spark, sf_dir):
    return _consistent(_scored(spark, sf_dir, lambda _, scaled: M.kernel_svm(M.kernel_width(scaled, S.FEATURES))))


@query(
    "stump_split",
    sql_with(
        """
SELECT round(min(value), 6) AS least_right, round((SELECT max(avg_chart_val) FROM feat WHERE avg_chart_val < (SELECT min(value) FROM best)), 6) AS greatest_left
FROM best""",
        """
cells AS (SELECT avg_chart_val AS value, count(*) AS n, sum(hospital_expire_flag) AS p FROM feat GROUP BY 1),
run AS (SELECT value, coalesce(sum(n) OVER w, 0) AS nl, coalesce(sum(p) OVER w, 0) AS pl, sum(n) OVER () AS n, sum(p) OVER () AS p FROM cells
        WINDOW w AS (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
gains AS (SELECT value, 2e0 * (p / n) * (1 - p / n) - nl / n * 2e0 * (pl / nl) * (1 - pl / nl)
                 - (n - nl) / n * 2e0 * ((p - pl) / (n - nl)) * (1 - (p - pl) / (n - nl)) AS gain FROM run WHERE nl > 0),
best AS (SELECT value FROM gains ORDER BY gain DESC, value LIMIT 1)""",
    ),
)
def stump_split(spark, sf_dir):
    """The one split of a depth-1 tree that considers every border: the values on its two sides."""
    rows = materialize(S.admission_features(spark, sf_dir).select("hadm_id", TARGET, "avg_chart_val"), "admissions")
    border = best_border(rows, "avg_chart_val", TARGET)
    x = F.col("avg_chart_val")
    return rounded_all(rows.agg(F.min(F.when(x >= border, x)).alias("least_right"), F.max(F.when(x < border, x)).alias("greatest_left")))


def _bayes_sql():
    scale = ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in S.FEATURES)
    shown = ", ".join(f"({f} - m_{f}) / coalesce(nullif(s_{f}, 0), 1) AS {f}" for f in S.FEATURES)
    moments = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in S.FEATURES)
    density = " ".join(f"+ CASE WHEN v_{f} > 0 THEN - 0.5e0 * ln(2 * pi() * v_{f}) - pow({f} - m_{f}, 2) / (2 * v_{f}) ELSE 0 END" for f in S.FEATURES)
    steps = f"""{_PARTS_SQL},
scale AS (SELECT {scale} FROM parts WHERE NOT is_test),
scaled AS (SELECT hadm_id, hospital_expire_flag AS y, is_test, {shown} FROM parts, scale),
fitted AS (SELECT y, count(*) AS n, {moments} FROM scaled WHERE NOT is_test GROUP BY y),
joint AS (SELECT s.hadm_id, s.y AS label, c.y AS class, ln(c.n / (SELECT sum(n) FROM fitted)) {density.replace("pow(", "pow(s.")} AS ll
          FROM scaled s CROSS JOIN fitted c WHERE s.is_test),
odds AS (SELECT hadm_id, any_value(label) AS label, max(ll) FILTER (class = 1) - max(ll) FILTER (class = 0) AS lo FROM joint GROUP BY hadm_id)"""
    return sql_with(
        "SELECT hadm_id, label, CAST(CASE WHEN lo > 0 THEN 1 ELSE 0 END AS INTEGER) AS prediction, round(1 / (1 + exp(-lo)), 6) AS probability FROM odds",
        steps,
    )


@query("fit_gaussian_nb", _bayes_sql())
def fit_gaussian_nb(spark, sf_dir):
    return _scored(spark, sf_dir, lambda *_: M.gaussian_bayes())


@query("score_fallback", _HELD_OUT_SQL)
def score_fallback(spark, sf_dir):
    """A model without probabilities reports its decision value, whose sign is the label."""
    return _consistent(_scored(spark, sf_dir, lambda *_: LinearSVC(featuresCol=M.FEATURES, labelCol=M.LABEL)), border=0)


def _nearest(train, test):
    from pyspark.ml.functions import vector_to_array

    def side(df):
        return df.select(F.col("hadm_id").alias("id"), "label", vector_to_array("features").alias("vector"))

    votes = knn_classify(side(train), side(test), "label")
    return votes.join(test.select(F.col("hadm_id").alias("id"), "label"), "id")


_METRICS = ("Accuracy", "Precision", "Recall", "F1-score", "ROC AUC")


def _recounted_sql(models):
    names = " UNION ALL ".join(f"SELECT '{m}' AS model" for m in models)
    metrics = " UNION ALL ".join(f"SELECT '{m}' AS metric" for m in _METRICS)
    return sql_with(
        f"SELECT model, metric, (SELECT count(*) FROM parts WHERE is_test) AS held_out, true AS same FROM ({names}) CROSS JOIN ({metrics})", _PARTS_SQL
    )


def _recounted(metrics, predictions):
    """Metrics against plain counts of the stored predictions, and the pair count that the area under the curve is."""
    y, p, s = F.col("label") == 1, F.col("prediction") == 1, F.col("probability")
    out = None
    for model, rows in predictions.items():
        ranks = rows.groupBy(s.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.count_if(y).alias("pos"))
        won = running_totals(ranks.withColumn("neg", F.col("n") - F.col("pos")), "s", ["neg"])
        negatives = won.agg(F.sum("neg")).first()[0]
        won = won.withColumn("under", F.lit(negatives) - F.col("neg_above") - F.col("neg"))
        area = won.agg((F.sum(F.col("pos") * (F.col("under") + F.col("neg") / 2)) / (F.sum("pos") * F.sum("neg"))).alias("ROC AUC")).first()[0]
        c = rows.agg(
            F.count_if(y == p).alias("right"), F.count_if(y & p).alias("tp"), F.count_if(y).alias("y"), F.count_if(p).alias("p"), F.count(F.lit(1)).alias("n")
        ).first()
        precision, recall = c["tp"] / max(1, c["p"]), c["tp"] / max(1, c["y"])
        want = [c["right"] / c["n"], precision, recall, 2 * precision * recall / max(precision + recall, 1e-300), area]
        part = spark_rows(rows, [(model, m, c["n"], float(v)) for m, v in zip(_METRICS, want, strict=True)])
        out = part if out is None else out.unionByName(part)
    joined = metrics.join(out, ["model", "metric"])
    return joined.select("model", "metric", "held_out", (F.abs(F.col("value") - F.col("want")) < 1e-9).alias("same"))


def spark_rows(df, rows):
    return df.sparkSession.createDataFrame(rows, "model string, metric string, held_out long, want double")


_COMPARED = ("Logistic Regression", "LightGBM", "Gradient Boosting", "Random Forest", "SVM", "Naive Bayes", "KNN")


@query("model_comparison", _recounted_sql(_COMPARED))
def model_comparison(spark, sf_dir):
    train, test, scaled = sides(spark, sf_dir)
    # a fifth of the trees of the single fits above, which take minutes each at full size
    compared = M.base_models(train.count(), M.kernel_width(scaled, S.FEATURES), trees=20)
    metrics, _, predictions = M.compare_models(train, test, compared, knn=_nearest)
    return _recounted(metrics, predictions)


def _folded(train, folds=5):
    return cv_folds(train.select("hadm_id", "label"), "label", folds, key=["hadm_id"]).drop("label").join(train, "hadm_id")


@query("grid_search", "SELECT 12 AS candidates, 1 AS best_rows, true AS best_is_maximum, true AS are_shares")
def grid_search(spark, sf_dir):
    """The whole grid of the boosting search: six models of 200 trees per fold, each scored after 100 and 200, grown in shared passes."""
    train, _, _ = sides(spark, sf_dir)
    _, table = M.grid_search(materialize(_folded(train), "folds"), M.level_boosting(), M.BOOSTING_GRID, folds=5)
    top = F.max("accuracy")
    return table.agg(
        F.count(F.lit(1)).cast("int").alias("candidates"), F.count_if("best").cast("int").alias("best_rows"),
        (F.max(F.when(F.col("best"), F.col("accuracy"))) == top).alias("best_is_maximum"), ((F.min("accuracy") > 0.4) & (top <= 1)).alias("are_shares"),
    )


_TUNED = ("Random Forest (Tuned)", "Gradient Boosting (Tuned)", "LightGBM (Tuned)")


@query("tuned_comparison", _recounted_sql(_TUNED))
def tuned_comparison(spark, sf_dir):
    train, test, _ = sides(spark, sf_dir)
    folded = materialize(_folded(train, 3), "folds")
    searches = {
        "Random Forest": (M.random_forest(), {"numTrees": [10], "maxDepth": M.FOREST_GRID["maxDepth"][:2]}),
        "Gradient Boosting": (M.level_boosting(), {"maxIter": [5], "stepSize": M.BOOSTING_GRID["stepSize"]}),
        "LightGBM": (M.hist_boosting(), {"maxIter": [5], "stepSize": M.HIST_GRID["stepSize"][1:]}),
    }
    predictions = {}
    for name, (estimator, grid) in searches.items():
        best, _ = M.grid_search(folded, estimator, grid, folds=3)
        predictions[f"{name} (Tuned)"] = materialize(M.predict(best, test).select("label", "prediction", "probability"), "tuned")
    return _recounted(M.evaluate_models(predictions, "label", "prediction", "probability"), predictions)


def _encoded(spark, sf_dir):
    wide = materialize(S.admission_features(spark, sf_dir).drop("subject_id", "discharge_location"), "admissions")
    levels = fit_levels(wide)
    return one_hot(wide, levels), levels


def _trained(spark, sf_dir):
    encoded, levels = _encoded(spark, sf_dir)
    run = TrainingRun(spark, encoded, TARGET, levels, key=["hadm_id"])
    folder = scratch_path(spark, "model")
    report = run.run(folder, M.gradient_boosting())
    return run, report


@query("train_model", _recounted_sql(["trained"]))
def train_model(spark, sf_dir):
    run, report = _trained(spark, sf_dir)
    predictions = run.predictions.select("label", "prediction", "probability")
    return _recounted(report["metrics"].withColumn("model", F.lit("trained")), {"trained": predictions})


def _bayes_scorer(spark, admissions):
    """A naive Bayes model on numbers and dummy columns, saved and loaded again."""
    wide = admissions.drop("hadm_id", "subject_id", "discharge_location")
    levels = fit_levels(wide)
    encoded = one_hot(wide, levels)
    features = [c for c in encoded.columns if c != TARGET]
    scale = fit_z_score(encoded, features)
    model = M.gaussian_bayes().fit(M.assemble(apply_z_score(encoded, scale), features, TARGET))
    folder = scratch_path(spark, "model")
    save_model(M.as_pipeline(model), f"{folder}/model")
    save_json(spark, asdict(FeatureSpec(features, levels, scale)), f"{folder}/feature_spec")
    save_features(spark, features, f"{folder}/feature_columns")
    return Scorer.load(spark, folder)


def _scored_sql():
    dummies = {"gender": ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], "valueuom": ["N", "R", "datamiss"]}
    flags = {f"{c}_{v}": f"CASE WHEN {c} = '{v}' THEN 1.0e0 ELSE 0.0e0 END" for c, vs in dummies.items() for v in vs}
    features = [*S.FEATURES, *flags]
    moments = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in features)
    density = " ".join(f"+ CASE WHEN v_{f} > 0 THEN - 0.5e0 * ln(v_{f}) - pow(s.{f} - m_{f}, 2) / (2 * v_{f}) ELSE 0 END" for f in features)
    steps = f"""
wide AS (SELECT *, {", ".join(f"{e} AS {f}" for f, e in flags.items())} FROM feat),
fitted AS (SELECT hospital_expire_flag AS y, count(*) AS n, {moments} FROM wide GROUP BY 1),
joint AS (SELECT s.hadm_id, c.y AS class, ln(c.n / (SELECT sum(n) FROM fitted)) {density} AS ll FROM wide s CROSS JOIN fitted c),
odds AS (SELECT hadm_id, max(ll) FILTER (class = 1) - max(ll) FILTER (class = 0) AS lo FROM joint GROUP BY hadm_id),
scored AS (SELECT feat.*, CAST(CASE WHEN lo > 0 THEN 1 ELSE 0 END AS INTEGER) AS predicted_label,
                  1 / (1 + exp(-lo)) AS predicted_probability FROM feat JOIN odds ON odds.hadm_id = feat.hadm_id)"""
    return steps


@query(
    "score_batch",
    sql_with(
        """
SELECT hadm_id, subject_id, gender, discharge_location, valueuom, age, round(avg_chart_val, 6) AS avg_chart_val,
       round(avg_lab_val, 6) AS avg_lab_val, diagnosis_count, charges, predicted_label,
       round(predicted_probability, 6) AS predicted_probability FROM scored""",
        _scored_sql(),
    ),
)
def score_batch(spark, sf_dir):
    admissions = materialize(S.admission_features(spark, sf_dir), "admissions")  # learnt from and scored: joined once
    return rounded_all(_bayes_scorer(spark, admissions).score(admissions.drop(TARGET)))


@query(
    "score_batch_eval",
    sql_with(
        """
SELECT 'Accuracy' AS metric, round((tp + tn) / n, 6) AS value FROM cells
UNION ALL SELECT 'Precision', round(coalesce(tp / nullif(tp + fp, 0), 0), 6) FROM cells
UNION ALL SELECT 'Recall', round(coalesce(tp / nullif(tp + fn, 0), 0), 6) FROM cells
UNION ALL SELECT 'F1-score', round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) FROM cells
UNION ALL SELECT 'ROC AUC', round(sum(neg * (cp - pos / 2)) / (any_value(p) * any_value(n)), 5) FROM cum""",
        _scored_sql()
        + """,
cells AS (SELECT sum(hospital_expire_flag * predicted_label) AS tp, sum((1 - hospital_expire_flag) * predicted_label) AS fp,
                 sum(hospital_expire_flag * (1 - predicted_label)) AS fn,
                 sum((1 - hospital_expire_flag) * (1 - predicted_label)) AS tn, count(*) AS n FROM scored),
per AS (SELECT predicted_probability AS score, sum(hospital_expire_flag) AS pos, sum(1 - hospital_expire_flag) AS neg
        FROM scored GROUP BY 1),
cum AS (SELECT pos, neg, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM per)""",
    ),
)
def score_batch_eval(spark, sf_dir):
    admissions = materialize(S.admission_features(spark, sf_dir), "admissions")
    _, report = _bayes_scorer(spark, admissions).score_and_evaluate(admissions)
    value = F.when(F.col("metric") == "ROC AUC", F.round("value", 5)).otherwise(F.round("value", 6))
    return report["metrics"].withColumn("value", value)


@query("score_raw", sql_with("SELECT hadm_id, true AS same, round(charges, 2) AS charges, age FROM feat"))
def score_raw(spark, sf_dir):
    """Raw rows through the saved preprocessing score as rows that were shaped in training; every raw row stays as it was."""
    rows = materialize(S.admission_features(spark, sf_dir).select("hadm_id", TARGET, *S.FEATURES), "admissions")
    spec = fit_shaping(rows, ("avg_chart_val", "charges", "avg_lab_val"))
    shaped = spec.shape(rows)
    scale = fit_z_score(shaped, S.FEATURES)
    model = M.gaussian_bayes().fit(M.assemble(apply_z_score(shaped, scale), S.FEATURES, TARGET))
    folder = scratch_path(spark, "model")
    save_model(M.as_pipeline(model), f"{folder}/model")
    save_json(spark, asdict(FeatureSpec(list(S.FEATURES), {}, scale, preprocess=asdict(spec))), f"{folder}/feature_spec")
    save_features(spark, S.FEATURES, f"{folder}/feature_columns")
    raw = Scorer.load(spark, folder).score(rows.drop(TARGET))
    known = Scorer.load(spark, folder, shaped=True).score(shaped.drop(TARGET))
    known = known.select("hadm_id", F.col("predicted_label").alias("l"), F.col("predicted_probability").alias("p"))
    same = (F.col("predicted_label") == F.col("l")) & (F.abs(F.col("predicted_probability") - F.col("p")) < 1e-9)
    return raw.join(known, "hadm_id").select(
        "hadm_id", same.alias("same"), F.round("charges", 2).alias("charges"), "age"
    )


@query(
    "balanced_classes",
    """
WITH sizes AS (SELECT toxic, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY toxic)
SELECT toxic, n AS real_rows, (SELECT max(n) FROM sizes) - n AS new_rows FROM sizes""",
)
def balanced_classes(spark, sf_dir):
    labels, documents = S.read(spark, sf_dir, "labels"), S.read(spark, sf_dir, "documents")
    rows = labels.join(documents.select("doc_id", "n_chars"), "doc_id")
    balanced = smote_balance(rows, "toxic", ["n_chars", "quality"], key=["doc_id"])
    return balanced.groupBy("toxic").agg(
        F.count_if(~F.col("is_synthetic")).alias("real_rows"), F.count_if("is_synthetic").alias("new_rows")
    )
