"""Classifier definitions, comparison and grid search on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VarianceThresholdSelector, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.expressions import as_column, positive_probability
from cohortflow.operators.boosting import LeafwiseBoosting, search
from cohortflow.operators.evaluate import evaluate_models
from cohortflow.operators.forest import DistributedForest, ForestModel
from cohortflow.sources.scratch import ensure_checkpoint_dir, materialize, spread

FEATURES, LABEL = "features", "label"
SEED = 42
MAX_DEPTH = 30  # the deepest tree that Spark allows
EVERY_LEAF = 1 << 20


def assemble(df: DataFrame, features: Sequence[str], label: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Vector column from the feature columns; the label as double."""
    out = VectorAssembler(inputCols=list(features), outputCol=FEATURES).transform(df)
    chosen = [as_column(c) for c in keep] + [F.col(FEATURES)]
    if label is not None:
        chosen.append(as_column(label).cast("double").alias(LABEL))
    return out.select(*chosen)


# ---- estimators -----------------------------------------------------------


def logistic(n_rows: int, c: float = 1.0) -> LogisticRegression:
    """Ridge-penalised fit. The per-row mean loss here needs a penalty of 1/(c*n)."""
    return LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=1000, regParam=1.0 / (c * max(n_rows, 1)), standardization=False
    )


def gradient_boosting(trees: int = 100, rate: float = 0.1, depth: int = 3, seed: int = SEED) -> GBTClassifier:
    return GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, maxIter=trees, stepSize=rate, maxDepth=depth, seed=seed)


def hist_boosting(trees: int = 100, rate: float = 0.1, leaves: int = 31, depth: int = 0, min_rows: int = 20) -> LeafwiseBoosting:
    """Leaf-wise grown trees over binned features."""
    return LeafwiseBoosting(maxIter=trees, stepSize=rate, numLeaves=leaves, maxDepth=depth, minInstancesPerNode=min_rows)


def level_boosting(trees: int = 100, rate: float = 0.1, depth: int = 3) -> LeafwiseBoosting:
    """Trees grown to a depth, whatever their number of leaves: what a search over depths tries."""
    return LeafwiseBoosting(maxIter=trees, stepSize=rate, numLeaves=EVERY_LEAF, maxDepth=depth, minInstancesPerNode=1)


def random_forest(trees: int = 100, depth: int = MAX_DEPTH, min_rows: int = 1, seed: int = SEED) -> DistributedForest:
    return DistributedForest(featuresCol=FEATURES, labelCol=LABEL, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_rows, seed=seed)


def gaussian_bayes() -> Pipeline:
    """Per-class normal densities. Constant features say nothing about the class but have no
    density, so they are left out first."""
    return Pipeline(
        stages=[
            VarianceThresholdSelector(featuresCol=FEATURES, outputCol="varying_features", varianceThreshold=0.0),
            NaiveBayes(featuresCol="varying_features", labelCol=LABEL, modelType="gaussian", smoothing=0.0),
        ]
    )


@lru_cache(maxsize=8)
def fourier_weights(seed: int, gamma: float, inputs: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """W and b, drawn once per worker."""
    draw = np.random.default_rng(seed)
    drawn = draw.normal(0.0, np.sqrt(2.0 * gamma), (inputs, width)), draw.uniform(0.0, 2.0 * np.pi, width)
    return drawn[0].astype(np.float32), drawn[1].astype(np.float32)


def fourier_features(vectors: pa.Array, seed: int, gamma: float, width: int) -> np.ndarray:
    """Rows x width in single precision, whose cosine is some ten times as fast."""
    if not len(vectors):
        return np.zeros((0, width), np.float32)
    x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype(np.float32)
    weights, shift = fourier_weights(seed, gamma, x.shape[1], width)
    out = x @ weights
    out += shift
    return np.multiply(np.cos(out, out=out), np.float32(np.sqrt(2.0 / width)), out=out)


class _FourierParams(Params):
    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label, 0 or 1", TypeConverters.toString)
    width = Param(Params._dummy(), "width", "number of random features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel exp(-gamma |x-y|^2)", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)


class FourierSVM(Estimator, _FourierParams, DefaultParamsReadable, DefaultParamsWritable):
    """Linear SVM on random Fourier features cos(Wx + b), whose inner products approximate a Gaussian kernel
    (Rahimi & Recht 2007): the mean hinge loss plus regParam / 2 times the squared weights of the scaled
    features, minimised by L-BFGS, as LinearSVC does. Each pass maps the vectors anew, so that rows are kept as they came and not
    `width` numbers each; its tasks add up loss and gradient, and only those sums reach the driver."""

    maxIter = Param(Params._dummy(), "maxIter", "iterations at most", TypeConverters.toInt)
    regParam = Param(Params._dummy(), "regParam", "penalty", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=FEATURES, labelCol=LABEL, width=128, gamma=0.1, seed=SEED, maxIter=50, regParam=1e-4):
        super().__init__()
        self._setDefault(inputCol=FEATURES, labelCol=LABEL, width=128, gamma=0.1, seed=SEED, maxIter=50, regParam=1e-4)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FourierSVMModel:
        get = self.getOrDefault
        width, seed, gamma = get(self.width), get(self.seed), get(self.gamma)
        rows = materialize(spread(df.select(vector_to_array(get(self.inputCol)).alias("x"), F.col(get(self.labelCol)).cast("double").alias("y"))), "svm_rows")

        def summed(task: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
            """Sum over all rows of what `task` finds for some of them."""

            def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total = np.zeros(size)
                for batch in batches:
                    for at in range(0, batch.num_rows, 1024):  # so many rows stay in cache
                        some = batch.slice(at, 1024)
                        total += task(fourier_features(some.column(0), seed, gamma, width), some.column(1).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["s"])

            parts = rows.mapInArrow(work, "s array<double>").select(F.posexplode("s")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
            out = np.zeros(size)
            for r in parts:
                out[r["pos"]] = r["s"]
            return out

        def moments(z: np.ndarray, y: np.ndarray) -> np.ndarray:
            return np.concatenate([[len(y)], z.sum(0, dtype=float), np.einsum("ij,ij->j", z, z, dtype=float)])

        n, *sums = summed(moments, 1 + 2 * width)
        mean, square = np.array(sums[:width]) / n, np.array(sums[width:]) / n
        deviation = np.sqrt(np.maximum(square - mean**2, 0.0) * n / max(n - 1, 1))
        scale = np.divide(1.0, deviation, out=np.zeros(width), where=deviation > 1e-9)
        penalty = get(self.regParam)

        def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
            plain, shift = (w[:-1] * scale).astype(np.float32), w[-1]

            def hinge(z: np.ndarray, y: np.ndarray) -> np.ndarray:
                sign = 2.0 * y - 1.0
                miss = 1.0 - sign * ((z @ plain).astype(float) + shift)
                pull = np.where(miss > 0, -sign, 0.0)
                return np.concatenate([[miss[miss > 0].sum()], (pull.astype(np.float32) @ z).astype(float), [pull.sum()]])

            value, *slope = summed(hinge, width + 2) / n
            gradient = np.array(slope)
            gradient[:-1] = gradient[:-1] * scale + penalty * w[:-1]
            return value + penalty / 2 * float(w[:-1] @ w[:-1]), gradient

        w = minimised(loss, np.zeros(width + 1), get(self.maxIter))
        return self._copyValues(FourierSVMModel(weights=[*(w[:-1] * scale).tolist(), float(w[-1])]))


class FourierSVMModel(Model, _FourierParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the decision value as a vector `margin`, and its sign as svm_prediction. W and b come from the seed, so only parameters are saved."""

    weights = Param(Params._dummy(), "weights", "weights of the features, the intercept last", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, weights=()):
        super().__init__()
        self._setDefault(inputCol=FEATURES, width=128, gamma=0.1, seed=SEED)
        self._set(**{k: list(v) for k, v in self._input_kwargs.items()})

    def _transform(self, df: DataFrame) -> DataFrame:
        get = self.getOrDefault
        width, seed, gamma = get(self.width), get(self.seed), get(self.gamma)
        weights, shift = np.array(get(self.weights)[:-1], np.float32), get(self.weights)[-1]

        @F.arrow_udf("double")
        def decided(vectors: pa.Array) -> pa.Array:
            return pa.array((fourier_features(vectors, seed, gamma, width) @ weights).astype(float) + shift)

        margin = decided(vector_to_array(F.col(get(self.inputCol))))
        shown = df.withColumn("margin", margin)
        return shown.withColumns({"margin": array_to_vector(F.array("margin")), "svm_prediction": (F.col("margin") > 0).cast("double")})


def minimised(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], w: np.ndarray, iterations: int, memory: int = 10, tolerance: float = 1e-6) -> np.ndarray:
    """L-BFGS with backtracking (Nocedal & Wright 2006, 7.4) from w; loss gives value and gradient."""
    value, gradient = loss(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    idle = 0
    for _ in range(iterations):
        direction, kept = -gradient, []
        for s, y in reversed(steps):
            a = (s @ direction) / (s @ y)
            direction = direction - a * y
            kept.append(a)
        if steps:
            direction = direction * (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1])
        for (s, y), a in zip(steps, reversed(kept), strict=True):
            direction = direction + (a - (y @ direction) / (s @ y)) * s
        slope = float(gradient @ direction)
        length = 1.0 if steps else 1.0 / max(1.0, float(np.linalg.norm(direction)))
        for _ in range(20):
            at = w + length * direction
            new, new_gradient = loss(at)
            if new <= value + 1e-4 * length * slope:
                break
            length /= 2
        else:
            if not steps:
                break  # no step gains at all
            steps = []  # the loss has a kink here: begin anew with its slope
            continue
        s, y = at - w, new_gradient - gradient
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-memory:]
        gained = value - new
        w, value, gradient = at, new, new_gradient
        idle = idle + 1 if gained <= tolerance * max(abs(value), 1e-12) else 0
        if idle == 3:
            break
    return w


def kernel_svm(gamma: float = 0.1, width: int = 128, iterations: int = 50, seed: int = SEED) -> Pipeline:
    """Linear SVM on random Fourier features, its margin turned into a probability by a
    one-variable logistic fit (Platt 1999)."""
    return Pipeline(
        stages=[
            FourierSVM(width=width, gamma=gamma, seed=seed, maxIter=iterations, regParam=1e-4),
            LogisticRegression(featuresCol="margin", labelCol=LABEL),
        ]
    )


def kernel_width(df: DataFrame, features: Sequence[str]) -> float:
    """1 / (features * variance over all cells), the usual default kernel width."""
    parts = []
    for i, f in enumerate(features):
        x = as_column(f).cast("double")
        parts += [F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    row = df.agg(*parts).first()
    means = [row[f"m{i}"] for i in range(len(features))]
    center = sum(means) / len(means)
    spread = sum(row[f"v{i}"] + (means[i] - center) ** 2 for i in range(len(features))) / len(features)
    return 1.0 / (len(features) * spread) if spread > 0 else 1.0


def base_models(n_rows: int, gamma: float, trees: int = 100) -> dict[str, Estimator]:
    """The compared classifiers; nearest neighbours are a join and are added by compare_models."""
    return {
        "Logistic Regression": logistic(n_rows),
        "LightGBM": hist_boosting(trees),
        "Gradient Boosting": gradient_boosting(trees),
        "Random Forest": random_forest(trees),
        "SVM": kernel_svm(gamma),
        "Naive Bayes": gaussian_bayes(),
    }


# ---- prediction and comparison -------------------------------------------


def predict(model: Transformer, df: DataFrame) -> DataFrame:
    """Add prediction (int) and probability of class 1 (or the decision value)."""
    out = model.transform(df)
    score = positive_probability(out.columns)
    dropped = ("prediction", "probability", "rawPrediction", "margin", "svm_prediction", "varying_features")
    return out.withColumns({"__p": F.col("prediction").cast("int"), "__s": score}).drop(*dropped).withColumnsRenamed(
        {"__p": "prediction", "__s": "probability"}
    )


def fit_predict(estimator: Estimator, train: DataFrame, test: DataFrame) -> tuple[Transformer, DataFrame]:
    ensure_checkpoint_dir(train.sparkSession)
    model = estimator.fit(train)
    return model, predict(model, test)


def compare_models(
    train: DataFrame,
    test: DataFrame,
    models: dict[str, Estimator],
    knn: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, dict[str, Transformer], dict[str, DataFrame]]:
    """Fit each model on `train`, evaluate on `test`: ((model, metric, value), models, predictions).

    Both frames are written once and reused by every fit."""
    train, test = materialize(train, "compare_train"), materialize(test, "compare_test")
    fitted, predictions = {}, {}
    for name, estimator in models.items():
        model, scored = fit_predict(estimator, train, test)
        fitted[name] = model
        predictions[name] = materialize(scored.select(LABEL, "prediction", "probability"), "compare_scored")
    if knn is not None:
        predictions["KNN"] = materialize(knn(train, test).select(LABEL, "prediction", "probability"), "compare_scored")
    return evaluate_models(predictions, LABEL, "prediction", "probability"), fitted, predictions


# ---- grid search ----------------------------------------------------------

# The searched parameters. Forest splits have no minimum-split-size
# parameter here, so that axis of the grid falls away.
FOREST_GRID = {"numTrees": [100, 200], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2]}
BOOSTING_GRID = {"maxIter": [100, 200], "stepSize": [0.05, 0.1], "maxDepth": [3, 5, 10]}
HIST_GRID = {
    "maxIter": [100, 200], "stepSize": [0.01, 0.05, 0.1], "maxDepth": [5, 10, 15], "numLeaves": [31, 50, 70], "minInstancesPerNode": [20, 30],
}


def param_grid(estimator: Estimator, grid: dict[str, list]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def grid_search(
    df: DataFrame,
    estimator: Estimator,
    grid: dict[str, list],
    folds: int = 5,
    fold_col: str = "fold",
    parallelism: int = 2,
    balance: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[Transformer, DataFrame]:
    """Best model by mean fold accuracy, refitted on all rows, and (params, accuracy, best).

    `df` has features, label and a fold number. `balance` oversamples the training
    part of each fold only, so no synthetic neighbour of a held-out row is learnt from.

    Leaf-wise boosting is searched in shared passes, each model being scored at every wanted number of trees. Forests
    of the same trees but for their number are grown in instalments, a larger one being the smaller with more trees."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    candidates = param_grid(estimator, grid)
    accuracy = MulticlassClassificationEvaluator(labelCol=LABEL, predictionCol="prediction", metricName="accuracy")
    if balance is None and isinstance(estimator, LeafwiseBoosting):
        scores = search(df, estimator, [estimator.copy(c).growth() for c in candidates], folds, fold_col)
        best = estimator.fit(df, candidates[int(np.argmax(scores))])
    elif balance is None and isinstance(estimator, DistributedForest):
        scores = _forest_scores(df, estimator, candidates, folds, fold_col)
        best = estimator.fit(df, candidates[int(np.argmax(scores))])
    elif balance is None:
        found = CrossValidator(
            estimator=estimator, estimatorParamMaps=candidates, evaluator=accuracy, numFolds=folds,
            foldCol=fold_col, parallelism=parallelism,
        ).fit(df)
        scores, best = list(found.avgMetrics), found.bestModel
    else:
        totals = np.zeros(len(candidates))
        for fold in range(folds):
            train = materialize(balance(df.filter(F.col(fold_col) != fold)), "fold_train")
            held = materialize(df.filter(F.col(fold_col) == fold), "fold_test")
            for i, model in estimator.fitMultiple(train, candidates):
                totals[i] += accuracy.evaluate(model.transform(held))
        scores = list(totals / folds)
        best = estimator.fit(balance(df), candidates[int(np.argmax(scores))])
    top = int(np.argmax(scores))
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(c.items(), key=lambda kv: kv[0].name)), float(s), i == top)
        for i, (c, s) in enumerate(zip(candidates, scores, strict=True))
    ]
    return best, spark.createDataFrame(rows, "params string, accuracy double, best boolean")


def _forest_scores(df: DataFrame, estimator: DistributedForest, candidates: Sequence[dict], folds: int, fold_col: str) -> list[float]:
    """Mean accuracy over the folds per candidate. Trees are independent, so the forest of 200 is that of 100 and 100 more; draws do
    not depend on the depth, so the forest of depth 10 is that of depth 20 ended there. Both are grown once."""
    trees, depth = estimator.numTrees, estimator.maxDepth
    seed = estimator.getSeed()
    groups: dict[tuple, list[int]] = {}
    for i, c in enumerate(candidates):
        groups.setdefault(tuple(sorted((p.name, v) for p, v in c.items() if p not in (trees, depth))), []).append(i)
    totals = np.zeros(len(candidates))
    for fold in range(folds):
        train = materialize(df.filter(F.col(fold_col) != fold), "fold_train")
        held = df.filter(F.col(fold_col) == fold).select(FEATURES, LABEL)
        for members in groups.values():
            wanted = {i: (candidates[i].get(trees, estimator.getNumTrees()), candidates[i].get(depth, estimator.getOrDefault(depth))) for i in members}
            depths = sorted({d for _, d in wanted.values()})
            grown, scored = 0, held
            for size in sorted({n for n, _ in wanted.values()}):
                other = {p: v for p, v in candidates[members[0]].items() if p not in (trees, depth)}
                part = estimator.fit(train, {**other, depth: depths[-1], trees: size - grown, estimator.seed: seed + grown})
                scored = materialize(_with_votes(part, scored, size - grown, depths), "forest_votes")
                grown = size
                right = [F.avg(((F.col("__votes")[j] / size > 0.5) == (F.col(LABEL) > 0.5)).cast("double")).alias(f"d{d}") for j, d in enumerate(depths)]
                found = scored.agg(*right).first()
                for i, (n, d) in wanted.items():
                    if n == size:
                        totals[i] += found[f"d{d}"]
    return list(totals / folds)


def _with_votes(forest: ForestModel, df: DataFrame, trees: int, depths: Sequence[int]) -> DataFrame:
    """Adds the forest's votes for class 1, ended at each of `depths`, to those of the forests before."""
    out = forest.with_shares(df, depths)
    before = [F.col("__votes")[j] if "__votes" in df.columns else F.lit(0.0) for j in range(len(depths))]
    return out.select(FEATURES, LABEL, F.array(*[b + F.col("shares")[j] * trees for j, b in enumerate(before)]).alias("__votes"))


def as_pipeline(model: Transformer) -> PipelineModel:
    return model if isinstance(model, PipelineModel) else PipelineModel([model])
