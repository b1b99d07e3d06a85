"""Classifier families on Spark ML, behind one fit/predict shape.

``fit(train)`` takes rows ``(features, label)`` and returns a model whose ``predict(rows)``
adds ``y_pred`` and ``proba`` (an array in the order of a given label space).  Labels are
strings; inside they are indexed in sorted order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from inspect import signature

import numpy as np
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.vectors import align_to_labels, argmax_index, normalise_sum, project_rows, vector_cells
from lexigrid.operators import network
from lexigrid.operators.boosting import Settings, boost
from lexigrid.operators.features import feature_variance
from lexigrid.operators.profile import with_class_weight
from lexigrid.session import keep, pack, run_parallel

MAX_DEPTH = 30  # Spark ML trees stop here
PLATT_FOLDS = 3


def tree_depth(asked: int | None) -> int:
    """Depth of a tree; unlimited means the library's limit, deeper is an error."""
    if asked is None:
        return MAX_DEPTH
    if asked > MAX_DEPTH:
        raise ValueError(f"trees of depth {asked} are not available, the limit is {MAX_DEPTH}")
    return asked


@dataclass
class Fitted:
    """A fitted classifier: its training labels and a function that adds scores."""

    labels: list[str]
    score: Callable[[DataFrame], DataFrame]  # adds `_p` (probabilities by training label)
    parts: list = field(default_factory=list)

    def predict(self, rows: DataFrame, label_space: list[str] | None = None) -> DataFrame:
        """Add ``y_pred`` and ``proba``; labels unseen in training get probability 0."""
        space = label_space or self.labels
        best = F.get(F.array(*[F.lit(x) for x in self.labels]), argmax_index(F.col("_p")).cast("int"))
        out = self.score(rows).withColumn("y_pred", best)
        return out.withColumn("proba", align_to_labels(F.col("_p"), self.labels, space)).select(
            *rows.columns, "y_pred", "proba"
        )


def training_labels(train: DataFrame) -> list[str]:
    return sorted(r["label"] for r in train.select("label").filter("label IS NOT NULL").distinct().collect())


def _indexed(df: DataFrame, labels: list[str]) -> DataFrame:
    index = StringIndexerModel.from_labels(labels, inputCol="label", outputCol="_y", handleInvalid="skip")
    return index.transform(df)


def _multiclass(train: DataFrame, build) -> Fitted:
    """Estimators that handle several classes and emit probabilities themselves."""
    labels = training_labels(train)
    rows = keep(pack(_indexed(train, labels), train.count()))
    model = build(len(labels)).fit(rows)
    rows.unpersist()
    model.setPredictionCol("_pred").setProbabilityCol("_prob").setRawPredictionCol("_raw")

    def score(rows: DataFrame) -> DataFrame:
        return model.transform(rows).withColumn("_p", vector_to_array("_prob"))

    return Fitted(labels, score, [model])


def _one_vs_rest(train: DataFrame, build, to_score: Callable[[Column, int], Column]) -> Fitted:
    """One binary model per class; scores are normalised to sum 1 over the classes.

    The binary models are applied one after the other inside the same stage, so a row is
    scored by all of them without leaving the JVM.
    """
    labels = training_labels(train)
    indexed = keep(pack(_indexed(train, labels), train.count()))
    positives = labels if len(labels) > 2 else labels[1:]

    def fit(name: str):
        return build().fit(indexed.withColumn("_y", (F.col("_y") == labels.index(name)).cast("double")))

    models = run_parallel(train.sparkSession, [lambda name=name: fit(name) for name in positives])
    indexed.unpersist()

    def score(rows: DataFrame) -> DataFrame:
        out = rows
        for j, m in enumerate(models):
            m.setRawPredictionCol(f"_raw{j}").setPredictionCol(f"_pred{j}")
            if m.hasParam("probabilityCol"):
                m.setProbabilityCol(f"_prob{j}")
            out = m.transform(out)
        margins = [to_score(F.get(vector_to_array(f"_raw{j}"), F.lit(1)), j) for j in range(len(models))]
        if len(models) == 1:
            p = F.array(F.lit(1.0) - margins[0], margins[0])
        else:
            p = normalise_sum(F.array(*margins))
        return out.withColumn("_p", p)

    return Fitted(labels, score, models)


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _weighted(train: DataFrame, balanced: bool) -> tuple[DataFrame, dict]:
    if not balanced:
        return train, {}
    return with_class_weight(train, kind="balanced", out="_w"), {"weightCol": "_w"}


# --- families -------------------------------------------------------------


def logistic_ovr(train: DataFrame, C: float = 1.0, penalty: str = "l2", max_iter: int = 100,
                 balanced: bool = False) -> Fitted:
    """Binary logistic regression per class; sigmoid scores normalised over the classes."""
    n = train.count()
    rows, extra = _weighted(train, balanced)
    return _one_vs_rest(
        rows,
        lambda: LogisticRegression(
            labelCol="_y", family="binomial", standardization=False, regParam=1.0 / (C * n),
            elasticNetParam=1.0 if penalty == "l1" else 0.0, maxIter=max_iter, **extra,
        ),
        lambda margin, j: _sigmoid(margin),
    )


def logistic_multinomial(train: DataFrame, C: float = 1.0, l1_ratio: float = 0.0, max_iter: int = 100,
                         balanced: bool = False) -> Fitted:
    """Softmax regression with L2, L1 or elastic-net penalty."""
    n = train.count()
    rows, extra = _weighted(train, balanced)
    return _multiclass(
        rows,
        lambda k: LogisticRegression(
            labelCol="_y", family="multinomial", standardization=False, regParam=1.0 / (C * n),
            elasticNetParam=l1_ratio, maxIter=max_iter, **extra,
        ),
    )


def random_forest(train: DataFrame, n_estimators: int = 200, max_depth: int | None = None, seed: int = 42) -> Fitted:
    return _multiclass(
        train,
        lambda k: RandomForestClassifier(
            labelCol="_y", numTrees=n_estimators, maxDepth=tree_depth(max_depth),
            featureSubsetStrategy="sqrt", seed=seed, maxMemoryInMB=512,
        ),
    )


def perceptron(train: DataFrame, hidden: tuple[int, ...] = (128, 64), max_iter: int = 100, seed: int = 42) -> Fitted:
    """Feed-forward network; the input layer takes the width of the vectors."""
    width = train.select("features").first()["features"].size
    return _multiclass(
        train,
        lambda k: MultilayerPerceptronClassifier(
            labelCol="_y", layers=[width, *hidden, k], maxIter=max_iter, seed=seed, blockSize=128
        ),
    )


def feed_forward(train: DataFrame, settings: network.Settings) -> Fitted:
    """Feed-forward network with Adam; see ``operators/network.py``."""
    labels = training_labels(train)
    net = network.train_network(_indexed(train, labels), len(labels), settings)
    return Fitted(labels, lambda rows: rows.withColumn("_p", net.probabilities(F.col("features"))), [net])


def boosted_trees(train: DataFrame, n_estimators: int = 300, max_depth: int = 6, learning_rate: float = 0.1,
                  subsample: float = 0.8, colsample: float = 0.8, seed: int = 42, max_bin: int = 32) -> Fitted:
    """Gradient boosting of the softmax loss (logistic with two classes): a tree a class and round from shared histograms."""
    labels = training_labels(train)
    if len(labels) < 2:
        return Fitted(labels, lambda rows: rows.withColumn("_p", F.array(F.lit(1.0))))
    settings = Settings(n_estimators, max_depth, learning_rate, subsample, colsample, bins=max_bin, seed=seed)
    model = boost(_indexed(train, labels), len(labels), settings)
    return Fitted(labels, lambda rows: rows.withColumn("_p", model.probabilities(F.col("features"))), [model])


def linear_svc(train: DataFrame, C: float = 1.0, max_iter: int = 100, balanced: bool = True) -> Fitted:
    """Linear SVM per class (hinge loss); probabilities by Platt scaling of the margins."""
    n = train.count()
    rows, extra = _weighted(train, balanced)
    return _platt(
        rows,
        lambda: LinearSVC(labelCol="_y", regParam=1.0 / (C * n), maxIter=max_iter, standardization=False, **extra),
    )


def _margins(models: list, rows: DataFrame) -> DataFrame:
    out = rows
    for j, m in enumerate(models):
        m.setRawPredictionCol(f"_raw{j}").setPredictionCol(f"_pred{j}")
        out = m.transform(out)
    return out.withColumn("_m", F.array(*[F.get(vector_to_array(f"_raw{j}"), F.lit(1)) for j in range(len(models))]))


def _platt(train: DataFrame, build) -> Fitted:
    """Margins per class, each mapped to a probability by a one-variable logistic fit.

    The curves are fitted on margins of rows that the margins' models have not seen: each fold
    is scored by models of the other folds.
    """
    base = _one_vs_rest(train, build, lambda margin, j: margin)
    labels, models = base.labels, base.parts
    positives = labels if len(labels) > 2 else labels[1:]
    own = F.col("doc_id") if "doc_id" in train.columns else vector_cells(F.col("features"))
    folded = keep(train.withColumn("_fold", F.pmod(F.xxhash64(own), F.lit(PLATT_FOLDS))))
    parts = []
    for k in range(PLATT_FOLDS):
        rest, held = folded.filter(F.col("_fold") != k).drop("_fold"), folded.filter(F.col("_fold") == k).drop("_fold")
        if training_labels(rest) == labels:
            parts.append(_margins(_one_vs_rest(rest, build, lambda margin, j: margin).parts, held).select("label", "_m"))
    scored = parts[0] if parts else _margins(models, folded.drop("_fold")).select("label", "_m")
    for part in parts[1:]:
        scored = scored.unionByName(part)
    scored = keep(pack(scored, train.count()))

    def fit(j: int, name: str) -> tuple[float, float]:
        rows = scored.select(
            array_to_vector(F.array(F.get("_m", F.lit(j)))).alias("features"),
            (F.col("label") == name).cast("double").alias("_y"),
        )
        model = LogisticRegression(labelCol="_y", maxIter=20).fit(rows)
        return float(model.coefficients[0]), float(model.intercept)

    curve = run_parallel(train.sparkSession, [lambda j=j, name=name: fit(j, name) for j, name in enumerate(positives)])
    scored.unpersist()
    folded.unpersist()

    def score(rows: DataFrame) -> DataFrame:
        p = [_sigmoid(F.get("_m", F.lit(j)) * a + b) for j, (a, b) in enumerate(curve)]
        array = F.array(F.lit(1.0) - p[0], p[0]) if len(p) == 1 else normalise_sum(F.array(*p))
        return _margins(models, rows).withColumn("_p", array)

    return Fitted(labels, score, models)


def rbf_svc(train: DataFrame, C: float = 1.0, gamma: str | float = "scale", n_components: int = 256,
            seed: int = 42, max_iter: int = 100) -> Fitted:
    """RBF-kernel SVM by random Fourier features, a linear SVM on them and Platt scaling.

    ``z(x) = sqrt(2 / D) * cos(x W + b)`` with W drawn from N(0, 2 * gamma); more components
    come closer to the exact kernel.
    """
    width = train.select("features").first()["features"].size
    if gamma == "scale":
        gamma = feature_variance(train, "features", width).first()["gamma"] or 1.0
    rng = np.random.default_rng(seed)
    matrix = rng.normal(scale=np.sqrt(2.0 * float(gamma)), size=(width, n_components))
    shift = rng.uniform(0.0, 2.0 * np.pi, size=n_components)
    project = project_rows(matrix, lambda z: np.sqrt(2.0 / n_components) * np.cos(z + shift))

    def lift(rows: DataFrame) -> DataFrame:
        raw = F.unwrap_udt("features")
        positions = F.when(raw["type"] == 0, raw["indices"]).otherwise(
            F.transform(raw["values"], lambda x, i: i)
        )
        return rows.withColumn("_original", F.col("features")).withColumn(
            "features", array_to_vector(project(positions, raw["values"]))
        )

    lifted = keep(lift(train).drop("_original"))
    inner = linear_svc(lifted, C=C, max_iter=max_iter, balanced=False)
    lifted.unpersist()

    def score(rows: DataFrame) -> DataFrame:
        return inner.score(lift(rows)).drop("features").withColumnRenamed("_original", "features")

    return Fitted(inner.labels, score, inner.parts)


def complement_nb(train: DataFrame, alpha: float = 1.0) -> Fitted:
    """Complement naive Bayes on count vectors."""
    return _multiclass(train, lambda k: NaiveBayes(labelCol="_y", modelType="complement", smoothing=alpha))


# --- registry -------------------------------------------------------------


def _logreg(
    train: DataFrame, C: float = 1.0, max_iter: int = 100, class_weight: str | None = None, penalty: str = "l2",
    multi_class: str | None = None, solver: str | None = None, l1_ratio: float = 0.5, random_state: int | None = None,
) -> Fitted:
    """One-vs-rest, or softmax where it is asked for by name or by solver; the fit has no random part."""
    shared = {"C": C, "max_iter": max_iter, "balanced": _balanced(class_weight)}
    if multi_class == "multinomial" or (multi_class is None and solver in ("saga", "lbfgs")):
        return logistic_multinomial(train, l1_ratio={"l1": 1.0, "elasticnet": l1_ratio}.get(penalty, 0.0), **shared)
    return logistic_ovr(train, penalty=penalty, **shared)


def _balanced(class_weight: str | None) -> bool:
    if class_weight not in (None, "balanced"):
        raise ValueError(f"class_weight {class_weight!r} is not available")
    return class_weight == "balanced"


def _rf(train: DataFrame, n_estimators: int = 200, max_depth: int | None = None, random_state: int = 42) -> Fitted:
    return random_forest(train, n_estimators, max_depth, random_state)


def _mlp(
    train: DataFrame, hidden_layer_sizes=(128, 64), max_iter: int = 200, random_state: int = 42, solver: str | None = None,
    activation: str | None = None, alpha: float | None = None, learning_rate_init: float | None = None, learning_rate: str | None = None,
    batch_size: int | str | None = None, dropout: float | None = None, tol: float | None = None, n_iter_no_change: int | None = None,
) -> Fitted:
    """Adam, where the solver or any of its parameters is named; else, or for ``lbfgs``, Spark ML's perceptron with sigmoid units."""
    hidden = tuple(hidden_layer_sizes) if isinstance(hidden_layer_sizes, (list, tuple)) else (int(hidden_layer_sizes),)
    if learning_rate not in (None, "constant"):
        raise ValueError(f"learning_rate {learning_rate!r} is not available")
    named = {"units": activation, "decay": alpha, "rate": learning_rate_init, "batch": None if batch_size == "auto" else batch_size, "dropout": dropout, "tolerance": tol, "patience": n_iter_no_change}
    named = {k: v for k, v in named.items() if v is not None}
    if solver not in (None, "adam", "lbfgs") or (solver == "lbfgs" and named):
        raise ValueError(f"solver {solver!r} with {', '.join(named) or 'these parameters'} is not available")
    if solver == "adam" or named or learning_rate or batch_size:
        return feed_forward(train, network.Settings(hidden=hidden, epochs=max_iter, seed=random_state, **named))
    return perceptron(train, hidden, max_iter, random_state)


def _xgb(
    train: DataFrame, n_estimators: int = 300, max_depth: int = 6, learning_rate: float = 0.1, subsample: float = 0.8,
    colsample_bytree: float = 0.8, random_state: int = 42, max_bin: int = 32,
) -> Fitted:
    return boosted_trees(train, n_estimators, max_depth, learning_rate, subsample, colsample_bytree, random_state, max_bin)


def _svc(train: DataFrame, C: float = 1.0, gamma: str | float = "scale", n_components: int = 256, max_iter: int = 100, random_state: int = 42) -> Fitted:
    return rbf_svc(train, C, gamma, n_components, random_state, max_iter)


def _linear_svc(train: DataFrame, C: float = 1.0, max_iter: int = 100, class_weight: str | None = None) -> Fitted:
    return linear_svc(train, C, max_iter, _balanced(class_weight))


FAMILIES: dict[str, Callable[..., Fitted]] = {
    "logreg": _logreg, "rf": _rf, "mlp": _mlp, "xgb": _xgb, "svc": _svc, "linear_svc": _linear_svc, "cnb": complement_nb,
}


def fit_classifier(kind: str, train: DataFrame, params: dict) -> Fitted:
    """Fit a family by name; a parameter that the family does not have is an error, not ignored."""
    if kind not in FAMILIES:
        raise ValueError(f"unknown classifier {kind!r}")
    known = set(signature(FAMILIES[kind]).parameters) - {"train"}
    if unknown := sorted(set(params) - known):
        raise ValueError(f"{kind} has no parameter {', '.join(unknown)}; it has {', '.join(sorted(known))}")
    return FAMILIES[kind](train, **params)
