"""Parameter grids and incremental scoring."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.operators.naive_bayes import class_term_counts, predict_models


def grid_points(spark: SparkSession, kind: str, axes: dict) -> DataFrame:
    """``(point, kind, params)``: one row for each combination of the axes' values.

    An axis is a list of values; any other value is fixed. Values travel as JSON, so axes of
    different types share a column. A point is named after its class and a hash of its
    parameters, which is unique whatever the parameters are called.
    """
    columns = {name: v if isinstance(v, list) else [v] for name, v in axes.items()}
    points = spark.range(1).select(F.lit(kind).alias("kind"))
    for i, values in enumerate(columns.values()):
        points = points.withColumn(f"_{i}", F.explode(F.array(*[F.lit(json.dumps(v)) for v in values])))
    pairs = [F.concat(F.lit(f"{json.dumps(name)}: "), F.col(f"_{i}")) for i, name in enumerate(columns)]
    params = F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))
    named = points.select("kind", params.alias("params"))
    return named.select(F.concat_ws("-", "kind", F.substring(F.sha2("params", 256), 1, 8)).alias("point"), "kind", "params")


def cnb_grid(
    train: DataFrame, test: DataFrame, cf: np.ndarray, alphas: list[float], sizes: list[int],
    label: str = "label",
) -> DataFrame:
    """Predictions of complement naive Bayes for every (alpha, vocabulary size).

    All points share one class x term table and one pass over the test vectors.  A smaller
    vocabulary is the most frequent part of the fitted one (``cf`` by index, ties by index,
    which is alphabetical).
    """
    table = class_term_counts(train, len(cf), label)
    order = np.lexsort((np.arange(len(cf)), -cf))
    models = {}
    for size in sizes:
        mask = np.zeros(len(cf), dtype=bool)
        mask[order[:size]] = True
        for alpha in alphas:
            models[f"a{alpha}_v{size}"] = table.weights(alpha, mask)
    return predict_models(test, models, table.labels, label=label)


def pending(corpus: DataFrame, models: list[str], done: DataFrame) -> DataFrame:
    """``(doc_id, model)`` pairs that have no stored prediction yet.

    The models of the grid are a literal list; stored predictions are removed by an
    anti-join on the pair.
    """
    wanted = corpus.select("doc_id", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    return wanted.join(done.select("doc_id", "model"), ["doc_id", "model"], "left_anti")


def union_predictions(*frames: DataFrame) -> DataFrame:
    """Stack prediction sets; a set without probabilities gets NULL there."""
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out
