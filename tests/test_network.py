"""The network's gradients by finite differences, its training against a plain loop, and the parameters of a study's grid."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexigrid.operators import network
from lexigrid.operators.classifiers import fit_classifier
from lexigrid.operators.network import Settings, train_network


@pytest.mark.parametrize("units", list(network.UNITS))
@pytest.mark.parametrize("masked", [False, True])
def test_gradient_equals_finite_differences(units, masked):
    rng = np.random.default_rng(3)
    sizes = [5, 4, 3, 3]
    theta, x, y = rng.normal(size=network.n_weights(sizes)), rng.normal(size=(7, 5)), rng.integers(0, 3, 7)
    masks = [(rng.random((7, h)) >= 0.4) / 0.6 for h in (4, 3)] if masked else None
    loss = lambda t: network.loss_and_gradient(t, sizes, units, x, y, 0.3, masks)[0]
    _, grad = network.loss_and_gradient(theta, sizes, units, x, y, 0.3, masks)
    for i in range(len(theta)):
        step = np.zeros(len(theta))
        step[i] = 1e-6
        assert abs((loss(theta + step) - loss(theta - step)) / 2e-6 - grad[i]) < 1e-5
    decayed = [w for w, _ in network.layers(np.arange(len(theta)), sizes)]
    assert sum(w.size for w in decayed) == 5 * 4 + 4 * 3 + 3 * 3


def data(n=300, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6)) * (rng.random((n, 6)) < 0.7)
    return x, ((x[:, 0] * x[:, 1] > 0).astype(int) + (x[:, 2] > 0.5)).astype(int)


def frame(spark, x, y, parts):
    rows = [(i, float(c), Vectors.sparse(6, {j: float(v) for j, v in enumerate(r) if v})) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["doc_id", "_y", "features"]).repartition(parts, "doc_id")


def test_one_part_is_plain_adam(spark):
    x, y = data()
    rows = frame(spark, x, y, 3)
    s = Settings(hidden=(8,), epochs=3, batch=32, rate=0.01, decay=0.1, dropout=0.2, seed=5)
    net = train_network(rows, 3, s)
    order = [r.doc_id for r in rows.select("doc_id", F.xxhash64("doc_id").alias("k")).orderBy("k").collect()]
    x, y = x[order], y[order]
    sizes = [6, 8, 3]
    theta = network.initial(sizes, 5, "relu")
    m, v, t, losses = np.zeros_like(theta), np.zeros_like(theta), 0, []
    for epoch in range(3):
        rng = np.random.default_rng([5, epoch, 0])
        order, total = rng.permutation(300), 0.0
        for at in range(0, 300, 32):
            b = order[at : at + 32]
            masks = [(rng.random((len(b), 8)) >= 0.2) / 0.8]
            loss, g = network.loss_and_gradient(theta, sizes, "relu", x[b], y[b], 0.1, masks)
            total, t = total + loss * len(b), t + 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta = theta - 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v) / np.sqrt(1 - 0.999**t) + 1e-8 / np.sqrt(1 - 0.999**t))
        losses.append(total / 300)
    assert np.allclose(net.theta, theta, atol=1e-9) and np.allclose(net.losses, losses)


def test_parts_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(network, "PART_ROWS", 40)
    monkeypatch.setattr(network, "AVERAGED", 3)
    x, y = data()
    s = Settings(hidden=(8, 4), epochs=12, batch=16, rate=0.02)
    a, b = (train_network(frame(spark, x, y, p), 3, s) for p in (1, 5))
    assert np.allclose(a.theta, b.theta, atol=1e-12) and a.losses[-1] < a.losses[0]


def test_family_takes_the_grid(spark):
    x, y = data(600, 2)
    rows = frame(spark, x, y, 2).withColumn("label", F.concat(F.lit("c"), F.col("_y").cast("int"))).drop("_y")
    params = {"hidden_layer_sizes": [32, 16], "activation": "relu", "solver": "adam", "alpha": 0.0001, "learning_rate_init": 0.01, "max_iter": 40, "batch_size": "auto"}
    fitted = fit_classifier("mlp", rows, params)
    out = fitted.predict(rows, ["c0", "c1", "c2", "unseen"]).collect()
    assert sum(r.label == r.y_pred for r in out) > 0.85 * len(out)
    assert all(abs(sum(r.proba) - 1) < 1e-9 and r.proba[3] == 0 for r in out)
    dense = rows.withColumn("features", F.udf(lambda v: Vectors.dense(v.toArray()), rows.schema["features"].dataType)("features"))
    again = {r.doc_id: r.proba for r in fitted.predict(dense).collect()}
    assert all(np.allclose(again[r.doc_id], r.proba[:3]) for r in out)
    for wrong in ({"solver": "sgd"}, {"activation": "step"}, {"learning_rate": "adaptive"}, {"dropout": 1.0}, {"solver": "lbfgs", "alpha": 1.0}):
        with pytest.raises(ValueError):
            fit_classifier("mlp", rows, wrong)


def test_training_stops_when_the_loss_does(spark):
    x, y = data(80)
    net = train_network(frame(spark, x, y * 0, 2), 2, Settings(hidden=(4,), epochs=200, rate=0.05, tolerance=0.01, patience=3))
    assert len(net.losses) < 60


def test_too_many_weights_are_refused(spark, monkeypatch):
    monkeypatch.setattr(network, "MOST_WEIGHTS", 20)
    with pytest.raises(ValueError):
        train_network(frame(spark, *data(20), 1), 3, Settings(hidden=(8,)))
