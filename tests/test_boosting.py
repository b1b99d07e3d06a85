"""Boosting against plain versions: every split by brute force, whole models by an unblocked fit in numpy."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexigrid.operators import boosting
from lexigrid.operators.boosting import Settings, boost
from lexigrid.operators.classifiers import fit_classifier


def test_best_split_equals_every_split():
    rng = np.random.default_rng(0)
    for _ in range(40):
        slots, features, bins = rng.integers(1, 4), rng.integers(1, 6), int(rng.integers(2, 7))
        n_cuts = rng.integers(0, bins, features)
        zero = np.array([rng.integers(0, c + 1) for c in n_cuts])
        rows = rng.integers(1, 60)
        slot, g, h = rng.integers(0, slots, rows), rng.normal(size=rows), rng.uniform(0.1, 1, rows)
        cell = np.stack([np.where(rng.random(rows) < 0.5, rng.integers(0, c + 1, rows), z) for c, z in zip(n_cuts, zero)], axis=1)
        stored = cell != zero
        hists = np.zeros((2, slots, features, bins))
        for f in range(features):
            for i, d in enumerate((g, h)):
                np.add.at(hists[i], (slot[stored[:, f]], f, cell[stored[:, f], f]), d[stored[:, f]])
        totals = [np.bincount(slot, d, slots) for d in (g, h)]
        gain, feature, cut_at, g_left, h_left = boosting.best_splits(*hists, *totals, zero, n_cuts, 1.0, 0.5)
        for s in range(slots):
            best = (-np.inf, 0, 0)
            for f in range(features):
                for b in range(n_cuts[f]):
                    left = (slot == s) & (cell[:, f] <= b)
                    right = (slot == s) & (cell[:, f] > b)
                    if h[left].sum() < 0.5 or h[right].sum() < 0.5:
                        continue
                    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1.0)
                    value = 0.5 * (score(left) + score(right) - score(slot == s))
                    if value > best[0] + 1e-9:
                        best = (value, f, b)
            if best[0] == -np.inf:
                assert gain[s] == -np.inf
            else:
                assert abs(gain[s] - best[0]) < 1e-9
                left = (slot == s) & (cell[:, feature[s]] <= cut_at[s])
                assert abs(g_left[s] - g[left].sum()) < 1e-9 and abs(h_left[s] - h[left].sum()) < 1e-9


def plain_boost(x, y, k, s: Settings, cuts):
    """All rows and features, level by level, without sampling."""
    margins = k if k > 2 else 1
    m = np.zeros((len(x), margins))
    losses = []
    for _ in range(s.rounds):
        p = boosting._softmax(m)
        losses.append(-np.log(p[np.arange(len(y)), y]).mean())
        if margins == 1:
            g, h = p[:, 1:] - (y == 1)[:, None], p[:, 1:] * p[:, :1]
        else:
            g, h = p - np.eye(k)[y], 2 * p * (1 - p)
        for j in range(margins):
            nodes = [np.ones(len(x), bool)]
            step = np.zeros(len(x))
            for _ in range(s.depth):
                after = []
                for rows in nodes:
                    score = lambda r: g[r, j].sum() ** 2 / (h[r, j].sum() + s.penalty)
                    step[rows] = -s.rate * g[rows, j].sum() / (h[rows, j].sum() + s.penalty)
                    best = (1e-9, None)
                    for f in range(x.shape[1]):
                        for c in cuts[f][np.isfinite(cuts[f])]:
                            left, right = rows & (x[:, f] <= c), rows & (x[:, f] > c)
                            if min(h[left, j].sum(), h[right, j].sum()) < s.least_weight:
                                continue
                            gain = 0.5 * (score(left) + score(right) - score(rows))
                            if gain > best[0] + 1e-10:
                                best = (gain, (left, right))
                    if best[1]:
                        for part in best[1]:
                            step[part] = -s.rate * g[part, j].sum() / (h[part, j].sum() + s.penalty)
                            after.append(part)
                nodes = after
            m[:, j] += step
    p = boosting._softmax(m)
    return p, [*losses, -np.log(p[np.arange(len(y)), y]).mean()]


def data(k, n=240, width=6, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)) * (rng.random((n, width)) < 0.6), 3)
    y = (np.digitize(x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * rng.normal(size=n), np.linspace(-0.7, 0.7, k - 1)) if k > 2 else (x[:, 0] * x[:, 1] > 0.05).astype(int))
    return x, y


def frame(spark, x, y, parts, sparse=True):
    vector = lambda r: Vectors.sparse(len(r), {i: float(v) for i, v in enumerate(r) if v}) if sparse else Vectors.dense(r)
    rows = [(i, float(c), vector(r)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["doc_id", "_y", "features"]).repartition(parts, "doc_id")


@pytest.mark.parametrize(("k", "sparse"), [(2, True), (3, True), (4, False)])
def test_boosting_equals_a_plain_fit(spark, monkeypatch, k, sparse):
    monkeypatch.setattr(boosting, "STORED_ROUNDS", 2)
    monkeypatch.setattr(boosting, "RANGE", 4)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    x, y = data(k)
    s = Settings(rounds=3, depth=3, rate=0.5, row_share=1.0, column_share=1.0, least_weight=0.5, bins=8)
    rows = frame(spark, x, y, 3, sparse)
    model = boost(rows, k, s)
    want, losses = plain_boost(x, y, k, s, boosting.quantile_cuts(rows, 8))
    got = {r.doc_id: r.p for r in rows.select("doc_id", model.probabilities(F.col("features")).alias("p")).collect()}
    assert np.allclose([got[i] for i in range(len(x))], want, atol=1e-9)
    assert np.allclose(model.losses, losses, atol=1e-9) and all(a > b for a, b in zip(model.losses, model.losses[1:]))


def test_sampling_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(boosting, "HISTOGRAM_CELLS", 200)  # several jobs a level
    x, y = data(3, 400)
    s = Settings(rounds=2, depth=3, row_share=0.5, column_share=0.5, bins=8)
    one, five = (boost(frame(spark, x, y, p), 3, s) for p in (1, 5))
    for a, b in zip(one.rounds, five.rounds):
        for t, u in zip(a, b):
            assert t.feature == u.feature and t.threshold == u.threshold and np.allclose(t.value, u.value, atol=1e-12)
    every = boost(frame(spark, x, y, 2), 3, Settings(rounds=2, depth=3, row_share=1.0, column_share=0.5, bins=8))
    assert every.rounds[0][0].value != one.rounds[0][0].value
    assert len({f for t in one.rounds[0] for f in t.feature if f >= 0}) <= 6


def test_family_uses_classes_and_handles_odd_input(spark):
    x, y = data(3, 500, seed=5)
    rows = frame(spark, x, y, 2).withColumn("label", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("_y") + 1).cast("int"))).drop("_y")
    fitted = fit_classifier("xgb", rows, {"n_estimators": 8, "max_depth": 4, "learning_rate": 0.3})
    out = fitted.predict(rows, ["a", "b", "c", "unseen"]).collect()
    assert sum(r.label == r.y_pred for r in out) > 0.8 * len(out)
    assert all(abs(sum(r.proba) - 1) < 1e-9 and r.proba[3] == 0 for r in out)
    lone = fit_classifier("xgb", rows.filter("label = 'a'"), {"n_estimators": 2})
    assert {r.y_pred for r in lone.predict(rows).collect()} == {"a"}
    empty = spark.createDataFrame([(1, "a", Vectors.sparse(6, {})), (2, "b", Vectors.sparse(6, {})), (3, "b", Vectors.sparse(6, {}))], ["doc_id", "label", "features"])
    flat = fit_classifier("xgb", empty, {"n_estimators": 2, "subsample": 1.0})
    assert {r.y_pred for r in flat.predict(empty).collect()} == {"b"}
