import json

import math

import pytest
from pyspark.sql import functions as F

from lexigrid.operators import diversity, ensemble, metrics, sweep

# y_true, predictions of three models; "z" is predicted but never true, "c" true but never predicted
ROWS = [
    (1, "a", "a", "a", "a"), (2, "a", "b", "a", "a"), (3, "b", "b", "b", "b"),
    (4, "b", "z", "a", "b"), (5, "c", "a", "a", "c"), (6, "b", "b", "a", "b"),
]


@pytest.fixture(scope="module")
def preds(spark):
    rows = []
    for i, y, m1, m2, m3 in ROWS:
        rows += [(i, "m1", y, m1), (i, "m2", y, m2), (i, "perfect", y, m3)]
    return spark.createDataFrame(rows, "doc_id long, model string, y_true string, y_pred string").cache()


def test_report(preds):
    rep = {(r["model"], r["label"]): r for r in metrics.classification_report(preds, "model").collect()}
    a = rep["m1", "a"]
    assert (a["precision"], a["recall"], a["f1"], a["support"]) == (0.5, 0.5, 0.5, 2)
    assert rep["m1", "z"]["support"] == 0 and rep["m1", "z"]["recall"] == 0.0
    assert rep["m1", "c"]["precision"] == 0.0 and rep["m1", "c"]["f1"] == 0.0
    b = rep["m1", "b"]
    assert math.isclose(b["precision"], 2 / 3) and math.isclose(b["recall"], 2 / 3)
    assert math.isclose(rep["m1", "macro avg"]["f1"], (0.5 + 2 / 3) / 4)
    assert rep["perfect", "weighted avg"]["f1"] == 1.0


def test_accuracy_equals_weighted_recall(preds):
    acc = {r["model"]: r["accuracy"] for r in metrics.accuracy(preds, "model").collect()}
    avg = {r["model"]: r["accuracy"] for r in metrics.scores(preds, "model").collect()}
    assert acc.keys() == avg.keys() and all(math.isclose(acc[m], avg[m]) for m in acc)


def test_report_round_trip(preds):
    rep = metrics.per_class(metrics.confusion(preds, "model"), "model")
    back = metrics.expand_report(metrics.archive_report(metrics.reports_as_rows(rep, "model")), "model")
    key = ("model", "label", "precision", "recall", "f1", "support")
    assert sorted(map(tuple, rep.select(*key).collect())) == sorted(map(tuple, back.select(*key).collect()))


def test_mean_std(spark):
    df = spark.createDataFrame(
        [("x", 0.5), ("x", 1.0), ("x", float("nan")), ("one", 0.3), ("none", None)], "combo string, score double"
    )
    got = {r["combo"]: (r["score_mean"], r["score_std"]) for r in metrics.mean_std(df, ["score"], "combo").collect()}
    assert got["x"][0] == 0.75 and math.isclose(got["x"][1], math.sqrt(0.125))
    assert got["one"] == (0.3, 0.0) and got["none"] == (None, None)


def test_macro_f1_evaluator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "label_idx double, prediction double")
    assert math.isclose(metrics.MacroF1Evaluator().evaluate(df), (2 / 3) / 2)


def test_pair_counts_against_brute_force(preds):
    err = {m: [y != p for p, y in zip(col, [r[1] for r in ROWS])] for m, col in
           (("m1", [r[2] for r in ROWS]), ("m2", [r[3] for r in ROWS]), ("perfect", [r[4] for r in ROWS]))}
    got = {(r["a"], r["b"]): r for r in diversity.pairwise_diversity(preds).collect()}
    assert set(got) == {("m1", "m2"), ("m1", "perfect"), ("m2", "perfect")}
    for (a, b), r in got.items():
        cells = [(x, y) for x, y in zip(err[a], err[b])]
        want = (cells.count((False, False)), cells.count((True, True)), cells.count((False, True)), cells.count((True, False)))
        assert (r["n11"], r["n00"], r["n10"], r["n01"]) == want and sum(want) == 6
        assert math.isclose(r["disagreement"], (want[2] + want[3]) / 6)
    assert got["m1", "perfect"]["error_corr"] is None and got["m1", "perfect"]["yules_q"] == 0.0
    corr = {(r["a"], r["b"]): r["corr"] for r in diversity.full_correlation(preds).collect()}
    assert corr["m1", "m1"] == 1.0 and corr["perfect", "perfect"] is None
    assert corr["m1", "m2"] == corr["m2", "m1"] and len(corr) == 9


PROBAS = [
    (1, "m1", "a", [0.6, 0.4]), (1, "m2", "a", [0.1, 0.9]), (2, "m1", "b", [0.5, 0.5]), (2, "m2", "b", [0.5, 0.5]),
    (1, "m3", "a", None), (2, "m3", "b", None),
]


@pytest.fixture(scope="module")
def probas(spark):
    return spark.createDataFrame(PROBAS, "doc_id long, model string, y_true string, proba array<double>").withColumn("y_pred", F.lit("a")).cache()


def weights(spark, **w):
    return spark.createDataFrame(list(w.items()), "model string, weight double")


def test_soft_vote(spark, probas):
    votes = {r["doc_id"]: r for r in ensemble.soft_vote(probas, weights(spark, m1=3.0, m2=1.0), ["a", "b"]).collect()}
    assert votes[1]["y_pred"] == "b" and math.isclose(votes[1]["proba"][0], 0.475)
    assert votes[2]["y_pred"] == "a"  # tie: first label
    single = {r["doc_id"]: r["y_pred"] for r in ensemble.soft_vote(probas.filter("model = 'm1'"), weights(spark, m1=0.7), ["a", "b"]).collect()}
    assert single == {1: "a", 2: "a"}


def test_soft_vote_many_labels_path(spark, probas, monkeypatch):
    a = ensemble.soft_vote(probas, weights(spark, m1=3.0, m2=1.0), ["a", "b"]).orderBy("doc_id").collect()
    monkeypatch.setattr(ensemble, "UNROLLED_LABELS", 1)
    b = ensemble.soft_vote(probas, weights(spark, m1=3.0, m2=1.0), ["a", "b"]).orderBy("doc_id").collect()
    assert a == b


def test_weights_all_zero_become_uniform(spark):
    got = ensemble.normalise_weights(weights(spark, a=0.0, b=-1.0)).collect()
    assert {r["weight"] for r in got} == {0.5}


def test_align_long(spark):
    df = spark.createDataFrame([(1, "m", "a", 0.3), (1, "m", "c", 0.7), (1, "m", "gone", 0.1)], "doc_id long, model string, label string, p double")
    assert ensemble.align_long(df, ["a", "b", "c"]).first()["proba"] == [0.3, 0.0, 0.7]


def test_trial_scores_equal_vote(spark, probas):
    matrix = ensemble.model_matrix(probas, ["m1", "m2"])
    got = ensemble.trial_scores(matrix, ["m1", "m2"], ["m1"], ["m2"], {"m1": 3.0, "m2": 1.0}, ["a", "b"])
    votes = ensemble.soft_vote(probas, weights(spark, m1=3.0, m2=1.0), ["a", "b"])
    want = metrics.scores(votes.withColumn("model", F.lit("e")), "model").first()
    assert got["m2"] == (want["macro_f1"], want["accuracy"])


def test_ranking(spark):
    df = spark.createDataFrame([("b", 0.5, 0.1), ("a", 0.5, 0.1), ("n", float("nan"), 0.9), ("z", None, 1.0), ("t", 0.5, 0.2)],
                               "model string, macro_f1 double, accuracy double")
    assert [r["model"] for r in ensemble.rank_results(df).orderBy("rank").collect()] == ["t", "a", "b", "z", "n"]
    s = spark.createDataFrame([("x", None, 0.4), ("y", 0.3, 0.4), ("w", float("nan"), None)], "model string, cv_macro_f1_mean double, holdout_macro_f1 double")
    assert {r["model"]: r["rank_score"] for r in ensemble.rank_score(s).collect()} == {"x": 0.4, "y": 0.3, "w": 0.0}


# Published macro-F1 and error correlation with the best model of the quick study.
QUICK = [
    ("tfidf12_3k_xgb", 0.5243, None), ("tfidf12_2k_svc", 0.5030, 0.7365), ("tfidf13_5k_lr", 0.4997, 0.7152),
    ("tfidf12_3k_rf", 0.4919, 0.7403), ("tfidf12_5k_lr", 0.4871, 0.7139), ("tfidf_char35_5k_lr", 0.4808, 0.6233),
    ("w2v100_lr", 0.4303, 0.5493), ("ft100_lr", 0.4125, 0.5112),
]


def test_forward_selection_golden():
    pairs = ensemble.PairTable([{"a": QUICK[0][0], "b": n, "error_corr": c, "double_fault": 0.2} for n, _, c in QUICK[1:]])
    calls = []

    def trial(selected, candidates):
        calls.append(candidates)
        return {c: (0.9 if selected else 0.5243, 0.6) for c in candidates}

    chosen, best = ensemble.select_forward([q[0] for q in QUICK], pairs, trial)
    assert chosen == ["tfidf12_3k_xgb"] and best == 0.5243 and len(calls) == 1
    assert ensemble.final_weights(chosen, {"tfidf12_3k_xgb": 0.5243}) == {"tfidf12_3k_xgb": 1.0}


def pair_table(values):
    return ensemble.PairTable([{"a": a, "b": b, "error_corr": c, "double_fault": d} for (a, b), (c, d) in values.items()])


def test_threshold_selection():
    pairs = pair_table({("a", "b"): (0.5, 0.0), ("a", "c"): (0.1, 0.05), ("b", "c"): (0.0, 0.0), ("a", "d"): (0.2, 0.2),
                        ("c", "d"): (0.2, 0.2), ("b", "d"): (0, 0), ("a", "e"): (None, 0.0), ("c", "e"): (0.1, 0.1)})
    assert ensemble.select_by_threshold(["a", "b", "c", "d", "e"], pairs) == ["a", "c", "e"]
    assert ensemble.select_by_threshold(["a", "b", "c"], pairs, max_models=1) == ["a"]
    with pytest.raises(KeyError):
        ensemble.select_by_threshold(["a", "missing"], pairs)


def test_improving_selection():
    pairs = pair_table({("a", "b"): (0.1, 0.0), ("a", "c"): (0.1, 0.0), ("b", "c"): (0.1, 0.0)})
    gains = {(): 0.5, ("a", "b"): 0.4, ("a", "c"): 0.6}

    def trial(selected, candidates):
        return {c: (gains.get((*selected, c), 0.5), 0.0) for c in candidates}

    assert ensemble.select_improving(["a", "b", "c"], pairs, trial) == (["a", "c"], 0.6)


def test_grid_points_are_the_product_of_the_axes(spark):
    axes = {"n": [300, 600], "range": [[1, 2], [1, 3], [2, 5]], "kind": "word", "depth": [None, 4]}
    rows = sweep.grid_points(spark, "trees", axes).collect()
    params = [json.loads(r["params"]) for r in rows]
    assert len(rows) == 12 == len({r["point"] for r in rows}) and all(r["kind"] == "trees" and r["point"].startswith("trees-") for r in rows)
    assert sorted(map(str, params)) == sorted(str({"n": n, "range": g, "kind": "word", "depth": d}) for n in axes["n"] for g in axes["range"] for d in axes["depth"])


def test_pending_and_union(spark, probas):
    corpus = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    left = sweep.pending(corpus, ["m1", "new"], probas)
    assert {tuple(r) for r in left.collect()} == {(3, "m1"), (1, "new"), (2, "new"), (3, "new")}
    both = sweep.union_predictions(probas, probas.drop("proba"))
    assert both.filter("proba IS NULL").count() == 2 + 6
