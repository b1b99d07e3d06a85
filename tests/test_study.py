import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrid.operators import classifiers as clf
from lexigrid.operators import metrics, split
from lexigrid.operators.features import NgramVectorizer, featurize
from lexigrid.plans import study
from lexigrid.session import keep
from lexigrid.sources import sinks
from lexigrid.sources.cache import StudyStore, reorder_probabilities
from lexigrid.sources.corpus import as_corpus, blank_missing, documents, pick, read_delimited


@pytest.fixture(scope="module")
def rows(spark, small):
    parts = split.holdout(documents(spark, small), 0.3)
    model = NgramVectorizer(minDF=2.0, maxFeatures=150).fit(parts.filter("part = 'train'"))
    out = keep(featurize(model, parts, "doc_id", "label", "part"))
    out.count()
    return out.filter("part = 'train'"), out.filter("part = 'test'")


CASES = {
    "logreg": {"solver": "liblinear", "max_iter": 20, "C": 10.0},
    "rf": {"n_estimators": 10, "max_depth": 6},
    "mlp": {"hidden_layer_sizes": [16], "max_iter": 30},
    "xgb": {"n_estimators": 3, "max_depth": 3},
    "svc": {"n_components": 64, "max_iter": 10},
    "linear_svc": {"max_iter": 10, "class_weight": "balanced"},
    "cnb": {"alpha": 1.0},
}


@pytest.mark.parametrize("kind", list(CASES))
def test_families_beat_the_majority_class(rows, kind):
    train, test = rows
    fitted = clf.fit_classifier(kind, train, CASES[kind])
    out = fitted.predict(test, ["aa", *fitted.labels]).collect()
    assert len(out) == test.count()
    majority = max(sum(r["label"] == x for r in out) for x in fitted.labels) / len(out)
    assert sum(r["label"] == r["y_pred"] for r in out) / len(out) > majority
    for r in out:
        assert r["proba"][0] == 0.0 and abs(sum(r["proba"]) - 1.0) < 1e-9 and min(r["proba"]) >= 0.0


def test_binary_and_multinomial(rows):
    train, test = (r.filter("label IN ('en', 'de')") for r in rows)
    for params in ({"solver": "saga", "penalty": "l1", "max_iter": 15}, {"solver": "liblinear", "class_weight": "balanced", "max_iter": 15}):
        fitted = clf.fit_classifier("logreg", train, params)
        out = fitted.predict(test).collect()
        assert fitted.labels == ["de", "en"] and all(abs(sum(r["proba"]) - 1) < 1e-9 for r in out)
        for r in out:
            assert r["y_pred"] == fitted.labels[0 if r["proba"][0] >= r["proba"][1] else 1]


def test_unknown_family(rows):
    with pytest.raises(ValueError):
        clf.fit_classifier("nope", rows[0], {})


VEC = [study.Component("w", "tfidf", {"ngram_range": [1, 2], "min_df": 2, "max_features": 100})]
CLF = [study.Component("cnb", "cnb", {}), study.Component("lr", "logreg", {"max_iter": 10})]


def test_second_run_trains_nothing(spark, small, tmp_path, monkeypatch):
    corpus = documents(spark, small)
    store = StudyStore(spark, str(tmp_path / "s"))
    first = study.holdout_study(corpus, VEC, CLF, store=store)
    assert {r["status"] for r in first.runs} == {"ok"}
    before = sorted(map(str, first.predictions.collect()))

    def refuse(*a, **k):
        raise AssertionError("trained again")

    monkeypatch.setattr(study, "fit_classifier", refuse)
    monkeypatch.setattr(study, "fit_vectorizer", refuse)
    second = study.holdout_study(corpus, VEC, CLF, store=store)
    assert {r["status"] for r in second.runs} == {"cached"}
    assert sorted(map(str, second.predictions.collect())) == before
    changed = [CLF[0], study.Component("lr", "logreg", {"max_iter": 11})]
    with pytest.raises(study.FailedCombination, match="trained again"):
        study.holdout_study(corpus, VEC, changed, store=store)
    recorded = study.holdout_study(corpus, VEC, changed, store=store, on_error="record")
    assert [r["status"] for r in recorded.runs] == ["cached", "failed"]
    assert "AssertionError" in recorded.failures()[0]["error"]


def test_every_family_in_one_multi_class_grid(spark, small):
    corpus = documents(spark, small)
    grid = [study.Component(kind, kind, params) for kind, params in CASES.items()]
    done = study.holdout_study(corpus, [study.Component("w", "tfidf", {"min_df": 2, "max_features": 60})], grid, parallelism=3)
    assert len(done.labels) == 4 and [r["status"] for r in done.runs] == ["ok"] * len(grid)
    rows = done.results().collect()
    assert len(rows) == len(grid) and all(r["macro_f1"] > 0 and r["total_time"] > 0 and json.loads(r["vectorizer_params"])["max_features"] == 60 for r in rows)


def test_partial_folds_are_left_out_of_the_summary(spark, small, monkeypatch):
    fit, calls = study.fit_classifier, []

    def sometimes(kind, train, params):
        calls.append(kind)
        if kind == "cnb" and calls.count("cnb") == 2:
            raise OSError("lost")
        return fit(kind, train, params)

    monkeypatch.setattr(study, "fit_classifier", sometimes)
    cv = study.cv_study(documents(spark, small), VEC, CLF, k=2, on_error="record", parallelism=1)
    assert [r["error"].splitlines()[-1] for r in cv.failures()] == ["OSError: lost"]
    assert [r["model"] for r in study.cv_summary(cv).collect()] == ["w+lr"]
    report = {r["model"]: r for r in study.pipeline_report(None, cv).collect()}
    assert (report["w+cnb"]["cv_folds_completed"], report["w+cnb"]["cv_folds_requested"]) == (1, 2)


def test_unknown_parameters_are_refused(rows, spark, small):
    for kind, params in (("mlp", {"momentum": 0.1}), ("rf", {"class_weight": "balanced"}), ("rf", {"max_depth": 40}), ("logreg", {"class_weight": "odd"})):
        with pytest.raises(ValueError):
            clf.fit_classifier(kind, rows[0], params)
    for spec in (study.Component("w", "tfidf", {"sublinear": True}), study.Component("e", "encoder", {"max_length": 5}), study.Component("x", "nope", {})):
        with pytest.raises(ValueError):
            study.fit_vectorizer(spec, documents(spark, small))


def test_user_encoder_in_a_study(spark, small):
    def make():
        def predict(texts):
            return np.array([[1.0, "ó" in t, "ä" in t, "è" in t] for t in texts], dtype=np.float32).reshape(len(texts), 4)

        return predict

    encoder = study.Component("enc", "encoder", {"make_encoder": make, "name": "accents-1"})
    done = study.holdout_study(documents(spark, small), [encoder], [CLF[1]])
    assert done.results().first()["accuracy"] > 0.8


def test_rank_score_orders_models(spark):
    scores = spark.createDataFrame([("a", 0.9, 0.8), ("b", 0.8, 0.7), ("c", 0.7, 0.7)], "model string, accuracy double, macro_f1 double")
    cv = spark.createDataFrame([("a", 0.5), ("b", float("nan"))], "model string, macro_f1_mean double")
    rows = study.ranked_models(scores, cv).orderBy("rank").collect()
    assert [(r["model"], r["rank_score"]) for r in rows] == [("b", 0.7), ("c", 0.7), ("a", 0.5)]


@pytest.mark.parametrize("bound", [0, 1 << 40])
def test_both_sides_of_the_broadcast_check_agree(spark, small, monkeypatch, bound):
    from lexigrid import session
    from lexigrid.functions.text import word_tokens
    from lexigrid.operators.features import tfidf_long
    from lexigrid.operators.vocab import fit_vocabulary

    monkeypatch.setattr(session, "BROADCAST_BYTES", bound)
    corpus = documents(spark, small)
    grams = word_tokens(F.col("text"))
    vocab = fit_vocabulary(corpus, grams, 2)
    got = tfidf_long(corpus, grams, vocab).agg(F.count("*"), F.round(F.sum("value"), 6)).first()
    _BOTH.append(tuple(got))
    assert got[0] > 0 and len(set(_BOTH)) == 1


_BOTH = []


def test_cv_study_and_report(spark, small):
    corpus = documents(spark, small)
    cv = study.cv_study(corpus, VEC, CLF[:1], k=2)
    assert cv.predictions.count() == corpus.count()
    hold = study.holdout_study(corpus, VEC, CLF[:1])
    row = study.pipeline_report(hold, cv).first()
    assert row["cv_folds_completed"] == 2 and 0 < row["cv_macro_f1_mean"] <= 1
    assert {e["label"] for e in json.loads(row["holdout_classification_report_json"])} >= {"en", "macro avg"}
    assert len(json.loads(row["cv_fold_metrics_json"])) == 2


def test_ensemble_round_trip(spark, small, tmp_path):
    corpus = documents(spark, small)
    grid = study.holdout_study(corpus, VEC, CLF)
    chosen, weights = study.choose_models(grid.predictions, grid.labels, "improve", max_corr=1.1, max_double_fault=1.0)
    assert abs(sum(weights.values()) - 1) < 1e-12
    specs = {f"{v.name}+{c.name}": (v, c) for v in VEC for c in CLF}
    ranking = study.ranked_models(metrics.scores(grid.predictions, "model"))
    table = study.selection_table(spark, chosen, weights, specs, ranking)
    study.write_selection(table, str(tmp_path / "sel"))
    document = json.loads(spark.read.text(str(tmp_path / "sel")).first()[0])["selected_models"][0]
    assert document["vectorizer"]["params"]["max_features"] == 100 and document["metrics"]["holdout_macro_f1"] > 0 and document["name"] == chosen[0]
    members = study.ensemble_members(sinks.read_selection(spark, str(tmp_path / "sel")))
    assert [m[0] for m in members] == chosen and members[0][1].params == VEC[0].params
    votes, summary = study.run_ensemble(corpus, members[:1], out=str(tmp_path / "out"))
    row = summary.first()
    assert row["ensemble_accuracy"] == row["models"][0]["accuracy"]  # one member: same model
    assert [m["name"] for m in row["models"]] == chosen[:1]
    assert row["n_train"] + row["n_test"] == corpus.count()
    written = spark.read.csv(str(tmp_path / "out/ensemble_predictions"), header=True, multiLine=True, escape='"')
    assert written.count() == votes.count() == row["n_test"]


def test_default_members():
    assert [m[0] for m in study.ensemble_members(None)] == ["w2v_100d+logreg", "tfidf_1-2_5000+logreg"]


def test_grid_search_uses_given_folds(rows):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import StringIndexerModel
    from pyspark.ml.tuning import ParamGridBuilder

    train, test = rows
    coder = StringIndexerModel.from_labels(clf.training_labels(train), inputCol="label", outputCol="label_idx")
    nb = NaiveBayes(labelCol="label_idx", modelType="complement")
    grid = ParamGridBuilder().addGrid(nb.smoothing, [0.5, 1.0]).build()
    best = study.grid_search(nb, grid, coder.transform(train), k=2)
    assert len(best.avgMetrics) == 2 and max(best.avgMetrics) > 0.5
    assert metrics.MacroF1Evaluator().evaluate(best.transform(coder.transform(test))) > 0.5


def test_latin1_csv(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_bytes('text;label;score\n"a;b ""q""\nção";x;1,5\n;y;2\nNA;z;\n'.encode("latin-1"))
    df = read_delimited(spark, str(path), "text string, label string, score double")
    assert [tuple(r) for r in df.collect()] == [('a;b "q"\nção', "x", 1.5), (None, "y", 2.0), ("NA", "z", None)]
    assert df.select(blank_missing(F.col("text"))).filter("1=1").collect()[2][0] is None
    corpus = as_corpus(df.withColumn("id", F.monotonically_increasing_id()), 0, "label", "id")
    assert corpus.columns == ["doc_id", "text", "label"] and corpus.filter("text = ''").count() == 1
    with pytest.raises(TypeError):
        pick(df, 1.5)


def test_result_sinks(spark, tmp_path):
    df = spark.createDataFrame([("m", 0.5, None, [("a", 1)])], "model string, f1 double, cv double, report array<struct<label:string,n:int>>")
    sinks.write_results(df, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r/parquet")).collect() == df.collect()
    row = spark.read.csv(str(tmp_path / "r/csv"), header=True, escape='"').first()
    assert json.loads(row["report"]) == [{"label": "a", "n": 1}] and row["cv"] is None
    vec = spark.createDataFrame([(1, "x")], "doc_id long, label string")
    from pyspark.ml.functions import array_to_vector

    sinks.export_vectors(vec.withColumn("features", array_to_vector(F.array(F.lit(1.0), F.lit(2.0)))), str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v")).first()["vector"] == [1.0, 2.0]


def test_reorder(spark):
    df = spark.createDataFrame([([0.1, 0.9],)], "proba array<double>")
    assert reorder_probabilities(df, ["a", "b"], ["b", "a"]).first()["proba"] == [0.9, 0.1]
    with pytest.raises(ValueError):
        reorder_probabilities(df, ["a", "b"], ["a", "c"])


def test_word_vector_store(spark, tmp_path):
    from lexigrid.operators import embed

    df = spark.createDataFrame([(1, "u v u v")], "doc_id long, text string")
    calls = []

    def fit():
        calls.append(1)
        return embed.fit_word_vectors(df, vector_size=3, min_count=1, epochs=1)

    path = str(tmp_path / "w2v")
    a = embed.load_or_fit(spark, path, {"size": 3}, fit).transform(df).first()["features"]
    b = embed.load_or_fit(spark, path, {"size": 3}, fit).transform(df).first()["features"]
    assert a == b and len(calls) == 1
    embed.load_or_fit(spark, path, {"size": 3, "window": 2}, fit)
    assert len(calls) == 2
