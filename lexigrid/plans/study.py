"""Studies: vectorizer x classifier grids by holdout and cross-validation, and ensembles.

The grid is a short driver loop; every fit, transform, prediction and metric in it is a Spark
job.  Features are computed once per vectorizer (and fold) and shared by all classifiers;
predictions are appended to one long table, and all metrics come from grouped queries on it.
"""

from __future__ import annotations

import json
import time
import traceback
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions.text import analyze_parts
from lexigrid.operators import diversity, ensemble, metrics, profile, split
from lexigrid.operators.classifiers import fit_classifier
from lexigrid.operators.embed import encode_texts, fit_word_vectors
from lexigrid.operators.features import DRIVER_TERMS, NgramVectorizer, bound
from lexigrid.operators.folds import FoldStatistics, complement_nb_from, counted_vectors
from lexigrid.operators.term_counts import counted_documents
from lexigrid.session import keep, pack, run_parallel
from lexigrid.sources.cache import StudyStore, params_hash
from lexigrid.sources.sinks import selection_document, write_json, write_predictions


@dataclass(frozen=True)
class Component:
    """Name, class and parameters of a vectorizer or classifier."""

    name: str
    kind: str
    params: dict = field(default_factory=dict, hash=False)


# Class names used in selection documents.
VECTORIZER_KINDS = {
    "TfidfVectorizerWrapper": "tfidf",
    "Word2VecVectorizer": "word2vec",
    "FastTextVectorizer": "subword",
    "BertVectorizer": "encoder",
}
CLASSIFIER_KINDS = {
    "LogisticRegressionClassifier": "logreg",
    "RandomForestTextClassifier": "rf",
    "MLPTextClassifier": "mlp",
    "XGBoostTextClassifier": "xgb",
}

# The pair that is trained when no selection document exists.
DEFAULT_PAIR = (
    ("w2v_100d+logreg", "word2vec", {"vector_size": 100, "window": 5, "min_count": 2, "epochs": 50, "seed": 42}, "logreg", {}),
    ("tfidf_1-2_5000+logreg", "tfidf", {"max_features": 5000, "ngram_range": [1, 2], "min_df": 2}, "logreg", {}),
)


# Parameters of each vectorizer class; others are an error, so no two grid points are equal by oversight.
VECTORIZER_PARAMS = {
    "tfidf": {"analyzer", "ngram_range", "min_df", "max_df", "max_features", "strip_accents", "stop_words"},
    "word2vec": {"vector_size", "window", "min_count", "epochs", "seed"},
    "subword": {"vector_size", "window", "min_count", "epochs", "seed", "min_n", "max_n", "bucket"},
    "encoder": {"make_encoder", "name", "batch_size"},
}
VECTORIZER_PARAMS["count"] = VECTORIZER_PARAMS["tfidf"]


def _stop_words(asked: list[str] | str | None) -> list[str]:
    """The given words, or the full list of a language by its name."""
    return StopWordsRemover.loadDefaultStopWords(asked) if isinstance(asked, str) else list(asked or ())


def _check_params(spec: Component, kind: str) -> None:
    if unknown := sorted(set(spec.params) - VECTORIZER_PARAMS[kind]):
        raise ValueError(f"{spec.kind} has no parameter {', '.join(unknown)}")


def fit_vectorizer(spec: Component, train: DataFrame):
    """Fit on the given rows only; the result maps a corpus to ``features``."""
    kind = VECTORIZER_KINDS.get(spec.kind, spec.kind)
    if kind not in VECTORIZER_PARAMS:
        raise ValueError(f"unknown vectorizer {spec.kind!r}")
    _check_params(spec, kind)
    p = spec.params
    if kind in ("tfidf", "count"):
        return NgramVectorizer(
            analyzer=p.get("analyzer", "word"), ngramRange=list(p.get("ngram_range", (1, 1))),
            minDF=float(p.get("min_df", 1)), maxDF=float(p.get("max_df", 1.0)),
            maxFeatures=int(p.get("max_features") or 0), stripAccents=bool(p.get("strip_accents")),
            stopWords=_stop_words(p.get("stop_words")), weighting=kind,
        ).fit(train).transform
    if kind in ("word2vec", "subword"):
        grams = {"subwords": (p.get("min_n", 3), p.get("max_n", 6)), "buckets": p.get("bucket", 100_000)} if kind == "subword" else {}
        return fit_word_vectors(
            train, p.get("vector_size", 100), p.get("window", 5), p.get("min_count", 1), p.get("epochs", 5), p.get("seed", 42), **grams
        ).transform
    if "make_encoder" not in p or "name" not in p:
        raise ValueError("an encoder needs make_encoder, and a name (with version) that keys its stored features")
    return lambda df: encode_texts(df, p["make_encoder"], p.get("batch_size", 16))


class FailedCombination(RuntimeError):
    """A combination of the grid could not be fitted; the cause is attached."""


def _run_combos(
    train: DataFrame, test: DataFrame, split_id: str, vec: Component, classifiers: list[Component],
    labels: list[str], store: StudyStore, scope: DataFrame, parallelism: int, suffix: dict, on_error: str = "raise",
    names: dict[str, str] | None = None, fitted_by: Callable | None = None, closed: dict[str, Callable] | None = None,
) -> list[dict]:
    """All classifiers on one vectorizer; stored combinations are not trained again.

    A combination that fails ends the study, or is recorded with its error's type, message and
    traceback if ``on_error`` is ``record``. ``names`` gives models other names than
    ``vectorizer+classifier``. ``fitted_by`` gives the vectorizer's transformation in place of a fit on
    ``scope``; ``closed`` gives fits by classifier kind that need no training vectors.
    """
    closed = closed or {}
    vec_key = params_hash(vec.kind, vec.params, suffix)
    full = {c.name: (names or {}).get(c.name) or f"{vec.name}+{c.name}" for c in classifiers}
    keys = {c.name: params_hash(vec.kind, vec.params, c.kind, c.params, labels, suffix, full[c.name]) for c in classifiers}
    todo = [c for c in classifiers if not store.has(store.predictions_path(split_id, keys[c.name]))]
    times = {"vectorizer_fit_time": None, "train_transform_time": None, "test_transform_time": None}
    if todo:
        vectors_of_train = any(CLASSIFIER_KINDS.get(c.kind, c.kind) not in closed for c in todo)
        parts = ("train", "test") if vectors_of_train else ("test",)
        cached = all(store.has(f"features/split_id={split_id}/vectorizer={vec_key}/part={p}") for p in parts)
        started = time.perf_counter()
        transform = None if cached else fitted_by() if fitted_by else fit_vectorizer(vec, scope)
        fitted = time.perf_counter()
        cols = ("doc_id", "label", "features")
        x_train = store.features(split_id, vec.name, vec_key, "train", lambda: transform(train).select(*cols)) if vectors_of_train else None
        trained = time.perf_counter()
        x_test = store.features(split_id, vec.name, vec_key, "test", lambda: transform(test).select(*cols))
        if not cached:
            times = {"vectorizer_fit_time": fitted - started, "train_transform_time": trained - fitted, "test_transform_time": time.perf_counter() - trained}

    def run(c: Component) -> dict:
        row = {
            "model": full[c.name], "vectorizer": vec.name, "classifier": c.name, "key": keys[c.name], "status": "ok", "error": None,
            "vectorizer_params": _as_json(vec.params), "classifier_params": _as_json(c.params), **suffix, **times,
            "classifier_fit_time": None, "predict_time": None,
        }
        if c not in todo:
            row["status"] = "cached"
            return row
        started = time.perf_counter()
        try:
            kind = CLASSIFIER_KINDS.get(c.kind, c.kind)
            fitted = closed[kind](**c.params) if kind in closed else fit_classifier(kind, x_train, c.params)
            row["classifier_fit_time"] = time.perf_counter() - started
            out = fitted.predict(x_test, labels).select(
                "doc_id", F.lit(row["model"]).alias("model"), F.col("label").alias("y_true"), "y_pred", "proba",
                *[F.lit(v).alias(k) for k, v in suffix.items()],
            )
            store.predictions(split_id, keys[c.name], lambda: out)
            row["predict_time"] = time.perf_counter() - started - row["classifier_fit_time"]
        except Exception as error:
            if on_error != "record":
                raise FailedCombination(f"{row['model']} {suffix}: {type(error).__name__}: {error}") from error
            row["status"] = "failed"
            row["error"] = "".join(traceback.format_exception(error))
        return row

    return run_parallel(train.sparkSession, [lambda c=c: run(c) for c in classifiers], parallelism)


def _as_json(params: dict) -> str:
    return json.dumps(params, sort_keys=True, default=str)


def labels_of(corpus: DataFrame) -> list[str]:
    return [r["label"] for r in profile.label_space(corpus).orderBy("idx").collect()]


@dataclass
class Study:
    """Outcome of a grid: one row per combination, and the long prediction table."""

    runs: list[dict]
    predictions: DataFrame
    labels: list[str]
    split_id: str

    def failures(self) -> list[dict]:
        return [r for r in self.runs if r["status"] == "failed"]

    def results(self, *keys: str) -> DataFrame:
        """Metrics of all combinations from one grouped query, with parameters, times and status."""
        spark = self.predictions.sparkSession
        names = ["model", "vectorizer", "classifier", "vectorizer_params", "classifier_params", "status"]
        seconds = ["vectorizer_fit_time", "train_transform_time", "test_transform_time", "classifier_fit_time", "predict_time"]
        rows = [(*[r[c] for c in (*names, *keys)], *[r[c] for c in seconds], sum(r[c] or 0.0 for c in seconds)) for r in self.runs]
        schema = ", ".join([f"{c} string" for c in names] + [f"{k} long" for k in keys] + [f"{c} double" for c in (*seconds, "total_time")])
        info = spark.createDataFrame(rows, schema)
        return info.join(metrics.scores(self.predictions, "model", *keys), ["model", *keys], "left")


def holdout_study(
    corpus: DataFrame, vectorizers: list[Component], classifiers: list[Component], test_size: float = 0.3,
    seed: int = 42, fit_scope: str = "train", store: StudyStore | None = None, parallelism: int = 2,
    on_error: str = "raise",
) -> Study:
    """Evaluate the grid on one stratified holdout.

    ``fit_scope='all'`` fits the vectorizers on the whole corpus, which leaks the test part
    into the vocabulary; the default does not.
    """
    store = store or StudyStore(corpus.sparkSession)
    parts = split.holdout(corpus, test_size, seed)
    split_id = split.split_fingerprint(parts).first()["split_id"]
    labels = labels_of(corpus)
    train, test = parts.filter("part = 'train'"), parts.filter("part = 'test'")
    scope = parts if fit_scope == "all" else train
    runs = []
    for vec in vectorizers:
        runs += _run_combos(train, test, split_id, vec, classifiers, labels, store, scope, parallelism, {"scope": fit_scope}, on_error)
    return _collect(runs, store, split_id, labels)


def cv_study(
    corpus: DataFrame, vectorizers: list[Component], classifiers: list[Component], k: int = 5,
    seed: int | None = 42, store: StudyStore | None = None, parallelism: int = 2, on_error: str = "raise",
) -> Study:
    """Evaluate the grid by stratified k-fold; the vectorizer is refitted on each fold's
    training part once and shared by all classifiers.

    N-gram vectorizers of one analyzer read the texts once, for all folds together: terms are counted by
    document and stored, and each fold's vocabulary and naive Bayes model is that of the whole corpus
    minus the fold (see ``operators/folds.py``). For other vectorizers the corpus is written once,
    partitioned by fold, so that a fold is a choice of folders.
    """
    store = store or StudyStore(corpus.sparkSession)
    folds = split.kfold(corpus.select("doc_id", "label"), k, seed)
    split_id = params_hash(split.split_fingerprint(folds.withColumn("part", F.col("fold").cast("string"))).first()["split_id"], k, seed)
    rows = folds.select(F.col("doc_id").alias("_id"), F.col("label").alias("_label"), "fold").distinct()
    rows = store.table(f"folds/split_id={split_id}", lambda: rows)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("label").eqNullSafe(F.col("_label"))
    tagged = corpus.select("doc_id", "text", "label").join(rows, same).drop("_id", "_label")
    labels = labels_of(corpus)
    runs = {}
    by_analyzer: dict[str, list[Component]] = {}
    for vec in vectorizers:
        kind = VECTORIZER_KINDS.get(vec.kind, vec.kind)
        by_analyzer.setdefault(params_hash(_analyzer_of(vec)) if kind in ("tfidf", "count") else "", []).append(vec)
    for key, group in by_analyzer.items():
        if key:
            runs |= _counted_folds(tagged, group, key, classifiers, k, split_id, labels, store, parallelism, on_error)
            continue
        path = f"corpus/split_id={split_id}"
        if not store.has(path):
            tagged.write.mode("overwrite").partitionBy("fold").parquet(f"{store.root}/{path}")
        folded = store.spark.read.parquet(f"{store.root}/{path}")
        for vec in group:
            runs[vec] = []
            for fold in range(k):
                train, test = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
                runs[vec] += _run_combos(train, test, split_id, vec, classifiers, labels, store, train, parallelism, {"fold": fold}, on_error)
    return _collect([r for vec in vectorizers for r in runs[vec]], store, split_id, labels)


def _analyzer_of(vec: Component) -> dict:
    """The parameters of an n-gram vectorizer that decide its features, whatever the vocabulary."""
    _check_params(vec, "tfidf")
    p = vec.params
    return {
        "analyzer": p.get("analyzer", "word"), "ngram_range": list(p.get("ngram_range", (1, 1))),
        "strip": bool(p.get("strip_accents")), "stop_words": _stop_words(p.get("stop_words")),
    }


def _counted_folds(
    tagged: DataFrame, vectorizers: list[Component], key: str, classifiers: list[Component], k: int, split_id: str,
    labels: list[str], store: StudyStore, parallelism: int, on_error: str,
) -> dict[Component, list[dict]]:
    """All folds of n-gram vectorizers with one analyzer, from one pass over the texts."""
    a = _analyzer_of(vectorizers[0])
    grams, sizes = analyze_parts(F.col("text"), a["analyzer"], tuple(a["ngram_range"]), a["strip"], a["stop_words"])
    counted = store.table(f"terms/split_id={split_id}/analyzer={key}", lambda: counted_documents(tagged, grams, "doc_id", "label", "fold", sizes=sizes))
    stats = FoldStatistics.of(counted)
    out = {}
    for vec in vectorizers:
        p, kind = vec.params, VECTORIZER_KINDS.get(vec.kind, vec.kind)
        low, high = float(p.get("min_df", 1)), float(p.get("max_df", 1.0))
        bounds = {"min_df": bound(low, below=1.0), "max_df": bound(high, below=1.0 + 1e-12), "max_features": int(p.get("max_features") or 0) or None}
        fitted: dict = {}

        def vocabularies(bounds=bounds, fitted=fitted):
            if "vocabularies" not in fitted:
                fitted["vocabularies"] = stats.collected(DRIVER_TERMS, **bounds)
            return fitted["vocabularies"]

        def counts_of(fold, vocabularies=vocabularies, fitted=fitted):
            if "counts" not in fitted:
                fitted["counts"] = stats.class_counts(vocabularies())
            return fitted["counts"][fold]

        out[vec] = []
        for fold in range(k):
            train, test = counted.filter(F.col("fold") != fold), counted.filter(F.col("fold") == fold)

            def transformation(fold=fold, vocabularies=vocabularies, kind=kind):
                vocabulary = vocabularies()[fold]
                return lambda df: counted_vectors(df, vocabulary, kind, "doc_id", "label")

            closed = {"cnb": lambda alpha=1.0, fold=fold, counts_of=counts_of: complement_nb_from(counts_of(fold), alpha)} if kind == "count" else {}
            out[vec] += _run_combos(
                train, test, split_id, vec, classifiers, labels, store, train, parallelism, {"fold": fold}, on_error,
                fitted_by=transformation, closed=closed,
            )
    stats.close()
    return out


def _collect(runs: list[dict], store: StudyStore, split_id: str, labels: list[str]) -> Study:
    done = [r["key"] for r in runs if r["status"] != "failed"]
    if not done:
        raise FailedCombination("no combination succeeded; the last error was " + str(runs[-1]["error"]))
    return Study(runs, store.all_predictions(split_id, done), labels, split_id)


def cv_summary(study: Study) -> DataFrame:
    """Mean and deviation over the folds, for combinations that have all of them."""
    partial = sorted({r["model"] for r in study.failures()})
    per_fold = metrics.scores(study.predictions, "model", "fold").filter(~F.col("model").isin(partial))
    names = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1"]
    return metrics.mean_std(per_fold, names, "model")


def pipeline_report(holdout: Study | None, cv: Study | None) -> DataFrame:
    """One row per combination: parameters, holdout metrics, times and report, fold means and deviations of
    metrics and times, and the folds' metrics and reports as JSON."""
    out = None
    ids = ["model", "vectorizer", "classifier", "vectorizer_params", "classifier_params"]
    if holdout is not None:
        as_json = metrics.archive_report(metrics.reports_as_rows(metrics.classification_report(holdout.predictions, "model"), "model"))
        scores = holdout.results()
        renamed = [F.col(c).alias(f"holdout_{c}") for c in scores.columns if c not in ids]
        out = scores.select(*ids, *renamed).join(
            as_json.withColumnRenamed("report_json", "holdout_classification_report_json"), "model", "left"
        )
    if cv is not None:
        summary = cv_summary(cv)
        summary = summary.select("model", *[F.col(c).alias(f"cv_{c}") for c in summary.columns if c != "model"])
        per_fold = cv.results("fold")
        seconds = [c for c in per_fold.columns if c.endswith("_time")]
        entry = F.struct("fold", *[c for c in per_fold.columns if c not in (*ids, "fold")])
        folds = per_fold.groupBy("model").agg(
            F.count(F.lit(1)).alias("cv_folds_requested"),
            F.count_if(F.col("status") != "failed").alias("cv_folds_completed"),
            *[f(c).alias(f"cv_{c}_{name}") for c in seconds for name, f in (("mean", F.avg), ("std", F.stddev_pop))],
            F.to_json(F.sort_array(F.collect_list(entry))).alias("cv_fold_metrics_json"),
        )
        reports = metrics.archive_report(metrics.reports_as_rows(metrics.classification_report(cv.predictions, "model", "fold"), "model", "fold"))
        listed = reports.groupBy("model").agg(F.to_json(F.sort_array(F.collect_list(F.struct("fold", "report_json")))).alias("cv_fold_reports_json"))
        both = folds.join(listed, "model", "left").join(summary, "model", "left")
        if out is None:
            both = per_fold.select(*ids).distinct().join(both, "model")
        out = both if out is None else out.join(both, "model", "left")
    return out.withColumn("run_timestamp", F.current_timestamp())


def grid_search(estimator, grid: list, train: DataFrame, k: int = 3, seed: int = 42, parallelism: int = 4,
                label_idx: str = "label_idx") -> CrossValidatorModel:
    """Macro-F1 grid search over exact stratified folds; the best point is refitted on all rows."""
    folded = keep(pack(split.kfold(train, k, seed, label="label"), train.count()))
    best = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=metrics.MacroF1Evaluator(labelCol=label_idx),
        foldCol="fold", numFolds=k, parallelism=parallelism, seed=seed,
    ).fit(folded)
    folded.unpersist()
    return best


def smoothing_search(
    corpus: DataFrame, vectorizer: Component, alphas: list[float], k: int = 3, test_size: float = 0.3, seed: int = 42,
    store: StudyStore | None = None,
) -> DataFrame:
    """Grid search over the smoothing of complement naive Bayes: ``(alpha, cv_macro_f1, chosen, holdout_macro_f1)``.

    All points and folds of the training part come from one pass over its texts. The point with the largest
    mean macro-F1 over the folds (the first of equal ones) is refitted on the training part and scored on the rest.
    """
    store = store or StudyStore(corpus.sparkSession)
    train = split.holdout(corpus, test_size, seed).filter("part = 'train'").drop("part")
    points = [Component(f"alpha={a:g}", "cnb", {"alpha": float(a)}) for a in alphas]
    folds = cv_summary(cv_study(train, [vectorizer], points, k, seed, store))
    means = {r["model"]: r["macro_f1_mean"] for r in folds.select("model", "macro_f1_mean").collect()}  # one row a point
    scores = [means[f"{vectorizer.name}+{p.name}"] for p in points]
    best = scores.index(max(scores))
    refitted = holdout_study(corpus, [vectorizer], [points[best]], test_size, seed, store=store).results().first()
    rows = [(float(a), m, i == best, refitted["macro_f1"] if i == best else None) for i, (a, m) in enumerate(zip(alphas, scores))]
    return corpus.sparkSession.createDataFrame(rows, "alpha double, cv_macro_f1 double, chosen boolean, holdout_macro_f1 double")


# --- ensembles ------------------------------------------------------------


def choose_models(
    preds: DataFrame, labels: list[str], strategy: str = "forward", scores: DataFrame | None = None,
    cv_scores: DataFrame | None = None, **limits
) -> tuple[list[str], dict[str, float]]:
    """Names in order of acceptance and their normalised weights.

    ``threshold`` uses only error overlap; ``forward`` adds the best gain per round;
    ``improve`` walks the ranking. Models are ranked and weighted by their rank score: macro-F1
    of cross-validation (``cv_scores``: model, macro_f1_mean), else of the holdout, else 0; ties
    go to the larger holdout macro-F1.
    """
    ranking = ranked_models(metrics.scores(preds, "model") if scores is None else scores, cv_scores)
    ranked_rows = ranking.orderBy("rank").select("model", "rank_score").collect()  # one row a model
    voting = {r["model"] for r in ensemble.with_probabilities(preds).select("model").distinct().collect()}
    ranked = [r["model"] for r in ranked_rows if r["model"] in voting]
    weights = {r["model"]: r["rank_score"] for r in ranked_rows}
    pairs = ensemble.PairTable.collect(diversity.pairwise_diversity(preds))
    if strategy == "threshold":
        chosen = ensemble.select_by_threshold(ranked, pairs, **limits) or ranked[:5]
        return chosen, {n: 1.0 / len(chosen) for n in chosen} if chosen else {}
    matrix = ensemble.model_matrix(preds, ranked)
    matrix = matrix.persist()

    def trial(selected, candidates):
        return ensemble.trial_scores(matrix, ranked, selected, candidates, weights, labels)

    pick = {"forward": ensemble.select_forward, "improve": ensemble.select_improving}[strategy]
    chosen, _ = pick(ranked, pairs, trial, **limits)
    matrix.unpersist()
    return chosen, ensemble.final_weights(chosen, weights)


def ranked_models(scores: DataFrame, cv_scores: DataFrame | None = None) -> DataFrame:
    """model, accuracy, holdout_macro_f1, cv_macro_f1_mean, rank_score and rank."""
    table = scores.select("model", "accuracy", F.col("macro_f1").alias("holdout_macro_f1"))
    if cv_scores is None:
        table = table.withColumn("cv_macro_f1_mean", F.lit(None).cast("double"))
    else:
        table = table.join(cv_scores.select("model", F.col("macro_f1_mean").alias("cv_macro_f1_mean")), "model", "left")
    scored = ensemble.rank_score(table)
    order = Window.orderBy(F.desc("rank_score"), F.desc(F.coalesce(F.nanvl("holdout_macro_f1", F.lit(-1.0)), F.lit(-1.0))), "model")
    return scored.withColumn("rank", F.row_number().over(order))


def selection_table(spark, chosen: list[str], weights: dict, specs: dict, ranking: DataFrame) -> DataFrame:
    """Ranked selection with component specs and metrics (see ``ranked_models``)."""
    rows = [
        (i + 1, n, specs[n][0].kind, _as_json(specs[n][0].params), specs[n][1].kind, _as_json(specs[n][1].params), weights[n])
        for i, n in enumerate(chosen)
    ]
    base = spark.createDataFrame(
        rows, "rank int, name string, vec_class string, vec_params string, clf_type string, clf_params string, weight double"
    )
    return base.join(ranking.select(F.col("model").alias("name"), "holdout_macro_f1", "cv_macro_f1_mean"), "name", "left").select(
        "rank", "name",
        F.struct(F.col("vec_class").alias("class"), F.col("vec_params").alias("params")).alias("vectorizer"),
        F.struct(F.col("clf_type").alias("type"), F.col("clf_params").alias("params")).alias("classifier"),
        F.struct("holdout_macro_f1", "cv_macro_f1_mean").alias("metrics"), "weight",
    )


def write_selection(selection: DataFrame, path: str) -> None:
    write_json(selection_document(selection), path)


def ensemble_members(selection: DataFrame | None) -> list[tuple[str, Component, Component, float]]:
    """Specs from a selection document, or the default pair with weight 1."""
    if selection is not None:
        rows = selection.orderBy("rank").collect()
        if rows:
            return [
                (r["name"], Component(r["name"], r["vec_class"], json.loads(r["vec_params"])),
                 Component(r["name"], r["clf_type"], json.loads(r["clf_params"])), r["weight"])
                for r in rows
            ]
    return [(n, Component(n, v, vp), Component(n, c, cp), 1.0) for n, v, vp, c, cp in DEFAULT_PAIR]


def run_ensemble(
    corpus: DataFrame, members: list[tuple[str, Component, Component, float]], test_size: float = 0.3,
    seed: int = 42, store: StudyStore | None = None, out: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train the members on one holdout, vote, and return ``(votes, summary)``.

    ``summary`` has the accuracy of every member, of the ensemble, and the split sizes.
    """
    spark = corpus.sparkSession
    store = store or StudyStore(spark)
    parts = split.holdout(corpus, test_size, seed)
    split_id = split.split_fingerprint(parts).first()["split_id"]
    labels = labels_of(corpus)
    train, test = parts.filter("part = 'train'"), parts.filter("part = 'test'")
    runs = []
    for name, vec, clf, _ in members:
        runs += _run_combos(train, test, split_id, vec, [clf], labels, store, train, 1, {"scope": "train"}, names={clf.name: name})
    preds = store.all_predictions(split_id, [r["key"] for r in runs])
    weights = spark.createDataFrame(
        [(r["model"], float(m[3])) for r, m in zip(runs, members, strict=True)], "model string, weight double"
    )
    votes = ensemble.soft_vote(preds, weights, labels)
    members_acc = metrics.accuracy(preds, "model")
    sizes = profile.split_sizes(parts).select("n_train", "n_test").first()
    listed = members_acc.agg(
        F.sort_array(F.collect_list(F.struct(F.col("model").alias("name"), "accuracy"))).alias("models")
    )
    overall = votes.agg(F.avg((F.col("y_true") == F.col("y_pred")).cast("double")).alias("ensemble_accuracy"))
    models = [(r["name"], r["accuracy"]) for r in listed.first()["models"]]
    summary = spark.createDataFrame(
        [(models, overall.first()[0], sizes["n_train"], sizes["n_test"])],
        "models array<struct<name:string,accuracy:double>>, ensemble_accuracy double, n_train long, n_test long",
    )
    if out:
        write_predictions(votes, corpus, f"{out}/ensemble_predictions")
        write_json(summary, f"{out}/ensemble_summary")
    return votes, summary
