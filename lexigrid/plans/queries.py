"""Registered queries over the test tables; their SQL twins live in ``oracle.py``."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.functions import text as tx
from lexigrid.functions.vectors import argmax_index, array_to_vector, masked_mean_pool, vector_to_array
from lexigrid.operators import diversity, embed, ensemble, metrics, profile, split, sweep, vocab
from lexigrid.operators.classifiers import fit_classifier, training_labels
from lexigrid.operators.features import (
    NgramVectorizer,
    count_long,
    feature_variance,
    featurize,
    flag_columns,
    stack_features,
    stack_long,
    tfidf_long,
    vector_entries,
)
from lexigrid.operators.naive_bayes import (
    class_term_counts,
    cnb_scores_long,
    cnb_weights_long,
    predict_models,
)
from lexigrid.plans import study
from lexigrid.session import broadcast_if_small, keep, spread
from lexigrid.sources.cache import StudyStore
from lexigrid.sources.corpus import as_corpus, documents, pick, read_delimited, table
from lexigrid.sources.sinks import correlation_matrix, export_vectors, read_selection, write_predictions, write_results

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Patterns for the personal data and licence lines in the test tables.
DATA_PATTERNS = {
    "has_email": r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}",
    "has_card": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
    "has_license": tx.whole_word("licen[cs]ed?|copyright"),
    "has_ipv4": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
}
ALL_PATTERNS = {**tx.FLAG_PATTERNS, **DATA_PATTERNS}

WORDS_12 = {"analyzer": "word", "ngramRange": [1, 2], "minDF": 2.0, "maxDF": 0.9, "maxFeatures": 1000}

# rows of a quick study, below the size of every test table
FIRST_ROWS = 150

# name, analyzer, vocabulary size, alpha: the models behind the diversity and voting queries
CNB_MODELS = (
    ("w20", "word", 20, 1.0),
    ("w100", "word", 100, 0.5),
    ("w500", "word", 500, 1.0),
    ("c100", "char", 100, 1.0),
    ("c300", "char", 300, 0.5),
)


# name, analyzer, n-gram range, least document frequency, vocabulary size
SPACES = (
    ("word_1_1_500", "word", (1, 1), 2, 500),
    ("word_1_2_1000", "word", (1, 2), 2, 1000),
    ("word_1_3_1000", "word", (1, 3), 2, 1000),
    ("char_3_3_300", "char", (3, 3), 2, 300),
    ("char_wb_3_5_1000", "char_wb", (3, 5), 2, 1000),
)


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _digest(grams):
    return [F.size(grams).alias("n"), F.md5(F.array_join(grams, "|")).alias("digest")]


# --- sources, projections, text -------------------------------------------


@query
def corpus_select(spark, sf):
    docs = table(spark, sf, "documents")
    chosen = docs.select(pick(docs, 0), pick(docs, "text"), pick(docs, 2)).toDF("row_id", "req_text", "profession")
    return chosen.select("row_id", "profession", F.length("req_text").alias("n_chars"))


@query
def null_to_text(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    joined = docs.select("doc_id", "text").join(labels, "doc_id", "left")
    return joined.select(
        "doc_id", tx.as_text(F.col("quality")).alias("quality_text"), F.length(tx.as_text(F.col("text"))).alias("n_chars")
    )


@query
def class_balance(spark, sf):
    return profile.class_balance(documents(spark, sf).drop("text"))


@query
def first_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.length("text").alias("n_chars"))
    return split.first_rows(docs, FIRST_ROWS)


@query
def ws_tokens(spark, sf):
    return documents(spark, sf).select("doc_id", *_digest(tx.ws_tokens(F.col("text"))))


@query
def word_ngrams(spark, sf):
    toks = documents(spark, sf).select("doc_id", tx.word_tokens(F.col("text")).alias("t"))
    return toks.select("doc_id", *_digest(tx.word_ngrams(F.col("t"), 1, 3)))


@query
def char_ngrams(spark, sf):
    return documents(spark, sf).select("doc_id", *_digest(tx.char_ngrams(F.col("text"), 3, 5)))


@query
def char_wb_ngrams(spark, sf):
    return documents(spark, sf).select("doc_id", *_digest(tx.char_wb_ngrams(F.col("text"), 3, 5)))


@query
def strip_accents_tokens(spark, sf):
    grams = tx.analyze(F.col("text"), "word", (1, 1), strip=True)
    return documents(spark, sf).select("doc_id", *_digest(grams))


@query
def stopword_filter(spark, sf):
    grams = tx.drop_stop_words(tx.word_tokens(F.col("text")), tx.STOP_PT)
    return documents(spark, sf).select("doc_id", *_digest(grams))


@query
def clean_tokens(spark, sf):
    return documents(spark, sf).select("doc_id", *_digest(tx.clean_tokens(F.col("text"))))


@query
def top_tokens_per_class(spark, sf):
    return profile.top_tokens(documents(spark, sf), tx.clean_tokens(F.col("text")), 30)


@query
def regex_flags(spark, sf):
    return documents(spark, sf).select(
        "doc_id", *[c.cast("int").alias(n) for c, n in zip(tx.regex_flags(F.col("text"), ALL_PATTERNS), ALL_PATTERNS)]
    )


@query
def flag_counts(spark, sf):
    """The 0/1 block summed per class."""
    flags = documents(spark, sf).select("label", *flag_columns(F.col("text"), ALL_PATTERNS))
    return flags.groupBy("label").agg(*[F.sum(n).cast("long").alias(n) for n in ALL_PATTERNS])


@query
def subword_ngrams(spark, sf):
    """Sub-word grams of every distinct token of the whole corpus, with their buckets."""
    toks = documents(spark, sf).select(F.explode(tx.ws_tokens(F.col("text"))).alias("token")).distinct()
    grams = toks.select(F.explode(tx.subword_ngrams(F.col("token"), 3, 6)).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count("*").alias("n_tokens"))
    return counted.groupBy(tx.md5_bucket(F.col("gram"), 1000).alias("bucket")).agg(
        F.count("*").alias("n_grams"), F.sum("n_tokens").alias("n_tokens")
    )


# --- vocabulary and features ----------------------------------------------


@query
def vocab_fit(spark, sf):
    v = NgramVectorizer(**WORDS_12).vocabulary(documents(spark, sf))
    return v.select("term", "idx", "df", "cf", F.round("idf", 9).alias("idf"))


@query
def feature_names(spark, sf):
    v = NgramVectorizer(analyzer="char_wb", ngramRange=[3, 5], minDF=3.0, maxFeatures=500, stripAccents=True)
    return v.vocabulary(documents(spark, sf)).select("idx", "term")


@query
def vocab_fit_scopes(spark, sf):
    """Vocabulary of the training part against the leak-prone one of the whole corpus."""
    parts = split.holdout(documents(spark, sf), 0.3)
    v = NgramVectorizer(analyzer="word", minDF=2.0, maxFeatures=300)
    out = None
    for scope, df in (("all", parts), ("train", parts.filter("part = 'train'"))):
        one = v.vocabulary(df).select(F.lit(scope).alias("scope"), "term", "idx", "df", F.round("idf", 9).alias("idf"))
        out = one if out is None else out.unionByName(one)
    return out


@query
def count_vectors(spark, sf):
    corpus = documents(spark, sf)
    model = NgramVectorizer(**WORDS_12, weighting="count").fit(corpus)
    cells = vector_entries(featurize(model, corpus, "doc_id"), "doc_id")
    return cells.select("doc_id", "idx", F.col("value").cast("long").alias("tf"))


@query
def tfidf(spark, sf):
    corpus = documents(spark, sf)
    model = NgramVectorizer(**WORDS_12).fit(corpus)
    cells = vector_entries(featurize(model, corpus, "doc_id"), "doc_id")
    return cells.select("doc_id", "idx", F.round("value", 9).alias("value"))


@query
def tfidf_unbounded(spark, sf):
    """TF-IDF over the full vocabulary, joined on the term instead of collected."""
    corpus = documents(spark, sf)
    grams = tx.word_tokens(F.col("text"))
    v = vocab.fit_vocabulary(corpus, grams)
    cells = tfidf_long(corpus, grams, v)
    return cells.groupBy("doc_id").agg(
        F.count("idx").alias("n_terms"),
        F.coalesce(F.sum("idx"), F.lit(0)).alias("idx_sum"),
        F.round(F.sum("value"), 6).alias("value_sum"),
    )


@query
def tfidf_word_char_flags(spark, sf):
    """Word TF-IDF, character TF-IDF and indicator columns stacked side by side."""
    corpus = documents(spark, sf)
    word = NgramVectorizer(analyzer="word", ngramRange=[1, 2], minDF=3.0, maxDF=0.9, maxFeatures=300,
                           stripAccents=True, outputCol="word").fit(corpus)
    char = NgramVectorizer(analyzer="char_wb", ngramRange=[3, 5], minDF=3.0, maxFeatures=300,
                           stripAccents=True, outputCol="char").fit(corpus)
    wide = featurize(word, corpus, "doc_id", "text", out="word")
    wide = featurize(char, wide, "doc_id", "text", "word", out="char")
    wide = wide.select("doc_id", "word", "char", *flag_columns(F.col("text"), ALL_PATTERNS))
    stacked = stack_features(wide, ["word", "char", *ALL_PATTERNS])
    return vector_entries(stacked, "doc_id").select("doc_id", "idx", F.round("value", 9).alias("value"))


@query
def hstack_long(spark, sf):
    """Word and character counts side by side in long form, per label."""
    corpus = documents(spark, sf)
    blocks = []
    for grams in (tx.word_tokens(F.col("text")), tx.char_ngrams(F.col("text"), 3, 3)):
        v = vocab.stored_vocabulary(corpus, grams, min_df=2, max_features=200)
        cells = count_long(corpus, grams, v, "label").select("label", "idx", F.col("tf").alias("value"))
        blocks.append((cells, 200))
    return stack_long(blocks, "label").groupBy("label", "idx").agg(F.sum("value").alias("value"))


@query
def feature_space_profile(spark, sf):
    """Size of five candidate feature spaces, and which fit a dense limit."""
    corpus = documents(spark, sf)
    n = corpus.count()
    out = None
    for analyzer in dict.fromkeys(a for _, a, *_ in SPACES):
        # a term's counts do not depend on the range it is asked for in: the spaces of an analyzer share their passes
        spaces = [x for x in SPACES if x[1] == analyzer]
        units, sizes, kind = tx.analyze_units(F.col("text"), analyzer, (min(x[2][0] for x in spaces), max(x[2][1] for x in spaces)))
        stats = vocab.term_stats(corpus, units, sizes, kind, [(rng, min_df, size) for _, _, rng, min_df, size in spaces])
        for i, (name, _, _, min_df, size) in enumerate(spaces):
            one = vocab.space_profile(stats.filter(F.col("top") == i).drop("top"), n, name, min_df, size)
            out = one if out is None else out.unionByName(one)
    return out.select(
        "candidate", "n_docs", "n_terms", "nnz", F.round("density", 9).alias("density"),
        F.round("dense_gb", 9).alias("dense_gb"), F.round("sparse_gb", 9).alias("sparse_gb"),
        (F.col("dense_gb") <= 0.005).alias("fits_dense"),
    )


@query
def rbf_gamma_scale(spark, sf):
    v = table(spark, sf, "embeddings").select(F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    out = feature_variance(v, "embedding", 64)
    return out.select("n_rows", F.round("variance", 6).alias("variance"), F.round("gamma", 6).alias("gamma"))


@query
def doc_mean_vector(spark, sf):
    """Mean vector of the known words: word i of the whole vocabulary has the i-th vector of the
    embedding table, which starts over after its last one."""
    corpus = documents(spark, sf)
    given = table(spark, sf, "embeddings")
    words = vocab.stored_vocabulary(corpus, tx.ws_tokens(F.col("text"))).withColumn("at", F.col("idx") % given.count())
    vectors = given.select(F.col("vec_id").alias("at"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    means = embed.mean_of_known(corpus, tx.ws_tokens(F.col("text")), vectors, 64, words.select(F.col("term").alias("word"), "at"))
    return means.select(
        "doc_id",
        "n_known",
        F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 6).alias("component_sum"),
        F.round(F.get("vector", F.lit(0)), 6).alias("first_component"),
    )


@query
def masked_mean_pool_rows(spark, sf):
    """Each 64-cell vector read as eight token vectors of eight cells; a token counts if its
    first cell is positive."""
    tokens = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda t: F.slice("embedding", t * 8 + 1, F.lit(8)))
    e = table(spark, sf, "embeddings").select("vec_id", tokens.alias("t"))
    mask = F.transform("t", lambda v: F.when(v[0] > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    pooled = e.select("vec_id", masked_mean_pool(F.col("t"), mask).alias("v"))
    return pooled.select("vec_id", F.posexplode("v").alias("dim", "x")).select(
        "vec_id", "dim", F.round("x", 6).alias("x")
    )


@query
def argmax_label(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", argmax_index(F.col("embedding")).alias("best"))


# --- splits and labels ----------------------------------------------------


@query
def stratified_holdout(spark, sf):
    return split.holdout(documents(spark, sf).drop("text"), 0.3).select("doc_id", "label", "part")


@query
def plain_holdout(spark, sf):
    return split.holdout(documents(spark, sf).drop("text"), 0.2, seed=7, stratify=None).select("doc_id", "part")


@query
def stratified_kfold(spark, sf):
    return split.kfold(documents(spark, sf).drop("text"), 5).select("doc_id", "label", "fold")


@query
def stratified_kfold_ordered(spark, sf):
    return split.kfold(documents(spark, sf).drop("text"), 3, seed=None).select("doc_id", "label", "fold")


@query
def split_fingerprint(spark, sf):
    return split.split_fingerprint(split.holdout(documents(spark, sf).drop("text"), 0.3))


@query
def split_sizes(spark, sf):
    return profile.split_sizes(split.holdout(documents(spark, sf).drop("text"), 0.3))


@query
def label_space(spark, sf):
    parts = split.holdout(documents(spark, sf).drop("text"), 0.3)
    return profile.label_space(parts.filter("part = 'train'"), parts.filter("part = 'test'"))


@query
def label_encode(spark, sf):
    corpus = documents(spark, sf).drop("text")
    codes = profile.label_space(corpus)
    coded = corpus.join(broadcast_if_small(codes), "label")
    back = codes.select(F.col("idx").alias("idx2"), F.col("label").alias("decoded"))
    return coded.join(broadcast_if_small(back), F.col("idx").cast("double").cast("int") == F.col("idx2")).select(
        "doc_id", "label", "idx", "decoded"
    )


@query
def class_weights(spark, sf):
    w = profile.class_weights(documents(spark, sf).drop("text"))
    return w.select("label", "n", F.round("inverse", 9).alias("inverse"), F.round("balanced", 9).alias("balanced"))


# --- complement naive Bayes -----------------------------------------------


def _word_counts(spark, sf, label, size=500):
    """Split corpus with word-count vectors, vocabulary fitted on the training part."""
    parts = split.holdout(documents(spark, sf, label), 0.3)
    v = NgramVectorizer(analyzer="word", minDF=2.0, maxFeatures=size, weighting="count")
    model = v.fit(parts.filter("part = 'train'"))
    return parts, model, featurize(model, parts, "doc_id", "label", "part")


def _width(model) -> int:
    return len(model.stages[1].vocabulary)


@query
def cnb_fit(spark, sf):
    parts = split.holdout(documents(spark, sf), 0.3)
    grams = tx.word_tokens(F.col("text"))
    train = parts.filter("part = 'train'")
    v = vocab.stored_vocabulary(train, grams, min_df=2, max_features=500)
    cells = count_long(train, grams, v, "label")
    w = cnb_weights_long(cells, v, 1.0)
    return w.select("label", "idx", F.round("weight", 9).alias("weight"))


@query
def cnb_predict(spark, sf):
    _, model, rows = _word_counts(spark, sf, "lang")
    t = class_term_counts(rows.filter("part = 'train'"), _width(model))
    preds = predict_models(rows.filter("part = 'test'"), {"cnb": t.weights(1.0)}, t.labels)
    return preds.select("doc_id", "y_true", "y_pred", F.round(F.array_max("proba"), 6).alias("p_best"))


@query
def cnb_score_long(spark, sf):
    """Scores per document and class through joins, for vocabularies of any size."""
    parts = split.holdout(documents(spark, sf), 0.3)
    grams = tx.word_tokens(F.col("text"))
    train, test = parts.filter("part = 'train'"), parts.filter("part = 'test'")
    v = vocab.stored_vocabulary(train, grams, min_df=2, max_features=500)
    w = cnb_weights_long(count_long(train, grams, v, "label"), v, 1.0)
    labels = [r["label"] for r in profile.label_space(parts).orderBy("idx").collect()]
    s = cnb_scores_long(count_long(test, grams, v, "doc_id"), test, w, labels)
    return s.select("doc_id", "label", F.round("score", 5).alias("score"))


@query
def align_proba(spark, sf):
    """A model that has not seen one class still yields a probability for every label."""
    _, model, rows = _word_counts(spark, sf, "lang")
    train = rows.filter("part = 'train' AND label <> 'es'")
    t = class_term_counts(train, _width(model))
    preds = predict_models(rows.filter("part = 'test'"), {"no_es": t.weights(1.0)}, t.labels)
    seen = F.array(*[F.lit(x) for x in t.labels])
    long = preds.select("doc_id", "model", F.inline(F.arrays_zip(seen.alias("label"), F.col("proba").alias("p"))))
    labels = [r["label"] for r in profile.label_space(rows).orderBy("idx").collect()]
    aligned = ensemble.align_long(long, labels)
    return aligned.select("doc_id", F.posexplode("proba").alias("label_idx", "p")).select(
        "doc_id", "label_idx", F.round("p", 6).alias("p")
    )


# --- several models on a lossy binary label -------------------------------


def model_predictions(spark, sf) -> DataFrame:
    """Predictions of the ``CNB_MODELS`` on the test part of the ``quality`` corpus."""
    parts = split.holdout(documents(spark, sf, "quality"), 0.3)
    train = parts.filter("part = 'train'")
    out = None
    for analyzer, rng in (("word", [1, 1]), ("char", [3, 3])):
        wanted = [m for m in CNB_MODELS if m[1] == analyzer]
        v = NgramVectorizer(analyzer=analyzer, ngramRange=rng, minDF=2.0,
                            maxFeatures=max(m[2] for m in wanted), weighting="count")
        terms = v.vocabulary(train).collect()
        model = v.model_from(terms)
        rows = featurize(model, parts, "doc_id", "label", "part")
        t = class_term_counts(rows.filter("part = 'train'"), len(terms))
        cf = np.array([r["cf"] for r in sorted(terms, key=lambda r: r["idx"])])
        order = np.lexsort((np.arange(len(cf)), -cf))
        weights = {}
        for name, _, size, alpha in wanted:
            mask = np.zeros(len(cf), dtype=bool)
            mask[order[:size]] = True
            weights[name] = t.weights(alpha, mask)
        preds = predict_models(rows.filter("part = 'test'"), weights, t.labels)
        out = sweep.union_predictions(preds) if out is None else sweep.union_predictions(out, preds)
    return out


QUALITY_LABELS = ["0", "1"]


@query
def union_predictions(spark, sf):
    p = model_predictions(spark, sf)
    return p.select("doc_id", "model", "y_true", "y_pred", F.round(F.get("proba", F.lit(1)), 6).alias("p1"))


@query
def confusion(spark, sf):
    return metrics.confusion(model_predictions(spark, sf), "model")


@query
def accuracy_by_model(spark, sf):
    a = metrics.accuracy(model_predictions(spark, sf), "model")
    return a.select("model", "n", F.round("accuracy", 9).alias("accuracy"))


def _rounded(df, skip):
    return df.select(*[
        F.round(c, 9).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes
    ])


@query
def classification_report(spark, sf):
    return _rounded(metrics.classification_report(model_predictions(spark, sf), "model"), ())


@query
def macro_f1(spark, sf):
    return _rounded(metrics.scores(model_predictions(spark, sf), "model"), ())


@query
def report_json_expand(spark, sf):
    """Report archived as JSON text and expanded again."""
    report = metrics.per_class(metrics.confusion(model_predictions(spark, sf), "model"), "model")
    archived = metrics.archive_report(metrics.reports_as_rows(report, "model"))
    return _rounded(metrics.expand_report(archived, "model"), ())


@query
def cv_summary(spark, sf):
    """Mean and deviation over folds of each model's fold scores."""
    preds = model_predictions(spark, sf)
    folded = split.kfold(preds, 5, label="model")
    per_fold = metrics.scores(folded, "model", "fold")
    return _rounded(metrics.mean_std(per_fold, ["accuracy", "macro_f1"], "model"), ())


@query
def error_correlation(spark, sf):
    return _rounded(diversity.full_correlation(keep_predictions(spark, sf)), ())


def keep_predictions(spark, sf):
    return keep(model_predictions(spark, sf))


@query
def error_correlation_matrix(spark, sf):
    corr = diversity.full_correlation(keep_predictions(spark, sf))
    return _rounded(correlation_matrix(corr, sorted(m[0] for m in CNB_MODELS)), ())


@query
def pairwise_diversity(spark, sf):
    return _rounded(diversity.pairwise_diversity(keep_predictions(spark, sf)), ())


@query
def pair_lookup(spark, sf):
    """Statistics of each model against the best one, asked for in rank order."""
    preds = keep_predictions(spark, sf)
    ranked = [r["model"] for r in ensemble.rank_results(metrics.scores(preds, "model")).orderBy("rank").collect()]
    asked = spark.createDataFrame([(ranked[0], x) for x in ranked[1:]], "x string, y string")
    pairs = diversity.pairwise_diversity(preds).select("a", "b", "double_fault", "error_corr")
    return _rounded(diversity.pair_lookup(asked, pairs), ())


@query
def weight_normalize(spark, sf):
    s = metrics.scores(model_predictions(spark, sf), "model").select("model", F.col("macro_f1").alias("weight"))
    return _rounded(ensemble.normalise_weights(s), ())


@query
def soft_vote(spark, sf):
    preds = keep_predictions(spark, sf)
    weights = metrics.scores(preds, "model").select("model", F.col("macro_f1").alias("weight"))
    votes = ensemble.soft_vote(preds, weights, QUALITY_LABELS)
    return votes.select("doc_id", "y_true", "y_pred", F.round(F.get("proba", F.lit(1)), 6).alias("p1"))


@query
def rank_results(spark, sf):
    s = metrics.scores(model_predictions(spark, sf), "model")
    return _rounded(ensemble.rank_results(s).select("rank", "model", "macro_f1", "accuracy"), ())


@query
def top_models(spark, sf):
    s = metrics.scores(model_predictions(spark, sf), "model").select("model", "macro_f1", "accuracy")
    return _rounded(ensemble.top_models(s, 3), ())


@query
def rank_score(spark, sf):
    """Score of a model: cross-validated if present, else holdout.  Only models with a
    defined deviation over folds count as cross-validated here."""
    preds = keep_predictions(spark, sf)
    hold = metrics.scores(preds, "model").select("model", F.col("macro_f1").alias("holdout_macro_f1"))
    folds = metrics.mean_std(
        metrics.scores(split.kfold(preds, 5, label="model"), "model", "fold"), ["macro_f1"], "model"
    ).filter("macro_f1_std > 0.05").select("model", F.col("macro_f1_mean").alias("cv_macro_f1_mean"))
    return _rounded(ensemble.rank_score(hold.join(folds, "model", "left")), ())


@query
def voters(spark, sf):
    """Predictions of models that carry probabilities, after stacking one set that has none."""
    preds = keep_predictions(spark, sf)
    bare = preds.filter("model = 'w20'").select("doc_id", F.lit("bare").alias("model"), "y_true", "y_pred")
    stacked = sweep.union_predictions(preds, bare)
    return ensemble.with_probabilities(stacked).groupBy("model").agg(F.count("*").alias("n"))


@query
def param_sweep(spark, sf):
    """Macro-F1 of every (alpha, vocabulary size) in one scoring pass."""
    parts = split.holdout(documents(spark, sf, "quality"), 0.3)
    train = parts.filter("part = 'train'")
    v = NgramVectorizer(analyzer="word", minDF=2.0, maxFeatures=500, weighting="count")
    terms = v.vocabulary(train).collect()
    rows = featurize(v.model_from(terms), parts, "doc_id", "label", "part")
    cf = np.array([r["cf"] for r in sorted(terms, key=lambda r: r["idx"])])
    preds = sweep.cnb_grid(
        rows.filter("part = 'train'"), rows.filter("part = 'test'"), cf, [0.2, 0.5, 1.0, 2.0], [20, 100, 500]
    )
    return _rounded(metrics.scores(preds, "model").select("model", "accuracy", "macro_f1"), ())


@query
def candidate_scores(spark, sf):
    """Every vectorizer x alpha candidate ranked on the same corpus."""
    s = metrics.scores(model_predictions(spark, sf), "model")
    specs = spark.createDataFrame(list(CNB_MODELS), "model string, vectorizer string, size int, alpha double")
    ranked = ensemble.rank_results(s).join(F.broadcast(specs), "model")
    return _rounded(ranked.select("rank", "model", "vectorizer", "size", "alpha", "macro_f1"), ())


@query
def pending_scores(spark, sf):
    """Documents and models without a stored prediction: everything outside the test part."""
    corpus = documents(spark, sf, "quality").select("doc_id", "label")
    done = model_predictions(spark, sf)
    left = sweep.pending(corpus, [m[0] for m in CNB_MODELS], done)
    return left.groupBy("model").agg(F.count("*").alias("n_pending"), F.sum("doc_id").alias("id_sum"))


# --- trained models: row checks in the driver, quality tests in tests/ ----


def _dense(spark, sf) -> DataFrame:
    """Embedding vectors with their class as a split corpus."""
    e = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        F.col("label").cast("string").alias("label"),
        array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
    )
    return split.holdout(spread(e, "doc_id"), 0.3)


def _tfidf_split(spark, sf, label="lang", size=300) -> tuple[DataFrame, DataFrame]:
    parts = split.holdout(documents(spark, sf, label), 0.3)
    model = NgramVectorizer(analyzer="word", minDF=2.0, maxFeatures=size).fit(parts.filter("part = 'train'"))
    rows = keep(featurize(model, parts, "doc_id", "label", "part"))
    return rows.filter("part = 'train'"), rows.filter("part = 'test'")


def _trained(spark, sf, kind, params, dense=False) -> DataFrame:
    if dense:
        rows = keep(_dense(spark, sf))
        train, test = rows.filter("part = 'train'"), rows.filter("part = 'test'")
    else:
        train, test = _tfidf_split(spark, sf)
    fitted = fit_classifier(kind, train, params)
    return fitted.predict(test).select("doc_id", F.col("label").alias("y_true"), "y_pred", F.array_max("proba").alias("p_best"))


@query
def lr_ovr(spark, sf):
    return _trained(spark, sf, "logreg", {"C": 1.0, "max_iter": 50, "solver": "liblinear"})


@query
def lr_multinomial(spark, sf):
    return _trained(spark, sf, "logreg", {"C": 1.0, "max_iter": 50, "solver": "saga", "penalty": "elasticnet"})


@query
def rf(spark, sf):
    return _trained(spark, sf, "rf", {"n_estimators": 20, "max_depth": 8})


@query
def mlp(spark, sf):
    return _trained(spark, sf, "mlp", {"hidden_layer_sizes": [32], "max_iter": 40}, dense=True)


@query
def gbt_ovr(spark, sf):
    return _trained(spark, sf, "xgb", {"n_estimators": 5, "max_depth": 4})


@query
def linear_svc(spark, sf):
    return _trained(spark, sf, "linear_svc", {"C": 1.0, "max_iter": 30, "class_weight": "balanced"})


@query
def rff_svc(spark, sf):
    return _trained(spark, sf, "svc", {"C": 1.0, "n_components": 128, "max_iter": 30})


# Settings at which every family is fast.
QUICK_FITS = {
    "logreg": {"C": 10.0, "max_iter": 20, "solver": "liblinear"},
    "rf": {"n_estimators": 10, "max_depth": 6},
    "mlp": {"hidden_layer_sizes": [16], "max_iter": 30},
    "xgb": {"n_estimators": 3, "max_depth": 3},
    "svc": {"n_components": 64, "max_iter": 10},
    "linear_svc": {"max_iter": 10, "class_weight": "balanced"},
    "cnb": {"alpha": 1.0},
}


@query
def family_facts(spark, sf):
    """What must hold for every family: a row per test document, probabilities that sum to one,
    the label of the largest one, and more documents right than the majority class has."""
    train, test = _tfidf_split(spark, sf, size=150)
    out = None
    for kind, params in QUICK_FITS.items():
        fitted = fit_classifier(kind, train, params)
        names = F.array(*[F.lit(x) for x in fitted.labels])
        facts = fitted.predict(test).select(
            F.lit(kind).alias("family"), "doc_id", "label", (F.col("label") == F.col("y_pred")).alias("right"),
            (F.abs(F.aggregate("proba", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias("sums_to_one"),
            (F.get("proba", (F.array_position(names, F.col("y_pred")) - 1).cast("int")) == F.array_max("proba")).alias("is_largest"),
        )
        out = facts if out is None else out.unionByName(facts)
    largest = test.groupBy("label").count().agg(F.max("count")).first()[0]  # one row a class
    return out.groupBy("family").agg(
        F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"), F.bool_and("sums_to_one").alias("sums_to_one"),
        F.bool_and("is_largest").alias("is_largest"), (F.count_if("right") > largest).alias("beats_majority"),
    )


# Families that fit all classes at once, with settings at which their loss is followed.
SOFTMAX_FITS = {
    "boosted": ("xgb", {"n_estimators": 6, "max_depth": 4, "learning_rate": 0.3}),
    "network": ("mlp", {"hidden_layer_sizes": [1024], "activation": "relu", "alpha": 0.001, "dropout": 0.3, "batch_size": 32, "max_iter": 4}),
    "softmax": ("logreg", {"C": 10.0, "max_iter": 20, "solver": "saga", "penalty": "elasticnet", "l1_ratio": 0.2}),
}


@query
def softmax_facts(spark, sf):
    """What must hold for boosting, a network and softmax regression over several classes: a row per test document,
    probabilities that sum to one, a loss that falls with each round or iteration, and more documents
    right than the majority class has."""
    train, test = _tfidf_split(spark, sf, size=150)
    largest = test.groupBy("label").count().agg(F.max("count")).first()[0]  # one row a class
    out = None
    for name, (kind, params) in SOFTMAX_FITS.items():
        fitted = fit_classifier(kind, train, params)
        model = fitted.parts[0]
        losses = list(model.summary.objectiveHistory) if name == "softmax" else model.losses
        facts = fitted.predict(test).agg(
            F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"),
            F.bool_and(F.abs(F.aggregate("proba", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias("sums_to_one"),
            (F.count_if(F.col("label") == F.col("y_pred")) > largest).alias("beats_majority"),
        )
        one = facts.select(
            F.lit(name).alias("family"), "*", F.lit(all(a > b for a, b in zip(losses, losses[1:])) and len(losses) > 2).alias("loss_falls")
        )
        out = one if out is None else out.unionByName(one)
    return out


@query
def cnb_mllib(spark, sf):
    """Complement naive Bayes through Spark ML; equal to ``cnb_predict``."""
    parts, model, rows = _word_counts(spark, sf, "lang")
    fitted = fit_classifier("cnb", rows.filter("part = 'train'"), {"alpha": 1.0})
    out = fitted.predict(rows.filter("part = 'test'"))
    return out.select("doc_id", F.col("label").alias("y_true"), "y_pred", F.round(F.array_max("proba"), 6).alias("p_best"))


@query
def w2v_docvec(spark, sf):
    corpus = documents(spark, sf)
    vectors = embed.fit_word_vectors(corpus, vector_size=100, window=5, min_count=2, epochs=5)
    return vectors.transform(corpus).select("doc_id", vector_to_array("features").alias("vector"))


@query
def subword_facts(spark, sf):
    """Vectors whose words share character grams: the known words are those that occur twice, and each text's
    mean is over its known words only."""
    corpus = documents(spark, sf)
    found = embed.fit_word_vectors(corpus, vector_size=32, window=3, min_count=2, epochs=2, subwords=(3, 5), buckets=5000)
    texts = corpus.select(F.col("doc_id").alias("key"), "text")
    means = found.means(texts).select(F.col("key").alias("doc_id"), "n_known")
    words = found.vocabulary.count()
    return corpus.select("doc_id").join(means, "doc_id", "left").select(
        "doc_id", F.coalesce("n_known", F.lit(0)).alias("n_known"), F.lit(words).cast("long").alias("n_words")
    )


@query
def grid_search(spark, sf):
    """Elastic-net grid on exact folds, refitted and scored on the holdout."""
    train, test = _tfidf_split(spark, sf, "quality")
    labels = training_labels(train)
    coder = StringIndexerModel.from_labels(labels, inputCol="label", outputCol="label_idx")
    lr = LogisticRegression(labelCol="label_idx", standardization=False, maxIter=30)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.001, 0.01]).addGrid(lr.elasticNetParam, [0.0, 0.5]).build()
    best = study.grid_search(lr, grid, coder.transform(train), k=3)
    scored = best.transform(coder.transform(test)).select(
        F.col("label_idx").alias("y_true"), F.col("prediction").alias("y_pred")
    )
    points = spark.createDataFrame(
        [(i, float(p[lr.regParam]), float(p[lr.elasticNetParam]), float(m))
         for i, (p, m) in enumerate(zip(grid, best.avgMetrics))],
        "point int, reg_param double, elastic_net double, cv_macro_f1 double",
    )
    holdout = metrics.scores(scored).first()
    return points.withColumn("holdout_macro_f1", F.lit(holdout["macro_f1"]))


# The grid of the studies: count vectors and complement naive Bayes, which has a closed form.
NB_VECTORIZERS = [
    (name, "count", {"analyzer": analyzer, "ngram_range": [1, 1] if analyzer == "word" else [3, 3], "min_df": 2, "max_features": size})
    for name, analyzer, size, _ in CNB_MODELS
]
NB_CLASSIFIERS = [("a1", "cnb", {"alpha": 1.0}), ("a05", "cnb", {"alpha": 0.5})]
# limits that let several of these models vote
LOOSE = {"max_corr": 1.0, "max_models": 5}


def _specs(items):
    return [study.Component(*x) for x in items]


def _nb_study(spark, sf, store=None, label="quality", vectorizers=NB_VECTORIZERS, classifiers=NB_CLASSIFIERS[:1]):
    return study.holdout_study(documents(spark, sf, label), _specs(vectorizers), _specs(classifiers), store=store)


def _metrics_of(df, *keys):
    names = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1"]
    return _rounded(df.select(*keys, *names, "support"), ())


@query
def holdout_study(spark, sf):
    return _metrics_of(_nb_study(spark, sf, classifiers=NB_CLASSIFIERS).results(), "model", "vectorizer", "classifier", "status")


@query
def holdout_study_lang(spark, sf):
    """The same with more than two classes."""
    return _metrics_of(_nb_study(spark, sf, label="lang", vectorizers=NB_VECTORIZERS[:2]).results(), "model", "status")


@query
def cv_study(spark, sf):
    out = study.cv_study(documents(spark, sf, "quality"), _specs(NB_VECTORIZERS[:2] + NB_VECTORIZERS[3:4]), _specs(NB_CLASSIFIERS[:1]), k=3)
    return _rounded(study.cv_summary(out).select("model", "accuracy_mean", "accuracy_std", "macro_f1_mean", "macro_f1_std"), ())


# smoothing of the naive Bayes grid search
ALPHAS = (0.05, 0.2, 0.5, 1.0, 2.0)


@query
def grid_search_smoothing(spark, sf):
    """Smoothing of naive Bayes by macro-F1 over folds of the training part, refitted and scored on the rest."""
    return _rounded(study.smoothing_search(documents(spark, sf, "quality"), study.Component(*NB_VECTORIZERS[3]), list(ALPHAS)), ("alpha",))


def _selected(spark, preds, strategy, **limits) -> DataFrame:
    chosen, weights = study.choose_models(preds, QUALITY_LABELS, strategy, **limits)
    return _rounded(spark.createDataFrame([(i + 1, n, weights[n]) for i, n in enumerate(chosen)], "rank int, model string, weight double"), ())


@query
def select_threshold(spark, sf):
    return _selected(spark, keep_predictions(spark, sf), "threshold", max_corr=0.6, max_double_fault=0.12)


@query
def select_forward(spark, sf):
    return _selected(spark, keep_predictions(spark, sf), "forward", **LOOSE)


@query
def select_improve(spark, sf):
    return _selected(spark, keep_predictions(spark, sf), "improve", max_double_fault=1.0, **LOOSE)


def _end_to_end(spark, sf):
    """Study, selection written and read again, and the members' weighted vote; all come from the store."""
    corpus = documents(spark, sf, "quality")
    store = StudyStore(spark)
    grid = _nb_study(spark, sf, store)
    chosen, weights = study.choose_models(grid.predictions, grid.labels, "threshold", max_corr=1.0, max_double_fault=1.0, max_models=3)
    specs = {f"{v.name}+{c.name}": (v, c) for v in _specs(NB_VECTORIZERS) for c in _specs(NB_CLASSIFIERS)}
    table_ = study.selection_table(spark, chosen, weights, specs, study.ranked_models(metrics.scores(grid.predictions, "model")))
    study.write_selection(table_, f"{store.root}/selection")
    return study.run_ensemble(corpus, study.ensemble_members(read_selection(spark, f"{store.root}/selection")), store=store)


@query
def ensemble_end_to_end(spark, sf):
    votes, _ = _end_to_end(spark, sf)
    return votes.select("doc_id", "y_true", "y_pred", F.round(F.array_max("proba"), 6).alias("p_best"))


@query
def ensemble_summary(spark, sf):
    """The summary document: each member under its name, the vote, and the split's sizes."""
    _, summary = _end_to_end(spark, sf)
    return _rounded(summary.select(F.inline("models"), "ensemble_accuracy", "n_train", "n_test"), ())


# --- round trips through the writers and readers ---------------------------


@query
def delimited_round_trip(spark, sf):
    """The corpus written as delimited text with quoted, multi-line fields, and read again."""
    path = f"{StudyStore(spark).root}/corpus"
    docs = table(spark, sf, "documents").select("text", "lang", F.col("doc_id").alias("id"))
    docs.write.csv(path, header=True, sep=";", quote='"', escape='"', encoding="UTF-8", quoteAll=True)
    back = as_corpus(read_delimited(spark, path, "text string, lang string, id long", encoding="UTF-8"), 0, 1, 2)
    return back.select("doc_id", F.md5("text").alias("digest"), "label")


@query
def results_round_trip(spark, sf):
    path = f"{StudyStore(spark).root}/results"
    write_results(macro_f1(spark, sf), path)
    return spark.read.parquet(f"{path}/parquet")


@query
def prediction_table_round_trip(spark, sf):
    preds = keep_predictions(spark, sf).filter("model = 'w100'")
    path = f"{StudyStore(spark).root}/votes"
    write_predictions(preds.select("doc_id", "y_true", "y_pred"), documents(spark, sf, "quality"), path)
    back = spark.read.csv(path, schema="doc_id long, text string, true_label string, pred_ensemble string", header=True, multiLine=True, escape='"')
    return back.select("doc_id", F.length("text").cast("long").alias("n_chars"), "true_label", "pred_ensemble")


@query
def vector_export_round_trip(spark, sf):
    """Exported document vectors: length and squared norm of each."""
    docs = documents(spark, sf)
    model = NgramVectorizer(analyzer="word", minDF=2.0, maxFeatures=300).fit(docs)
    path = f"{StudyStore(spark).root}/vectors"
    export_vectors(featurize(model, docs, "doc_id", "label"), path)
    back = spark.read.parquet(path)
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    return back.select("doc_id", "label", F.size("vector").cast("long").alias("width"), F.round(norm, 6).alias("squared_norm"))


@query
def vocab_shares(spark, sf):
    """Document-frequency bounds as a share from below and a number from above."""
    v = NgramVectorizer(analyzer="word", minDF=0.01, maxDF=100.0).vocabulary(documents(spark, sf))
    return v.select("term", "idx", "df", "cf")
