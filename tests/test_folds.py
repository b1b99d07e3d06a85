"""Counts inside the row, heavy hitters, and folds by subtraction, each against a plain fit."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrid.functions import text as tx
from lexigrid.operators import folds, naive_bayes, term_counts, vocab
from lexigrid.operators.classifiers import fit_classifier
from lexigrid.operators.features import NgramVectorizer, featurize
from lexigrid.plans import study
from lexigrid.sources.cache import StudyStore
from lexigrid.sources.corpus import documents

def grams():
    return tx.ws_tokens(F.col("text"))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 3000}"
    rows = [(i, " ".join(word() for _ in range(rng.randrange(0, 60))), rng.choice(["a", "b", "c", None])) for i in range(300)]
    rows += [(1000, None, "a"), (1001, "", "b"), (None, "w1 w2 w2 only", "c"), (7, "w1 again under a used id", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(5).cache()


def plain_stats(corpus):
    df, cf = Counter(), Counter()
    for r in corpus.collect():
        words = (r.text or "").lower().split()
        df.update(set(words))
        cf.update(words)
    return df, cf


def test_counts_in_the_row(corpus):
    df, cf = plain_stats(corpus)
    got = {r.term: (r.df, r.cf) for r in vocab.term_stats(corpus, grams()).collect()}
    assert got == {t: (df[t], cf[t]) for t in cf}
    counted = term_counts.counted_documents(corpus, grams(), "doc_id", "label")
    for r in counted.filter("doc_id = 1001 or doc_id = 1000").collect():
        assert r.terms == [] and r.tfs == []
    again = term_counts.partial_counts(counted, "label")
    assert {r.term: (r.df, r.cf) for r in term_counts.summed(again).collect()} == got
    by_label = {r.label: r.df for r in again.filter("term is null").groupBy("label").agg(F.sum("df").alias("df")).collect()}
    assert by_label == {r.label: r["count"] for r in corpus.groupBy("label").count().collect()}


def test_long_rows_are_cut_into_pieces(corpus, monkeypatch):
    want = {r.term: (r.df, r.cf) for r in vocab.term_stats(corpus, grams()).collect()}
    batch = next(iter(corpus.select(F.split("text", " ").alias("terms")).toArrow().to_batches()))
    monkeypatch.setattr(term_counts, "PIECE", 40)
    pieces = list(term_counts._pieces([batch], "terms"))
    assert sum(p.num_rows for p in pieces) == batch.num_rows and len(pieces) > 3 and len(want) > 100


@pytest.mark.parametrize("bounds", [(1, 1.0, 20), (2, 0.2, 50), (3, 10, 30), (0.02, 0.5, 5), (2, 1.0, 100_000), (40, 1.0, 50)])
def test_heavy_hitters_equal_a_full_count(corpus, bounds, monkeypatch):
    monkeypatch.setattr(term_counts, "BUCKETS_PER_TERM", 2)  # many collisions
    low, high, k = bounds
    df, cf = plain_stats(corpus)
    n = corpus.count()
    a, b = low * n if isinstance(low, float) else low, high * n if isinstance(high, float) else high
    kept = sorted((t for t in cf if a <= df[t] <= b), key=lambda t: (-cf[t], t))[:k]
    got = vocab.fit_vocabulary(corpus, grams(), low, high, k).collect()
    assert {(r.term, r.idx, r.df, r.cf) for r in got} == {(t, i, df[t], cf[t]) for i, t in enumerate(sorted(kept))}


def test_only_candidates_are_shuffled(spark):
    """Terms that occur once are counted in the sketch, but leave few rows for the exact counts."""
    rows = [(i, " ".join([f"common{j}" for j in range(20)] + [f"rare{i}x{j}" for j in range(200)])) for i in range(400)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counts = term_counts.partial_counts(corpus.select(grams().alias("terms"))).cache()
    sketch = term_counts.Sketch(counts, 20)
    left = sketch.candidates(max(1, sketch.above(40)))
    assert counts.count() > 80_000 and left.count() < 4_000
    top = vocab.top_of(counts, 400, 2, 1.0, 20).collect()
    assert {(r.term, r.cf) for r in top} == {(f"common{j}", 400) for j in range(20)}


@pytest.mark.parametrize("bounds", [{}, {"max_features": 15}, {"min_df": 2, "max_df": 0.3, "max_features": 40}])
def test_folds_equal_fits_on_their_training_parts(corpus, bounds):
    tagged = corpus.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(3)).cast("int"))
    stats = folds.FoldStatistics.of(term_counts.counted_documents(tagged, grams(), "label", "fold"))
    vocabularies = stats.collected(10_000, **bounds)
    counts = stats.class_counts(vocabularies)
    for fold in range(3):
        train = tagged.filter(F.col("fold") != fold)
        want = sorted(vocab.fit_vocabulary(train, grams(), **bounds).collect(), key=lambda r: r.idx)
        assert vocabularies[fold].terms == [r.term for r in want]
        assert np.allclose(vocabularies[fold].idf, [r.idf for r in want], rtol=1e-14)
        params = {"minDF": float(bounds.get("min_df", 1)), "maxDF": float(bounds.get("max_df", 1.0)), "maxFeatures": bounds.get("max_features", 0)}
        model = NgramVectorizer(analyzer="space", weighting="count", **params).fit(train)
        vectors = featurize(model, train, "label").cache()
        plain = naive_bayes.class_term_counts(vectors, len(want))
        assert plain.labels == counts[fold].labels and np.allclose(plain.counts, counts[fold].counts)  # MLlib sums through means
        closed, fitted = folds.complement_nb_from(counts[fold], 0.5), fit_classifier("cnb", vectors, {"alpha": 0.5})
        test = featurize(model, tagged.filter(F.col("fold") == fold), "doc_id", "label")
        a, b = (sorted((r.doc_id or -1, r.y_pred, *np.round(r.proba, 9)) for r in m.predict(test).collect()) for m in (closed, fitted))
        assert a == b
    stats.close()


@pytest.mark.parametrize("weighting", ["count", "tfidf"])
def test_vectors_of_counted_documents(corpus, weighting):
    model = NgramVectorizer(analyzer="space", minDF=2.0, maxFeatures=60, weighting=weighting)
    rows = model.vocabulary(corpus).collect()
    want = featurize(model.model_from(rows), corpus, "doc_id", "text").collect()
    ordered = sorted(rows, key=lambda r: r.idx)
    vocabulary = folds.FoldVocabulary([r.term for r in ordered], np.array([r.idf for r in ordered]))
    got = folds.counted_vectors(term_counts.counted_documents(corpus, grams(), "doc_id", "text"), vocabulary, weighting, "doc_id", "text").collect()
    a, b = (sorted(((r.doc_id or -1, r.text or "", r.features.size, r.features.indices.tolist(), np.round(r.features.values, 12).tolist()) for r in x)) for x in (got, want))
    assert a == b


def test_cv_study_reads_the_texts_once(spark, corpus):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    rows = corpus.filter("label is not null").select("doc_id", "text", "label").persist()
    watched = rows.withColumn("text", seen("text"))
    vectorizers = [study.Component(f"w{size}", kind, {"analyzer": "space", "max_features": size}) for size, kind in ((20, "count"), (50, "count"), (30, "tfidf"))]
    classifiers = [study.Component("nb1", "cnb", {"alpha": 1.0}), study.Component("nb2", "cnb", {"alpha": 0.2})]
    out = study.cv_study(watched, vectorizers, classifiers, k=4, parallelism=1)
    assert read.value == rows.count()
    assert len(out.runs) == 3 * 2 * 4 and {r["status"] for r in out.runs} == {"ok"}
    assert out.predictions.count() == 6 * rows.count()


def test_second_cv_study_trains_nothing(spark, small, tmp_path):
    corpus, store = documents(spark, small), StudyStore(spark, str(tmp_path / "s"))
    args = corpus, [study.Component("w", "count", {"max_features": 50})], [study.Component("nb", "cnb", {})]
    first = study.cv_study(*args, k=2, store=store)
    again = study.cv_study(*args, k=2, store=store)
    assert {r["status"] for r in first.runs} == {"ok"} and {r["status"] for r in again.runs} == {"cached"}
    assert first.predictions.exceptAll(again.predictions).isEmpty()


@pytest.mark.parametrize("sizes", [(1, 1), (1, 2), (2, 3), (3, 5)])
def test_neighbours_joined_in_batches_equal_word_ngrams(corpus, sizes):
    text = F.coalesce("text", F.lit(""))
    parts, left = tx.analyze_parts(text, "space", sizes)
    want = {r.term: (r.df, r.cf) for r in vocab.term_stats(corpus, tx.analyze(text, "space", sizes)).collect()}
    assert {r.term: (r.df, r.cf) for r in vocab.term_stats(corpus, parts, left).collect()} == want
    assert tx.analyze_parts(text, "char", (3, 3))[1] == (1, 1)
