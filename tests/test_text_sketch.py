"""Frequent features of texts in two passes against plain counts of listed features."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexigrid.functions import text as tx
from lexigrid.operators import term_counts, text_sketch, vocab
from lexigrid.operators import features as ft


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    words = ["a", "é", "ab", "Straße", "x𝒳y", "naïve", "日本語", "w-w", "ﬁn", "longer words", "o"] + [f"r{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words[: rng.randrange(3, len(words))]) + rng.choice(["", "  ", "\t", "."]) for _ in range(rng.randrange(0, 40)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "  "), (None, "a ab ab"), (3, "ab ab é"), (3, "ab ab é")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()


def plain(corpus, analyzer, rng, strip=False):
    df, cf = Counter(), Counter()
    for r in corpus.select(tx.analyze(F.col("text"), analyzer, rng, strip).alias("g")).collect():
        df.update(set(r.g))
        cf.update(r.g)
    return df, cf


@pytest.mark.parametrize(
    "analyzer, rng, strip",
    [("word", (1, 1), False), ("word", (1, 3), True), ("space", (2, 3), False), ("char", (3, 3), False), ("char", (1, 4), True), ("char_wb", (3, 5), True), ("char_wb", (5, 6), False)],
)
def test_top_terms_equal_plain_counts(corpus, monkeypatch, analyzer, rng, strip):
    monkeypatch.setattr(text_sketch, "PIECE", 500)
    monkeypatch.setattr(text_sketch, "TABLE", 1 << 10)
    df, cf = plain(corpus, analyzer, rng, strip)
    for low, k in ((1, 7), (2, 40), (3, 100_000 // 2)):
        want = sorted((-cf[t], t) for t in cf if low <= df[t] <= 100)[:k]
        v = ft.NgramVectorizer(analyzer=analyzer, ngramRange=list(rng), stripAccents=strip, minDF=float(low), maxDF=100.0, maxFeatures=k)
        got = v.vocabulary(corpus).collect()
        assert {(r.term, r.df, r.cf) for r in got} == {(t, df[t], cf[t]) for _, t in want}


def test_a_term_of_several_sizes_is_one_term(spark):
    """Elements may hold a blank: the run of two elements and the element are the same term."""
    df = spark.createDataFrame([(["a", "b", "a b"],), (["a b"],), (["a", "b"],), (["c"] * 2,)], "g array<string>")
    got = vocab.fit_vocabulary(df, F.col("g"), max_features=1, sizes=(1, 2)).collect()
    assert [(r.term, r.df, r.cf) for r in got] == [("a b", 3, 4)]


def test_nothing_of_the_corpus_is_kept(corpus, monkeypatch):
    """A bounded vocabulary was fitted on counts of all features, kept in the executors' memory."""
    kept = []
    monkeypatch.setattr(term_counts, "keep", lambda df: kept.append(df) or df)
    monkeypatch.setattr(vocab, "keep", lambda df: kept.append(df) or df, raising=False)
    assert ft.NgramVectorizer(ngramRange=[1, 2], maxFeatures=5).vocabulary(corpus).count() == 5 and not kept


def test_tops_of_several_ranges_share_passes(corpus, monkeypatch):
    passes = []
    counts = text_sketch.TextSketch._counts
    monkeypatch.setattr(text_sketch.TextSketch, "_counts", lambda self, *a: passes.append(a) or counts(self, *a))
    tops = [((1, 1), 2, 5), ((1, 2), 2, 10), ((1, 3), 2, 30)]
    units, sizes, kind = tx.analyze_units(F.col("text"), "word", (1, 3))
    got = vocab.term_stats(corpus, units, sizes, kind, tops).collect()
    for i, (rng, low, k) in enumerate(tops):
        df, cf = plain(corpus, "word", rng)
        want = sorted((-cf[t], t) for t in cf if df[t] >= low)[:k]
        assert {(r.term, r.df, r.cf) for r in got if r.top == i} == {(t, df[t], cf[t]) for _, t in want}
    assert len(passes) <= 2
