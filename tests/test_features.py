import math

import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from lexigrid.functions import text as tx
from lexigrid import session
from lexigrid.operators import embed, vocab
from lexigrid.operators import features as ft
from lexigrid.functions.vectors import align_to_labels, argmax_index, array_to_vector, masked_mean_pool

TEXTS = [(1, "bb aa aa", "x"), (2, "bb cc", "y"), (3, "", "y"), (4, None, "x"), (5, "zz", "x")]


def corpus(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string, label string")


def grams():
    return tx.analyze(F.col("text"))


def test_vocabulary_counts_and_idf(spark):
    v = {r["term"]: r for r in vocab.fit_vocabulary(corpus(spark), grams()).collect()}
    assert [(t, v[t]["idx"], v[t]["df"], v[t]["cf"]) for t in sorted(v)] == [
        ("aa", 0, 1, 2), ("bb", 1, 2, 2), ("cc", 2, 1, 1), ("zz", 3, 1, 1),
    ]
    assert math.isclose(v["bb"]["idf"], math.log(6 / 3) + 1)


def test_bounds_that_cross_leave_no_term_and_no_model(spark):
    """A share of the documents passes a number of them as the corpus grows: the vocabulary is empty, as in SQL."""
    df = spark.createDataFrame([(i, "aa bb" if i % 2 else "aa cc") for i in range(40)], "doc_id long, text string")
    for size in (0, 5):
        v = ft.NgramVectorizer(minDF=0.1, maxDF=3.0, maxFeatures=size)
        assert v.vocabulary(df).select("term", "idx", "df", "cf").collect() == []
        with pytest.raises(ValueError):
            v.fit(df)
    assert [r["term"] for r in ft.NgramVectorizer(minDF=0.1, maxDF=20.0).vocabulary(df).orderBy("idx").collect()] == ["bb", "cc"]


def test_max_features_ties_by_term(spark):
    v = vocab.fit_vocabulary(corpus(spark), grams(), max_features=3).orderBy("idx").collect()
    assert [r["term"] for r in v] == ["aa", "bb", "cc"]


def test_top_terms_by_bins_equals_plain_order(spark):
    stats = spark.range(500).select(
        F.format_string("t%03d", "id").alias("term"), F.lit(1).alias("df"), (F.col("id") % 37 + 1).alias("cf")
    )
    for k in (1, 17, 200, 500, 900):
        plain = [r["term"] for r in vocab.top_terms(stats, k).collect()]
        binned = [r["term"] for r in vocab.top_terms(stats, k, merge_rows=0).collect()]
        assert plain == binned


def test_unbounded_index_equals_window(spark):
    terms = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("term"))
    a = {r["term"]: r["idx"] for r in vocab.alphabetical_index(terms, bounded=False).collect()}
    assert a == {t: i for i, t in enumerate(sorted(a))}


def test_tfidf_rows_have_norm_one_or_zero_and_match_long_form(spark):
    df = corpus(spark)
    model = ft.NgramVectorizer().fit(df)
    rows = {r["doc_id"]: r["features"].toArray() for r in ft.featurize(model, df, "doc_id").collect()}
    assert len(rows) == 5
    for i, v in rows.items():
        assert math.isclose(np.linalg.norm(v), 0.0 if i in (3, 4) else 1.0, abs_tol=1e-12)
    long = ft.tfidf_long(df, grams(), vocab.fit_vocabulary(df, grams())).collect()
    assert {r["doc_id"] for r in long if r["idx"] is None and r["value"] == 0} == {3, 4}
    for r in long:
        if r["idx"] is None:
            continue
        assert math.isclose(rows[r["doc_id"]][r["idx"]], r["value"], rel_tol=1e-12)
    assert sum(r["idx"] is not None for r in long) == sum(int((v > 0).sum()) for v in rows.values())


def test_hot_and_cold_lookup_equals_broadcast(spark, monkeypatch):
    df = corpus(spark)
    v = vocab.fit_vocabulary(df, grams())
    plain = sorted(map(tuple, ft.count_long(df, grams(), v, "doc_id").select("doc_id", "idx", "tf").collect()))
    monkeypatch.setattr(session, "BROADCAST_ROWS", 1)
    terms = df.select("doc_id", F.explode(grams()).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    split = sorted(map(tuple, ft.lookup_terms(terms, v, hot=2).select("doc_id", "idx", "tf").collect()))
    assert plain == split


def test_model_survives_storage(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df = corpus(spark)
    model = ft.NgramVectorizer(ngramRange=[1, 2]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a = [r["features"] for r in model.transform(df).orderBy("doc_id").collect()]
    b = [r["features"] for r in again.transform(df).orderBy("doc_id").collect()]
    assert a == b


def test_stack_keeps_order(spark):
    df = spark.createDataFrame([(1, "empresa")], "doc_id long, text string")
    model = CountVectorizerModel.from_vocabulary(["empresa", "x"], "g", "w")
    rows = model.transform(df.withColumn("g", grams())).select("doc_id", "w", *ft.flag_columns(F.col("text")))
    v = ft.stack_features(rows, ["w", *tx.FLAG_PATTERNS]).first()["features"].toArray()
    assert v.tolist() == [1.0, 0.0, 0, 0, 1.0, 0, 0, 0, 0, 0, 0, 0]


def test_gamma_counts_unstored_zeros(spark):
    df = corpus(spark)
    rows = ft.featurize(ft.NgramVectorizer(weighting="count").fit(df), df, "doc_id")
    dense = np.array([r["features"].toArray() for r in rows.collect()])
    out = ft.feature_variance(rows, "features", dense.shape[1]).first()
    assert math.isclose(out["variance"], dense.var())
    assert math.isclose(out["gamma"], 1 / (dense.shape[1] * dense.var()))


def test_mean_of_known_words(spark):
    df = spark.createDataFrame([(1, "a b b q"), (2, "q"), (3, None)], "doc_id long, text string")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 3.0])], "word string, v array<double>").select(
        "word", array_to_vector("v").alias("vector")
    )
    got = {r["doc_id"]: (r["n_known"], r["vector"]) for r in embed.mean_of_known(df, tx.ws_tokens(F.coalesce("text", F.lit(""))), vectors, 2).collect()}
    assert got[1][0] == 3 and np.allclose(got[1][1], [1 / 3, 2.0])
    assert got[2] == (0, [0.0, 0.0]) and got[3] == (0, [0.0, 0.0])


def test_masked_mean_pool_floor(spark):
    df = spark.createDataFrame(
        [(1, [[1.0, 2.0], [3.0, 4.0]], [1.0, 0.0]), (2, [[1.0, 2.0]], [0.0])], "i int, t array<array<double>>, m array<double>"
    )
    got = {r["i"]: r["v"] for r in df.select("i", masked_mean_pool(F.col("t"), F.col("m")).alias("v")).collect()}
    assert got == {1: [1.0, 2.0], 2: [0.0, 0.0]}


def test_argmax_and_alignment(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],)], "p array<double>")
    row = df.select(argmax_index(F.col("p")).alias("i"), align_to_labels(F.col("p"), ["a", "c", "d"], ["a", "b", "c", "d"]).alias("q")).first()
    assert row["i"] == 0 and row["q"] == [0.4, 0.0, 0.4, 0.2]


def test_word_vectors_ignore_unknown_tokens(spark):
    df = spark.createDataFrame([(i, "u v u v w") for i in range(20)] + [(99, "u unknown"), (100, "nothing")], "doc_id long, text string")
    fitted = embed.fit_word_vectors(df, vector_size=4, min_count=2)
    table = {r["word"]: np.array(r["vector"]) for r in fitted.table().collect()}
    assert set(table) == {"u", "v", "w"}
    rows = {r["doc_id"]: r["features"].toArray() for r in fitted.transform(df).collect()}
    assert np.allclose(rows[99], table["u"], atol=1e-5) and np.allclose(rows[100], 0)
    assert np.allclose(rows[0], (2 * table["u"] + 2 * table["v"] + table["w"]) / 5, atol=1e-5)


def test_encoder_gets_whole_texts(spark):
    def make():
        def predict(texts):
            return np.array([[len(t.split()), sum(map(ord, t))] for t in texts], dtype=np.float32).reshape(len(texts), 2)

        return predict

    df = spark.createDataFrame([(1, "a " * 5000), (2, "a b"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["features"].toArray().tolist() for r in embed.encode_texts(df, make).collect()}
    assert got[1][0] == 5000 and got[2] == [2.0, 227.0] and got[3] == [0.0, 0.0]


def test_frequency_bounds_as_shares_and_numbers(spark):
    df = spark.createDataFrame([(i, "all " + ("half " if i % 2 else "") + ("rare " if i == 1 else "")) for i in range(10)], "doc_id long, text string")

    def terms(**bounds):
        return {r["term"] for r in ft.NgramVectorizer(**bounds).vocabulary(df).collect()}

    assert terms() == {"all", "half", "rare"} and terms(minDF=0.5) == {"all", "half"} and terms(maxDF=5.0) == {"half", "rare"}
    assert terms(minDF=2.0, maxDF=0.5) == {"half"}


def test_words_that_share_vectors_have_the_means_of_their_own(spark, monkeypatch):
    """Repeated and missing ids, words without a vector, a vector given twice, one without cells; one and several blocks of vectors."""
    monkeypatch.setattr(embed, "SHARED_CELLS", 7)  # documents whose cells are added in parts
    words = [f"w{i}" for i in range(40)]
    rows = [(i % 25, " ".join(words[(i * j) % 40] for j in range(i % 9))) for i in range(60)] + [(None, "w1 w2"), (70, None), (71, "unknown")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    at = spark.createDataFrame([(w, i % 6) for i, w in enumerate(words)], "word string, at long")
    given = [(k, [float(k), k * 0.5 - 1, 1.0]) for k in (0, 1, 2, 3, 3)] + [(5, None)]
    vectors = spark.createDataFrame(given, "at long, vector array<double>")
    want = {}
    for doc_id, text in rows:
        n, own = want.setdefault(doc_id, [0, []])
        for w in (text or "").split():
            hits = [v for k, v in given if w in words and k == words.index(w) % 6]
            want[doc_id][0] += len(hits)
            own += [v for v in hits if v is not None]
    for size in (48 << 20, 48):
        monkeypatch.setattr(embed, "SHARED_BYTES", size)
        got = embed.mean_of_known(df, tx.ws_tokens(F.col("text")), vectors, 3, at).collect()
        assert len(got) == len(rows)
        for r in got:
            n, own = (0, []) if r.doc_id is None else want[r.doc_id]
            assert r.n_known == n
            assert np.allclose(r.vector, np.mean(own, axis=0) if own else 0), r
