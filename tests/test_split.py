import math

import pytest
from pyspark.sql import functions as F

from lexigrid.operators import profile, split


def labelled(spark, n=300):
    label = F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b").otherwise("c")
    return spark.range(n).select(F.col("id").alias("doc_id"), label.alias("label"))


def test_quotas_match_published_sizes():
    q = split.class_quotas({"a": 40_000, "b": 3_000, "c": 678}, 0.3)
    assert sum(q.values()) == 13_104 and 43_678 - sum(q.values()) == 30_574


def test_holdout_is_exact_and_stable(spark):
    df = labelled(spark)
    rows = split.holdout(df, 0.25).collect()
    assert len(rows) == 300
    test = [r for r in rows if r["part"] == "test"]
    assert len(test) == math.ceil(300 * 0.25)
    per = {c: sum(r["label"] == c for r in test) for c in "abc"}
    assert all(abs(per[c] - m * 0.25) < 1 for c, m in {"a": 210, "b": 60, "c": 30}.items())
    again = split.holdout(df.repartition(7), 0.25).filter("part = 'test'")
    assert {r["doc_id"] for r in test} == {r["doc_id"] for r in again.collect()}


def test_holdout_orders_by_key(spark):
    import hashlib

    df = labelled(spark, 50)
    got = {r["doc_id"] for r in split.holdout(df, 0.2, seed=3, stratify=None).filter("part = 'test'").collect()}
    ranked = sorted(range(50), key=lambda i: hashlib.md5(f"3:{i}".encode()).hexdigest())
    assert got == set(ranked[:10])


def test_rare_class_and_null_label(spark):
    df = spark.createDataFrame([(i, "a" if i < 9 else None) for i in range(10)], "doc_id long, label string")
    rows = split.holdout(df, 0.3).collect()
    assert len(rows) == 10 and sum(r["part"] == "test" for r in rows) == 3


@pytest.mark.parametrize("seed", [42, None])
def test_kfold_sizes(spark, seed, monkeypatch):
    monkeypatch.setattr(split, "BUCKET_ROWS", 3)
    df = labelled(spark, 101)
    rows = split.kfold(df, 4, seed).collect()
    assert len(rows) == 101
    for group in [rows] + [[r for r in rows if r["label"] == c] for c in "abc"]:
        sizes = [sum(r["fold"] == f for r in group) for f in range(4)]
        assert max(sizes) - min(sizes) <= 1
    if seed is None:
        first = sorted(r["doc_id"] for r in rows if r["label"] == "a")
        by_id = {r["doc_id"]: r["fold"] for r in rows}
        assert [by_id[i] for i in first] == [i % 4 for i in range(len(first))]


def test_kfold_needs_two(spark):
    with pytest.raises(ValueError):
        split.kfold(labelled(spark), 1)


def test_fingerprint_ignores_order(spark):
    parts = split.holdout(labelled(spark), 0.3)
    a = split.split_fingerprint(parts).first()
    b = split.split_fingerprint(parts.repartition(5).orderBy(F.col("doc_id").desc())).first()
    c = split.split_fingerprint(split.holdout(labelled(spark), 0.3, seed=1)).first()
    assert a == b and a["split_id"] != c["split_id"] and len(a["split_id"]) == 16


def test_class_weights_and_labels(spark):
    df = labelled(spark)
    w = {r["label"]: r for r in profile.class_weights(df).collect()}
    assert math.isclose(sum(r["inverse"] for r in w.values()) / 3, 1.0)
    assert math.isclose(w["b"]["balanced"], 300 / (3 * 60))
    other = spark.createDataFrame([("z",), (None,)], "label string")
    assert [tuple(r) for r in profile.label_space(df, other).orderBy("idx").collect()] == [("a", 0), ("b", 1), ("c", 2), ("z", 3)]
    assert profile.same_label_space(df.select("label"), df.select("label"))


def test_top_tokens_limit_before_shuffle(spark):
    df = spark.createDataFrame([("a", "x y y"), ("b", "z")], "label string, text string")
    top = profile.top_tokens(df, F.split("text", " "), 1)
    assert {(r["label"], r["token"], r["n"]) for r in top.collect()} == {("a", "y", 2), ("b", "z", 1)}
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
