"""Periodic runs against a plain search over all periods, and the query against its planted periods."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexigrid.llm import periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, min_words=24, times=3):
    out, n = [], len(w)
    for q in range(1, n // times + 1):
        s = 0
        while s + q < n:
            if w[s] != w[s + q]:
                s += 1
                continue
            e = s
            while e + q < n and w[e] == w[e + q]:
                e += 1
            length = e + q - s
            if length >= max(min_words, times * q) and not any(x <= s and x + m >= s + length and p < q for x, m, p in out):
                out.append((s, length, q))
            s = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, w):
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(listed), sha(kept))


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def texts(seed):
    rng = random.Random(seed)
    word = lambda k=30: f"w{rng.randrange(k)}"
    out = [None, "", " \n\t ", "one", "the " * 23, "the " * 24, "the " * 500, "a b " * 12, "a b " * 40 + "a", ("a b c " * 9).strip() + " d"]
    for _ in range(60):
        unit = [word(rng.choice([2, 30])) for _ in range(rng.randrange(1, 40))]
        times = rng.randrange(2, 9)
        out.append(" ".join([*(word() for _ in range(rng.randrange(20))), *(unit * times)[: rng.randrange(1, len(unit) * times + 1)], *(word() for _ in range(rng.randrange(20)))]))
    out += [" ".join(word(2) for _ in range(300)), " ".join((["x"] * 30 + ["y"]) * 6), " ".join((["x"] * 9 + ["y"]) * 40), "é é " * 30, " ".join(word() for _ in range(4000))]
    out.append(" ".join([*(f"u{i}" for i in range(700))] * 4))
    return out + [out[9], out[9]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_equal_all_periods(seed):
    words = [WORD.findall(t or "") for t in texts(seed)]
    code = {}
    codes = np.array([code.setdefault(w, len(code)) for t in words for w in t], np.int64)
    of, start, length, period = periodic_runs.find_runs(codes, np.array(list(map(len, words))))
    got = list(zip(of.tolist(), start.tolist(), length.tolist(), period.tolist()))
    assert got == [(i, *r) for i, t in enumerate(words) for r in plain_runs(t)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=50), max_size=4), st.integers(1, 12))
def test_runs_of_few_words(lists, min_words):
    codes = np.array([x for t in lists for x in t], np.int64)
    got = periodic_runs.find_runs(codes, np.array(list(map(len, lists)), np.int64), min_words)
    want = [(i, s, n, q) for i, t in enumerate(lists) for s, n, q in plain_runs(t, min_words)]
    assert list(zip(*(x.tolist() for x in got))) == want


def test_extension_reaches_as_far_as_words_are_equal():
    codes = np.array([9, *([1, 2, 3] * 5000), 7], np.int64)
    right = periodic_runs._equal_steps(codes, np.array([5]), np.array([3]), np.array([len(codes) - 8]), 1)
    left = periodic_runs._equal_steps(codes, np.array([9000]), np.array([3]), np.array([9001]), -1)
    assert right.tolist() == [15001 - 5 - 3] and left.tolist() == [9000]


def test_query_equals_plain_version(spark, tmp_path):
    rows = [(i if i % 11 else None, t, "x") for i, t in enumerate(texts(4) * 6)] + [(10**12 + i, t, "x") for i, t in enumerate(texts(5) * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string").withColumns({c: F.lit(1) for c in ("w", "a", "p", "n", "h", "start")})
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(plain_row(i, planted(i, t)) for i, t, _ in rows)


def test_operator_returns_collapsed_texts_and_needs_three_periods(spark):
    docs = spark.createDataFrame([(1, "go " + "a b " * 30 + "end")], "doc_id long, text string")
    row = periodic_runs.periodic_runs(docs).first()
    assert row.collapsed == "go a b end" and [tuple(r) for r in row.runs] == [(1, 60, 2)] and row.strongest == 0
    assert periodic_runs.periodic_runs(docs.filter("false")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(3, np.int64), np.array([3]), times=2)
