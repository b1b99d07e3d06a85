"""Exact range join of vectors against all pairs, with cells small enough to be partitioned."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrid.llm import vector_join

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, cosine=0.93):
    xs = []
    for _, e, label in rows:
        ok = label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)
        x = np.array(e, np.float32).astype(float) if ok else None
        xs.append(x / np.linalg.norm(x) if ok else None)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if xs[i] is None or xs[j] is None or rows[i][2] != rows[j][2] or len(xs[i]) != len(xs[j]):
                continue
            if xs[i] @ xs[j] >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            least[find(i)] = min(v, least.get(find(i), v))
    return Counter((v, links[i], least.get(find(i)), v == least.get(find(i))) for i, (v, _, _) in enumerate(rows))


def fixture(dimension, seed):
    rng = np.random.default_rng(seed)
    some = lambda: rng.normal(size=dimension)
    rows = []
    for label in (0, 1):
        centres = [some() for _ in range(6)]
        for c in centres:
            spread = rng.choice([0.02, 0.2, 0.4]) / math.sqrt(dimension) * np.linalg.norm(c)
            rows += [(c + spread * rng.normal(size=dimension), label) for _ in range(int(rng.integers(1, 40)))]
        rows += [(some(), label) for _ in range(60)]
    hot = some()
    rows += [(hot + 0.01 * some(), 0) for _ in range(120)] + [(hot, 0)] * 30 + [(2 * hot, 0)] * 3 + [(hot, 1), (hot, None)]
    rows = [(1000 - 2 * i if i % 17 else None, [float(np.float32(v)) for v in x], label) for i, (x, label) in enumerate(rows)]
    odd = [None, [], [0.0] * dimension, [None] * dimension, [float("nan")] * dimension, [float("inf")] + [1.0] * (dimension - 1), [1e-30] * dimension, [1e-30] * dimension, [1e30] * dimension, [1.0] * (dimension + 1)]
    rows += [(5000 + i, e, 0) for i, e in enumerate(odd)] + [rows[0], rows[0], (None, rows[0][1], 0)]
    return rows


@pytest.mark.parametrize(("dimension", "limit"), [(3, 8), (3, 4096), (24, 8), (24, 30), (64, 16), (2, 5)])
def test_groups_equal_all_pairs(spark, dimension, limit):
    rows = fixture(dimension, 10 * dimension + limit)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("node", "cell", "n", "vector", "near")}).repartition(3)
    got = Counter(tuple(r) for r in vector_join.vector_groups(frame, 0.93, limit).select("vec_id", "n_links", "component_id", "kept").collect())
    want = plain(rows)
    assert sum(got.values()) == len(rows)
    # a group without any id has none to be named by
    assert got == Counter({(v, n, c, v == c): m for (v, n, c, _), m in want.items()})


def test_a_tight_group_is_not_compared(spark):
    rng = np.random.default_rng(0)
    hot = rng.normal(size=16)
    rows = [(i, [float(v) for v in hot + 0.02 * rng.normal(size=16)], 1) for i in range(400)] + [(1000 + i, [float(v) for v in rng.normal(size=16)], 1) for i in range(50)]
    found = vector_join.nodes(spark.createDataFrame(rows, SCHEMA))
    links = vector_join.vector_links(found, 0.93, 20)
    assert links.filter("b >= 0").count() < 12 * len(rows)  # stars and forests, not 80,000 pairs
    got = vector_join.vector_groups(spark.createDataFrame(rows, SCHEMA), 0.93, 20).filter("vec_id < 1000").collect()
    assert {r.component_id for r in got} == {0} and all(r.n_links >= 399 for r in got)


def test_empty_and_unlinked_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vector_join.vector_groups(none).count() == 0
    lone = spark.createDataFrame([(1, None, 1), (2, [1.0], None), (None, None, None)], SCHEMA)
    assert {tuple(r) for r in vector_join.vector_groups(lone).collect()} == {(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)}
