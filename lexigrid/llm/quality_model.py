"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a document are shares and extremes of its bytes, words and lines, over the whole text. Trees are grown level by
level on binned statistics: per round each feature's histogram of gradients gives all splits of a level. The fitted trees are
flattened into arrays (feature, threshold, children, value), which numpy walks for all documents and trees at once.

The classifier is fitted on at most `MAX_ROWS` labelled rows (a share of doc_id hashes, so the same rows in each run); a score
needs only the text. Defined cases: a null text counts as empty; empty texts get a score like any other; labels that are null
or without a document are left out, repeated labels count as often as they occur; without labels of both kinds every score is
the share of good labels (0.5 without any); rows of equal doc_id each keep a row; an empty table gives no rows. Only doc_id,
text and quality are read, `accepted` returns all columns of its documents.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import by_rows, raw

#: Labelled rows that a fit takes at most, about.
MAX_ROWS = 20_000
ROUNDS, DEPTH, BINS, RATE, RIDGE, LEAST = 60, 4, 64, 0.2, 1.0, 10

#: Words looked at together for the extremes of a long document.
STRETCH = 40

#: Classes of bytes: 0 blank, 1 capital, 2 small letter, 3 digit, 4 beyond ASCII, 5 plain mark, 6 other mark.
_CLASS = np.full(256, 6, np.uint8)
for _kind, _bytes in enumerate((b" \t\n\x0b\x0c\r", bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), bytes(range(128, 256)), b".,;:'\"-()")):
    _CLASS[list(_bytes)] = _kind
FEATURES = (
    "log_words log_bytes bytes_a_word longest_word distinct_words top_word repeats digits upper high marks odd_marks exclamations bars "
    "odd_words upper_words lines words_a_line distinct_lines end_stops stretch_repeats stretch_odd stretch_upper stretch_distinct"
).split()


#: Words are compared by a polynomial hash of their bytes; blanks add nothing.
_MIX = np.random.default_rng(1).integers(1, 1 << 63, 256, np.uint64)
_MIX[_CLASS == 0] = 0
_POWERS = np.multiply.accumulate(np.full(1024, 0x9E3779B97F4A7C15, np.uint64))


def statistics(text: bytes) -> list[float]:
    """The features of one text, in the order of FEATURES."""
    data = np.frombuffer(text, np.uint8)
    kind = _CLASS[data]
    inside = kind > 0
    starts = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1]))) if len(data) else data
    n = len(starts)
    if not n:
        return [0.0] * len(FEATURES)
    blank, capital, small, digit, high, plain, other = np.bincount(kind, minlength=7).tolist()
    total, inked, letters = len(text), len(text) - blank, max(1, capital + small)
    reach = np.diff(starts, append=total)
    offset = np.arange(total - starts[0]) - np.repeat(starts - starts[0], reach)
    word = np.add.reduceat(_MIX[data[starts[0] :]] * _POWERS[offset & 1023], starts - starts[0])
    length = np.add.reduceat(inside, starts, dtype=np.int32)
    odd = np.logical_or.reduceat(kind == 6, starts)
    upper = np.logical_or.reduceat(kind == 1, starts) & ~np.logical_or.reduceat(kind == 2, starts)
    same = np.concatenate(([False], word[1:] == word[:-1]))
    ordered = np.sort(word)
    runs = np.diff(np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True]))))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    cuts = np.arange(0, n, STRETCH)
    lengths = np.minimum(STRETCH, n - cuts)
    odds, uppers, sames = (np.add.reduceat(x, cuts, dtype=np.int32) for x in (odd, upper, same))
    square = np.sort(np.concatenate((word, np.full(-n % STRETCH, word[-1]))).reshape(-1, STRETCH), axis=1)
    variety = ((np.diff(square, axis=1) != 0).sum(axis=1) + 1) / lengths
    return [
        log1p(n), log1p(total), inked / n, length.max(), len(runs) / n, runs.max() / n, sames.sum() / n,
        digit / inked, capital / letters, high / inked, (plain + other) / inked, other / inked, text.count(b"!") / n, text.count(b"|") / n,
        odds.sum() / n, uppers.sum() / n, len(lines), n / len(lines), len(set(lines)) / len(lines), text.count(b".") / n,
        (sames / lengths).max(), (odds / lengths).max(), (uppers / lengths).max(), variety.min(),
    ]


def feature_matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class Trees:
    """Boosted trees as flat arrays; a leaf is its own child."""

    base: float
    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, left, right, v in zip(self.feature, self.threshold, self.left, self.right, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = np.where(x[rows, f[node]] <= t[node], left[node], right[node])
            margin += v[node]
        return 1 / (1 + np.exp(-margin))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Logistic loss, second-order gains; the first of equal splits is taken, so equal inputs give equal trees."""
    n, k = x.shape
    share = float(y.mean()) if n else 0.5
    nodes = 2 ** (depth + 1) - 1
    if not 0 < share < 1:
        share, rounds = min(max(share, 1e-6), 1 - 1e-6), 0
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) if n else np.zeros(0) for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1) if n else np.zeros((0, k), np.int64)
    margin = np.full(n, np.log(share / (1 - share)))
    out = Trees(float(np.log(share / (1 - share))), np.zeros((rounds, nodes), np.int64), np.zeros((rounds, nodes)), np.zeros((rounds, nodes), np.int64), np.zeros((rounds, nodes), np.int64), np.zeros((rounds, nodes)), depth)
    itself = np.arange(nodes)
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        out.left[r], out.right[r] = itself, itself
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = node - first
            live = (at >= 0) & (at < width)
            best, chosen, where = np.full(width, 1e-6), np.full(width, -1), np.zeros(width, np.int64)
            for j in range(k):
                m = len(cuts[j]) + 1
                key = at[live] * m + binned[live, j]
                hist = [np.bincount(key, w, width * m).reshape(width, m).cumsum(axis=1) for w in (g[live], h[live], np.ones(int(live.sum())))]
                (gl, hl, nl), (ga, ha, na) = hist, [z[:, -1:] for z in hist]
                gain = gl**2 / (hl + RIDGE) + (ga - gl) ** 2 / (ha - hl + RIDGE) - ga**2 / (ha + RIDGE)
                gain[(nl < LEAST) | (na - nl < LEAST)] = 0
                gain[:, -1] = 0
                b = gain.argmax(axis=1)
                better = gain[np.arange(width), b] > best
                best[better], chosen[better], where[better] = gain[np.arange(width), b][better], j, b[better]
            for i in np.flatnonzero(chosen >= 0):
                v = first + i
                out.feature[r, v], out.threshold[r, v] = chosen[i], cuts[chosen[i]][where[i]]
                out.left[r, v], out.right[r, v] = 2 * v + 1, 2 * v + 2
            go = live & (chosen[np.clip(at, 0, width - 1)] >= 0)
            f = chosen[at[go]]
            node[go] = 2 * node[go] + 1 + (binned[np.flatnonzero(go), f] > where[at[go]])
        total_g, total_h = np.bincount(node, g, nodes), np.bincount(node, h, nodes)
        out.value[r] = rate * total_g / (total_h + RIDGE)
        margin += out.value[r][node]
    return out


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """id, text_hash, text and label of the rows a fit takes; equal (id, text_hash) are one row, at most max_rows in all.

    A doc_id with several labels has that of most of them, 1 if they are as many. Of more rows than max_rows those with the smallest
    hashes are taken, first of labelled doc_ids, then of their distinct texts.
    """
    known = labels.filter("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
    known = known.agg((F.avg((F.col("quality") > 0).cast("double")) >= 0.5).cast("double").alias("good"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    keys = texts.select("id", "text_hash").join(F.broadcast(known), "id").distinct()
    keys = keys.orderBy(F.xxhash64("id", "text_hash"), "id", "text_hash").limit(max_rows)
    return texts.join(F.broadcast(keys), ["id", "text_hash"])


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Trees:
    """Statistics are made where the texts are; some numbers a row come to the driver, bounded by max_rows."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = feature_matrix(raw(batch.column(2)))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64())), batch.column(3)], ["id", "text_hash", "x", "good"])

    taken = training_rows(docs, labels, max_rows).select("id", "text_hash", "text", "good")
    rows = taken.mapInArrow(by_rows(make), "id long, text_hash long, x array<double>, good double").dropDuplicates(["id", "text_hash"]).select("x", "good").toArrow()
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    y = rows.column("good").to_numpy()
    order = np.lexsort((*x.T, y))  # whatever order tasks end in
    return fit_trees(x[order], y[order])


def quality_scores(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.score(feature_matrix(raw(batch.column(1)))))], ["doc_id", "score"])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(by_rows(make), "doc_id long, score double")


def accepted(docs: DataFrame, trees: Trees, threshold: float = 0.5) -> DataFrame:
    """The rows whose score is at least the threshold, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = raw(batch.column(batch.schema.get_field_index("text")).cast(pa.binary()))
        return batch.filter(pa.array(model.value.score(feature_matrix(texts)) >= threshold))

    return docs.mapInArrow(by_rows(make), docs.schema)
