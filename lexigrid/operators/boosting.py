"""Gradient boosting of softmax margins: one tree a class and round, grown level by level from histograms that Spark adds up.

Values are binned at quantiles of each feature, and rows become blocks of binned cells. A level of all of a round's trees is one job:
each task adds first and second derivatives of the loss into histograms by (tree, node, feature, bin), a shuffle by range of
features adds up the tasks' histograms and finds each node's best split in its range, and the driver, which only sees one candidate
a node and range, takes the best. A cell that a sparse row does not store is zero: its bin is what a node's total leaves over.

Margins are kept in the blocks. They are brought up to date and stored every ``STORED_ROUNDS`` rounds, and in between the trees since
then are applied again, so lineage stays short and a lost executor costs little. Rows are sampled by a hash of round and row,
whatever the partitioning, features by a draw for each tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.vectors import MATRIX_CELLS, vector_cells
from lexigrid.operators.term_counts import _pieces
from lexigrid.session import cut

#: Rows of a block, cells of the histograms of one job, and rounds after which margins are stored.
BLOCK_ROWS, HISTOGRAM_CELLS, STORED_ROUNDS = 2048, 8 << 20, 8
#: Features whose histograms meet in one task.
RANGE = 256

_BLOCK = "n int, row binary, feature binary, bin binary, label binary, key binary, margin binary"
_BEST = "tree int, slot int, gain double, feature int, bin int, g_left double, h_left double, g double, h double, loss double, rows long"


@dataclass
class Tree:
    """Nodes in arrays; a leaf has feature -1. A row goes right if its value is above the threshold (its bin above ``bin``)."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int, threshold: float, left: float, right: float) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.bin[node], self.threshold[node], self.left[node], self.right[node] = feature, at, threshold, a, a + 1
        for value in (left, right):
            for x, y in ((self.feature, -1), (self.bin, 0), (self.threshold, 0.0), (self.left, 0), (self.right, 0), (self.value, value)):
                x.append(y)
        return a, a + 1

    def nodes(self, values: np.ndarray, column: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The leaf of each row. values: rows x used features; column: place of a feature among these; cuts: ``bin`` or ``threshold``."""
        feature, left, right = (np.array(x) for x in (self.feature, self.left, self.right))
        at, rows = np.zeros(len(values), np.int64), np.arange(len(values))
        while len(rows):
            rows = rows[feature[at[rows]] >= 0]
            node = at[rows]
            at[rows] = np.where(values[rows, column[feature[node]]] > cuts[node], right[node], left[node])
        return at


@dataclass(frozen=True)
class Settings:
    rounds: int = 300
    depth: int = 6
    rate: float = 0.1
    row_share: float = 0.8
    column_share: float = 0.8
    penalty: float = 1.0
    least_weight: float = 1.0
    bins: int = 32
    seed: int = 42


@dataclass
class Boosted:
    """Trees by round and class, and the mean loss on the training rows before each round and after the last."""

    rounds: list[list[Tree]]
    n_classes: int
    losses: list[float]

    def probabilities(self, vector: Column) -> Column:
        return _probabilities(self)(F.unwrap_udt(vector)["indices"], F.unwrap_udt(vector)["values"])


def _softmax(margin: np.ndarray) -> np.ndarray:
    """Class probabilities; one margin is that of the second class against the first."""
    if margin.shape[1] == 1:
        margin = np.concatenate((np.zeros_like(margin), margin), axis=1)
    p = np.exp(margin - margin.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _used(trees: list[Tree]) -> np.ndarray:
    return np.unique([f for t in trees for f in t.feature if f >= 0]).astype(np.int64)


def _probabilities(model: Boosted):
    trees = [t for r in model.rounds for t in r]
    used = _used(trees)
    column = np.zeros(int(used.max()) + 1 if len(used) else 1, np.int64)
    column[used] = np.arange(len(used))

    @F.pandas_udf("array<double>")
    def score(indices: pd.Series, values: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(values), 4096):
            idx, val = indices.iloc[at : at + 4096], values.iloc[at : at + 4096]
            n = len(val)
            idx = [np.arange(len(v)) if i is None else i for i, v in zip(idx, val)]  # a dense vector stores no indices
            row, idx, val = np.repeat(np.arange(n), [len(v) for v in val]), np.concatenate([*idx, []]).astype(np.int64), np.concatenate([*val, []])
            known = np.isin(idx, used)
            cells = np.zeros((n, max(1, len(used))))
            cells[row[known], column[idx[known]]] = val[known]
            margin = np.zeros((n, len(model.rounds[0]) if model.rounds else 1))
            for trees in model.rounds:
                for k, tree in enumerate(trees):
                    margin[:, k] += np.array(tree.value)[tree.nodes(cells, column, np.array(tree.threshold))]
            out += list(_softmax(margin))
        return pd.Series(out)

    return score


def quantile_cuts(rows: DataFrame, bins: int, features: str = "features") -> np.ndarray:
    """features x (bins - 1) cut points: quantiles of the stored values, padded with infinity; cells that are not stored are zero."""
    width = rows.select(features).first()[0].size
    if width * bins > MATRIX_CELLS:
        raise ValueError(f"{width} features of {bins} bins are more than one table of cuts holds: use fewer of either")
    cells = rows.select(F.inline(vector_cells(F.col(features))))
    probs = [(i + 1) / bins for i in range(bins - 1)]
    found = cells.groupBy("idx").agg(F.percentile_approx("value", probs, 100 * bins).alias("q"), F.min("value").alias("low"), F.max("value").alias("high"))
    out = np.full((width, bins - 1), np.inf)
    for r in found.collect():  # one row a feature
        points = sorted({*r["q"], 0.0} if r["low"] > 0 else set(r["q"]))  # zero is apart from what is stored
        points = [p for p in points if p < r["high"]][: bins - 1]
        out[r["idx"], : len(points)] = points
    return out


def _blocks(rows: DataFrame, cuts: np.ndarray, n_margins: int) -> DataFrame:
    """Blocks of binned cells; ``rows``: idx and value arrays, the class as ``_y`` and a hash of the row as ``_key``."""
    sent = rows.sparkSession.sparkContext.broadcast(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = sent.value
        for piece in _pieces(batches, "values"):
            for at in range(0, piece.num_rows, BLOCK_ROWS):
                part = piece.slice(at, BLOCK_ROWS)
                lengths = part.column("values").value_lengths().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(part.num_rows, dtype=np.int32), lengths)
                feature = part.column("idx").flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                value = part.column("values").flatten().to_numpy(zero_copy_only=False)
                bins = np.zeros(len(value), np.uint8)
                for b in range(cuts.shape[1]):
                    bins += value > cuts[feature, b]
                label = part.column("_y").to_numpy().astype(np.int32)
                key = part.column("_key").to_numpy().view(np.uint64)
                columns = [row, feature, bins, label, key, np.zeros((part.num_rows, n_margins))]
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int32()), *(pa.array([x.tobytes()]) for x in columns)], [c.split()[0] for c in _BLOCK.split(", ")])

    return rows.mapInArrow(run, _BLOCK)


class _Block:
    def __init__(self, row: dict, zero: np.ndarray) -> None:
        self.n, self.zero = row["n"], zero
        self.row, self.feature = (np.frombuffer(row[c], np.int32) for c in ("row", "feature"))
        self.bin, self.label = np.frombuffer(row["bin"], np.uint8), np.frombuffer(row["label"], np.int32)
        self.key = np.frombuffer(row["key"], np.uint64)
        self.margin = np.frombuffer(row["margin"]).reshape(self.n, -1).copy()

    def leaves(self, trees: list[Tree]) -> list[np.ndarray]:
        used = _used(trees)
        column = np.full(len(self.zero), -1, np.int64)
        column[used] = np.arange(len(used))
        values = np.repeat(self.zero[used][None], self.n, axis=0)
        place = column[self.feature]
        values[self.row[place >= 0], place[place >= 0]] = self.bin[place >= 0]
        return [t.nodes(values, column, np.array(t.bin)) for t in trees]

    def add(self, rounds: list[list[Tree]]) -> None:
        leaves = iter(self.leaves([t for r in rounds for t in r]))
        for trees in rounds:
            for k, tree in enumerate(trees):
                self.margin[:, k] += np.array(tree.value)[next(leaves)]

    def derivatives(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and second derivatives of the loss by margin, and the loss of each row."""
        p = _softmax(self.margin)
        loss = -np.log(np.maximum(p[np.arange(self.n), self.label], 1e-300))
        if self.margin.shape[1] == 1:
            p = p[:, 1:]
            return p - (self.label == 1)[:, None], np.maximum(p * (1 - p), 1e-16), loss
        return p - (self.label[:, None] == np.arange(p.shape[1])), np.maximum(2 * p * (1 - p), 1e-16), loss

    def sampled(self, share: float, seed: int, at: int) -> np.ndarray:
        x = self.key ^ np.uint64((seed * 0x9E3779B97F4A7C15 + at * 0xD1342543DE82EF95) & (1 << 64) - 1)
        for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            x = (x ^ (x >> np.uint64(29))) * np.uint64(m)
        return (x ^ (x >> np.uint64(32))) >> np.uint64(11) < np.uint64(int(share * (1 << 53)))


@dataclass
class _Level:
    """What a job needs to know: rounds that the margins lack, the trees that grow, their frontier and their features."""

    pending: list[list[Tree]]
    trees: list[Tree]
    frontier: list[list[int]]  # nodes by tree
    features: list[np.ndarray]  # by tree, in order
    at: int
    zero: np.ndarray
    n_cuts: np.ndarray


def _histograms(sent, settings: Settings, bins: int):
    """Rows (tree, part, g, h, loss, rows): the task's histograms of a range of a tree's features, by (slot, feature, bin), then the slots' totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level: _Level = sent.value
        grow = [k for k, f in enumerate(level.frontier) if f]
        sums = {k: np.zeros((2, len(level.frontier[k]), len(level.features[k]), bins)) for k in grow}
        totals = {k: np.zeros((2, len(level.frontier[k]))) for k in grow}
        loss, rows, slots, places = 0.0, 0, {}, {}
        for k in grow:
            slots[k] = np.full(len(level.trees[k].feature), -1)
            slots[k][level.frontier[k]] = np.arange(len(level.frontier[k]))
            places[k] = np.full(len(level.zero), -1)
            places[k][level.features[k]] = np.arange(len(level.features[k]))
        for batch in batches:
            for r in batch.to_pylist():
                block = _Block(r, level.zero)
                block.add(level.pending)
                g, h, losses = block.derivatives()
                loss, rows = loss + float(losses.sum()), rows + block.n
                drawn = block.sampled(settings.row_share, settings.seed, level.at)
                leaves = block.leaves(level.trees)
                for k in grow:
                    slot = np.where(drawn, slots[k][leaves[k]], -1)
                    place, own = places[k][block.feature], slot[block.row]
                    cell = (place >= 0) & (own >= 0)
                    key = (own[cell] * len(level.features[k]) + place[cell]) * bins + block.bin[cell]
                    inside = slot >= 0
                    for i, d in enumerate((g[:, k], h[:, k])):
                        sums[k][i] += np.bincount(key, d[block.row[cell]], sums[k][i].size).reshape(sums[k][i].shape)
                        totals[k][i] += np.bincount(slot[inside], d[inside], len(totals[k][i]))
        if not rows:
            return
        for k in grow:
            for part in range(0, max(1, len(level.features[k])), RANGE):
                data = [np.concatenate((sums[k][i][:, part : part + RANGE].ravel(), totals[k][i])).tobytes() for i in range(2)]
                yield pa.RecordBatch.from_pydict({"tree": [k], "part": [part], "g": data[:1], "h": data[1:], "loss": [loss], "rows": [rows]}, _PART_ARROW)

    return run


_PART = "tree int, part int, g binary, h binary, loss double, rows long"
_PART_ARROW = pa.schema([("tree", pa.int32()), ("part", pa.int32()), ("g", pa.binary()), ("h", pa.binary()), ("loss", pa.float64()), ("rows", pa.int64())])


def best_splits(g: np.ndarray, h: np.ndarray, g_total: np.ndarray, h_total: np.ndarray, zero: np.ndarray, n_cuts: np.ndarray, penalty: float, least: float):
    """Gain, feature, bin and left sums of the best split of each slot; -inf where there is none.

    g, h: slots x features x bins of stored cells; what is left of the totals is in each feature's bin of zero. Of equal gains the
    first feature, then the first bin.
    """
    g, h = g.copy(), h.copy()
    f = np.arange(len(zero))
    g[:, f, zero] += g_total[:, None] - g.sum(axis=2)
    h[:, f, zero] += h_total[:, None] - h.sum(axis=2)
    g_left, h_left = g.cumsum(axis=2), h.cumsum(axis=2)
    g_right, h_right = g_total[:, None, None] - g_left, h_total[:, None, None] - h_left
    score = lambda a, b: a * a / (b + penalty)
    gain = 0.5 * (score(g_left, h_left) + score(g_right, h_right) - score(g_total, h_total)[:, None, None])
    gain[(h_left < least) | (h_right < least) | (np.arange(g.shape[2]) >= n_cuts[:, None])] = -np.inf
    at = gain.reshape(len(gain), -1).argmax(axis=1)
    s, feature, cut_at = np.arange(len(gain)), at // g.shape[2], at % g.shape[2]
    return gain[s, feature, cut_at], feature, cut_at, g_left[s, feature, cut_at], h_left[s, feature, cut_at]


def _chosen(sent, settings: Settings, bins: int):
    def run(table: pa.Table) -> pa.Table:
        level: _Level = sent.value
        k, part = table.column("tree")[0].as_py(), table.column("part")[0].as_py()
        order = np.argsort(table.column("loss").to_numpy(), kind="stable")  # one order of adding up
        g, h = (np.sum([np.frombuffer(table.column(c)[int(i)].as_py()) for i in order], axis=0) for c in ("g", "h"))
        features = level.features[k][part : part + RANGE]
        slots = len(level.frontier[k])
        cells = slots * len(features) * bins
        shape = (slots, len(features), bins)
        g_total, h_total = g[cells:], h[cells:]
        if len(features):
            found = best_splits(g[:cells].reshape(shape), h[:cells].reshape(shape), g_total, h_total, level.zero[features], level.n_cuts[features], settings.penalty, settings.least_weight)
        else:
            found = (np.full(slots, -np.inf), *(np.zeros(slots, np.int64) for _ in range(2)), *(np.zeros(slots) for _ in range(2)))
        gain, feature, cut_at, g_left, h_left = found
        named = features[feature] if len(features) else feature
        columns = [np.full(slots, k), np.arange(slots), gain, named, cut_at, g_left, h_left, g_total, h_total]
        columns += [np.full(slots, float(np.sum(table.column("loss").to_numpy()[order]))), np.full(slots, int(np.sum(table.column("rows").to_numpy())))]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), *([pa.float64()] * 5), pa.int64()]
        return pa.table([pa.array(x).cast(t) for x, t in zip(columns, kinds)], names=[c.split()[0] for c in _BEST.split(", ")])

    return run


def _groups(trees: list[Tree], frontier: list[list[int]], features: list[np.ndarray], bins: int) -> Iterator[list[list[int]]]:
    """Frontiers by job, each with histograms of at most ``HISTOGRAM_CELLS``, or of one node."""
    job, cells = [[] for _ in trees], 0
    for k, nodes in enumerate(frontier):
        for node in nodes:
            size = max(1, len(features[k])) * bins
            if cells and cells + size > HISTOGRAM_CELLS:
                yield job
                job, cells = [[] for _ in trees], 0
            job[k].append(node)
            cells += size
    if cells:
        yield job


def _updated(sent, zero: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                block = _Block(r, zero)
                block.add(sent.value)
                r["margin"] = block.margin.tobytes()
            yield pa.RecordBatch.from_pylist(rows, batch.schema)

    return run


def boost(rows: DataFrame, n_classes: int, settings: Settings = Settings(), features: str = "features") -> Boosted:
    """Fit on ``rows``: a vector column, the class number as ``_y``; other columns only feed the hash that samples rows."""
    spark = rows.sparkSession
    cuts = quantile_cuts(rows, settings.bins, features)
    bins = settings.bins
    zero = (cuts < 0).sum(axis=1).astype(np.uint8)
    n_cuts = np.isfinite(cuts).sum(axis=1)
    usable = np.flatnonzero(n_cuts > 0)
    margins = n_classes if n_classes > 2 else 1
    cells = vector_cells(F.col(features))
    key = F.xxhash64("doc_id") if "doc_id" in rows.columns else F.xxhash64(cells)
    source = rows.select(F.transform(cells, lambda x: x["idx"]).alias("idx"), F.transform(cells, lambda x: x["value"]).alias("values"), F.col("_y").cast("int").alias("_y"), key.alias("_key"))
    blocks = cut(_blocks(source, cuts, margins))
    model, pending = Boosted([], n_classes, []), []
    for at in range(settings.rounds):
        trees = [Tree() for _ in range(margins)]
        drawn = []
        for k in range(margins):
            rng = np.random.default_rng([settings.seed, at, k])
            n = max(1, round(settings.column_share * len(usable)))
            drawn.append(np.sort(rng.choice(usable, min(n, len(usable)), replace=False)))
        frontier = [[0] for _ in trees]
        for depth in range(settings.depth):
            after: list[list[int]] = [[] for _ in trees]
            for job in _groups(trees, frontier, drawn, bins):
                sent = spark.sparkContext.broadcast(_Level(pending, trees, job, drawn, at, zero, n_cuts))
                parts = blocks.mapInArrow(_histograms(sent, settings, bins), _PART)
                best: dict[tuple[int, int], tuple] = {}
                found = parts.groupBy("tree", "part").applyInArrow(_chosen(sent, settings, bins), _BEST).collect()  # a row a node and range
                for r in sorted(found, key=lambda r: (-r["gain"], r["feature"])):
                    best.setdefault((r["tree"], r["slot"]), r)
                if depth == 0 and found and len(model.losses) == at:
                    model.losses.append(found[0]["loss"] / found[0]["rows"])
                for (k, slot), r in best.items():
                    node, tree = job[k][slot], trees[k]
                    leaf = lambda a, b: -settings.rate * a / (b + settings.penalty)
                    tree.value[node] = leaf(r["g"], r["h"])
                    if r["gain"] > 1e-9:
                        f, b = r["feature"], r["bin"]
                        after[k] += tree.split(node, f, b, float(cuts[f, b]), leaf(r["g_left"], r["h_left"]), leaf(r["g"] - r["g_left"], r["h"] - r["h_left"]))
                sent.unpersist()
            frontier = [sorted(x) for x in after]
            if not any(frontier):
                break
        model.rounds.append(trees)
        pending.append(trees)
        if len(pending) == STORED_ROUNDS:
            blocks = cut(blocks.mapInArrow(_updated(spark.sparkContext.broadcast(pending), zero), _BLOCK))
            pending = []
    model.losses.append(mean_loss(blocks, pending, zero))
    return model


def mean_loss(blocks: DataFrame, pending: list[list[Tree]], zero: np.ndarray) -> float:
    """Mean loss of the rows in blocks, after the rounds that their margins lack."""
    sent = blocks.sparkSession.sparkContext.broadcast(pending)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                block = _Block(r, zero)
                block.add(sent.value)
                yield pa.RecordBatch.from_pydict({"loss": [float(block.derivatives()[2].sum())], "rows": pa.array([block.n], pa.int64())})

    total = blocks.mapInArrow(run, "loss double, rows long").agg(F.sum("loss").alias("loss"), F.sum("rows").alias("rows")).first()
    return total["loss"] / total["rows"]
