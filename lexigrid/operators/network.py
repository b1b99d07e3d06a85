"""Feed-forward networks: rectified or other hidden units, Adam, weight decay and dropout, trained in parallel parts.

Rows are dealt by hash into parts of about ``PART_ROWS``; a part is one packed row of the training table. An epoch is one job: every part
starts from the same weights and takes Adam's steps over its own mini-batches, and weights and moments are averaged, weighted by rows
(parallel stochastic gradients, Zinkevich et al. 2010), a few at a time, so one row comes to the driver. Parts depend on the rows alone
and all draws on seed, epoch and part, so the result does not depend on partitions, cores or lost executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.vectors import vector_cells
from lexigrid.session import cut

#: Rows of a part, results that one task averages, weights of a network (8 bytes each, and twice that for moments), and cells of a dense
#: batch.
PART_ROWS, AVERAGED, MOST_WEIGHTS, BATCH_CELLS = 8192, 8, 16 << 20, 1 << 22

#: Hidden units and their slopes by the unit's output.
UNITS = {
    "relu": (lambda x: np.maximum(x, 0), lambda y: (y > 0).astype(np.float64)),
    "tanh": (np.tanh, lambda y: 1 - y * y),
    "logistic": (lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60))), lambda y: y * (1 - y)),
    "identity": (lambda x: x, np.ones_like),
}

_PART = "part int, n int, offsets binary, features binary, data binary, labels binary"
_STATE = "part int, n double, loss double, state binary"


@dataclass(frozen=True)
class Settings:
    hidden: tuple[int, ...] = (100,)
    units: str = "relu"
    decay: float = 1e-4
    rate: float = 1e-3
    batch: int = 200
    epochs: int = 200
    dropout: float = 0.0
    tolerance: float = 1e-4
    patience: int = 10
    seed: int = 42


def layers(theta: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights and offsets of each layer, as views of one vector."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((theta[at : at + a * b].reshape(a, b), theta[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def n_weights(sizes: list[int]) -> int:
    return sum(a * b + b for a, b in zip(sizes, sizes[1:]))


def initial(sizes: list[int], seed: int, units: str) -> np.ndarray:
    """Uniform weights whose bound keeps the spread of a layer's outputs (Glorot and Bengio 2010)."""
    rng, out = np.random.default_rng(seed), []
    for a, b in zip(sizes, sizes[1:]):
        bound = np.sqrt((2.0 if units == "logistic" else 6.0) / (a + b))
        out.append(rng.uniform(-bound, bound, a * b + b))
    return np.concatenate(out)


def forward(theta: np.ndarray, sizes: list[int], units: str, x: np.ndarray, masks: list[np.ndarray] | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Outputs of the input and hidden layers, and class probabilities. masks: factors of hidden outputs (dropout)."""
    outs, every = [x], layers(theta, sizes)
    for i, (w, b) in enumerate(every[:-1]):
        y = UNITS[units][0](outs[-1] @ w + b)
        outs.append(y if masks is None else y * masks[i])
    z = outs[-1] @ every[-1][0] + every[-1][1]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return outs, p / p.sum(axis=1, keepdims=True)


def loss_and_gradient(theta: np.ndarray, sizes: list[int], units: str, x: np.ndarray, y: np.ndarray, decay: float, masks: list[np.ndarray] | None = None) -> tuple[float, np.ndarray]:
    """Mean log loss of a batch plus half the decayed squares of weights over its rows, and the gradient."""
    outs, p = forward(theta, sizes, units, x, masks)
    n, every, grad = len(x), layers(theta, sizes), np.zeros_like(theta)
    parts = layers(grad, sizes)
    loss = -np.log(np.maximum(p[np.arange(n), y], 1e-300)).mean() + 0.5 * decay / n * sum(float((w * w).sum()) for w, _ in every)
    delta = p.copy()
    delta[np.arange(n), y] -= 1
    delta /= n
    for i in range(len(every) - 1, -1, -1):
        w, _ = every[i]
        parts[i][0][...] = outs[i].T @ delta + decay / n * w
        parts[i][1][...] = delta.sum(axis=0)
        if i:
            own = outs[i] if masks is None else np.divide(outs[i], masks[i - 1], out=np.zeros_like(outs[i]), where=masks[i - 1] > 0)
            delta = (delta @ w.T) * UNITS[units][1](own) * (1.0 if masks is None else masks[i - 1])
    return loss, grad


class _Part:
    """Sparse rows and their classes."""

    def __init__(self, row: dict, width: int) -> None:
        self.n, self.width = row["n"], width
        self.offsets, self.features = np.frombuffer(row["offsets"], np.int64), np.frombuffer(row["features"], np.int32)
        self.data, self.labels = np.frombuffer(row["data"]), np.frombuffer(row["labels"], np.int32)

    def dense(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.width))
        sizes = self.offsets[rows + 1] - self.offsets[rows]
        at = np.repeat(self.offsets[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        out[np.repeat(np.arange(len(rows)), sizes), self.features[at]] = self.data[at]
        return out


def _parts(rows: DataFrame, parts: int) -> DataFrame:
    """``rows``: idx and values arrays, class ``_y`` and a hash ``_key``; packed by hash, in order of hash and values."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_key", "ascending"), ("_y", "ascending")])
        lists = table.column("values").combine_chunks()
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        data = [
            np.concatenate(([0], np.cumsum(lengths))), table.column("idx").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int32),
            lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), table.column("_y").to_numpy().astype(np.int32),
        ]
        head = [pa.array([table.column("part")[0].as_py()], pa.int32()), pa.array([table.num_rows], pa.int32())]
        return pa.table([*head, *(pa.array([x.tobytes()], pa.binary()) for x in data)], names=[c.split()[0] for c in _PART.split(", ")])

    keyed = rows.withColumn("part", F.pmod("_key", F.lit(parts)).cast("int"))
    return cut(keyed.groupBy("part").applyInArrow(pack, _PART))


def _epoch(sent, sizes: list[int], s: Settings):
    """One pass of each part over its rows in a drawn order: weights and moments after it, and the mean loss on the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                state, steps, epoch = sent.value
                theta, first, second = state.reshape(3, -1).copy()
                part = _Part(row, sizes[0])
                rng = np.random.default_rng([s.seed, epoch, row["part"]])
                order, loss = rng.permutation(part.n), 0.0
                size = max(1, min(s.batch, part.n, BATCH_CELLS // sizes[0] or 1))
                for at in range(0, part.n, size):
                    rows = order[at : at + size]
                    masks = [(rng.random((len(rows), h)) >= s.dropout) / (1 - s.dropout) for h in s.hidden] if s.dropout else None
                    now, g = loss_and_gradient(theta, sizes, s.units, part.dense(rows), part.labels[rows], s.decay, masks)
                    loss += now * len(rows)
                    steps += 1
                    first = 0.9 * first + 0.1 * g
                    second = 0.999 * second + 0.001 * g * g
                    theta = theta - s.rate * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps) * first / (np.sqrt(second) + 1e-8)
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([row["part"]], pa.int32()), "n": [float(part.n)], "loss": [loss], "state": [np.concatenate((theta, first, second)).tobytes()]}
                )

    return run


def _averaged(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    n = sum(r["n"] for r in rows)
    state = sum(np.frombuffer(r["state"]) * (r["n"] / n) for r in rows)
    return pa.table({"part": pa.array([rows[0]["part"]], pa.int32()), "n": [n], "loss": [sum(r["loss"] for r in rows)], "state": [state.tobytes()]})


@dataclass
class Network:
    sizes: list[int]
    units: str
    theta: np.ndarray
    losses: list[float]

    def probabilities(self, vector: Column) -> Column:
        raw = F.unwrap_udt(vector)
        return _probabilities(self)(raw["indices"], raw["values"])


def _probabilities(net: Network):
    @F.pandas_udf("array<double>")
    def score(indices: pd.Series, values: pd.Series) -> pd.Series:
        out, step = [], max(1, min(4096, BATCH_CELLS // net.sizes[0]))
        for at in range(0, len(values), step):
            x = np.zeros((len(values.iloc[at : at + step]), net.sizes[0]))
            for i, (idx, val) in enumerate(zip(indices.iloc[at : at + step], values.iloc[at : at + step])):
                x[i, slice(None) if idx is None else idx] = val  # a dense vector stores no indices
            out += list(forward(net.theta, net.sizes, net.units, x)[1])
        return pd.Series(out)

    return score


def train_network(rows: DataFrame, n_classes: int, s: Settings = Settings(), features: str = "features") -> Network:
    """Fit on ``rows``: a vector column and the class number as ``_y``."""
    if s.units not in UNITS:
        raise ValueError(f"activation {s.units!r} is not one of {', '.join(UNITS)}")
    if not 0 <= s.dropout < 1:
        raise ValueError("dropout is a share from 0 to below 1")
    spark = rows.sparkSession
    sizes = [rows.select(features).first()[0].size, *s.hidden, n_classes]
    if n_weights(sizes) > MOST_WEIGHTS:
        raise ValueError(f"a network of {n_weights(sizes)} weights is more than {MOST_WEIGHTS}: reduce the features or the layers")
    cells = vector_cells(F.col(features))
    key = F.xxhash64("doc_id") if "doc_id" in rows.columns else F.xxhash64(cells)
    source = rows.select(F.transform(cells, lambda x: x["idx"]).alias("idx"), F.transform(cells, lambda x: x["value"]).alias("values"), F.col("_y").cast("int").alias("_y"), key.alias("_key"))
    n = rows.count()
    count = max(1, -(-n // PART_ROWS))
    parts = _parts(source, count)
    state, losses, best, waited = np.zeros((3, n_weights(sizes))), [], np.inf, 0
    state[0] = initial(sizes, s.seed, s.units)
    per_epoch = -(-min(n, PART_ROWS) // max(1, min(s.batch, n)))
    for epoch in range(s.epochs):
        sent = spark.sparkContext.broadcast((state.ravel(), epoch * per_epoch, epoch))
        found, left = parts.mapInArrow(_epoch(sent, sizes, s), _STATE), count
        while left > 1:
            left = -(-left // AVERAGED)
            found = found.groupBy(F.pmod("part", F.lit(left)).alias("of")).applyInArrow(_averaged, _STATE)
        row = found.collect()[0]  # one row
        sent.unpersist()
        state = np.frombuffer(row["state"]).reshape(3, -1)
        losses.append(row["loss"] / row["n"])
        waited = 0 if losses[-1] < best - s.tolerance else waited + 1
        best = min(best, losses[-1])
        if waited >= s.patience:
            break
    return Network(sizes, s.units, state[0].copy(), losses)
