"""Complement naive Bayes: closed form, so a whole parameter sweep is one scoring job."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cells of the collected class x term table (8 bytes each).
DRIVER_CELLS = 50_000_000


@dataclass(frozen=True)
class ClassTermCounts:
    """Sums of term counts per class: labels in sorted order, matrix classes x terms."""

    labels: list[str]
    counts: np.ndarray

    def weights(self, alpha: float, terms: np.ndarray | None = None) -> np.ndarray:
        """classes x terms weights ``-ln((alpha + complement) / (alpha * V + total))``.

        ``terms`` restricts the vocabulary to a boolean mask; other columns become zero.
        """
        counts = self.counts if terms is None else self.counts * terms
        width = counts.shape[1] if terms is None else int(terms.sum())
        complement = counts.sum(axis=0, keepdims=True) - counts
        total = complement.sum(axis=1, keepdims=True)
        w = -np.log((alpha + complement) / (alpha * width + total))
        return w if terms is None else w * terms


def class_term_counts(train: DataFrame, width: int, label: str = "label", features: str = "features") -> ClassTermCounts:
    """One pass over count vectors; partial sums per class and partition, one row per class."""
    sums = train.filter(F.col(label).isNotNull()).groupBy(label).agg(Summarizer.sum(F.col(features)).alias("s"))
    limit = max(1, DRIVER_CELLS // max(1, width))
    rows = sorted(sums.limit(limit + 1).collect(), key=lambda r: r[label])
    if len(rows) > limit:
        raise ValueError("class x term table too large for the driver: use cnb_weights_long")
    return ClassTermCounts([r[label] for r in rows], np.array([r["s"].toArray() for r in rows]))


def _score_udf(weights: np.ndarray, n_labels: int):
    """Pandas UDF: sparse count rows to ``array<struct<best, proba>>``, one entry per model.

    ``weights`` is terms x (models * labels).  One gather and one segmented sum per batch.
    """
    width = weights.shape[1]

    @F.pandas_udf("array<double>")
    def score(indices: pd.Series, values: pd.Series) -> pd.Series:
        sizes = np.array([len(i) for i in indices], dtype=np.int64)
        out = np.zeros((len(sizes), width))
        filled = np.flatnonzero(sizes)
        # a bounded number of gathered cells at a time
        chunk = max(1, int(4_000_000 // max(1, width * max(1, sizes.max(initial=1)))))
        for start in range(0, len(filled), chunk):
            rows = filled[start : start + chunk]
            idx = np.concatenate([indices.iloc[r] for r in rows]).astype(np.int64)
            val = np.concatenate([values.iloc[r] for r in rows])
            starts = np.concatenate([[0], np.cumsum(sizes[rows])[:-1]])
            out[rows] = np.add.reduceat(weights[idx] * val[:, None], starts, axis=0)
        cube = out.reshape(len(out), width // n_labels, n_labels)
        cube = np.exp(cube - cube.max(axis=2, keepdims=True))
        cube /= cube.sum(axis=2, keepdims=True)
        return pd.Series(list(cube.reshape(len(out), width)))

    return score


def score_vectors(rows: DataFrame, weights: np.ndarray, out: str, features: str = "features") -> DataFrame:
    """Add the class probabilities of count vectors under one model's classes x terms weights."""
    raw = F.unwrap_udt(features)
    return rows.withColumn(out, _score_udf(np.ascontiguousarray(weights.T), len(weights))(raw["indices"], raw["values"]))


def predict_models(
    rows: DataFrame, models: dict[str, np.ndarray], labels: list[str],
    features: str = "features", label: str = "label", keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Score every document with every model of a sweep in one map-only pass.

    ``models`` maps a name to classes x terms weights over the same terms.  Returns
    ``(keep..., model, y_true, y_pred, proba)``; a document without known terms scores 0 for
    every class and gets the first label and equal probabilities.
    """
    names = list(models)
    k = len(labels)
    weights = np.concatenate([models[n].T for n in names], axis=1)
    raw = F.unwrap_udt(features)
    scored = rows.select(
        *keep, F.col(label).alias("y_true"), _score_udf(weights, k)(raw["indices"], raw["values"]).alias("_s")
    )
    per_model = F.inline(
        F.array(*[
            F.struct(F.lit(n).alias("model"), F.slice("_s", i * k + 1, k).alias("proba"))
            for i, n in enumerate(names)
        ])
    )
    best = F.array_position("proba", F.array_max("proba"))
    return scored.select(*keep, "y_true", per_model).select(
        *keep,
        "model",
        "y_true",
        F.element_at(F.array(*[F.lit(x) for x in labels]), best.cast("int")).alias("y_pred"),
        "proba",
    )


# --- long form: any number of terms ---------------------------------------


def cnb_weights_long(cells: DataFrame, vocab: DataFrame, alpha: float, label: str = "label") -> DataFrame:
    """``(label, idx, weight)`` for the full class x term grid, without collecting it.

    ``cells`` is ``(label, idx, tf)`` of the training documents.  Only one total per class
    and the vocabulary size come to the driver; the counts of a term in all classes travel
    in one row.
    """
    sums = cells.groupBy(label).agg(F.sum("tf").alias("t")).collect()
    totals = {r[label]: r["t"] for r in sums if r[label] is not None}
    labels = sorted(totals)
    everything = sum(totals.values())
    width = vocab.count()
    own = [F.sum(F.when(F.col(label) == x, F.col("tf"))).alias(f"_n{j}") for j, x in enumerate(labels)]
    by_term = cells.groupBy("idx").agg(*own)
    counts = [F.coalesce(f"_n{j}", F.lit(0)) for j in range(len(labels))]
    of_term = F.lit(0)
    for c in counts:
        of_term = of_term + c
    a = float(alpha)
    entries = F.array(*[
        F.struct(
            F.lit(x).alias(label),
            (-F.log((of_term - counts[j] + a) / F.lit(a * width + everything - totals[x]))).alias("weight"),
        )
        for j, x in enumerate(labels)
    ])
    return vocab.select("idx").join(by_term, "idx", "left").select("idx", F.inline(entries))


def cnb_scores_long(cells: DataFrame, docs: DataFrame, weights: DataFrame, labels: list[str]) -> DataFrame:
    """``(doc_id, label, score)`` by joining cells to weights on the term.

    ``cells`` is ``(doc_id, idx, tf)``.  The weights of a term travel as one array, so a cell
    meets one row.  Documents without known terms keep score 0 through the left join.
    """
    slots = [F.max(F.when(F.col("label") == x, F.col("weight"))).alias(f"_w{j}") for j, x in enumerate(labels)]
    wide = weights.groupBy("idx").agg(*slots)
    sums = [F.sum(F.col("tf") * F.col(f"_w{j}")).alias(f"_s{j}") for j in range(len(labels))]
    per_doc = cells.join(wide, "idx").groupBy("doc_id").agg(*sums)
    entries = F.array(*[
        F.struct(F.lit(x).alias("label"), F.coalesce(f"_s{j}", F.lit(0.0)).alias("score"))
        for j, x in enumerate(labels)
    ])
    return docs.select("doc_id").join(per_doc, "doc_id", "left").select("doc_id", F.inline(entries))
