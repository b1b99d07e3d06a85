"""Weighted soft voting and greedy selection of a diverse set of models."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions.vectors import argmax_index
from lexigrid.operators.metrics import scores

# Sums of probabilities are rounded before the arg-max, so that the order in which Spark adds
# them up cannot decide a tie; ties go to the first label.
VOTE_DECIMALS = 12
UNROLLED_LABELS = 256


def normalise_weights(weights: DataFrame) -> DataFrame:
    """``(model, weight)`` scaled to sum 1; if none is positive, all become equal.

    One row per model.
    """
    everything = Window.partitionBy(F.lit(1))
    w = F.when(F.max("weight").over(everything) <= 0, F.lit(1.0)).otherwise(F.col("weight").cast("double"))
    return weights.withColumn("_w", w).select(
        "model", (F.col("_w") / F.sum("_w").over(everything)).alias("weight")
    )


def align_long(long_proba: DataFrame, labels: list[str]) -> DataFrame:
    """``(doc_id, model, proba)`` with the array in label order; absent labels get 0.

    ``long_proba`` is ``(doc_id, model, label, p)``.  One running value per label keeps the
    aggregation partial and its state fixed in size.
    """
    slots = [F.max(F.when(F.col("label") == x, F.col("p"))).alias(f"_p{j}") for j, x in enumerate(labels)]
    return long_proba.groupBy("doc_id", "model").agg(*slots).select(
        "doc_id",
        "model",
        F.array(*[F.coalesce(f"_p{j}", F.lit(0.0)) for j in range(len(labels))]).alias("proba"),
    )


def with_probabilities(preds: DataFrame) -> DataFrame:
    """Only models whose predictions carry probabilities can vote."""
    return preds.filter("proba IS NOT NULL")


def _vote_label(votes: Column, labels: list[str]) -> Column:
    rounded = F.transform(votes, lambda x: F.round(x, VOTE_DECIMALS))
    return F.get(F.array(*[F.lit(x) for x in labels]), argmax_index(rounded).cast("int"))


def soft_vote(preds: DataFrame, weights: DataFrame, labels: list[str]) -> DataFrame:
    """``(doc_id, y_true, y_pred, proba)`` of the weighted vote.

    One shuffle on the document, with partial sums before it: a fixed number of running
    sums per document instead of a list of its probability arrays.
    """
    weighted = with_probabilities(preds).join(F.broadcast(normalise_weights(weights)), "model")
    if len(labels) <= UNROLLED_LABELS:
        sums = [F.sum(F.col("weight") * F.get("proba", F.lit(j))).alias(f"_v{j}") for j in range(len(labels))]
        voted = weighted.groupBy("doc_id").agg(F.first("y_true").alias("y_true"), *sums)
        votes = F.array(*[F.col(f"_v{j}") for j in range(len(labels))])
    else:
        cells = weighted.select("doc_id", "y_true", "weight", F.posexplode("proba").alias("j", "p"))
        per_label = cells.groupBy("doc_id", "j").agg(
            F.first("y_true").alias("y_true"), F.sum(F.col("weight") * F.col("p")).alias("v")
        )
        voted = per_label.groupBy("doc_id").agg(
            F.first("y_true").alias("y_true"),
            F.sort_array(F.collect_list(F.struct("j", "v"))).alias("_e"),
        )
        votes = F.transform("_e", lambda e: e["v"])
    return voted.select("doc_id", "y_true", votes.alias("proba")).withColumn(
        "y_pred", _vote_label(F.col("proba"), labels)
    )


# --- ranking --------------------------------------------------------------


def rank_results(results: DataFrame) -> DataFrame:
    """Rank by macro-F1, then accuracy (missing counts as -1), then name."""
    order = Window.orderBy(
        F.coalesce(F.nanvl("macro_f1", F.lit(-1.0)), F.lit(-1.0)).desc(),
        F.coalesce(F.nanvl("accuracy", F.lit(-1.0)), F.lit(-1.0)).desc(),
        "model",
    )
    return results.withColumn("rank", F.row_number().over(order))


def top_models(results: DataFrame, n: int = 5) -> DataFrame:
    return rank_results(results).orderBy("rank").limit(n)


def rank_score(results: DataFrame) -> DataFrame:
    """Cross-validated macro-F1, else holdout macro-F1, else 0."""
    cv, hold = (F.nanvl(c, F.lit(None).cast("double")) for c in ("cv_macro_f1_mean", "holdout_macro_f1"))
    return results.withColumn("rank_score", F.coalesce(cv, hold, F.lit(0.0)))


# --- one row per document, for repeated voting ----------------------------


def model_matrix(preds: DataFrame, models: list[str]) -> DataFrame:
    """``(doc_id, y_true, probas)``: probability arrays of all candidates in model order.

    One shuffle on the document; every later vote is then a row-local expression.
    """
    by_model = F.map_from_entries(F.collect_list(F.struct("model", "proba")))
    wide = with_probabilities(preds).filter(F.col("model").isin(models)).groupBy("doc_id").agg(
        F.first("y_true").alias("y_true"), by_model.alias("m")
    )
    order = F.array(*[F.lit(m) for m in models])
    return wide.select(
        "doc_id", "y_true", F.transform(order, lambda name: F.try_element_at("m", name)).alias("probas")
    )


def trial_scores(
    matrix: DataFrame, models: list[str], selected: list[str], candidates: list[str],
    weights: dict[str, float], labels: list[str],
) -> dict[str, tuple[float, float]]:
    """``candidate -> (macro_f1, accuracy)`` of selected + candidate, in one Spark job.

    The selected models' weighted sum is made once per document; the candidates are rows that
    are exploded against it, so the plan has one expression however many candidates there are.
    """
    at = {m: i for i, m in enumerate(models)}
    rows = []
    for c in candidates:
        raw = [float(weights[n]) for n in (*selected, c)]
        equal = all(w <= 0 for w in raw)
        rows.append({"model": c, "at": at[c], "weight": 1.0 if equal else raw[-1], "total": float(len(raw)) if equal else sum(raw), "equal": equal})

    def summed(pairs: list[tuple[int, float]]) -> Column:
        """Weighted sum of the selected models' arrays; zeros if there is none."""
        first = F.transform(F.get("probas", F.lit(at[candidates[0]])), lambda x: F.lit(0.0))
        if not pairs:
            return first
        listed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in pairs])
        return F.aggregate(listed, first, lambda acc, p: F.zip_with(acc, F.get("probas", p["i"]), lambda a, b: a + b * p["w"]))

    based = matrix.select(
        "y_true", "probas", summed([(at[n], float(weights[n])) for n in selected]).alias("_raw"), summed([(at[n], 1.0) for n in selected]).alias("_one")
    )
    offered = F.from_json(F.lit(json.dumps(rows)), "array<struct<model:string,at:int,weight:double,total:double,equal:boolean>>")
    each = based.select("*", F.explode(offered).alias("c"))
    base = F.when(F.col("c.equal"), F.col("_one")).otherwise(F.col("_raw"))
    votes = F.zip_with(base, F.get("probas", F.col("c.at")), lambda a, b: (a + b * F.col("c.weight")) / F.col("c.total"))
    voted = each.select("y_true", F.col("c.model").alias("model"), _vote_label(votes, labels).alias("y_pred"))
    return {r["model"]: (r["macro_f1"], r["accuracy"]) for r in scores(voted, "model").collect()}


# --- greedy selection -----------------------------------------------------
#
# The loops run over model names and the collected models x models summary; anything that
# looks at documents is a Spark job.


class PairTable:
    """Pair statistics of a few models, looked up in either order."""

    def __init__(self, rows):
        self.rows = {}
        for r in rows:
            self.rows[frozenset((r["a"], r["b"]))] = (r["error_corr"], r["double_fault"])

    @classmethod
    def collect(cls, pairs: DataFrame) -> PairTable:
        return cls(pairs.select("a", "b", "error_corr", "double_fault").collect())

    def _mean(self, name: str, selected: list[str], which: int) -> float | None:
        values = []
        for s in selected:
            if frozenset((name, s)) not in self.rows:
                raise KeyError(f"no pair statistics for {name!r} and {s!r}")
            v = self.rows[frozenset((name, s))][which]
            if v is None or math.isnan(v):
                return None  # a constant error column has no correlation
            values.append(v)
        return sum(values) / len(values) if values else None

    def mean_corr(self, name: str, selected: list[str]) -> float | None:
        return self._mean(name, selected, 0)

    def mean_double_fault(self, name: str, selected: list[str]) -> float | None:
        return self._mean(name, selected, 1)


def _exceeds(value: float | None, bound: float) -> bool:
    return value is not None and value > bound


def select_by_threshold(
    ranked: list[str], pairs: PairTable, max_corr: float = 0.3, max_double_fault: float = 0.10,
    max_models: int = 5,
) -> list[str]:
    """Walk the ranking and keep models that err differently from those kept so far."""
    chosen: list[str] = []
    for name in ranked:
        if chosen and (
            _exceeds(pairs.mean_corr(name, chosen), max_corr)
            or _exceeds(pairs.mean_double_fault(name, chosen), max_double_fault)
        ):
            continue
        chosen.append(name)
        if len(chosen) >= max_models:
            break
    return chosen


def select_forward(
    ranked: list[str], pairs: PairTable, score_trials, max_corr: float = 0.5, max_models: int = 5,
) -> tuple[list[str], float]:
    """Start with the best model and add the candidate with the largest gain each round.

    ``score_trials(selected, candidates)`` returns macro-F1 per candidate.  A candidate needs
    a mean error correlation of at most ``max_corr``; an undefined one does not pass.
    """
    if not ranked:
        return [], -1.0
    chosen = [ranked[0]]
    best = score_trials([], [ranked[0]])[ranked[0]][0]
    while len(chosen) < max_models:
        allowed = []
        for name in ranked:
            if name in chosen:
                continue
            corr = pairs.mean_corr(name, chosen)
            if corr is not None and corr <= max_corr:
                allowed.append(name)
        if not allowed:
            break
        trial = score_trials(chosen, allowed)
        winner = max(allowed, key=lambda n: (trial[n][0], -ranked.index(n)))
        if trial[winner][0] <= best:
            break
        chosen.append(winner)
        best = trial[winner][0]
    return chosen, best


def select_improving(
    ranked: list[str], pairs: PairTable, score_trials, max_corr: float = 0.6,
    max_double_fault: float = 0.12, max_models: int = 7,
) -> tuple[list[str], float]:
    """Walk the ranking once; keep a model if it is diverse enough and the vote improves."""
    chosen: list[str] = []
    best = -1.0
    for name in ranked:
        if chosen and (
            _exceeds(pairs.mean_corr(name, chosen), max_corr)
            or _exceeds(pairs.mean_double_fault(name, chosen), max_double_fault)
        ):
            continue
        gained = score_trials(chosen, [name])[name][0]
        if not chosen or gained > best:
            chosen.append(name)
            best = gained
        if len(chosen) >= max_models:
            break
    return chosen, best


def final_weights(chosen: list[str], scores_by_name: dict[str, float]) -> dict[str, float]:
    raw = {n: float(scores_by_name[n]) for n in chosen}
    if raw and all(w <= 0 for w in raw.values()):
        raw = dict.fromkeys(raw, 1.0)
    total = sum(raw.values())
    return {n: w / total for n, w in raw.items()}
