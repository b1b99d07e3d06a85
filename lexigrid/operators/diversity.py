"""How much the errors of models overlap.

Documents are first reduced to their error pattern (which models were wrong); equal patterns
are counted, and only the distinct patterns are expanded to pairs of models that were wrong
together.  The other three cells of each pair follow from the error totals of the models, so
pairs that were right together are never emitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def error_matrix(preds: DataFrame) -> DataFrame:
    """Long 0/1 errors ``(doc_id, model, err)``."""
    return preds.select(
        "doc_id", "model", (~F.col("y_true").eqNullSafe(F.col("y_pred"))).cast("int").alias("err")
    )


def error_patterns(preds: DataFrame) -> DataFrame:
    """``(wrong, n)``: sorted array of the models that failed, and how many documents share it."""
    wrong = F.collect_set(F.when(F.col("err") == 1, F.col("model")))
    per_doc = error_matrix(preds).groupBy("doc_id").agg(F.sort_array(wrong).alias("wrong"))
    return per_doc.groupBy("wrong").agg(F.count("*").alias("n"))


def _error_totals(preds: DataFrame) -> DataFrame:
    """``(model, errors, n)``; one row per model."""
    return error_matrix(preds).groupBy("model").agg(
        F.sum("err").cast("long").alias("errors"), F.count("*").alias("n")
    )


def both_wrong(patterns: DataFrame) -> DataFrame:
    """``(a, b, n00)`` for a < b over the documents on which both models fail."""
    first = patterns.select("wrong", "n", F.posexplode("wrong").alias("i", "a"))
    # the pattern is sorted, so the models after position i are the partners of a
    partners = F.slice("wrong", F.col("i") + 2, F.size("wrong"))
    return (
        first.select("a", "n", F.explode(partners).alias("b"))
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n00"))
    )


def pair_counts(preds: DataFrame) -> DataFrame:
    """``(a, b, n, n11, n00, n10, n01)`` for every pair of models a < b.

    n11 both right, n00 both wrong, n10 only a right, n01 only b right.  Every model must
    have predicted the same documents.
    """
    totals = _error_totals(preds)
    # one row per model, so the sorted list of all models is one small array
    listed = totals.agg(F.sort_array(F.collect_list(F.struct("model", "errors", "n"))).alias("all"))
    first = listed.select("all", F.posexplode("all").alias("i", "x"))
    pairs = first.select(
        F.col("x.model").alias("a"), F.col("x.errors").alias("ea"), F.col("x.n").alias("n"),
        F.explode(F.slice("all", F.col("i") + 2, F.size("all"))).alias("y"),
    ).select("a", "ea", "n", F.col("y.model").alias("b"), F.col("y.errors").alias("eb"))
    together = both_wrong(error_patterns(preds))
    return pairs.join(together, ["a", "b"], "left").select(
        "a",
        "b",
        "n",
        (F.col("n") - F.col("ea") - F.col("eb") + F.coalesce("n00", F.lit(0))).alias("n11"),
        F.coalesce("n00", F.lit(0)).alias("n00"),
        (F.col("eb") - F.coalesce("n00", F.lit(0))).alias("n10"),
        (F.col("ea") - F.coalesce("n00", F.lit(0))).alias("n01"),
    )


def _phi() -> Column:
    n11, n00, n10, n01 = (F.col(c).cast("double") for c in ("n11", "n00", "n10", "n01"))
    spread = F.sqrt((n11 + n10) * (n01 + n00) * (n11 + n01) * (n10 + n00))
    return F.try_divide(n11 * n00 - n10 * n01, spread)


def pairwise_diversity(preds: DataFrame) -> DataFrame:
    """Disagreement, double fault, Yule's Q and error correlation per pair.

    Q is 0 where its denominator is 0; the correlation is NULL where a model is always
    right or always wrong.
    """
    n11, n00, n10, n01 = (F.col(c).cast("double") for c in ("n11", "n00", "n10", "n01"))
    q_den = n11 * n00 + n10 * n01
    return pair_counts(preds).select(
        "a", "b", "n11", "n00", "n10", "n01",
        ((n10 + n01) / F.col("n")).alias("disagreement"),
        (n00 / F.col("n")).alias("double_fault"),
        F.coalesce(F.try_divide(n11 * n00 - n10 * n01, q_den), F.lit(0.0)).alias("yules_q"),
        _phi().alias("error_corr"),
    )


def full_correlation(preds: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Long symmetric ``(a, b, corr)`` with the diagonal (1, or NULL for constant errors)."""
    pairs = pairwise_diversity(preds) if pairs is None else pairs
    up = pairs.select("a", "b", F.col("error_corr").alias("corr"))
    down = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("error_corr").alias("corr"))
    diag = _error_totals(preds).select(
        F.col("model").alias("a"),
        F.col("model").alias("b"),
        F.when((F.col("errors") > 0) & (F.col("errors") < F.col("n")), F.lit(1.0)).alias("corr"),
    )
    return up.unionByName(down).unionByName(diag)


def pair_lookup(requests: DataFrame, pairs: DataFrame) -> DataFrame:
    """Statistics of requested pairs, in either order."""
    keyed = requests.select(
        "*", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    )
    return keyed.join(pairs, ["a", "b"], "left").drop("a", "b")
