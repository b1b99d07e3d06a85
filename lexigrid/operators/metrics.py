"""Evaluation of stored predictions: every model in one grouped query.

Predictions are long rows ``(doc_id, model, y_true, y_pred, proba)``.  The confusion counts
are the only aggregate over documents; all reports derive from them.
"""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(preds: DataFrame, *keys: str) -> DataFrame:
    """``(keys..., y_true, y_pred, n)``."""
    return preds.groupBy(*keys, "y_true", "y_pred").agg(F.count("*").alias("n"))


def confusion_pivot(preds: DataFrame, labels: list, *keys: str) -> DataFrame:
    return preds.groupBy(*keys, "y_true").pivot("y_pred", labels).count().na.fill(0, [str(x) for x in labels])


def accuracy(preds: DataFrame, *keys: str) -> DataFrame:
    return preds.groupBy(*keys).agg(
        F.avg((F.col("y_true") == F.col("y_pred")).cast("double")).alias("accuracy"),
        F.count("*").alias("n"),
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def per_class(conf: DataFrame, *keys: str) -> DataFrame:
    """``(keys..., label, precision, recall, f1, support)`` from confusion counts.

    Labels are those seen as truth or as prediction; divisions by zero give 0.
    """
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    sides = conf.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"),
                         F.lit(0).cast("long").alias("predicted"), hit.alias("tp")),
                F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("long").alias("support"),
                         F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
            )
        ),
    )
    totals = sides.groupBy(*keys, "label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    return totals.select(
        *keys,
        "label",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
    )


def averages(report: DataFrame, *keys: str) -> DataFrame:
    """One row per key: accuracy, macro and weighted precision/recall/F1, support."""
    total = F.sum("support")

    def weighted(c: str) -> Column:
        return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), total), F.lit(0.0))

    return report.groupBy(*keys).agg(
        weighted("recall").alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("weighted_f1"),
        total.alias("support"),
    )


def classification_report(preds: DataFrame, *keys: str) -> DataFrame:
    """Per-class rows plus ``macro avg`` and ``weighted avg`` rows, in one table."""
    rows = per_class(confusion(preds, *keys), *keys)
    avg = averages(rows, *keys)
    extra = avg.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.lit("macro avg").alias("label"), F.col("macro_precision").alias("precision"),
                         F.col("macro_recall").alias("recall"), F.col("macro_f1").alias("f1"), "support"),
                F.struct(F.lit("weighted avg").alias("label"), F.col("weighted_precision").alias("precision"),
                         F.col("weighted_recall").alias("recall"), F.col("weighted_f1").alias("f1"), "support"),
            )
        ),
    )
    return rows.unionByName(extra)


def scores(preds: DataFrame, *keys: str) -> DataFrame:
    """The averages table straight from predictions."""
    return averages(per_class(confusion(preds, *keys), *keys), *keys)


REPORT_TYPE = "array<struct<label:string,precision:double,recall:double,f1:double,support:bigint>>"


def reports_as_rows(report: DataFrame, *keys: str) -> DataFrame:
    """Fold the long report into one ``report`` array per key (one entry per class)."""
    entry = F.struct("label", "precision", "recall", "f1", "support")
    return report.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("report"))


def archive_report(rows: DataFrame) -> DataFrame:
    """``report`` array to a JSON text column."""
    return rows.withColumn("report_json", F.to_json("report")).drop("report")


def expand_report(archived: DataFrame, *keys: str) -> DataFrame:
    """JSON text back to the long report."""
    return archived.select(*keys, F.inline(F.from_json("report_json", REPORT_TYPE)))


def mean_std(df: DataFrame, metrics: list[str], *keys: str) -> DataFrame:
    """Mean and sample deviation per key; NULL and NaN are skipped.

    A single value has deviation 0, no value at all gives NULL.
    """
    aggs = []
    for m in metrics:
        valid = F.when(F.col(m).isNotNull() & ~F.isnan(m), F.col(m).cast("double"))
        aggs.append(F.avg(valid).alias(f"{m}_mean"))
        aggs.append(
            F.when(F.count(valid) > 1, F.stddev_samp(valid))
            .when(F.count(valid) == 1, F.lit(0.0))
            .alias(f"{m}_std")
        )
    return df.groupBy(*keys).agg(*aggs)


class MacroF1Evaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """Macro-F1 over the union of true and predicted labels, for cross-validation."""

    def __init__(self, labelCol: str = "label_idx", predictionCol: str = "prediction"):
        super().__init__()
        self._setDefault(labelCol="label_idx", predictionCol="prediction")
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        preds = dataset.select(
            F.col(self.getLabelCol()).alias("y_true"), F.col(self.getPredictionCol()).alias("y_pred")
        )
        row = scores(preds).first()
        return float(row["macro_f1"]) if row is not None and row["macro_f1"] is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True
