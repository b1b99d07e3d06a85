"""Study store: features and predictions in Parquet, keyed by split, model and parameters.

Everything lives under one shared folder, so executors can be lost and a second run of a
study reads what the first one finished.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.session import ensure_checkpoint_dir


def _named(value):
    """JSON for what JSON has no form for; a function counts by its module and name."""
    if callable(value):
        return f"{getattr(value, '__module__', '')}.{getattr(value, '__qualname__', type(value).__qualname__)}"
    return list(value)


def params_hash(*specs) -> str:
    """Key of a component: class and parameters, not just its name."""
    text = json.dumps(specs, sort_keys=True, ensure_ascii=False, default=_named)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


class StudyStore:
    """Parquet tables of one study under ``root``."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        if root is None:
            # scratch study: next to the checkpoints, the folder every executor can reach
            ensure_checkpoint_dir(spark)
            root = f"{spark.sparkContext.getCheckpointDir()}/study-{uuid.uuid4().hex}"
        self.root = root.rstrip("/")

    def _exists(self, path: str) -> bool:
        """A table counts once its job has committed."""
        jvm = self.spark.sparkContext._jvm
        done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return done.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(done)

    def table(self, path: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Read ``path`` if it is complete, else build, write and read it."""
        full = f"{self.root}/{path}"
        if not self._exists(full):
            build().write.mode("overwrite").parquet(full)
        return self.spark.read.parquet(full)

    def has(self, path: str) -> bool:
        return self._exists(f"{self.root}/{path}")

    def features(self, split_id: str, name: str, key: str, part: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self.table(f"features/split_id={split_id}/vectorizer={key}/part={part}", build)

    def predictions_path(self, split_id: str, key: str) -> str:
        return f"predictions/split_id={split_id}/model_key={key}"

    def predictions(self, split_id: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self.table(self.predictions_path(split_id, key), build)

    def all_predictions(self, split_id: str, keys: list[str]) -> DataFrame:
        """Stored predictions of the given model keys, as one table."""
        base = f"{self.root}/predictions/split_id={split_id}"
        return self.spark.read.option("basePath", base).parquet(*[f"{base}/model_key={k}" for k in keys]).drop("model_key")


def reorder_probabilities(preds: DataFrame, stored: list[str], current: list[str]) -> DataFrame:
    """Bring stored probabilities into the order of the current label space."""
    if stored == current:
        return preds
    if sorted(stored) != sorted(current):
        raise ValueError("stored and current label spaces differ")
    order = [stored.index(x) for x in current]
    return preds.withColumn("proba", F.array(*[F.get("proba", F.lit(i)) for i in order]))
