"""Session helpers: parallelism, checkpoints and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast side may hold at most this many rows and bytes.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 << 20


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own, with this package installed for their workers."""
    root, known = str(Path(__file__).resolve().parents[1]), os.environ.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lexigrid")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="lexigrid-checkpoint-"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition an input that has fewer splits than the cluster has cores.

    A corpus that already arrives in enough splits is left alone: the text of a large
    corpus is not shuffled just to be tokenised.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def _bytes(value: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        if isinstance(inner, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType)):
            return F.aggregate(F.coalesce(F.transform(value, lambda x: _bytes(x, inner).cast("long")), F.array().cast("array<long>")), F.lit(16).cast("long"), lambda a, x: a + x)
        return F.greatest(F.size(value), F.lit(0)) * 8 + 16
    if isinstance(kind, T.StructType):
        return sum((_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(8))
    if isinstance(kind, T.UserDefinedType):
        return F.octet_length(F.to_json(F.struct(value.alias("v"))))
    if isinstance(kind, T.MapType):
        return F.octet_length(F.to_json(value))
    return F.lit(8)


def fits_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether a table has few enough rows and bytes to be sent to every executor."""
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    width = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(8)).cast("long")
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return n <= max_rows and (size or 0) <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Broadcast hint only behind a check of the size; else leave the choice to Spark."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder that the session names.

    One is made only where none is set and driver and executors are one process, as in tests; on a
    cluster only a named folder is shared by all executors.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="lexigrid-checkpoint-")
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Materialise in reliable storage and forget the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def keep(df: DataFrame) -> DataFrame:
    """Cache with spill to disk for data that several jobs of one step read."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


_in_pool = threading.local()


def run_parallel(spark: SparkSession, tasks: list[Callable], workers: int = 4) -> list:
    """Run independent fits from a few driver threads; Spark interleaves their small jobs.

    Tasks started from inside a task run one after the other in its thread, so there is only
    ever one pool. The first error is raised once all tasks have ended.
    """
    if workers <= 1 or len(tasks) <= 1 or getattr(_in_pool, "on", False):
        return [t() for t in tasks]

    def marked(task: Callable):
        _in_pool.on = True
        return task()

    with ThreadPoolExecutor(min(workers, len(tasks))) as pool:
        inherit = inheritable_thread_target(spark)
        return list(pool.map(lambda t: inherit(marked)(t), tasks))


def pack(df: DataFrame, n_rows: int, rows_per_partition: int = 2000) -> DataFrame:
    """Fewer partitions for a small training set, whose iterations are all task overhead.

    Narrow, and without effect once the data has that many rows per partition.
    """
    return df.coalesce(max(1, -(-n_rows // rows_per_partition)))
