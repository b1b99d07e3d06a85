"""Helpers shared by the operators: tables, shared scratch storage, words, Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[ \t\n\x0b\f\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; in plain local mode one is made where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    made = "file://" + tempfile.mkdtemp(prefix="lexigrid-shared-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/lexigrid-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropping_shuffles(spark: SparkSession, job: Callable[[], DataFrame]) -> DataFrame:
    """Run a job whose shuffle files go as soon as it has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        return job()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def words(text: Column) -> Column:
    """Runs of other than space and U+0009 to U+000D; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words, without building more than one array."""
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE_CLASS}|{SPACE_CLASS}\\z", "")
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, SPACE_CLASS))).cast("long")


_OTHER_SPACE = re.compile(r"[^\S \n]|\x00")


def is_plain(text: str) -> bool:
    """Whether words stand behind single blanks or line feeds only, with no other white space and no zero character."""
    if len(text.split()) != text.count(" ") + text.count("\n") + 1:
        return False
    return text.replace("\n", "").isprintable() or not _OTHER_SPACE.search(text)


def raw(column: pa.Array) -> list[bytes]:
    """Bytes of a binary column; null becomes empty."""
    return [b"" if x is None else x for x in column.to_pylist()]


def by_rows(make: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = 512) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that handles a bounded number of rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield make(batch.slice(at, rows))

    return run
