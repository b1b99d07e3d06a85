"""Labelled corpora: delimited files, column choice, table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.functions.text import as_text
from lexigrid.session import spread

# Spellings that a data-frame CSV reader takes for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    decimal: str = ",",
) -> DataFrame:
    """Delimited text with a header and quoted, possibly multi-line, fields.

    Multi-line files cannot be split, so a large corpus should come as many files or be
    converted once to Parquet.  Floating columns are read as text and converted, because
    the CSV reader only honours a decimal comma for decimal types.
    """
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    floating = {f.name: f.dataType for f in wanted if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    raw = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in floating else f.dataType) for f in wanted]
    )
    df = spark.read.csv(
        path, schema=raw, sep=sep, header=True, encoding=encoding,
        multiLine=True, quote='"', escape='"', enforceSchema=True,
        locale="pt-BR" if decimal == "," else "en-US",
    )
    return df.select(
        *[
            F.regexp_replace(F.col(f.name), F.lit(decimal), F.lit(".")).cast(f.dataType).alias(f.name)
            if f.name in floating and decimal == ","
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in wanted
        ]
    )


def blank_missing(text):
    """Text column in which every missing-value spelling is NULL."""
    return F.when(~text.isin(*MISSING), text)


def pick(df: DataFrame, column: int | str):
    """A column by position or by name."""
    if isinstance(column, bool) or not isinstance(column, (int, str)):
        raise TypeError("a column is chosen by position (int) or name (str)")
    name = df.columns[column] if isinstance(column, int) else column
    return df[name]


def as_corpus(
    df: DataFrame,
    text_column: int | str = 0,
    label_column: int | str = 1,
    id_column: int | str | None = None,
) -> DataFrame:
    """``(doc_id, text, label)``; the id carries every later split and join."""
    if id_column is None:
        raise ValueError("a corpus needs an id column: rows have no order of their own")
    return df.select(
        pick(df, id_column).cast("long").alias("doc_id"),
        as_text(pick(df, text_column)).alias("text"),
        pick(df, label_column).cast("string").alias("label"),
    )


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def documents(spark: SparkSession, base: str, label: str = "lang") -> DataFrame:
    """Corpus ``(doc_id, text, label)`` from the test tables.

    ``label`` is a column of ``documents`` or of ``labels``; the latter covers a subset.
    """
    docs = table(spark, base, "documents")
    if label in docs.columns:
        return spread(as_corpus(docs, "text", label, "doc_id"), "doc_id")
    # spread the scan, not the join: the join then keeps the partitioning on the id
    texts = spread(docs.select("doc_id", "text"), "doc_id")
    labels = table(spark, base, "labels").select("doc_id", label)
    return as_corpus(texts.join(labels, "doc_id"), "text", label, "doc_id")
