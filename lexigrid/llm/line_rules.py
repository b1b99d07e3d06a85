"""Quality rules with cross-document line frequencies, in DataFrame functions only.

Lines are normalised (lower case, runs of digits to one 0, blanks to one space, trimmed) and hashed; a line's frequency is the
number of documents of one host that hold it. Lines above both limits, `max_docs` documents and one document in `max_share`
of the host, are boilerplate. A document is depleted, and rejected, if boilerplate lines hold more than `max_removed` of its
words or leave fewer than `min_words`. A document is also rejected if it fails the base rules (see `base_statistics`).

A document's lines are made distinct before they are counted, and counts are summed before the shuffle, so a line that a third
of all documents hold costs a few rows. Frequent lines meet the documents' lines in a join that adaptive execution can split.

Defined cases: null and blank texts have no words and fail the base rules; a null host is a host of its own; rows of equal
doc_id each keep a row, and count as one document in a line's frequency; rows without a doc_id count as one document together;
an empty table gives no rows. Only doc_id, text and the host column are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import SPACES, stored, words

#: A line is boilerplate if more than one in MAX_SHARE of its host's documents hold it, and more documents than a few.
MAX_DOCS, MAX_SHARE = 3, 20
#: A document is depleted if over this share of its words goes, or fewer words than this stay.
MAX_REMOVED, MIN_WORDS = 0.8, 10

SYMBOLS = "#*$%&|<>"


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), r"\s+", " "))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.translate(x, SPACES, "") != "")


#: 5-word windows by hash, then, for texts that hold one twice, their places: neighbours of equal hash in sorted order.
_GRAMS = """CASE WHEN size(_words) < 5 THEN cast(array() AS array<bigint>) ELSE
    transform(sequence(0, size(_words) - 5), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2], _words[i + 3], _words[i + 4])) END"""
_SORTED = """CASE WHEN size(array_distinct(_grams)) < size(_grams) THEN
    array_sort(transform(_grams, (g, i) -> named_struct('g', g, 'i', i))) END"""
_PLACES = """array_sort(transform(
    filter(_sorted, (s, k) -> coalesce(s.g = get(_sorted, k - 1).g, false) OR coalesce(s.g = get(_sorted, k + 1).g, false)), s -> s.i))"""
_COVERED = "aggregate(transform(_places, (p, k) -> least(5, coalesce(get(_places, k + 1) - p, 5))), 0L, (a, x) -> a + x)"


def base_statistics(docs: DataFrame, *keep: Column) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of every row, beside the columns to keep."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [F.col(c) for c in docs.select(*keep).columns]
    df = docs.select(*keep, text.alias("_text"), F.transform(words(text), lambda w: F.xxhash64(w)).alias("_words"), lines_with_words(text).alias("_lines"))
    df = df.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(_GRAMS).alias("_grams"),
    )
    for name, made in (("_sorted", _SORTED), ("_places", _PLACES), ("n_repeat_words", f"coalesce({_COVERED}, 0L)")):
        df = df.withColumn(name, F.expr(made))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.select(*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


def document_lines(docs: DataFrame, host: str) -> DataFrame:
    """Distinct normalised lines of each document (doc_id, host, text_hash): their hash and how many words they hold."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).alias("host"), F.xxhash64(text).alias("text_hash"), F.explode(lines_with_words(text)).alias("line"))
    hashed = lines.select("doc_id", "host", "text_hash", F.xxhash64(normalised(F.col("line"))).alias("line"), F.size(words(F.col("line"))).alias("n"))
    return hashed.groupBy("doc_id", "host", "text_hash", "line").agg(F.sum("n").alias("n"))


def frequent_lines(lines: DataFrame, max_docs: int, max_share: int) -> DataFrame:
    """(host, line) of lines that too many documents of the host hold."""
    counts = lines.select("host", "line", "doc_id").distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > max_docs)
    hosts = lines.select("host", "doc_id").distinct().groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("all_docs"))
    both = counts.join(hosts, F.col("host").eqNullSafe(F.col("of")))
    return both.filter(F.col("n_docs") * max_share > F.col("all_docs")).select(F.col("host").alias("of"), F.col("line").alias("frequent"))


def without_frequent_lines(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, max_share: int = MAX_SHARE) -> DataFrame:
    """Every row with all its columns, and the text without its host's boilerplate lines; a text that holds none is as it was."""
    lines = stored(document_lines(docs, host), "lines")
    frequent = frequent_lines(lines, max_docs, max_share)
    marked = lines.join(frequent, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("frequent")))
    gone = marked.groupBy(F.col("doc_id").alias("_doc"), F.col("host").alias("_host"), F.col("text_hash").alias("_hash")).agg(F.collect_set("line").alias("_gone"))
    doc_id, of, text_hash = (F.col(f"_row.{c}") for c in ("doc_id", host, "text"))
    rows = docs.select(F.struct("*").alias("_row"))
    text_hash = F.xxhash64(F.coalesce(text_hash, F.lit("")))
    joined = rows.join(gone, doc_id.cast("long").eqNullSafe(F.col("_doc")) & of.eqNullSafe(F.col("_host")) & (text_hash == F.col("_hash")), "left")
    stays = F.filter(F.split("_row.text", "\n", -1), lambda x: (F.translate(x, SPACES, "") == "") | ~F.array_contains("_gone", F.xxhash64(normalised(x))))
    text = F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(F.array_join(stays, "\n"))
    return joined.select(*[text.alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns])


def judged(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, max_share: int = MAX_SHARE, max_removed: float = MAX_REMOVED, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row's doc_id and host, base statistics, words in boilerplate lines (n_boilerplate) and whether it is kept."""
    lines = stored(document_lines(docs, host), "lines")
    frequent = frequent_lines(lines, max_docs, max_share)
    marked = lines.join(frequent, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("frequent")))
    # a repeated row counts its words once: lines of equal rows were summed, so their share is taken
    total = lines.groupBy("doc_id", "host", "text_hash").agg(F.sum("n").alias("total"))
    removed = marked.groupBy("doc_id", "host", "text_hash").agg(F.sum("n").alias("removed"))
    key = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["host"].eqNullSafe(b["host"]) & (a["text_hash"] == b["text_hash"])
    share = total.join(removed, key(total, removed)).select(
        total["doc_id"].alias("_doc"), total["host"].alias("_host"), total["text_hash"].alias("_hash"), (F.col("removed") / F.col("total")).alias("share")
    )
    base = base_statistics(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col(host).alias("host"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    known = F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("host").eqNullSafe(F.col("_host")) & (F.col("text_hash") == F.col("_hash"))
    joined = base.join(share, known, "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    gone = F.round(F.col("share") * F.col("n_words")).cast("long")
    depleted = (F.col("share") > 0) & ((F.col("share") > max_removed) | (F.col("n_words") - gone < min_words))
    return joined.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        gone.alias("n_boilerplate"), (~F.col("base_failed") & ~depleted).alias("kept"),
    )
