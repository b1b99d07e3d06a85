"""Substring deduplication by relative Lempel-Ziv parsing of documents against everything that documents before them hold.

The reference of a document is all text of documents with a smaller doc_id. It is cut into content-defined blocks: a stretch of
windows of `width` words with one anchor gram, plus the words those windows reach over (see windows.py). Blocks are indexed by
anchor gram and content hash, each under the first document that holds it; the index is spread over the cluster by hash, so
every document is parsed against every part of it by one join.

Documents are not parsed in order: window hashing replaces the greedy factorisation. Every block that a document before it holds
is found by the join, all at once, and what blocks and windows cover is united; a factor of at least `width` words is a run of
such windows, so the same words go. At factor boundaries a block can hold some repeated windows though it is not repeated as a whole. Such blocks share
their anchor gram with another block of the index; only these are opened, and their windows are looked up one by one among the
windows of the blocks with that gram. Windows hold their words' hashes, so equal windows are found wherever they stand.

Defined cases: null and blank texts have no words and lose none; texts shorter than `width` lose none; rows of equal doc_id are
one document, which repeats nothing of itself; a row without a doc_id is neither before nor after any other and loses none; an
empty table gives no rows. Only doc_id and text are read. Texts may be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import dropping_shuffles, raw, stored
from lexigrid.llm.windows import by_bytes, covered, packed, stretches, unpacked

WIDTH, GRAM = 50, 8


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _blocks(width: int, gram: int):
    """Blocks of texts: anchor gram, content hash, document, place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 2):
            texts = [t.split() for t in raw(batch.column(2))]
            codes = np.concatenate([word_codes(w) for w in texts])
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            found = stretches(lambda a, b: codes[a:b], lengths, width, gram)
            begin = (np.cumsum(lengths) - lengths)[found.doc] + found.start
            data = codes.tobytes()
            content = np.fromiter(
                (xxhash.xxh3_64_intdigest(data[8 * a : 8 * b]) for a, b in zip(begin.tolist(), (begin + found.count - 1 + width).tolist())), np.uint64, len(begin)
            )
            doc, text_hash = (batch.column(i).to_numpy()[found.doc] for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (found.gram.view(np.int64), content.view(np.int64), doc, text_hash, packed(found.start, found.count, found.anchor))],
                ["gram", "content", "doc_id", "text_hash", "pack"],
            )

    return run


def _opened(width: int):
    """Windows of blocks: 128-bit key, document, place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 2):
            for doc, text_hash, text, packs in zip(*(batch.column(i).to_pylist() for i in range(4))):
                data = word_codes(text.split()).tobytes()
                start, count, _ = unpacked(np.unique(np.array(packs, np.int64)))
                at = np.concatenate([np.arange(a, a + n) for a, n in zip(start, count)])
                keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(data[8 * i : 8 * (i + width)]) for i in at.tolist()), ">i8").astype(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(np.full(len(at), doc)), pa.array(np.full(len(at), text_hash)), pa.array(at)],
                    ["high", "low", "doc_id", "text_hash", "start"],
                )

    return run


def repeated_windows(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_hash, start, count): runs of window starts whose windows a document with a smaller doc_id holds."""
    spark = docs.sparkSession
    texts = _texts(docs).filter("doc_id is not null")
    blocks = dropping_shuffles(spark, lambda: stored(texts.mapInArrow(_blocks(width, gram), "gram long, content long, doc_id long, text_hash long, pack long"), "blocks"))
    # the index: each block under its first document; grams with more than one content, whose first documents differ
    index = blocks.groupBy("gram", "content").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = index.groupBy("gram").agg(F.min("first").alias("least"), F.max("first").alias("most")).filter("least < most").select("gram", F.lit(True).alias("shared"))
    index = index.join(shared, "gram", "left").filter("first < last or shared").select("gram", "content", "first", F.coalesce("shared", F.lit(False)).alias("shared"))
    found = blocks.join(index, ["gram", "content"]).select("doc_id", "text_hash", "pack", (F.col("doc_id") > F.col("first")).alias("repeated"), "shared").filter("repeated or shared")
    found = dropping_shuffles(spark, lambda: stored(found, "found"))
    factors = found.filter("repeated").select("doc_id", "text_hash", F.shiftright("pack", 18).alias("start"), (F.shiftright("pack", 9).bitwiseAND(F.lit(511)) + 1).alias("count"))

    # factor boundaries: the first holders of blocks that share their gram, window by window
    edges = found.filter("shared and not repeated").groupBy("doc_id", "text_hash").agg(F.collect_set("pack").alias("packs"))
    opened = texts.join(edges, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "packs").mapInArrow(_opened(width), "high long, low long, doc_id long, text_hash long, start long")
    windows = dropping_shuffles(spark, lambda: stored(opened, "windows"))
    first = windows.groupBy("high", "low").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("high", "low", "first")
    late = windows.join(first, ["high", "low"]).filter("doc_id > first").select("doc_id", "text_hash", "start", F.lit(1).cast("long").alias("count"))
    return factors.unionByName(late)


def listed_runs(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_hash, runs): the distinct runs of each document; rows that repeat one as a whole add none."""
    return repeated_windows(docs, width, gram).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "count")).alias("runs"))


def _parsed(width: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            out: list[tuple] = []
            for doc, text, runs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = text.split()
                factors: list[int] = []
                if runs:
                    starts, counts = (np.array([r[f] for r in runs], np.int64) for f in ("start", "count"))
                    factors = covered(starts, counts, width, len(words)).tolist()
                kept = b" ".join(w for a, b in zip([0, *factors[1::2]], [*factors[::2], len(words)]) for w in words[a:b])
                removed = sum(factors[1::2]) - sum(factors[::2])
                out.append((doc, len(words), removed, factors, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), PARSED.types)], PARSED.names)

    return run


PARSED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.int64())), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def deduplicated(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """Every row: doc_id, n_words, n_removed, spans ([from, to, ...] of removed words), kept_sha256, and the kept words if asked for."""
    runs = listed_runs(docs, width, gram)
    joined = _texts(docs).join(runs, ["doc_id", "text_hash"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_parsed(width, keep_text), "doc_id long, n_words long, n_removed long, spans array<long>, kept_sha256 string, kept binary")
