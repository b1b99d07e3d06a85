"""Suffix-array deduplication: bytes inside strings of `width` bytes that start twice or more anywhere are removed.

Suffixes are taken at content-defined anchors (see windows.py), one for each stretch of windows. Sampled splitters partition
them by range of their leading bytes, and each bucket sorts its suffixes by multikey quicksort. Neighbours with equal leading
grams are compared by the context of their stretch: a stretch whose context stands elsewhere, too, repeats as a whole; one
whose gram stands alone does not repeat at all. A gram so frequent that it fills several splitters is spread over their buckets
and compared across these boundaries by counts.

What is left, stretches that share their gram with other contexts only, is bounded by the edges of repeated passages. It is cut
into stretches of at most `STEP` windows, which are compared in the same two ways, and what is left then window by window. Each
repeated context sends one representative to these comparisons. All comparisons count equal keys, summed before the shuffle, so
a group of copies costs a row for each task, and pairs are never made.

Defined cases: null and empty texts have no bytes and lose none; texts shorter than `width` lose none; a row repeated with equal
doc_id and text is another place, so both lose what they share; rows of equal doc_id with different texts are judged apart; a
null doc_id is an id like any other; an empty table gives no rows. Only doc_id and text are read. Texts may be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import dropping_shuffles, raw, stored
from lexigrid.llm.windows import by_bytes, covered, packed, stretches, unpacked

WIDTH, GRAM, STEP = 200, 32, 24
#: Suffixes in a bucket, about; sampled suffixes for each bucket; splitters at most (16 bytes each).
BUCKET, SAMPLED, MAX_SPLITTERS = 40_000, 64, 1 << 20

#: States of a suffix: repeated, repeated and representative of its context, to be compared further, alone so far.
REPEATED, REPRESENTATIVE, OPEN, SPREAD = 1, 2, 3, 4

_CODES = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)


def row_key() -> Column:
    """Names a row by what it holds."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(row_key().alias("key"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


SUFFIX = "lead long, gram long, context long, key long, pack long, bucket int, spread boolean"


def _suffixes(splitters: np.ndarray, width: int, gram: int):
    """Suffix rows of texts: leading 8 bytes, hash of the leading gram, hash of the stretch's context, place, bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            texts = raw(batch.column(1))
            data = b"".join(texts)
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            flat = np.frombuffer(data, np.uint8)
            found = stretches(lambda a, b: _CODES[flat[a:b]], lengths, width, gram)
            base = (np.cumsum(lengths) - lengths)[found.doc]
            begin = base + found.start
            context = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(begin.tolist(), (begin + found.count - 1 + width).tolist())), np.uint64, len(begin))
            lead = np.zeros(len(begin), np.uint64)
            for i in range(8):
                lead = lead << np.uint64(8) | flat[base + found.anchor + i]
            bucket, spread = routed(lead, found.gram, context, base + found.start, splitters)
            keys = batch.column(0).to_numpy()[found.doc]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lead.view(np.int64)), pa.array(found.gram.view(np.int64)), pa.array(context.view(np.int64)), pa.array(keys),
                    pa.array(packed(found.start, found.count, found.anchor)), pa.array(bucket.astype(np.int32)), pa.array(spread),
                ],
                ["lead", "gram", "context", "key", "pack", "bucket", "spread"],
            )

    return run


def sort_keys(lead: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Leading bytes and gram as strings that compare like them."""
    return np.stack([lead, gram], axis=1).astype(">u8").view("S16").ravel()


def routed(lead: np.ndarray, gram: np.ndarray, context: np.ndarray, place: np.ndarray, splitters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each suffix, and whether its gram fills several splitters and is spread over their buckets."""
    at = sort_keys(lead, gram)
    low, high = np.searchsorted(splitters, at, "left"), np.searchsorted(splitters, at, "right")
    spread = high - low >= 2
    turn = ((context ^ place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
    return np.where(spread, low + turn % np.maximum(high - low, 1), low), spread


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """Multikey quicksort with 8-byte characters: sort by one, then only what ties by the next."""
    order = np.argsort(keys[0], kind="stable")
    group = np.zeros(len(order), np.int64)
    for before, key in zip(keys, keys[1:]):
        ordered = before[order]
        group = np.cumsum(np.concatenate(([0], (ordered[1:] != ordered[:-1]) | (group[1:] != group[:-1])))) if len(order) else group
        tied = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        places = np.flatnonzero(tied)
        within = np.lexsort((key[order[places]], group[places]))
        order[places] = order[places][within]
    return order


RESULT = pa.schema([("key", pa.int64()), ("pack", pa.int64()), ("state", pa.int8()), ("gram", pa.int64()), ("context", pa.int64()), ("spread", pa.bool_())])


def sorted_bucket(bucket: pa.Table) -> pa.Table:
    """Sorts one bucket and compares neighbours; suffixes that stand alone are left out."""
    lead, gram, context, key, pack = (bucket.column(c).to_numpy() for c in ("lead", "gram", "context", "key", "pack"))
    spread = bucket.column("spread").to_numpy(zero_copy_only=False)
    order = multikey_order([lead.view(np.uint64), gram.view(np.uint64), context.view(np.uint64)])
    lead, gram, context, key, pack, spread = (x[order] for x in (lead, gram, context, key, pack, spread))
    new_gram = np.concatenate(([True], (lead[1:] != lead[:-1]) | (gram[1:] != gram[:-1])))
    new_context = new_gram | np.concatenate(([True], context[1:] != context[:-1]))
    of_gram, of_context = np.cumsum(new_gram) - 1, np.cumsum(new_context) - 1
    several = np.bincount(of_gram, new_context)[of_gram] > 1
    repeated = np.bincount(of_context)[of_context] > 1
    state = np.zeros(len(key), np.int8)
    state[repeated] = REPEATED
    state[repeated & new_context & (several | spread)] = REPRESENTATIVE
    state[~repeated & several] = OPEN
    state[~repeated & spread] = SPREAD
    told = state > 0
    return pa.table([pa.array(x[told]) for x in (key, pack, state, gram, context, spread)], schema=RESULT)


def first_level(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """key, pack and state (REPEATED, REPRESENTATIVE or OPEN) of every suffix that does not stand alone."""
    texts = _texts(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    suffixes = size / ((width - gram) / 2.4) + 1
    buckets = int(min(MAX_SPLITTERS, suffixes // bucket + 1))
    share = min(1.0, SAMPLED * buckets / suffixes)
    none = np.zeros(0, "S16")
    sample = texts.filter(F.pmod("key", F.lit(1 << 20)) < max(1, int(share * (1 << 20)))).mapInArrow(_suffixes(none, width, gram), SUFFIX).select("lead", "gram").toArrow()
    drawn = np.sort(sort_keys(*(sample.column(c).to_numpy().view(np.uint64) for c in ("lead", "gram"))))
    splitters = drawn[(np.arange(1, buckets) * len(drawn)) // buckets] if len(drawn) else none
    rows = texts.mapInArrow(_suffixes(splitters, width, gram), SUFFIX)
    judged = rows.groupBy("bucket").applyInArrow(sorted_bucket, "key long, pack long, state byte, gram long, context long, spread boolean")
    judged = dropping_shuffles(docs.sparkSession, lambda: stored(judged, "suffixes"))
    # across boundaries: spread grams have their contexts counted over all of their buckets
    edge = judged.filter(F.col("spread") & F.col("state").isin(REPRESENTATIVE, SPREAD))
    totals = edge.groupBy("gram", "context").agg(
        F.sum(F.when(F.col("state") == SPREAD, 1).otherwise(2)).alias("n"), F.min(F.when(F.col("state") == SPREAD, F.struct("key", "pack"))).alias("first"), F.max(F.col("state") == REPRESENTATIVE).alias("has")
    )
    alone = edge.filter(F.col("state") == SPREAD).join(totals, ["gram", "context"])
    state = (
        F.when(F.col("n") < 2, OPEN)
        .when((~F.col("has") | F.col("has").isNull()) & (F.struct("key", "pack") == F.col("first")), REPRESENTATIVE)
        .otherwise(REPEATED)
    )
    return judged.filter(F.col("state") != SPREAD).select("key", "pack", "state").unionByName(alone.select("key", "pack", state.cast("byte").alias("state")))


def _open_texts(width: int):
    """Contexts of stretches: (key, start, count, anchor, open, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            out: list[tuple] = []
            for key, text, list_ in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for item in list_:
                    (start,), (count,), (anchor,) = unpacked(np.array([item["pack"]]))
                    out.append((key, int(start), int(count), int(anchor), item["open"], text[start : start + count - 1 + width]))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), CONTEXT.types)], CONTEXT.names)

    return run


CONTEXT = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("count", pa.int32()), ("anchor", pa.int64()), ("open", pa.bool_()), ("bytes", pa.binary())])
CONTEXT_SQL = "key long, start long, count int, anchor long, open boolean, bytes binary"


def _parts(width: int, step: int):
    """Stretches cut at multiples of `step` of their windows' anchor offsets: key of the bytes all windows share, and of all bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, start, count, anchor, open_, data in zip(*(c.to_pylist() for c in batch.columns)):
                most, least = anchor - start, anchor - start - count + 1
                for r in range(least // step, most // step + 1):
                    high, low = min(most, r * step + step - 1), max(least, r * step)
                    a = most - r * step  # where the window with offset r * step would start, from the context's start
                    core = data[a : a - step + 1 + width]
                    part = data[most - high : most - low + width]
                    out.append((_signed(xxhash.xxh3_64_intdigest(core, r)), _signed(xxhash.xxh3_64_intdigest(part)), key, start, most - high, high - low + 1, open_))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], ["core", "part", "key", "start", "skip", "count", "open"])

    return run


def _windows(width: int):
    """Single windows of parts: 128-bit key, place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, start, data, parts in zip(*(c.to_pylist() for c in batch.columns)):
                for part in parts:
                    for i in range(part["skip"], part["skip"] + part["count"]):
                        digest = xxhash.xxh3_128_intdigest(data[i : i + width])
                        out.append((_signed(digest >> 64), _signed(digest & _M64), key, start + i, part["open"]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], ["high", "low", "key", "start", "open"])

    return run


_M64 = (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def repeated_windows(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, step: int = STEP, bucket: int = BUCKET) -> DataFrame:
    """(key, start, count): all windows that also start elsewhere, as runs of consecutive window starts of the rows named by key."""
    spark = docs.sparkSession
    level0 = stored(first_level(docs, width, gram, bucket), "level0")
    start = F.shiftright("pack", 18)
    done = level0.filter(F.col("state") != OPEN).select("key", start.alias("start"), (F.shiftright("pack", 9).bitwiseAND(F.lit(511)) + 1).alias("count"))

    left = level0.filter(F.col("state").isin(REPRESENTATIVE, OPEN)).groupBy("key").agg(F.collect_set(F.struct("pack", (F.col("state") == OPEN).alias("open"))).alias("list"))
    # rows that are repeated as a whole have equal keys: each has all that is listed, once
    contexts = _texts(docs).join(left, "key").mapInArrow(_open_texts(width), CONTEXT_SQL)
    contexts = dropping_shuffles(spark, lambda: stored(contexts, "contexts"))
    times = F.sum(F.when(F.col("open"), 1).otherwise(2)).alias("n")

    parts = stored(contexts.mapInArrow(_parts(width, step), "core long, part long, key long, start long, skip long, count long, open boolean"), "parts")
    kinds = parts.groupBy("core", "part").agg(times, F.min(F.struct("key", "start", "skip", "count")).alias("first"))
    again = kinds.filter("n > 1").select("core", "part")
    done = done.unionByName(parts.filter("open").join(again, ["core", "part"]).select("key", (F.col("start") + F.col("skip")).alias("start"), "count"))
    several = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("core")
    still = kinds.join(several, "core").select("first.*", (F.col("n") < 2).alias("open"))

    by_context = still.groupBy("key", "start").agg(F.collect_list(F.struct("skip", "count", "open")).alias("parts"))
    opened = contexts.select("key", "start", "bytes").dropDuplicates(["key", "start"]).join(by_context, ["key", "start"]).select("key", "start", "bytes", "parts")
    single = stored(opened.mapInArrow(_windows(width), "high long, low long, key long, start long, open boolean"), "windows")
    again = single.groupBy("high", "low").agg(times).filter("n > 1").select("high", "low")
    return done.unionByName(single.filter("open").join(again, ["high", "low"]).select("key", "start", F.lit(1).cast("long").alias("count")))


def listed_runs(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, step: int = STEP, bucket: int = BUCKET) -> DataFrame:
    """(key, runs): the distinct runs of each key; rows that repeat one as a whole add none."""
    return repeated_windows(docs, width, gram, step, bucket).groupBy("key").agg(F.collect_set(F.struct("start", "count")).alias("runs"))


def _digests(width: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            out: list[tuple] = []
            for doc_id, text, runs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                spans: list[int] = []
                if runs:
                    starts, counts = (np.array([r[f] for r in runs], np.int64) for f in ("start", "count"))
                    spans = covered(starts, counts, width, len(text)).tolist()
                kept = b"".join(text[a:b] for a, b in zip([0, *spans[1::2]], [*spans[::2], len(text)]))
                out.append((doc_id, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), DIGEST.types)], DIGEST.names)

    return run


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.int64())), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def deduplicated(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, step: int = STEP, bucket: int = BUCKET, keep_text: bool = False) -> DataFrame:
    """Every row: doc_id, n_bytes, n_removed, spans ([from, to, ...] of removed bytes), kept_sha256, and the kept bytes if asked for."""
    runs = listed_runs(docs, width, gram, step, bucket)
    texts = docs.select(row_key().alias("key"), F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    joined = texts.join(runs, "key", "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_digests(width, keep_text), "doc_id long, n_bytes long, n_removed long, spans array<long>, kept_sha256 string, kept binary")
