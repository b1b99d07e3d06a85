"""SimHash near-duplicates: fingerprints of word shingles, linked by a binary-trie self-join.

Equal fingerprints are one node, so copies cost one row. Fingerprints that differ in at most `errors` bits agree in at least
one of `errors + 1` bit blocks; rotating each block to the front gives the upper levels of that many binary tries, whose
subtrees Spark deals out. In a task the sorted codes of a subtree are the trie: pairs of nodes are traversed together, level
by level, the differing bits of their edges are added up, and a pair ends when it has used up its error budget. Pairs of nodes
that are one component already are left out, and a task hands on a spanning forest, never all pairs. A subtree with more than
`NODE_LIMIT` codes is dealt out as pairs of its own subtrees. Forests are joined into components by star contraction.

Defined cases: texts without a word (null, empty, blank) have fingerprint zero and are linked like any other; fewer words than
a shingle make one shingle; rows of equal doc_id each keep a row; a null doc_id never names a component unless all of its
members have none; an empty table gives no rows. Other columns are not looked at. Texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import by_rows, raw, stored
from lexigrid.llm.components import component_labels

#: Codes of one trie node that one task takes; larger nodes are split into pairs of nodes below.
NODE_LIMIT = 40_000
#: Node pairs held at once, and leaves whose pairs are compared one by one.
FRONTIER, LEAVES = 1 << 17, 64


def shingle_hashes(text: bytes, shingle: int = 4, seed: int = 42) -> np.ndarray:
    """Hashes of all word shingles, in order; fewer words than a shingle make one, no word none."""
    words = text.lower().split()  # on bytes: A to Z, and the six ASCII blanks
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, n)


def majority(hashes: np.ndarray) -> bytes:
    """Eight bytes: a bit is 1 if it is set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> bytes:
    """Eight bytes: a bit is 1 if it is set in over half of the shingles' hashes."""
    return majority(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, shingle: int = 4, *others: str) -> DataFrame:
    """doc_id, the fingerprint as a signed long and other long columns, for every row."""
    names = ["doc_id", "fp", *others]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.frombuffer(b"".join(fingerprint(t, shingle) for t in raw(batch.column(1))), ">i8").astype(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp), *batch.columns[2:]], names)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), *others)
    return source.mapInArrow(by_rows(make), ", ".join(f"{c} long" for c in names))


class _Forest:
    """Union of codes that are linked; labels are always roots."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.runs = self.root

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            differ = x != y
            if not differ.any():
                break
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]
        self.runs = np.cumsum(np.concatenate(([0], self.root[1:] != self.root[:-1])))

    def joined(self, ulo, uhi, vlo, vhi) -> np.ndarray:
        """Whether all leaves of both nodes are one component."""
        same = (self.runs[ulo] == self.runs[uhi - 1]) & (self.runs[vlo] == self.runs[vhi - 1])
        return same & (self.root[ulo] == self.root[vlo])


def trie_forest(codes: np.ndarray, starts: list[tuple[int, int, int, int, int, int]], errors: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links below the given node pairs: indices of linked codes.

    codes: unsigned, sorted within each node. starts: (depth, u from, u to, v from, v to, differing bits above the depth).
    """
    forest, zeros = _Forest(len(codes)), {}
    stack = []
    for depth in sorted({s[0] for s in starts}):
        stack.append((depth, np.array([s[1:] for s in starts if s[0] == depth], np.int64).T))
    while stack:
        depth, (ulo, uhi, vlo, vhi, bits) = stack.pop()
        if len(ulo) > FRONTIER:
            half = len(ulo) // 2
            stack += [(depth, np.stack([x[half:] for x in (ulo, uhi, vlo, vhi, bits)])), (depth, np.stack([x[:half] for x in (ulo, uhi, vlo, vhi, bits)]))]
            continue
        go = (bits <= errors) & (ulo < uhi) & (vlo < vhi)
        ulo, uhi, vlo, vhi, bits = (x[go] for x in (ulo, uhi, vlo, vhi, bits))
        if not len(ulo):
            continue
        go = ~forest.joined(ulo, uhi, vlo, vhi)
        ulo, uhi, vlo, vhi, bits = (x[go] for x in (ulo, uhi, vlo, vhi, bits))
        small = ((uhi - ulo) * (vhi - vlo) <= LEAVES) | (depth == 64)
        if small.any():
            a, n = ulo[small], (uhi - ulo)[small]
            c, m = vlo[small], (vhi - vlo)[small]
            pair = np.repeat(np.arange(len(a)), n * m)
            k = np.arange(len(pair)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
            i, j = a[pair] + k // m[pair], c[pair] + k % m[pair]
            near = np.bitwise_count(codes[i] ^ codes[j]) <= errors
            forest.join(i[near], j[near])
        ulo, uhi, vlo, vhi, bits = (x[~small] for x in (ulo, uhi, vlo, vhi, bits))
        if not len(ulo):
            continue
        if depth not in zeros:
            zeros[depth] = np.concatenate(([0], np.cumsum(1 - ((codes >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64))))
        umid = ulo + zeros[depth][uhi] - zeros[depth][ulo]
        vmid = vlo + zeros[depth][vhi] - zeros[depth][vlo]
        own = (ulo == vlo) & (uhi == vhi)  # a node with itself has three pairs of children, not four
        other = ~own
        across = [
            (ulo, umid, vmid, vhi, bits + 1),
            tuple(x[other] for x in (umid, uhi, vlo, vmid, bits + 1)),
        ]
        along = [(ulo, umid, vlo, vmid, bits), (umid, uhi, vmid, vhi, bits)]
        for group in (across, along):  # what agrees is looked at first
            stack.append((depth + 1, np.concatenate([np.stack(g) for g in group], axis=1)))
    child = np.flatnonzero(forest.root != np.arange(len(codes)))
    return child, forest.root[child]


def _links(block_of: list[int], errors: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).sort_by([("node", "ascending"), ("lo", "ascending"), ("hi", "ascending"), ("side", "ascending")])
        node, lo, hi, side, deep, fp = (t.column(c).to_numpy() for c in ("node", "lo", "hi", "side", "deep", "fp"))
        fp = fp.view(np.uint64)
        widths = np.array(block_of, np.uint64)
        shift = (np.cumsum(widths) - widths)[node >> 16]
        codes = np.where(shift == 0, fp, (fp << shift) | (fp >> ((np.uint64(64) - shift) & np.uint64(63))))
        order = np.lexsort((codes, side, hi, lo, node))
        node, lo, hi, side, deep, codes, fp = (x[order] for x in (node, lo, hi, side, deep, codes, fp))
        edge = np.flatnonzero((np.diff(node) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)) + 1
        begins, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(node)]))
        starts = []
        for a, b in zip(begins.tolist(), ends.tolist()):
            depth = block_of[node[a] >> 16] + int(deep[a])
            if lo[a] == hi[a]:
                starts.append((depth, a, b, a, b, 0))
            else:
                mid = a + int(np.searchsorted(side[a:b], 1))
                starts.append((depth, a, mid, mid, b, int(lo[a] ^ hi[a]).bit_count()))
        i, j = trie_forest(codes, starts, errors)
        yield pa.RecordBatch.from_arrays([pa.array(fp[i].view(np.int64)), pa.array(fp[j].view(np.int64))], ["a", "b"])

    return run


def near_links(prints: DataFrame, errors: int = 4, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints that span every class of fingerprints within `errors` bits of each other."""
    blocks = [64 // (errors + 1) + (i < 64 % (errors + 1)) for i in range(errors + 1)]
    first = [sum(blocks[:i]) for i in range(len(blocks))]
    nodes = F.array(*[
        F.struct(
            (F.lit(i << 16) + F.shiftrightunsigned("fp", 64 - first[i] - w).bitwiseAND(F.lit((1 << w) - 1))).cast("int").alias("node"),
            F.shiftrightunsigned(F.shiftleft("fp", (first[i] + w) % 64), 48).alias("below"),
        )
        for i, w in enumerate(blocks)
    ])
    routed = prints.select("fp", F.explode(nodes).alias("at")).select("fp", "at.*")
    sizes = routed.groupBy("node").count()  # at most (errors + 1) * 2 ** width rows
    total = prints.count()
    large = sizes.filter(F.col("count") > node_limit).select(
        "node", F.least(F.lit(8), F.ceil(F.log2(F.col("count") / node_limit))).cast("int").alias("deep")
    )
    wide = routed.join(F.broadcast(large), "node", "left").fillna({"deep": 0})
    sub = F.expr("cast(shiftrightunsigned(below, 16 - deep) as int)")
    pair = F.filter(F.expr("sequence(0, shiftleft(1, deep) - 1)"), lambda t: F.bit_count(F.col("sub").bitwiseXOR(t)) <= errors)
    wide = wide.withColumn("sub", sub).select("fp", "node", "deep", "sub", F.explode(pair).alias("t")).select(
        "fp", "node", "deep", F.least("sub", "t").alias("lo"), F.greatest("sub", "t").alias("hi"),
        (F.col("sub") > F.col("t")).cast("int").alias("side"),
    )
    copies = wide.count() if large.count() else total * len(blocks)  # a node that is split sends each code several times
    parts = max(prints.sparkSession.sparkContext.defaultParallelism, -(-copies // 400_000))
    return wide.repartition(parts, "node", "lo", "hi").mapInArrow(_links(blocks, errors), "a long, b long")


def _classes(prints: DataFrame, errors: int) -> DataFrame:
    """fp and label (one for each component) of every distinct fingerprint."""
    distinct = prints.select("fp").distinct()
    labels = component_labels(near_links(distinct, errors)).withColumnRenamed("node", "fp")
    return distinct.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def simhash_groups(docs: DataFrame, shingle: int = 4, errors: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    by_print = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")).join(_classes(prints, errors), "fp")
    smallest = by_print.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = by_print.join(smallest, "label").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = 4, errors: int = 4) -> DataFrame:
    """One document of each component, the one with the smallest doc_id (of several such, the smallest fingerprint, then hash of text).

    A document is a doc_id with a text: rows of one doc_id with other texts are judged apart, and of repeated rows of a document that
    stays one stays. Rows without a doc_id stay: nothing can name them. Columns keep their names and order, whatever these are.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    prints = stored(fingerprints(keyed, shingle, "text_hash"), "fingerprints").filter("doc_id is not null")
    by_print = prints.groupBy("fp").agg(F.min(F.struct("doc_id", "fp", "text_hash")).alias("own")).join(_classes(prints, errors), "fp")
    first = by_print.groupBy("label").agg(F.min("own").alias("first"))
    named = by_print.join(first, "label").select("fp", "first")
    gone = prints.join(named, "fp").filter("struct(doc_id, fp, text_hash) != first").select("doc_id", "text_hash").distinct()
    row = docs.select(F.struct("*").alias("row")).select("row", F.col("row.doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("of"))
    kept = row.join(gone, (F.col("id") == F.col("doc_id")) & (F.col("of") == F.col("text_hash")), "left_anti")
    if not prints.groupBy("doc_id", "text_hash").count().filter("count > 1").isEmpty():  # else no row is repeated, and texts need no shuffle
        kept = kept.filter("id is not null").dropDuplicates(["id", "of"]).unionByName(kept.filter("id is null"))
    return kept.select("row.*")
