"""Alignment of two tokenizers over one text: groups of tokens that end together, links of tokens that overlap.

Tokenizer A is a byte-level BPE file of the tokenizers library and encodes a space and the text; tokenizer B is a sentencepiece
model, which adds that space itself. Both cut the same bytes. Dictionaries from the byte where a token ends to its index are
intersected; the common ends, sorted, slice both lists of ids into groups, and inside each slice every pair of tokens whose bytes
overlap is a link. How many documents of the corpus hold a pair of ids linked is counted over all of them, and each document's links
are read against these counts.

A token of either tokenizer that holds something other than white space ends where a blank or a line feed follows, so a text falls
into chunks (white space and what follows it) that are aligned alone; each distinct chunk is aligned once in a worker and looked up
afterwards. A model with a piece that has a blank behind another character, or a line feed in it, is refused.

Defined cases: a text that is null or empty, or whose tokens do not spell it (a tokenizer that drops or changes characters), has no
tokens: zeros and an empty string of groups; strings of special tokens are plain text; every row is a document, so repeated rows
count as often as they stand, and a null doc_id keeps its row; an empty table gives no rows; other columns are not looked at. Texts
may be of any length, only whole texts are aligned.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import is_plain, stored
from lexigrid.llm.windows import by_bytes

#: Aligned chunks that a worker keeps before it starts anew, at some 300 bytes, and chunks that are aligned at once.
MEMO_ENTRIES, LEARNT = 600_000, 8192
#: Bytes of text that are aligned at once, about.
PIECE = 2 << 20
#: Distinct pairs that a worker sums up before it hands them on.
HELD_PAIRS = 1 << 20
#: Pairs whose counts are sent to every worker, at 16 bytes; more are joined by a shuffle.
BROADCAST_PAIRS = 4_000_000

_CHUNK = re.compile(r"(?<=\S)(?=[ \n])")
#: Chunks in which the ranks' pattern and the file's pattern surely see the same letters.
_LATIN = re.compile(r"[\x20-\x7e\xa1-\u024f\n]*")
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def chunks(text: str) -> list[str]:
    """Pieces of a space and the text, each white space and what follows up to the next blank or line feed."""
    return _CHUNK.split(" " + text)


def key_of(chunk: str) -> str:
    """A chunk without the blank in front; where that would not tell it from others, a zero character and the chunk."""
    if chunk[0] == "\n":
        return chunk
    return "\x00" + chunk if chunk[1:2] in ("", " ", "\n") else chunk[1:]


def chunk_of(key: str) -> str:
    if key[:2] in ("\x00 ", "\x00\n"):
        return key[1:]
    return key if key[0] == "\n" else " " + key


def keyed(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Keys of each text's chunks, end to end, and how many each text has."""
    strings = texts.to_pylist()
    plain = np.fromiter((bool(t) and is_plain(t) for t in strings), bool, len(strings))
    split = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(plain)), "\n", " \n"), " ")
    odd = [[key_of(c) for c in chunks(t)] if t else [] for t, p in zip(strings, plain) if not p]
    if not odd:
        return pc.list_value_length(split).to_numpy().astype(np.int64), split.flatten()
    lists = pa.concat_arrays([split, pa.array(odd, split.type)])
    order = np.argsort(np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain))))
    lists = lists.take(pa.array(order))
    return pc.list_value_length(lists).to_numpy().astype(np.int64), lists.flatten()


def common_ends(a_ends: list[int], b_ends: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes where a token of A and one of B end, and how many tokens of either have ended there."""
    index_a, index_b = dict(zip(a_ends, range(1, len(a_ends) + 1))), dict(zip(b_ends, range(1, len(b_ends) + 1)))
    both = sorted(index_a.keys() & index_b.keys())
    return tuple(np.array(x, np.int64) for x in (both, [index_a[e] for e in both], [index_b[e] for e in both]))


def linked(a_ends: np.ndarray, b_ends: np.ndarray, a_to: np.ndarray, b_to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (in A, in B) of all tokens that overlap, in order: inside a group each end but the last starts a new pair."""
    ends = np.unique(np.concatenate((a_ends, b_ends)))
    group = np.searchsorted(a_ends[a_to - 1], ends)  # the slice that an end lies in
    a, b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    return np.minimum(a, a_to[group] - 1), np.minimum(b, b_to[group] - 1)


def _byte_of() -> dict[str, int]:
    """The character that stands for each byte in byte-level tokens: printable Latin-1 for itself, others from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [x for x in range(256) if x not in own]
    return {chr(x): x for x in own} | {chr(0x100 + i): x for i, x in enumerate(others)}


def _ranked(path: str, token_bytes: dict[int, bytes]):
    """The BPE file as an encoder of ranks, if its merges are in the order of its ids; else None."""
    import tiktoken

    with open(path) as f:
        file = json.load(f)
    model, vocabulary = file["model"], file["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    byte_level = (file.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not file.get("normalizer")
    if not byte_level or any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    ranks = {token_bytes[i]: i for t, i in vocabulary.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == 256 + len(merges) else None


class Aligner:
    """Both tokenizers, and the chunks that they have aligned: numbers of their entries by key."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        byte_of, vocabulary = _byte_of(), self.a.get_vocab(with_added_tokens=True)
        a_bytes = {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t, i in vocabulary.items()}
        self.a_bytes = [a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)]
        self.ranks = _ranked(a_path, a_bytes)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            plain = not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))
            if plain and ("▁" in piece.lstrip("▁") or "\n" in piece):
                raise ValueError(f"piece {piece!r} goes on behind white space")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        n = max(len(self.a_bytes), len(self.b_bytes))
        self.digits = np.zeros((n, len(str(n)) + 1), np.uint8)
        for i in range(n):
            self.digits[i, : len(str(i))] = np.frombuffer(str(i).encode(), np.uint8)
        self.n_digits = (self.digits > 0).sum(axis=1)
        self.space = self.b.piece_to_id("▁")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.numbers = np.zeros((1024, 4), np.int32)  # COUNTS of each entry; -1 where its ids do not spell it
        self.strings: list[str] = []
        self.links, self.link_ends = np.zeros(4096, np.int64), np.zeros(1024, np.int64)

    def ids_a(self, parts: list[str], stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A end to end, and of how many chunks each is; stops: bytes up to each chunk's end."""
        if self.ranks is not None and _LATIN.fullmatch(joined := "".join(parts)) and not any(map(str.isspace, parts)):
            ids = np.array(self.ranks.encode_ordinary(joined), np.int64)
            return ids, np.diff(np.searchsorted(np.cumsum(self.a_sizes[ids]), stops, side="left") + 1, prepend=0)
        if self.ranks is not None and len(parts) > 64:  # the few chunks with other letters are found by halves
            half = len(parts) // 2
            left = self.ids_a(parts[:half], stops[:half])
            right = self.ids_a(parts[half:], stops[half:] - stops[half - 1])
            return tuple(np.concatenate(x) for x in zip(left, right))
        ids = [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))

    def ids_b(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of B, likewise. B puts a blank in front: it is the chunk's own, or must go again."""
        ids = self.b.encode([c[1:] if c[0] == " " else c for c in parts], num_threads=1)
        for i, c in enumerate(parts):
            if c[0] != " ":
                del ids[i][:1]
            elif c == " ":
                ids[i] = [self.space]
        return np.fromiter(chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))

    def _spelt(self, whole: bytes, stops: np.ndarray, ids: np.ndarray, counts: np.ndarray, token_bytes: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Which chunks the ids spell; chunks end at stops."""
        firsts = np.concatenate(([0], stops[:-1]))
        ends = np.concatenate(([0], np.cumsum(sizes[ids])))
        to = np.cumsum(counts)
        good = (ends[to] - ends[to - counts]) == stops - firsts
        pieces = [token_bytes[i] for i in ids.tolist()]
        if good.all() and b"".join(pieces) == whole:
            return good
        for i, (a, b, x, y) in enumerate(zip(firsts.tolist(), stops.tolist(), (to - counts).tolist(), to.tolist())):
            good[i] = b"".join(pieces[x:y]) == whole[a:b]
        return good

    def learn(self, keys: list[str]) -> np.ndarray:
        """Numbers of the entries of distinct keys."""
        if len(self.known) + len(keys) > MEMO_ENTRIES:
            self.forget()
        new = [k for k in keys if k not in self.known]
        for at in range(0, len(new), LEARNT):
            self._add(new[at : at + LEARNT])
        return np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))

    def _add(self, keys: list[str]) -> None:
        parts = [chunk_of(k) for k in keys]
        whole = "".join(parts).encode()
        stops = np.cumsum(pc.binary_length(pa.array(parts, pa.string())).to_numpy().astype(np.int64))
        (a, n_a), (b, n_b) = self.ids_a(parts, stops), self.ids_b(parts)
        good = self._spelt(whole, stops, a, n_a, self.a_bytes, self.a_sizes) & self._spelt(whole, stops, b, n_b, self.b_bytes, self.b_sizes)
        numbers, strings, links, n_links = self._aligned(a[np.repeat(good, n_a)], n_a[good], b[np.repeat(good, n_b)], n_b[good])
        first, n = len(self.strings), len(parts)
        self.known.update(zip(keys, range(first, first + n)))
        while first + n > len(self.numbers):
            self.numbers = np.concatenate((self.numbers, np.zeros_like(self.numbers)))
            self.link_ends = np.concatenate((self.link_ends, np.zeros_like(self.link_ends)))
        self.numbers[first : first + n] = -1
        self.numbers[first : first + n][good] = numbers
        given = iter(strings)
        self.strings += [next(given) if g else "" for g in good]
        each = np.zeros(n, np.int64)
        each[good] = n_links
        before = self.link_ends[first - 1] if first else 0
        self.link_ends[first : first + n] = before + np.cumsum(each)
        while before + len(links) > len(self.links):
            self.links = np.concatenate((self.links, np.zeros_like(self.links)))
        self.links[before : before + len(links)] = links

    def _aligned(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """COUNTS, groups and links of chunks whose ids spell them, all end to end as one stretch of bytes."""
        n = len(n_a)
        if not n:
            return np.zeros((0, 4), np.int32), [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        stops = a_ends[np.cumsum(n_a) - 1]
        common, a_to, b_to = common_ends(a_ends.tolist(), b_ends.tolist())
        i, j = linked(a_ends, b_ends, a_to, b_to)
        n_groups = np.bincount(np.searchsorted(stops, common), minlength=n)
        n_links = np.bincount(np.searchsorted(stops, a_ends[i]), minlength=n)
        # text: tokens by group, A before B; the sign behind each
        group_a, group_b = np.searchsorted(a_to, np.arange(len(a)), side="right"), np.searchsorted(b_to, np.arange(len(b)), side="right")
        place_a = np.arange(len(a)) + np.concatenate(([0], b_to))[group_a]
        place_b = np.arange(len(b)) + a_to[group_b]
        ids, sign = np.zeros(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        sign[place_a[a_to - 1]] = ord("|")
        sign[place_b[b_to - 1]] = np.where(np.isin(common, stops), ord("\n"), ord(";"))
        cells, width = self.digits[ids], self.n_digits[ids]
        cells[np.arange(len(ids)), width] = sign
        strings = cells[np.arange(cells.shape[1]) <= width[:, None]].tobytes().decode().split("\n")[:-1]
        return np.stack([n_a, n_b, n_groups, n_links], axis=1).astype(np.int32), strings, a[i] << 32 | b[j], n_links


@lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> Aligner:
    """A worker that is used again keeps its tokenizers and what they have learnt."""
    return Aligner(a_path, b_path)


class _Batch:
    """Texts as numbers of distinct chunks, and the entries of these."""

    def __init__(self, aligner: Aligner, texts: pa.Array) -> None:
        sizes, keys = keyed(texts)
        coded = keys.dictionary_encode()
        entries = aligner.learn(coded.dictionary.to_pylist())
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.cumsum(sizes)
        self.numbers = aligner.numbers[entries].astype(np.int64)
        self.strings = list(map(aligner.strings.__getitem__, entries.tolist()))
        # a text with a chunk that is not spelt has no tokens
        broken = self.numbers[:, 0] < 0
        if broken.any():
            bad = self.sums(broken.astype(np.int64)) > 0
            self.numbers[broken] = 0
            self.codes = self.codes[~np.repeat(bad, sizes)]
            self.ends = np.cumsum(np.where(bad, 0, sizes))
        n_links = self.numbers[:, 3]
        self.link_ends = np.cumsum(n_links)
        within = np.arange(n_links.sum()) - np.repeat(self.link_ends - n_links, n_links)
        self.links = aligner.links[np.repeat(aligner.link_ends[entries] - n_links, n_links) + within]

    def sums(self, of_entry: np.ndarray) -> np.ndarray:
        """Sum over each text of a value that its chunks have."""
        total = np.concatenate(([0], np.cumsum(of_entry[self.codes])))
        return np.diff(total[self.ends], prepend=0)

    def groups(self) -> list[str]:
        return [";".join(map(self.strings.__getitem__, self.codes[a:b].tolist())) for a, b in pairwise(chain((0,), self.ends.tolist()))]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, id pair and links of each pair that a text holds."""
        n = max(1, len(self.numbers))
        doc = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))
        held, times = np.unique(doc * n + self.codes, return_counts=True)
        doc, code = held // n, held % n
        known, links = np.unique(self.links, return_inverse=True)
        sizes = self.numbers[code, 3]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        pair = links[np.repeat(self.link_ends[code] - sizes, sizes) + within]
        width = max(1, len(known))
        keyed_, at = np.unique(np.repeat(doc, sizes) * width + pair, return_inverse=True)
        n_links = np.bincount(at, np.repeat(times, sizes), len(keyed_)).astype(np.int64)
        return keyed_ // width, known[keyed_ % width] if len(known) else known, n_links


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(np.concatenate(pairs), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)


def _counter(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, pairs, counts = _aligner(a_path, b_path), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x[0]) for x in (pairs, counts)], ["pair", "n_docs"])

        for batch in by_bytes(batches, 1, PIECE):
            pair, n = _summed([(p := _Batch(aligner, _strings(batch)).pairs())[1]], [np.ones(len(p[1]))])
            pairs.append(pair)
            counts.append(n)
            if sum(map(len, pairs)) > 2 * HELD_PAIRS:
                pairs, counts = ([x] for x in _summed(pairs, counts))
                if len(pairs[0]) > HELD_PAIRS:
                    yield out()
                    pairs, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        pairs, counts = ([x] for x in _summed(pairs, counts))
        yield out()

    return run


def _strings(batch: pa.RecordBatch) -> pa.Array:
    return pc.fill_null(batch.column(1), b"").cast(pa.string())


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """a_id, b_id, n_docs (documents that hold the pair linked) and best (no pair of that a_id is held by more)."""
    found = _source(docs).mapInArrow(_counter(a_path, b_path), "pair long, n_docs long").groupBy("pair").agg(F.sum("n_docs").alias("n_docs"))
    found = stored(found, "pairs").select(F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"), "n_docs")
    most = found.groupBy("a_id").agg(F.max("n_docs").alias("most"))  # at most one row an id of A's vocabulary
    return found.join(F.broadcast(most), "a_id").select("a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _table(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs in order and 2 * n_docs + best of each, if there are at most `limit`."""
    if counts.count() > limit:
        return None
    coded = counts.select((F.shiftleft(F.col("a_id").cast("long"), 32) + F.col("b_id")).alias("pair"), (2 * F.col("n_docs") + F.col("best").cast("int")).alias("n"))
    rows = coded.toArrow()
    pair, n = (rows.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pair)
    return pair[order], n[order]


def _described(a_path: str, b_path: str, known):
    """Rows of alignments(): read against the counts in `known`, or with each document's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path)
        for batch in by_bytes(batches, 1, PIECE):
            held = _Batch(aligner, _strings(batch))
            columns = [batch.column(0), *(pa.array(held.sums(held.numbers[:, k])) for k in range(4)), pa.array(held.groups(), pa.string())]
            names = ["doc_id", *COUNTS, "groups"]
            if known is None:
                doc, pair, n = held.pairs()
                offsets = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32())
                columns += [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (pair, n)]
                names += ["pairs", "times"]
            else:
                pairs, counts = known.value
                n = counts[np.searchsorted(pairs, held.links)] if len(held.links) else held.links
                for value in (n & 1, n >> 1):
                    total = np.concatenate(([0], np.cumsum(value)))
                    columns.append(pa.array(held.sums(np.diff(total[held.link_ends], prepend=0))))
                names += ["n_best", "count_sum"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def alignments(docs: DataFrame, a_path: str, b_path: str, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_a, n_b, n_groups, n_links, groups, n_best and count_sum.

    counts: what pair_counts() gives for the corpus, which holds these documents. groups: `a1,a2|b1;a3|b2,b3`, the ids of each group
    in order. n_best: links whose pair is best of its a_id; count_sum: the pairs' n_docs, summed over links. Counts of at most
    `broadcast_pairs` pairs go to every worker; more are joined with the pairs that each document holds.
    """
    spark, first = docs.sparkSession, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
    known = _table(counts, broadcast_pairs)
    if known is not None:
        return _source(docs).mapInArrow(_described(a_path, b_path, spark.sparkContext.broadcast(known)), f"{first}, n_best long, count_sum long")
    rows = _source(docs).mapInArrow(_described(a_path, b_path, None), f"{first}, pairs array<long>, times array<long>")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.times", F.shiftright("x.pairs", 32).cast("int").alias("a_id"), F.col("x.pairs").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"))
    sums = each.join(counts, ["a_id", "b_id"]).groupBy("row").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"), F.sum(F.col("times") * F.col("n_docs")).alias("count_sum")
    )
    return rows.drop("pairs", "times").join(sums, "row", "left").drop("row").fillna(0, ["n_best", "count_sum"])
