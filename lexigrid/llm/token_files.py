"""Token-ID files: flat unsigned integers and 64-bit document offsets, read through memory maps.

Documents are dealt by range of doc_id, so file k holds smaller ids than file k + 1. A task writes `<name>.ids` (flat
little-endian unsigned integers, 16 bits wide where the vocabulary allows it, else 32), `<name>.off` (64-bit offsets,
one more than documents) and `<name>.doc` (the doc_ids, 64-bit; null is the smallest integer). The manifest has one row per file; prefix sums over it give each file's base. A task that is run
again writes files of another name, and the manifest names those of the run that counted.

Defined cases: a null or empty text is the end id alone; rows with a null doc_id come first; rows of equal doc_id follow
each other in the order of their texts, and each keeps its own place; an empty table gives no file. Texts may be of any
length, only whole texts are encoded. Further columns are not looked at.
"""

from __future__ import annotations

import mmap
import os
import string
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.common import scratch
from lexigrid.llm.windows import by_bytes

#: Encoded words that a worker keeps before it starts anew, at some 180 bytes, and words that are encoded in one go.
MEMO_ENTRIES, LEARNT = 900_000, 512
#: Text bytes of a file, about, and of a piece that is encoded at once.
FILE_BYTES, PIECE = 64 << 20, 2 << 20
#: What keeps a text from being cut into words: white space other than one blank or line feed between two words, or a zero character.
_ODD = r"\A[ \n]|[ \n]\z|[ \n][ \n]|[\x00\t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class Encoder:
    """Encodes texts with a byte-level BPE file of the tokenizers library.

    Its pre-tokenizer always ends a token before a single blank and on either side of a single line feed, so a word has the
    same ids wherever it stands behind the same sign; each distinct word is encoded once and looked up afterwards. Signs that close
    a word behind a letter or digit are tokens of their own, where the pre-tokenizer cuts there, so `word`, `word.` and `word,` need
    one encoding. Texts with other white space, or with strings of special tokens, are encoded whole.
    """

    def __init__(self, path: str, end_id: int, special_as_text: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocabulary.values(), default=0) < 1 << 16 else "<u4")
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)  # a byte-level token has one character per byte
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end_id = end_id
        # by code point, whether a character is a letter or digit that a closing sign never joins
        self.letters = np.array([chr(i).isalnum() and self._cuts(chr(i), ".") for i in range(0x280)])
        self.closing = "".join(s for s in string.punctuation if self._cuts("a", s) and self._cuts("1", s))
        self.forget()

    def _cuts(self, before: str, sign: str) -> bool:
        """Whether the pre-tokenizer ends a token between a character of a word and a sign."""
        cutter = self.tokenizer.pre_tokenizer
        return cutter is not None and len(cutter.pre_tokenize_str(f" {before}")) + 1 == len(cutter.pre_tokenize_str(f" {before}{sign}"))

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.zeros(1 << 16, self.dtype), np.zeros(1 << 14, np.int64)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _keep(self, keys: list[str], ids: np.ndarray, stops: np.ndarray) -> None:
        """Enter keys with their ids, end to end."""
        first, before = len(self.known), self.ends[len(self.known) - 1] if self.known else 0
        self.known.update(zip(keys, range(first, first + len(keys))))
        while first + len(keys) > len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros_like(self.ends)))
        while before + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ends[first : first + len(keys)] = before + stops
        self.ids[before : before + len(ids)] = ids

    def _learn(self, keys: list[str]) -> None:
        """Encode words in one go, each behind its line feed or blank, then cut where each word ends."""
        joined = "".join([k if k[0] == "\n" else " " + k for k in keys])
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
        sizes = pyarrow.compute.binary_length(pa.array(keys, pa.string())).to_numpy() + np.fromiter((k[0] != "\n" for k in keys), np.int64, len(keys))
        self._keep(keys, ids, np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(sizes), side="left") + 1)

    def _learn_closing(self, keys: list[str]) -> None:
        """Encode closing signs, each behind a zero character that is no part of them, alone."""
        ids = [self._whole(k[1:]) for k in keys]
        self._keep(keys, np.array([i for x in ids for i in x], np.int64), np.cumsum([len(x) for x in ids]))

    def _entries(self, keys: list[str], learn: Callable[[list[str]], None]) -> np.ndarray:
        """Numbers of distinct keys in the table, where new ones are entered."""
        entry = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        new, first = np.flatnonzero(entry < 0), len(self.known)
        for at in range(0, len(new), LEARNT):
            learn([keys[i] for i in new[at : at + LEARNT].tolist()])
        entry[new] = first + np.arange(len(new))
        return entry

    def _parted(self, keys: pa.StringArray) -> tuple[pa.DictionaryArray, pa.DictionaryArray]:
        """Words without their closing signs, and these (empty where there are none, or what stands before is no letter or digit)."""
        n, (_, edges, data) = len(keys), keys.buffers()
        edges, octets = np.frombuffer(edges, np.int32)[keys.offset : keys.offset + n + 1], np.frombuffer(data, np.uint8)
        length = pyarrow.compute.binary_length(pyarrow.compute.ascii_rtrim(keys, characters=self.closing)).to_numpy()
        stop = edges[:-1] + length
        last, before = octets[stop - 1].astype(np.int64), octets[stop - 2].astype(np.int64)
        # a character of one octet, or one of two behind the first of them
        point = np.where(last < 0x80, last, np.where((0xC2 <= before) & (before <= 0xC9), (before & 0x1F) << 6 | last & 0x3F, 0))
        both = np.empty(2 * n + 1, np.int32)
        both[::2], both[1::2] = edges, np.where((length > 0) & self.letters[point], stop, edges[1:])
        parts = pa.StringArray.from_buffers(2 * n, pa.py_buffer(both), data)
        return tuple(parts.take(pa.array(np.arange(i, 2 * n, 2))).dictionary_encode() for i in (0, 1))

    def _table(self, keys: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words end to end, and where each word's end."""
        if not len(keys):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        parts = self._parted(keys)
        words, closing = (p.dictionary.to_numpy(zero_copy_only=False).tolist() for p in parts)
        if len(self.known) + len(words) + len(closing) > MEMO_ENTRIES:
            self.forget()
        found = self._entries(words, self._learn), self._entries(["\0" + c for c in closing], self._learn_closing)
        entry = np.stack([f[p.indices.to_numpy()] for f, p in zip(found, parts)], 1).ravel()
        starts = np.where(entry > 0, self.ends[entry - 1], 0)
        count = self.ends[entry] - starts
        ends = np.cumsum(count)
        return self.ids[np.arange(ends[-1]) + np.repeat(starts - ends + count, count)], ends[1::2]

    def _plain(self, texts: pa.Array) -> pa.Array:
        """Whether texts hold words behind single blanks or line feeds, without special strings."""
        odd = pyarrow.compute.or_(pyarrow.compute.equal(texts, ""), pyarrow.compute.match_substring_regex(texts, _ODD))
        for s in self.special:
            odd = pyarrow.compute.or_(odd, pyarrow.compute.match_substring(texts, s))
        return pyarrow.compute.invert(odd)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids with the end id, as the files hold them."""
        ids, sizes = self.encode_all(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each with the end id behind it, and the number of ids of each text."""
        texts = texts.cast(pa.string())
        marks = self._plain(texts)
        plain = marks.to_numpy(zero_copy_only=False)
        # words behind a line feed keep it, and so does the first word of a text, where it is taken away again
        marked = pyarrow.compute.replace_substring(texts.filter(marks), "\n", " \n")
        lists = pyarrow.compute.split_pattern(pyarrow.compute.binary_join_element_wise("\n", marked, ""), " ")
        coded = lists.flatten().dictionary_encode()
        table, ends = self._table(coded.dictionary)
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = pyarrow.compute.list_value_length(lists).to_numpy().astype(np.int64)
        start, count = starts[code], (ends - starts)[code]
        first = (np.cumsum(words) - words)[words > 0]
        start[first] += 1  # the line feed is one id
        count[first] -= 1
        total = np.concatenate(([0], np.cumsum(count)))
        sizes = np.zeros(len(texts), np.int64)
        sizes[plain] = np.diff(total[np.cumsum(words)], prepend=0)
        odd = {i: self._whole(texts[i].as_py()) for i in np.flatnonzero(~plain).tolist()}
        for i, ids in odd.items():
            sizes[i] = len(ids)
        out = np.full(int(sizes.sum()) + len(sizes), self.end_id, self.dtype)
        place = np.cumsum(sizes + 1) - sizes - 1
        body = table[np.arange(total[-1]) + np.repeat(start - total[:-1], count)]
        own = sizes[plain]
        out[np.arange(len(body)) + np.repeat(place[plain] - (np.cumsum(own) - own), own)] = body
        for i, ids in odd.items():
            out[place[i] : place[i] + sizes[i]] = ids
        return out, sizes + 1


@lru_cache(maxsize=1)
def _encoder(*args) -> Encoder:
    """A worker that is used again keeps its encoder and what that has learnt."""
    return Encoder(*args)


def _filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return pa.fs.LocalFileSystem(), parsed.path
    return pa.fs.FileSystem.from_uri(uri)


def _read(uri: str) -> memoryview:
    """A file's bytes: memory-mapped where the store is a mounted folder, else read from it."""
    fs, path = _filesystem(uri)
    if isinstance(fs, pa.fs.LocalFileSystem):
        with open(path, "rb") as f:
            return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) if os.path.getsize(path) else b"")
    with fs.open_input_file(path) as f:
        return memoryview(f.read())


def _writer(folder: str, tokenizer: str, end_id: int, special_as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoder(tokenizer, end_id, special_as_text)
        fs, path = _filesystem(folder)
        fs.create_dir(path, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        offsets, doc_ids, done = [np.zeros(1, np.int64)], [], 0
        with fs.open_output_stream(f"{path}/{name}.ids") as out:
            for piece in by_bytes(batches, 1, PIECE):
                ids, sizes = encoder.encode_all(pa.compute.fill_null(piece.column(1), ""))
                out.write(ids.tobytes())
                offsets.append(done + np.cumsum(sizes))
                doc_ids.append(pa.compute.fill_null(piece.column(0), NULL_ID).to_numpy(zero_copy_only=False))
                done += len(ids)
        for kind, values in (("off", offsets), ("doc", doc_ids or [np.zeros(0, np.int64)])):
            with fs.open_output_stream(f"{path}/{name}.{kind}") as out:
                out.write(np.concatenate(values).astype("<i8").tobytes())
        if doc_ids:
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "name": [name], "n_docs": [sum(map(len, doc_ids))], "n_ids": [done], "width": [encoder.dtype.itemsize]}, MANIFEST_ARROW
            )

    return run


#: Stands for a null doc_id in `.doc` files.
NULL_ID = -(1 << 63)
MANIFEST = "part int, name string, n_docs long, n_ids long, width int"
MANIFEST_ARROW = pa.schema([("part", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32())])


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, files: int, special_as_text: bool = False) -> list[dict]:
    """Write documents in ascending doc_id order to at most `files` sets of files.

    Returns the manifest, one entry for each set of files, with `base`: the ids in all files before it.
    """
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(_writer(folder, tokenizer, end_id, special_as_text), MANIFEST).collect()  # one row a file
    base, out = 0, []
    for row in sorted(rows, key=lambda r: r.part):
        out.append(row.asDict() | {"base": base})
        base += row.n_ids
    return out


def read_ids(spark: SparkSession, folder: str, manifest: list[dict]) -> DataFrame:
    """One row per document as the files have it: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(_read(f"{folder}/{row['name']}.ids"), f"<u{row['width']}")
                offsets = np.frombuffer(_read(f"{folder}/{row['name']}.off"), "<i8")
                doc_ids = np.frombuffer(_read(f"{folder}/{row['name']}.doc"), "<i8")
                for at in range(0, len(doc_ids), 10_000):
                    a, b = offsets[at : at + 10_000], offsets[at + 1 : at + 10_001]
                    a = a[: len(b)]
                    crc = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(a, b)]
                    doc = doc_ids[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc, mask=doc == NULL_ID), pa.array(a + row["base"]), pa.array(b - a), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
                    )

    listed = spark.createDataFrame([(m["name"], m["width"], m["base"]) for m in manifest], "name string, width int, base long")
    return listed.repartition(max(1, len(manifest))).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, files: int | None = None, special_as_text: bool = False) -> DataFrame:
    """Write the files, then describe each document from what the files hold."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "token_ids")
    if files is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(1, -(-size // FILE_BYTES))
    return read_ids(spark, folder, write_ids(docs, folder, tokenizer, end_id, files, special_as_text))
