"""Cross-tokenizer alignment against a plain version that encodes whole texts and looks at every pair of tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lexigrid.llm import queries, token_alignment

A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "\n", "\t", "one", " one", "one ", "one\n", "\none", "Hello world\nfoo  bar", "a\n\n b \n c", "tab\there and there", "many      blanks   \n\n\n  here  ",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "a ▁ piece ▁▁", "naïve café ﬁ é 日本語 \U0001f600 done", "nul\x00inside here", "x" * 3000, "12345 67,890.12 !? (a)", "\x1c odd \x85   z",
    "they're we'll I'd 's", "word " * 300, "　wide", "one", "one",
]


def spelt(tokenizer, pieces, text):
    """Ids and bytes of both tokenizations of a whole text; none where they do not spell it."""
    if not text:
        return [], [], [], []
    a = tokenizer.encode(" " + text, add_special_tokens=False)
    from tokenizers.pre_tokenizers import ByteLevel

    alphabet = sorted(ByteLevel.alphabet())
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in own]
    byte_of = {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(rest)}
    assert set(alphabet) == set(byte_of)
    x = [bytes(byte_of[c] for c in t) for t in a.tokens]
    b = pieces.encode(text)
    y = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
        return [], [], [], []
    return a.ids, b, x, y


def spans(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(texts):
    tokenizer, pieces = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    tokenizer.encode_special_tokens = True
    held, links = [], []
    for text in texts:
        a, b, x, y = spelt(tokenizer, pieces, text)
        sa, sb = spans(x), spans(y)
        first, pairs = 0, []
        for i, (lo, hi) in enumerate(sa):
            while first < len(sb) and sb[first][1] <= lo:
                first += 1
            j = first
            while j < len(sb) and sb[j][0] < hi:
                pairs.append((a[i], b[j]))
                j += 1
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, before = [], 0
        for e in ends:
            cut = [",".join(str(t) for t, (lo, hi) in zip(ids, s) if before <= lo and hi <= e) for ids, s in ((a, sa), (b, sb))]
            groups.append("|".join(cut))
            before = e
        held.append((len(a), len(b), len(groups), len(pairs), ";".join(groups)))
        links.append(pairs)
    counts = Counter(p for pairs in links for p in set(pairs))
    most = {}
    for (i, _), n in counts.items():
        most[i] = max(n, most.get(i, 0))
    sums = [(sum(counts[p] == most[p[0]] for p in pairs), sum(counts[p] for p in pairs)) for pairs in links]
    return [h + s for h, s in zip(held, sums)], counts, most


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choices("aeinorst", k=rng.randrange(1, 9))) for _ in range(n))
    mixed = ["".join(rng.choices(" \n\tab.é1▁日", k=60)) for _ in range(60)]
    return TEXTS + [prose(rng.randrange(1, 200)) for _ in range(40)] + mixed


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i if i % 9 else None, t, "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, pair string, n_a int").withColumn("groups", F.lit(1)).repartition(4)


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]


@pytest.mark.parametrize("limit", [token_alignment.BROADCAST_PAIRS, 0])
def test_equals_whole_texts(docs, texts, limit):
    want, counts, most = plain(texts)
    found = token_alignment.pair_counts(docs, A, B)
    assert {(r.a_id, r.b_id): (r.n_docs, r.best) for r in found.collect()} == {p: (n, n == most[p[0]]) for p, n in counts.items()}
    got = token_alignment.alignments(docs, A, B, found, limit)
    assert Counter(tuple(r) for r in got.select("doc_id", *COLUMNS).collect()) == Counter((i if i % 9 else None, *w) for i, w in enumerate(want))


def test_small_memory_of_chunks(docs, texts, monkeypatch):
    aligner = token_alignment.Aligner(A, B)
    assert aligner.ranks is not None
    monkeypatch.setattr(token_alignment, "MEMO_ENTRIES", 5)
    monkeypatch.setattr(token_alignment, "LEARNT", 7)
    want = plain(texts)[0]
    for at in range(0, len(texts), 3):
        batch = token_alignment._Batch(aligner, pa.array([t or "" for t in texts[at : at + 3]], pa.string()))
        assert batch.groups() == [w[4] for w in want[at : at + 3]]
    assert len(aligner.known) < 500
    aligner.ranks = None
    aligner.forget()
    assert token_alignment._Batch(aligner, pa.array([t or "" for t in texts], pa.string())).groups() == [w[4] for w in want]


def test_ranks_give_the_ids_of_the_file():
    """Chunks that go through the ranks: random signs of the range for which they are used."""
    aligner, rng = token_alignment.Aligner(A, B), random.Random(8)
    signs = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x250))]
    parts = [rng.choice(" \n") + "".join(rng.choices(signs if i % 2 else signs[:94], k=rng.randrange(1, 25))) for i in range(20_000)]
    parts += [f"{c}{x}" for c in " \n" for x in ("don't", "we're", "'ll", "''s", "a'b", "x" * 500, "12ab", "ab12", "-" * 70)]
    parts = list(dict.fromkeys(parts))
    stops = np.cumsum([len(c.encode()) for c in parts])
    ids, counts = aligner.ids_a(parts, stops)
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [e.ids for e in aligner.a.encode_batch_fast(parts, add_special_tokens=False)]
    assert all(token_alignment.chunk_of(token_alignment.key_of(c)) == c for c in [*parts, " ", "  ", " \n", "\n", "\n\n", "  x", " \nx", "  \nx", " \x00", " \x00b"])


def test_chunks_are_the_text(texts):
    for t in texts:
        if t:
            assert "".join(token_alignment.chunks(t)) == " " + t


def test_empty_table(spark, docs):
    none = docs.filter("false")
    for limit in (10, 0):
        assert token_alignment.alignments(none, A, B, token_alignment.pair_counts(none, A, B), limit).count() == 0


def test_query_digest(spark, small, tmp_path):
    rows = [(1, "one two"), (2, None), (3, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op11_alignment(spark, str(tmp_path)).collect()}
    want = plain(["one two"])[0][0]
    assert got[1].groups_sha256 == hashlib.sha256(want[4].encode()).hexdigest() and got[1].n_best == want[5]
    assert got[2].groups_sha256 == got[3].groups_sha256 == "" and got[2].n_links == got[2].count_sum == 0
