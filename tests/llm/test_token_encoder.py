"""The encoder of distinct words against whole texts, with odd white space, special strings and a small memory."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lexigrid.llm import token_files
from lexigrid.llm.common import is_plain

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("special_as_text", [False, True])
def test_encoder_equals_whole_texts(monkeypatch, special_as_text):
    monkeypatch.setattr(token_files, "MEMO_ENTRIES", 40)
    monkeypatch.setattr(token_files, "LEARNT", 3)
    rng = random.Random(1)
    texts = [None, "", " ", "\n", "one", "a b\nc d", "\na", "a\n", " a", "a ", "a  b", "a\n\nb", "a\tb", "a \tb", "a\t b", "x\xa0y z", "<|endoftext|> a b", "a\x00 b", "­ x", "don't we'll\n'ss"]
    texts += [" ".join("".join(rng.choices("abé日1!", k=rng.randrange(1, 6))) for _ in range(40)).replace(" a", "\na") for _ in range(30)]
    texts += ["".join(rng.choices("ab \n\t'", k=30)) for _ in range(100)]
    encoder = token_files.Encoder(FILE, 2, special_as_text)
    plain = Tokenizer.from_file(FILE)
    plain.encode_special_tokens = special_as_text
    want = [plain.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    for at in range(0, len(texts), 7):
        ids, sizes = encoder.encode_all(pa.array([t or "" for t in texts[at : at + 7]], pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want[at : at + 7]


def test_plain_texts():
    assert all(map(is_plain, ("a", "a b", "a\nb c", "é­ x")))
    assert not any(map(is_plain, ("", " ", "a  b", " a", "a ", "a\tb", "a\t b", "a \tb", "a b c", "a\x00 b", "a\n\nb")))


@pytest.mark.parametrize("special_as_text", [False, True])
def test_closing_signs_are_no_words_of_their_own(special_as_text):
    ends = ["", ".", ",", "'", "''", "'.", "...", "!?", "&&&", "%%%)", "\"", "_", "-", "<|"]
    words = ["tree", "dogs'", "it's", "'s", "'re", "1", "3.14", "x2", "é", "straße", "½", "日", "—", "x—", "a\u0301", "😀", "ɏ", "ʰ", "\u02c2", "don't've", "-", "."]
    rng = random.Random(2)
    texts = ["".join(w + e + rng.choice(" \n") for w in rng.sample(words, 6) for e in rng.sample(ends, 3)).strip() for _ in range(200)]
    encoder, plain = token_files.Encoder(FILE, 2, special_as_text), Tokenizer.from_file(FILE)
    plain.encode_special_tokens = special_as_text
    ids, sizes = encoder.encode_all(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]

    encoder = token_files.Encoder(FILE, 2, special_as_text)
    encoder.encode_all(pa.array(["tree " + " ".join("tree" + e for e in ends)], pa.string()))
    assert {k for k in encoder.known if "tree" in k} == {"\ntree", "tree"}


def test_odd_texts_are_those_that_are_not_plain():
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab \n\t\x0b\x1c\x1f\x85\xa0\u1680\u2003\u2028\u202f\u3000\x00\u200b\xad", [30, 30, 9, 3] + [0.2] * 14, k=rng.randrange(12))) for _ in range(3000)]
    got = token_files.Encoder(FILE, 2)._plain(pa.array(texts, pa.string())).to_pylist()
    assert got == [bool(t) and is_plain(t) for t in texts] and 300 < sum(got) < 2700
