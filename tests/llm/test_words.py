"""The word and token kernels against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cropweave.llm import tokens
from cropweave.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB z9é日😀\n\t\x0b-_", max_size=30)), max_size=20)


def words_of(text, pattern, lower):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(pattern, text)


@settings(deadline=None, max_examples=150)
@given(TEXTS, st.integers(1, 40), st.booleans())
def test_words_are_those_of_the_pattern(texts, size, lower):
    for table, pattern in ((W.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (W.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        if table is W.ALNUM and not lower:
            continue
        got, keys = [], {}
        for piece in W.slices(pa.array(texts, pa.string()), size):
            found = piece.words(table, lower)
            texts_of = [found.data[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends)]
            for word, key in zip(texts_of, found.hashes().tolist()):
                assert keys.setdefault(word, key) == key
            got += [texts_of[a:b] for a, b in zip(found.of_text[:-1], found.of_text[1:])]
        assert got == [words_of(t, pattern, lower) for t in texts]
        assert len(set(keys.values())) == len(keys)


def test_grams_and_look_ups():
    words = np.array([5, 6, 7, 5, 6, 7], np.uint64)
    grams = W.gram_hashes(words, 3)
    assert grams[0] == grams[3] and len(set(grams.tolist())) == 3
    assert len(W.gram_hashes(words, 7)) == 0
    keys = np.unique(W.mix(np.arange(5000, dtype=np.uint64)))
    table = W.SortedHashes(keys)
    assert (table.find(keys) == np.arange(5000)).all()
    assert (table.find(W.mix(np.arange(5000, 9000, dtype=np.uint64))) == -1).all()
    assert W.SortedHashes(keys[:0]).find(keys[:3]).tolist() == [-1] * 3


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_equal_those_of_the_library(name):
    spec = open(public_tokenizers.path(name), encoding="utf-8").read()
    plain = Tokenizer.from_str(spec)
    plain.encode_special_tokens = True
    parts = ["a", "b", "S", "re", "ll", "'", "'s", "'S", " ", "  ", "\n", "\t", "1", "23", "é", "È", "%", "!!", "\xa0",
             "　", "日本", "’", "😀", "é", "Σ", "İ", "ß", "\x00", "\x1c", "\x85", "_", "<|endoftext|>", "ﬁ", "½",
             "가", "ㄱ", "​", "﻿", "n't", "we've", "'ll "]
    pick = random.Random(5)
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 30))) for _ in range(4000)] + [None, "", "x'sy"]
    got = list(tokens.encoded(pa.array(texts), spec))
    for text, ids in zip(texts, got):
        assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_tokens_after_the_memory_is_full(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 3)
    monkeypatch.setattr(tokens, "RECENT", 2)
    spec = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    plain = Tokenizer.from_str(spec)
    worker = tokens.Encoder(spec)
    for text in ("one two three four five", "one six", "seven eight one two"):
        for piece in W.slices(pa.array([text])):
            assert [x.tolist() for x in worker.encode(piece)] == [plain.encode(text).ids]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_new_pieces_go_to_the_model_alone(name):
    spec = open(public_tokenizers.path(name), encoding="utf-8").read()
    plain = Tokenizer.from_str(spec)
    worker = tokens.Encoder(spec)
    texts = ["It's 2024:\n\n  naïve Ċ ĉ Ġ words,\tthey'll  cost 30% more </w> \n", "ÀÉÎ über — straße … \r\n end ", "\n", " \n a"]
    for piece in W.slices(pa.array(texts)):
        assert [x.tolist() for x in worker.encode(piece)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert "tokenizer" not in vars(worker)
