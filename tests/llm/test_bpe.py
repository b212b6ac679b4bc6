from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from sheaf.llm import bpe
from tests.llm.conftest import docs_df, odd_texts

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "the", " ", "  ", "\n", "\n\n", "\t", "é", "ß", "日本", "1", "23", "'s", "'ll", "...", "!!", "<|endoftext|>",
    "aaaa", "\xa0", "\x1c", "\x85", "\x0b", "\r\n", "\U0001f600", "ing", "​", "٣", "Ⅷ", "²", "____", " '", "﻿",
    "ͅ", "　", "\x00",
]


def texts():
    rng = random.Random(2)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    return made + ["a" * 5000, "ab" * 3000, " ".join(f"w{k}" for k in range(20_000))]


def test_round_trip_against_the_library(spark):
    own = Tokenizer.from_file(PATH)
    rows = list(enumerate(texts(), 100)) + odd_texts()
    got = bpe.round_trip(docs_df(spark, rows), PATH).collect()
    assert len(got) == len(rows)
    want = {i: own.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    for r in got:
        assert r.ids == want[r.doc_id]
        assert r.decoded == own.decode(r.ids, skip_special_tokens=False)


def test_digests(spark):
    rows = [(1, "Hello world"), (2, None)]
    got = {r.doc_id: r for r in bpe.digests(bpe.round_trip(docs_df(spark, rows), PATH)).collect()}
    ids = Tokenizer.from_file(PATH).encode("Hello world").ids
    assert got[1].n_tokens == len(ids) and got[2].n_tokens == 0
    assert got[1].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[1].decoded_sha256 == hashlib.sha256(b"Hello world").hexdigest()
    assert got[2].ids_sha256 == got[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    assert bpe.digests(bpe.round_trip(docs_df(spark, []), PATH)).count() == 0


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    enc, sample = bpe.Encoder(bpe.vocabulary(PATH)), texts()[:50]
    once = [np.frombuffer(x, "<i4").tolist() for x in enc.encode(sample)]
    assert once == [np.frombuffer(enc.encode([t])[0], "<i4").tolist() for t in sample]


def test_invalid_bytes_decode_to_the_replacement_character():
    vocab = bpe.vocabulary(PATH)
    alone = int(vocab.of_byte[0xC3])
    assert bpe.decode_ids(vocab, np.array([alone])) == "�"
