import hashlib
import random

import numpy as np
import pytest
import tiktoken

from rawstar.llm import bpe


@pytest.fixture(scope="module")
def tik():
    path, pattern = bpe.vocabulary()
    return tiktoken.Encoding(
        "test", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={}
    )


def odd_texts():
    draw = random.Random(0)
    pool = " \n\tabcXYZ0189.,'!?<|éßñ日本🙂  ́\x1c\x00"
    out = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 80))) for _ in range(300)]
    return out + ["", "a" * 5000, " " * 3000, "<|endoftext|>", "It's we'll I'M", "!?" * 700, "é" * 999]


def test_ids(tik):
    enc = bpe.encoder(*bpe.vocabulary())
    for t in odd_texts():
        ids = enc.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == tik.encode_ordinary(t)
        assert enc.decode(ids) == t.encode()


def test_both_folds_agree():
    ranks = bpe.load_ranks(bpe.vocabulary()[0])
    draw = random.Random(1)
    for _ in range(200):
        word = bytes(draw.choice(b"etaoin shr\xc3\xa9") for _ in range(draw.randint(2, 300)))
        if word not in ranks:
            short = bpe.LONG_WORD
            try:
                bpe.LONG_WORD = 10**9
                assert bpe.fold(word, ranks) == bpe._fold_long(word, ranks)
            finally:
                bpe.LONG_WORD = short


def test_a_full_cache_changes_nothing(tik, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 2)
    enc = bpe.Encoder(*bpe.vocabulary())
    t = "never seen wordz qqq zzyzx never seen wordz"
    assert np.frombuffer(enc.encode(t), "<u4").tolist() == tik.encode_ordinary(t)
    assert len(enc.known) <= 2


def test_documents(make_docs, awkward, empty, tik, plain):
    docs = make_docs(odd_texts())
    for row, text in zip(plain(bpe.round_trip(docs)), odd_texts()):
        ids = tik.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    back = plain(bpe.decode(bpe.encode(docs)))
    assert [bytes(r["data"]).decode() for r in back] == odd_texts()
    assert bpe.round_trip(awkward).count() == awkward.count()
    assert bpe.round_trip(empty).collect() == [] and bpe.decode(bpe.encode(empty)).collect() == []
