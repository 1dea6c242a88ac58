import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rawstar.llm import range_coder as rc
from rawstar.llm import token_files as tf


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(tf.vocabulary())
    tokenizer.encode_special_tokens = True
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def blocks_of(draw):
    return [
        np.array([draw.choice([1, 7, 7, 300, 49_407]) for _ in range(n)], dtype=np.uint32)
        for n in (0, 1, 2, 900, 900, 2048, 31)
    ] + [np.array([draw.randrange(49_408) for _ in range(3000)], dtype=np.uint32), np.zeros(500, np.uint32)]


@pytest.mark.parametrize("lanes", [1, 3, 2048])
def test_blocks_come_back(monkeypatch, lanes):
    monkeypatch.setattr(rc, "LANES", lanes)
    blocks = blocks_of(random.Random(1))
    payloads = rc.encode_blocks(blocks, 49_408)
    back = rc.decode_blocks(payloads, [len(b) for b in blocks], 49_408)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))
    # a block does not depend on those coded beside it
    assert payloads == [p for b in blocks for p in rc.encode_blocks([b], 49_408)]


def test_predictions_save_space():
    draw = random.Random(2)
    phrase = [draw.randrange(49_408) for _ in range(50)]
    repeated = np.array(phrase * 40, dtype=np.uint32)
    (payload,) = rc.encode_blocks([repeated], 49_408)
    assert len(payload) < len(repeated) / 2
    (even,) = rc.encode_blocks([np.array([draw.randrange(49_408) for _ in range(2000)])], 49_408)
    assert len(even) < 2000 * 2.4


def test_ids_out_of_range():
    with pytest.raises(ValueError):
        rc.encode_blocks([np.array([49_408])], 49_408)
    with pytest.raises(ValueError):
        rc.encode_blocks([np.zeros(70_000, dtype=np.uint32)], 10)


@pytest.mark.parametrize("size", [1, 2, 300, 50_000])
def test_other_vocabularies(size):
    draw = random.Random(size)
    block = np.array([draw.randrange(size) for _ in range(500)], dtype=np.uint32)
    (payload,) = rc.encode_blocks([block], size)
    assert np.array_equal(rc.decode_blocks([payload], [500], size)[0], block)


def test_words_as_the_library(library, prose, awkward):
    texts = prose + [r.text or "" for r in awkward.collect()] + [
        "don't WE'LL  x\ty\r\nz", "á ́b é Ω Å", "ΑΣ Σ ΟΔΟΣ", "\x1c\x1d a\x85b　c d",
        "<|endoftext|> <|startoftext|>x", "İstanbul ǅ ﬁ", "1234 5,6 ''s 's", " ", "\n\n",
    ]
    words = tf.WordEncoder(tf.vocabulary())
    for t in texts * 2:
        assert words.document(t).tolist() == library(t), t


def test_pieces_and_forgetting(library, monkeypatch, prose):
    monkeypatch.setattr(tf, "PIECE", 40)
    monkeypatch.setattr(tf, "WORDS", 50)
    words = tf.WordEncoder(tf.vocabulary())
    for t in prose:
        assert words.document(t).tolist() == library(t)
    assert " ".join(tf.pieces("a b  c d" * 9, 5)) == "a b  c d" * 9


def arrow(texts):
    return pa.array(texts, pa.string())


def test_texts_together(library, prose, monkeypatch):
    texts = ["", *prose, "", "one two\n", prose[0], "Ünïcode ÉTÉ × 漢字 e\u0301t\u00e9 'S're'dx \"'s ''ll x²1"] * 2
    for together, piece in ((1 << 23, 1 << 20), (70, 60), (1, 5)):
        monkeypatch.setattr(tf, "TOGETHER", together)
        monkeypatch.setattr(tf, "PIECE", piece)
        words = tf.WordEncoder(tf.vocabulary())
        for _ in range(2):
            got = [ids.tolist() for ids in words.documents(arrow(texts)[1:])]
            assert got == [library(t) for t in texts[1:]], together
    assert list(words.documents(arrow([]))) == []


class Counted:
    def __init__(self, model):
        self.model, self.asked = model, []

    def tokenize(self, run):
        self.asked.append(run)
        return self.model.tokenize(run)


def test_a_run_is_encoded_once(library):
    texts = ["Word word, WORD. word's Élan", "(word) élan, word7 words"]
    words = tf.WordEncoder(tf.vocabulary())
    words.model = Counted(words.model)
    got = [ids.tolist() for ids in words.documents(arrow(texts))] + [words.document(texts[0]).tolist()]
    assert got == [library(t) for t in (*texts, texts[0])]
    assert sorted(words.model.asked) == sorted(["word", ",", ".", "'s", "Ã©lan", "(", ")", "7", "words"])


def test_plain_words_as_the_library(library):
    draw = random.Random(5)
    letters = "abzAZ09'stmdrevl.,!<|>_-\"éÉßÿÀþ÷×\u0300\t²µ"
    texts = [" ".join("".join(draw.choices(letters, k=draw.randrange(9))) for _ in range(60)) for _ in range(60)]
    words = tf.WordEncoder(tf.vocabulary())
    assert words.by_runs
    assert [ids.tolist() for ids in words.documents(arrow(texts))] == [library(t) for t in texts]


@pytest.mark.parametrize("change", ["case", "added"])
def test_other_steps(tmp_path, change):
    from tokenizers import AddedToken, normalizers

    tokenizer = Tokenizer.from_file(tf.vocabulary())
    if change == "case":
        tokenizer.normalizer = normalizers.NFC()
    else:
        tokenizer.add_tokens([AddedToken("WORD", normalized=False)])
    path = str(tmp_path / "other.json")
    tokenizer.save(path)
    words, text = tf.WordEncoder(path), "One WORD, word's one"
    assert not words.by_runs
    assert words.document(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_groups_share_counts(tmp_path, monkeypatch):
    monkeypatch.setattr(rc, "LANES", 3)
    path, draw = str(tmp_path / "a.ids"), random.Random(4)
    ids = [draw.randrange(16) * 32 + (i // 3000) for i in range(10_000)]
    writer = tf.FileWriter(path, 600, block_ids=1000)
    writer.add(1, np.array(ids[:100], dtype=np.uint32))
    writer.add(2, np.array(ids[100:9000], dtype=np.uint32))
    writer.add(3, np.array(ids[9000:], dtype=np.uint32))
    n_bytes = writer.close()[2]
    # 4 bits an id, as each of the 16 ids of a group is as likely
    assert n_bytes < len(ids) * 0.8
    reader = tf.FileReader(path)
    assert reader.shares.shape == (4, 600)
    assert np.concatenate([x for _, _, x in reader.documents()]).tolist() == ids
    for start, n in ((2999, 2), (2500, 5000), (8999, 1001), (0, 10_000)):
        assert reader.ids(start, n).tolist() == ids[start : start + n]


def test_shares():
    shares = rc.shares_of(np.array([0, 1, 10**9, 0, 3]))
    assert shares.sum() == 1 << 18 and (shares > 0).tolist() == [False, True, True, False, True]
    with pytest.raises(ValueError):
        rc.encode_blocks([np.array([0, 1])], 5, shares)
    with pytest.raises(ValueError):
        rc.shares_of(np.zeros(4, dtype=np.int64))


def expected(docs, library):
    """doc_id -> (tokens, checksums) of its rows."""
    out = {}
    for r in docs.collect():
        ids = np.array([*library(r.text), tf.END_ID], dtype="<u4")
        out.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("block_ids", [5, 64, rc.BLOCK_IDS])
def test_round_trip(make_docs, prose, library, block_ids, monkeypatch):
    monkeypatch.setattr(rc, "LANES", 7 if block_ids == 5 else 2048)
    texts = prose * 2
    ids = list(range(len(texts)))
    random.Random(3).shuffle(ids)
    docs = make_docs(texts, ids=ids).repartition(3)
    rows = tf.round_trip(docs, block_ids=block_ids).select("*", F.crc32("ids").alias("crc")).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(ids)
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows[:-1]]]).tolist()
    assert {r.doc_id: [(r.n_tokens, r.crc)] for r in rows} == expected(docs, library)


def test_awkward(awkward, empty, library):
    clash = awkward.selectExpr("*", "1 AS mark", "2 AS row", "3 AS ids", "4 AS start")
    rows = tf.round_trip(clash).select("*", F.crc32("ids").alias("crc")).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.crc))
    assert {k: sorted(v) for k, v in got.items()} == expected(awkward, library)
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)][:2] == [None, None]
    assert tf.round_trip(empty).collect() == []


@pytest.fixture
def a_file(tmp_path):
    path = str(tmp_path / "a.ids")
    writer = tf.FileWriter(path, 1000, block_ids=16)
    docs = [(None, []), (3, range(40)), (4, [5] * 7), (9, range(500, 600)), (10, [])]
    for doc_id, ids in docs:
        writer.add(doc_id, np.array(list(ids), dtype=np.uint32))
    assert writer.close()[:2] == (5, 147)
    return path, docs


def test_any_part_can_be_read(a_file):
    path, docs = a_file
    reader = tf.FileReader(path)
    every = [i for _, ids in docs for i in ids]
    assert [(d, s, x.tolist()) for d, s, x in reader.documents()] == [
        (d, sum(len(x) for _, x in docs[:k]), list(ids)) for k, (d, ids) in enumerate(docs)
    ]
    for start, n in ((0, 147), (15, 2), (16, 16), (140, 7), (3, 0)):
        assert reader.ids(start, n).tolist() == every[start : start + n]


def test_damage_is_noticed(a_file):
    path, _ = a_file
    whole = open(path, "rb").read()
    at = tf.FileReader(path).offsets
    places = (0, int(at[1]) + 3, int(at[2]) + tf.BLOCK.size, int(at[-1]) + 4, len(whole) - 1)
    for place in places:
        with open(path, "wb") as f:
            f.write(whole[:place] + bytes([whole[place] ^ 0x55]) + whole[place + 1 :])
        with pytest.raises((tf.DamagedFile, MemoryError, OSError)):
            list(tf.FileReader(path).documents())


def test_starts_over_groups(spark):
    rows = [(i, "p", 1, i + 1, 1) for i in range(25) if i % 4]
    files = tf.with_starts(spark.createDataFrame(rows, tf.FILE_DDL), group=3)
    got = [(r.file_no, r.start) for r in files.orderBy("file_no").collect()]
    total = 0
    for (no, _, _, n, _), (found, start) in zip(rows, got, strict=True):
        assert (no, total) == (found, start)
        total += n


def test_table_of_words(library, prose, monkeypatch):
    monkeypatch.setattr(tf, "SEEN", 30)
    words = tf.WordEncoder(tf.vocabulary())
    # a full table is left with the words of the last text that was looked up in it
    most = max(len(set(t.split(" "))) for t in prose)
    for t in (*prose, "one", *prose, "漢字 one"):
        assert words.document(t).tolist() == library(t)
        assert len(words.seen) <= most
        assert len(words.seen_ids) == words.seen_lengths.sum()
