import random
from collections import Counter

import numpy as np
import pytest

from rawstar.llm import suffix_dedup as sd


def runs(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        spans = []
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        out.append([tuple(s) for s in spans])
    return out


def check(docs, length, **options):
    rows = docs.collect()
    want = []
    for r, spans in zip(rows, runs([r.text for r in rows], length)):
        raw, kept, at = (r.text or "").encode(), b"", 0
        for s, e in spans:
            kept, at = kept + raw[at:s], e
        want.append((str(r.doc_id), len(raw), spans, kept + raw[at:]))
    got = [
        (str(r.doc_id), r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept))
        for r in sd.remove_repeats(docs, length, **options).collect()
    ]
    assert sorted(got) == sorted(want)
    return sum(len(w[2]) for w in want)


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"bucket": 5, "hot": 8}])
@pytest.mark.parametrize("length", [200, 40])
def test_passages(make_docs, prose, length, options):
    assert check(make_docs(prose), length, **options) > 10


def test_periodic_texts(make_docs):
    texts = ["abc" * 300, "bca" * 90, "x" * 500, "x" * 250, "ab" * 120 + "c" * 120, "é" * 400, "q" * 199]
    for length in (200, 33, 7):
        check(make_docs(texts), length)


def test_borders_of_chunks(make_docs, prose, monkeypatch):
    monkeypatch.setattr(sd, "CHUNK", 64)
    data = np.frombuffer(" ".join(prose).encode(), np.uint8)
    assert len(data) > 64
    check(make_docs(prose[:30] + prose[:3]), 50)


def test_awkward(awkward, empty):
    check(awkward.filter("doc_id is null or doc_id not in (11, 12)"), 200)
    assert sd.remove_repeats(empty).collect() == []
    # two long texts that differ at the end only
    rows = {r.doc_id: r for r in sd.remove_repeats(awkward.filter("doc_id in (11, 12)")).collect()}
    assert bytes(rows[11].kept) == b"" and bytes(rows[12].kept) in (b" end", b"d", b"nd", b"end")


def test_sort_against_bytes():
    draw = random.Random(1)
    rows = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 30))) for _ in range(500)]
    group = np.array([draw.randint(0, 4) for _ in rows])
    size = np.array([len(r) for r in rows])
    data = np.zeros((len(rows), 30), np.uint8)
    for i, r in enumerate(rows):
        data[i, : len(r)] = np.frombuffer(r, np.uint8)
    order, shared = sd.verified_sort(data, size, group)
    keys = [(int(group[i]), rows[i]) for i in order]
    assert keys == sorted(keys)
    for k in range(1, len(keys)):
        (ga, a), (gb, b) = keys[k - 1], keys[k]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert shared[k] == (n if ga == gb else -1)


def test_a_lying_hash_is_found_out(monkeypatch):
    monkeypatch.setattr(sd, "prefix_hashes", lambda data, power: np.zeros((len(data), data.shape[1] + 1), np.uint64))
    data = np.array([[3, 1], [1, 2], [1, 1], [2, 9]], np.uint8)
    order, shared = sd.verified_sort(data, np.full(4, 2), np.zeros(4, np.int64))
    assert order.tolist() == [2, 1, 3, 0] and shared.tolist() == [-1, 1, 0, 0]
