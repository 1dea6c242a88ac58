import math
import random
from collections import defaultdict

import numpy as np
import pytest

from rawstar.llm import mixing as mx


def targets(sizes):
    """source -> target, by resharing until none is above its stop."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mx.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, at_stop = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in at_stop)
        open_ = [s for s in order if s not in at_stop]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return share | {s: 3 * sizes[s] for s in at_stop}
        at_stop |= over


@pytest.fixture(scope="module")
def many(make_docs):
    draw = random.Random(9)
    texts, sources = [], []
    for i in range(900):
        sources.append("hot" if i % 3 == 0 else draw.choice(["a", "b", "B", "é", "z", None, "tiny"]))
        n = draw.randint(1, 60) if sources[-1] != "tiny" else 1
        texts.append("w " * n)
    return make_docs(texts, sources=sources)


def by_source(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.source].append(r)
    return out


@pytest.mark.parametrize("block", [7, 50, 20_000])
def test_targets_and_copies(many, block):
    rows = mx.mix(many, block=block).collect()
    assert len(rows) == 900
    groups = by_source(rows)
    sizes = {s: sum(r.size for r in g) for s, g in groups.items()}
    want = targets(sizes)
    for s, g in groups.items():
        assert {r.source_size for r in g} == {sizes[s]}
        assert g[0].target == pytest.approx(want[s])
        rate = want[s] / sizes[s]
        assert {r.copies for r in g} <= set(range(mx.MAX_COPIES + 1))
        assert all(abs(r.copies - rate) < 2 for r in g)
        assert abs(sum(r.copies * r.size for r in g) - want[s]) <= max(r.size for r in g)


@pytest.mark.parametrize("seed", range(3))
def test_every_source_ends_near_its_target(make_docs, seed):
    draw = random.Random(seed)
    texts, sources = [], []
    for s in "abcdefg":
        sizes = [draw.randint(1, 60) for _ in range(60)] + [draw.randint(200, 900) for _ in range(3)]
        texts += ["w " * n for n in sizes]
        sources += [s] * len(sizes)
    rows = mx.mix(make_docs(texts, sources=sources), seed=seed, block=100).collect()
    for g in by_source(rows).values():
        taken = sum(r.copies * r.size for r in g)
        assert abs(taken - g[0].target) < 0.01 * g[0].target


def test_long_documents_keep_their_expectation():
    size = np.array([900.0, 300.0, *[20.0] * 80])
    for share in (0.02, 0.5, 0.97):
        total = np.zeros(len(size))
        for seed in range(3000):
            p = np.full(len(size), share)
            mx._pivot_block(p, size, np.random.default_rng(seed), -1, 2)
            assert p @ size == pytest.approx(share * size.sum())
            assert -1 <= p.min() and p.max() <= 2
            total += p
        assert total[:2] / 3000 == pytest.approx([share] * 2, abs=0.03)
        assert total[2:].mean() / 3000 == pytest.approx(share, abs=0.02)


def test_reruns_agree(many):
    def copies(df):
        return sorted((r.doc_id, r.copies) for r in mx.mix(df, block=50).collect())

    assert copies(many) == copies(many.repartition(5))
    assert copies(many) != sorted((r.doc_id, r.copies) for r in mx.mix(many, block=50, seed=1).collect())


def test_expectations_are_kept():
    size, want = np.array([9.0, 5.0, 5.0, 3.0, 1.0, 8.0]), np.array([0.3, 0.7, 0.5, 0.25, 0.9, 0.6])
    total = np.zeros(6)
    for seed in range(4000):
        p = want.copy()
        mx._pivot_block(p, size, np.random.default_rng(seed))
        assert p @ size == pytest.approx(want @ size)
        assert sum(1e-9 < x < 1 - 1e-9 for x in p) <= 1
        total += p
    assert total / 4000 == pytest.approx(want, abs=0.03)


def test_awkward(awkward, empty, make_docs):
    rows = mx.mix(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.doc_id: r.size for r in rows}[4] == 1
    sizes = {s: sum(r.size for r in g) for s, g in by_source(rows).items()}
    want = targets(sizes)
    assert {r.source: r.target for r in rows} == pytest.approx(want)
    assert mx.mix(empty).collect() == [] and mx.mixed_documents(empty).collect() == []
    blank = mx.mix(make_docs(["", None, " "])).collect()
    assert {(r.size, r.source_size, r.target) for r in blank} == {(0, 0, 0.0)}


def test_the_mix_repeats_rows(many):
    docs = many.selectExpr("*", "1 AS copies", "2 AS size", "3 AS _n", "4 AS _key", "5 AS _times", "6 AS _added_0")
    taken = {r.doc_id: r.copies for r in mx.mix(docs).collect()}
    out = mx.mixed_documents(docs)
    assert out.columns == docs.columns
    seen = defaultdict(int)
    for r in out.collect():
        seen[r.doc_id] += 1
    assert seen == {i: n for i, n in taken.items() if n}
