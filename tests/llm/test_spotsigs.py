import hashlib

import pytest

from rawstar.llm import spotsigs as sp


def expected(rows):
    order = sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.text or ""))
    out = []
    for i, r in enumerate(order):
        text, after = r.text or "", order[(i + 1) % len(order)].text or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        a, b, c = (set(sp.signature(t).tolist()) for t in (text, changed, after))
        near = [len(a & x) / len(a | x) for x in (b, c)]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((r.doc_id, len(text), digest, *near))
    return sorted(out, key=str)


def found(df):
    rows = df.collect()
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in rows]
    return sorted(got, key=str)


@pytest.mark.parametrize("parts", [1, 2, 5, 40])
def test_successors(make_docs, prose, parts):
    docs = make_docs(prose).repartition(4)
    assert found(sp.next_likeness(docs, parts)) == expected(docs.collect())


def test_awkward(awkward, empty, make_docs):
    assert found(sp.next_likeness(awkward, 3)) == expected(awkward.collect())
    assert sp.next_likeness(empty).collect() == []
    assert sp.signatures(empty).collect() == []
    one = sp.next_likeness(make_docs(["the cat sat on the mat"])).collect()[0]
    assert (one.near_edited, one.near_next) != (None, None) and one.near_next == 1.0


def test_equal_texts_have_equal_fingerprints(make_docs, prose):
    rows = sp.signatures(make_docs(prose + prose[:5])).collect()
    by = {r.doc_id: r.fingerprint for r in rows}
    assert all(by[i] == by[len(prose) + i] for i in range(5))
    assert len(set(by.values())) > 50


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.8, 1.0])
def test_pruned_jaccard(prose, threshold):
    sigs = [sp.signature(t) for t in prose]
    for a in sigs[:20]:
        for b in sigs:
            x, y = set(a.tolist()), set(b.tolist())
            exact = len(x & y) / len(x | y)
            assert sp.jaccard(a, b, threshold) == (exact if exact >= threshold else 0.0)
            if 0 < threshold < 1 and exact >= threshold:
                gap = sp.length_class(len(x), threshold) - sp.length_class(len(y), threshold)
                assert abs(gap) <= 1


def classes(rows, threshold):
    """(doc_id, class, links) by comparing all pairs of distinct signatures."""
    sets = {}
    for r in rows:
        sets.setdefault(frozenset(sp.signature(r.text or "").tolist()), []).append(r.doc_id)
    nodes = list(sets)
    near = {a: [b for b in nodes if a != b and len(a & b) >= threshold * len(a | b)] for a in nodes}
    out, seen = [], set()
    for a in nodes:
        if a in seen:
            continue
        group, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in group:
                    group.add(b)
                    todo.append(b)
        seen |= group
        ids = [i for b in group for i in sets[b] if i is not None]
        out += [(i, min(ids, default=None), len(near[b])) for b in group for i in sets[b]]
    return sorted(out, key=str)


def variants(prose):
    """Chains of texts that differ by a word or a few from one to the next, of all lengths."""
    out = list(prose[:25])
    for k, text in enumerate(prose[:12]):
        words = " ".join([text] * 2).split()
        for step in range(1, 6):
            words = list(words)
            words[(step * 7 + k) % len(words)] = f"new{step}"
            out += [" ".join(words), " ".join(words[: len(words) - step * (k % 3)])]
    return out + out[:4] + ["", "...", "the", "x"]


@pytest.mark.parametrize("threshold", [0.3, 0.8, 1.0])
def test_near_duplicates(make_docs, prose, threshold):
    docs = make_docs(variants(prose))
    got = sorted(map(tuple, sp.near_duplicates(docs, threshold).collect()), key=str)
    want = classes(docs.collect(), threshold)
    assert got == want
    if threshold == 0.8:
        assert sum(r[2] for r in got) > 20 and len({r[1] for r in got}) < len(got)


def test_near_duplicates_of_awkward_rows(awkward, empty):
    got = sorted(map(tuple, sp.near_duplicates(awkward).collect()), key=str)
    assert got == classes(awkward.collect(), 0.8)
    assert sp.near_duplicates(empty).collect() == []


def test_prefixes_meet(prose):
    import numpy as np

    sigs = [sp.signature(t) for t in variants(prose)]
    counts = sum(np.bincount(s % sp.BINS, minlength=sp.BINS) for s in sigs)
    for t in (0.5, 0.8):
        cut = [set(sp.prefix(s, counts, t).tolist()) for s in sigs]
        for i, a in enumerate(sigs):
            for j in range(i):
                if sp.jaccard(a, sigs[j], t):
                    assert cut[i] & cut[j]
