import random
import re

import numpy as np
import pytest
import xxhash

from rawstar.llm import graph
from rawstar.llm import simhash as sh


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints, bits=2):
    root = {p: p for p in prints}
    again = True
    while again:
        again = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= bits and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    again = True
    return root


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def cluster(seed, n, centres=3, flips=3):
    draw = random.Random(seed)
    out = set()
    for _ in range(centres):
        c = draw.getrandbits(64)
        for _ in range(n):
            p = c
            for _ in range(draw.randint(0, flips)):
                p ^= 1 << draw.randrange(64)
            out.add(p)
    return out | {draw.getrandbits(64) for _ in range(n)} | {0, (1 << 64) - 1}


def test_fingerprints(prose):
    for t in [*prose[:30], "", " ", "one", "one two", "a b c", "a a a a a"]:
        assert sh.fingerprint(t) == brute_print(t)


@pytest.mark.parametrize("leaf", [2, 40, 10_000])
def test_trie_join_finds_all_components(spark, leaf):
    prints = cluster(leaf, 40)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = {r.u: r.root for r in graph.components(sh.links(df, leaf=leaf)).collect()}
    want = brute_roots(prints)
    groups = {}
    for p in prints:
        groups.setdefault(got.get(signed(p), signed(p)), set()).add(p)
    expected = {}
    for p, r in want.items():
        expected.setdefault(r, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_links_inside_one_leaf():
    a = np.array(sorted(cluster(1, 200)), np.uint64)
    i, j = sh.trie_links(a, a, True, 0, 0, 2)
    want = {(x, y) for x in range(len(a)) for y in range(x + 1, len(a)) if int(a[x] ^ a[y]).bit_count() <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(60)] + [(500, 600 + i) for i in range(300)]
    df = spark.createDataFrame(chain, "u long, v long")
    got = {r.u: r.root for r in graph.components(df).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {600 + i: 500 for i in range(300)}
    assert graph.components(df.limit(0)).collect() == []


def check(docs, plain):
    rows = docs.collect()
    prints = [brute_print(r.text) for r in rows]
    root = brute_roots(sorted(set(prints)))
    least = {}
    for r, p in zip(rows, prints):
        if r.doc_id is not None:
            least[root[p]] = min(r.doc_id, least.get(root[p], r.doc_id))
    want = sorted(((r.doc_id, signed(p), least.get(root[p])) for r, p in zip(rows, prints)), key=str)
    got = sh.near_duplicates(docs)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in got.collect()), key=str) == want
    return len({root[p] for p in prints})


def test_documents(make_docs, prose, plain):
    check(make_docs(prose), plain)


def test_awkward(awkward, empty, plain):
    n = check(awkward, plain)
    kept = sh.keep_one(awkward)
    assert kept.columns == awkward.columns and kept.count() == n
    assert sh.near_duplicates(empty).collect() == [] and sh.keep_one(empty).collect() == []
