from collections import Counter

import pytest

import corpus_pipeline as cp
from rawstar.llm import mixing, quality, simhash
from test_exact_dedup import low


@pytest.fixture(scope="module")
def sf_dir(spark, awkward, make_docs, prose, tmp_path_factory):
    base = tmp_path_factory.mktemp("sf")
    more = make_docs(prose, ids=range(100, 100 + len(prose)), sources=["p", "q"] * (len(prose) // 2) + ["p"] * (len(prose) % 2))
    awkward.filter("doc_id is null or doc_id not in (11, 12)").unionByName(more).write.parquet(f"{base}/documents.parquet")
    labels = [(100 + i, int(i % 7 != 0), 0) for i in range(len(prose))]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return str(base)


def key(r):
    return (r.doc_id, r.text or "")


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, steps, n = docs.columns, dict(cp.STAGES), 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")

    def step(name, docs):
        nonlocal n
        n += 1
        steps[name](spark, docs, sf_dir).write.parquet(f"{sf_dir}/stage{n}")
        return spark.read.parquet(f"{sf_dir}/stage{n}")

    good = step("quality", docs)
    predicted = quality.classify(docs, labels).collect()
    assert good.columns == columns and good.count() == sum(r.predicted for r in predicted)

    exact = step("exact", good)
    best = {}
    for r in good.collect():
        old = best.get(low(r.text))
        if old is None or (r.doc_id is not None and (old.doc_id is None or r.doc_id > old.doc_id)):
            best[low(r.text)] = r
    assert sorted(r.doc_id or -1 for r in exact.collect()) == sorted(r.doc_id or -1 for r in best.values())

    near = step("near", exact)
    found = simhash.near_duplicates(exact).collect()
    assert near.count() == len({r.root for r in found})
    ids = {r.component_id for r in found if r.component_id is not None}
    assert {r.doc_id for r in near.collect() if r.doc_id is not None} == ids

    mixed = step("mix", near)
    seen = Counter(map(key, mixed.collect()))
    for r in mixing.mix(near).collect():
        if r.doc_id is not None and r.size:
            assert sum(n for (i, _), n in seen.items() if i == r.doc_id) == r.copies

    out = step("tokens", mixed)
    assert out.count() == mixed.count() and cp.run(spark, sf_dir).count() == out.count()
