import hashlib
from collections import defaultdict

from rawstar.llm import exact_dedup as ed


def low(text):
    return (text or "").encode().lower()


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[low(r["text"])].append(r["doc_id"])
    out = []
    for r in rows:
        g = groups[low(r["text"])]
        keep = max((i for i in g if i is not None), default=None)
        out.append((r["doc_id"], keep, len(g), r["doc_id"] == keep))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


def test_groups(make_docs, prose):
    docs = make_docs(prose)
    assert found(ed.exact_dedup(docs)) == expected(docs.collect())


def test_awkward(awkward, empty):
    assert found(ed.exact_dedup(awkward)) == expected(awkward.collect())
    assert ed.exact_dedup(empty).collect() == []


def test_digest_is_of_the_normalised_text(make_docs):
    row = ed.exact_dedup(make_docs(["ÄBC"])).collect()[0]
    assert row.digest == hashlib.sha256("Äbc".encode()).hexdigest()


def test_contents_that_share_a_digest_stay_apart(make_docs, prose):
    docs = make_docs(prose)
    weak = ed.exact_dedup(docs, digest=lambda content: str(len(content) % 3))
    assert found(weak) == expected(docs.collect())


def test_any_number_of_salts(make_docs):
    docs = make_docs(["same"] * 50 + ["other"])
    assert found(ed.exact_dedup(docs, salts=1)) == found(ed.exact_dedup(docs, salts=7))


def test_kept_rows_have_all_columns(awkward):
    kept = ed.keep_exact(awkward)
    assert kept.columns == awkward.columns
    got = kept.collect()
    texts = [low(r.text) for r in got]
    assert len(texts) == len(set(texts)) == len({low(r["text"]) for r in awkward.collect()})
    assert {r.doc_id for r in got if low(r.text) == b"one"} == {5}


def test_clashing_names(make_docs):
    docs = make_docs(["a", "A", "b"]).selectExpr(
        "*", "1 AS digest", "2 AS keep_id", "3 AS _key", "4 AS salt", "5 AS content"
    )
    assert ed.exact_dedup(docs).count() == 3
    kept = ed.keep_exact(docs)
    assert kept.columns == docs.columns and kept.count() == 2
