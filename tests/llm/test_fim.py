import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rawstar.llm import fim


def expected(doc_id, text):
    """Form, cuts and output by the plain rules."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(docs):
    got = fim.transform(docs).withColumn("back", fim.restored()).collect()
    want = sorted(
        ((r.doc_id, *expected(r.doc_id, r.text), r.text or "") for r in docs.collect()), key=str
    )
    rows = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got]
    assert sorted(rows, key=str) == want
    return got


def test_forms_cuts_and_round_trip(make_docs, prose):
    texts = prose + ["a<P>b", "x<S>", "<M>", "<P", "a < P > b", "<<S<M<P ok", "é1é2", "\U0001f600a\U0001f600", "ab"]
    found = check(make_docs(texts * 3, ids=range(3 * len(texts))))
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_awkward(awkward, empty, make_docs):
    check(awkward)
    assert fim.transform(empty).collect() == []
    clash = awkward.selectExpr("*", "1 AS output", "2 AS form", "3 AS cut", "4 AS digest", "5 AS n")
    assert fim.transform(clash).count() == awkward.count()


def test_every_kind_of_container():
    draw = random.Random(3)
    cases = {
        "empty": [],
        "array": sorted(draw.sample(range(60_000), 500)),
        "bitmap": sorted(draw.sample(range(60_000), 30_000)),
        "run": [*range(10, 9_000), *range(20_000, 65_536)],
        "many": sorted({*range(70_000, 140_000), *draw.sample(range(400_000), 50_000), 399_999}),
    }
    for name, members in cases.items():
        found = fim.BoundarySet(np.array(members, dtype=np.int64))
        assert [found.select(k) for k in range(len(found))] == members, name
        with pytest.raises(IndexError):
            found.select(len(members))
    kinds = {type(p).__name__ for m in cases.values() for p in fim.BoundarySet(np.array(m, dtype=np.int64)).parts}
    assert kinds == {"ArrayContainer", "BitmapContainer", "RunContainer"}


def test_long_text(make_docs):
    draw = random.Random(4)
    text = "".join(draw.choice("ab c,é\U0001f600") for _ in range(300_000)) + "z" * 200_000
    check(make_docs([text, "1" * 150_000]))


def test_rates(make_docs):
    plain = fim.transform(make_docs(["some text"] * 200), cut_rate=0)
    assert {r.form for r in plain.select("form").collect()} == {"plain"}
    spm = fim.transform(make_docs(["some text"] * 200), cut_rate=100, spm_rate=100)
    assert spm.filter(F.col("form") != "spm").count() == 0
