import random
import re
from collections import defaultdict
from itertools import permutations

import pytest

from rawstar.llm import audit


def conditions(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
    )


def expected(docs, labels):
    """Every order applied to every document, one after the other."""
    good, toxic = defaultdict(bool), defaultdict(bool)
    for i, q, t in labels:
        good[i] |= q == 1
        toxic[i] |= t == 1
    ids = defaultdict(list)
    for i, text, _ in docs:
        if i is not None:
            ids[text or ""].append(i)
    rows = []
    for i, text, source in docs:
        text = text or ""
        repeated = i is not None and min(ids[text]) < i
        fails = dict(zip("ABCDE", (*conditions(text), repeated)))
        known = i is not None
        rows.append((source or "", fails, known and good[i], known and toxic[i]))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, start=1):
                lost = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                shapley[f] += len(lost)
                failing = [r for r in mine if r[1][f]]
                out[part, "".join(order), step] = [
                    len(left),
                    len(lost),
                    len(failing) - len(lost),
                    sum(sum(r[1].values()) == 1 for r in failing),
                    sum(r[2] for r in lost),
                    sum(r[3] for r in lost),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def check(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.audit(d, lab).collect()
    got = {(r.part, r.filter_order, r.step): [r[f] for f in (*audit.FIELDS, "shapley")] for r in found}
    assert len(found) == len(got)
    assert got == expected(docs, labels)


def test_against_every_document(spark):
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(120):
        text = " ".join(draw.choices(vocabulary[: draw.choice([20, 400])], k=draw.choice([5, 150, 200, 260])))
        text += draw.choice(["", " 5 % off", " SHOUT" * 30, "\tx|y"])
        docs.append((draw.randint(1, 90), text, draw.choice(["a", "b", "", None, "hot", "hot"])))
    docs += [(draw.randint(1, 200), d[1], draw.choice(["a", "hot"])) for d in docs[:60]]
    docs += docs[:3] + [(None, docs[0][1], "a"), (None, None, None), (500, None, "b"), (501, "", "b")]
    labels = [(i, draw.randint(0, 1), draw.randint(0, 1)) for i in range(0, 150, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None)]
    check(spark, docs, labels)


def test_borders(spark):
    one = " ".join(f"w{i}" for i in range(200))
    docs = [
        (1, one, "s"), (2, one[:-5], "s"), (3, "a " * 400, "s"), (4, "Ab" + "c" * 98, "s"),
        (5, "AB" + "c" * 98, "s"), (6, "ABC" + "c" * 97, "s"), (7, "x\x0by z", "s"), (8, "w" * 300_000, "s"),
    ]
    check(spark, docs, [])


def test_awkward(awkward, empty, spark):
    labels = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    clash = awkward.selectExpr("*", "1 AS part", "2 AS mask", "3 AS digest", "4 AS n")
    found = audit.audit(clash, labels).collect()
    parts = {r.source or "" for r in awkward.collect()}
    assert len(found) == 600 * len(parts)
    assert audit.audit(empty, labels).collect() == []
    assert audit.audit(awkward, labels.limit(0)).filter("good_lost > 0").count() == 0


def test_orders_fold_to_six_hundred(spark):
    cells = spark.createDataFrame([("p", 31, 7, 3, 2)], "part string, mask int, n long, good long, toxic long")
    rows = audit.interactions(cells).collect()
    assert len(rows) == 600 and len({r.filter_order for r in rows}) == 120
    first = [r for r in rows if r.step == 1]
    assert {(r.kept, r.removed, r.redundant, r.good_lost, r.toxic_lost) for r in first} == {(0, 7, 0, 3, 2)}
    assert {r.shapley for r in rows} == {7 * 24}


@pytest.mark.parametrize("mask", [0, 4, 9])
def test_single_cells(spark, mask):
    cells = spark.createDataFrame([("p", mask, 1, 0, 0)], "part string, mask int, n long, good long, toxic long")
    rows = audit.interactions(cells).collect()
    unique = {r.filter for r in rows if r.unique_fails}
    assert unique == ({"C"} if mask == 4 else set())
