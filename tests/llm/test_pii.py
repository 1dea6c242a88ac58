import hashlib
import random
import re

import pytest

from rawstar.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        sums = [sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(sums) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    spans = [
        (m.start(), n, m.end(), kind)
        for n, (kind, p) in enumerate(PLAIN.items())
        for m in re.finditer(p, text)
        if holds(kind, m[0])
    ]
    return [(a, b, kind) for a, _, b, kind in sorted(spans)]


TEXTS = [
    "a.b@c.d@e.f x@y @z.q a@b..c a@-.- é@a.b aé.b@x-y.z.",
    "1.2.3.4.5.6.7.8 300.1.1.1 1.2.3 01.002.0003.4 255.255.255.2551 1.2.3.4",
    "4111 1111 1111 1111, 4111111111111112; 4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1 4111  1111 1111 1111",
    "+1 (229) 555-4838 +12 +1 2 +49.30.1234567-89 ++1 234 567 8901+1 234 567 8901 +123456789012345678",
    "192.168.0.1@host.example 4111111111111111@a.b +4111111111111111",
    "", "@", "+", "1", "a@" * 50, "9" * 3000, "1." * 2000, "ab@" + "c." * 500,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    text = "a" * 200_000 + " " + "1" * 200_000 + " " + "x@" * 50_000
    assert isinstance(pii.base_spans(text), list) and isinstance(pii.candidates(text, []), list)


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def test_columns(make_docs, plain):
    got = plain(pii.digest_columns(pii.find_pii(make_docs(TEXTS))))
    for text, row in zip(TEXTS, got):
        base = brute(text)
        assert row["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest()
        for kind in PLAIN:
            assert row[f"n_{kind}"] == sum(s[2] == kind for s in base)
        assert set(listed(base).split(",")) <= set(row["spans"].split(","))


def test_contexts_find_unseen_identifiers(make_docs, plain):
    texts = [f"word{'abcdefghij'[i]} password=ab{i}cd34ef56 end" for i in range(10)]
    # the context `at host _ port` is learned from addresses, then finds names
    texts += [f"go to at host 10.0.0.{i} port now" for i in range(20)]
    texts += ["x host srv-77-b.local port y", "plain words only", "see 2024-01-02 for more"]
    got = plain(pii.digest_columns(pii.find_pii(make_docs(texts))))
    assert all("id:" in r["spans"] for r in got[:10])
    t = texts[30]
    assert got[30]["spans"] == f"id:{t.index('srv')}:{t.index(' port')}"
    assert got[31]["spans"] == got[32]["spans"] == ""


def test_awkward(awkward, empty):
    got = pii.find_pii(awkward)
    assert got.count() == awkward.count()
    assert pii.digest_columns(pii.find_pii(empty)).collect() == []
    rows = pii.digest_columns(got).filter("n_email + n_phone > 0").collect()
    assert [(r.doc_id, r.n_email, r.n_phone) for r in rows] == [(None, 1, 1)]


def test_long_zeros_and_overlaps():
    assert pii.base_spans("0" * 5000 + ".1.1.1") == [(0, 5006, "ip")]
    text = "key=AB1234xyz 10.0.0.1 " * 3
    base = pii.base_spans(text)
    assert [t[:2] for t in pii.candidates(text, base) if t[2] == "id"] == [(4, 13), (27, 36), (50, 59)]


SECRETS = {
    "token=abc123def&uid=77": ["abc123def"],
    "password=Ab12cd== next": ["Ab12cd=="],
    "password=correcthorse": ["correcthorse"],
    'x {"apikey": "sk12345678", "n": 1}': ["sk12345678"],
    '{"token":"abc:de=fg","pwd":"x y z"}': ["abc:de=fg", "x y z"],
    "secret: 'Zx81ab22cd'": ["Zx81ab22cd"],
    "a=1;passwd=hunter2;b=2": ["hunter2"],
    "TOKEN = aB3dE6gH9.": ["aB3dE6gH9"],
    "https://h.example/p?access_token=qwertyui&x=1#y": ["qwertyui"],
}
CLEAN = [
    "the password: please ask", "a token: something", "see: that", "pwd=", "token= ", "x = y",
    "ratio 3:4 = fine", "secret", 'he said: "token"',
]


def test_every_form_of_a_secret_is_found(make_docs, plain):
    """Each is the only one of its kind, so no pattern has support."""
    texts = list(SECRETS) + CLEAN
    got = plain(pii.digest_columns(pii.find_pii(make_docs(texts))))
    for row, (text, want) in zip(got, SECRETS.items()):
        found = [s.split(":") for s in row["spans"].split(",")]
        assert [text[int(a) : int(b)] for kind, a, b in found if kind == "id"] == want, text
    for row, text in zip(got[len(SECRETS) :], CLEAN):
        assert row["spans"] == "", text


def test_other_keys_are_learned(make_docs, plain):
    """A key whose values also stand behind seed keys is one itself; others are not."""
    texts = [f"token=key{i}abc{i} then sessid=key{i}abc{i}" for i in range(20)]
    texts += ["and sessid=fresh123value", "page=number123456"]
    got = plain(pii.digest_columns(pii.find_pii(make_docs(texts))))
    assert got[20]["spans"] == "id:11:24" and got[21]["spans"] == ""


def test_scores_against_a_plain_loop(spark):
    draw = random.Random(6)
    edges = sorted({(f"p{draw.randint(0, 30)}", draw.randint(0, 200)) for _ in range(600)})
    seeds = {i for _, i in edges if i % 7 == 0}
    conf = {i: float(i in seeds) for _, i in edges}
    for _ in range(pii.ROUNDS):
        members = {p: [i for q, i in edges if q == p] for p, _ in edges}
        score = {p: sum(conf[i] for i in m) / (len(m) + 1) for p, m in members.items()}
        conf = {i: max(float(i in seeds), *(score[p] for p, j in edges if j == i)) for i in conf}
    graph = spark.createDataFrame([(p, i, i in seeds) for p, i in edges], "pattern string, instance long, seed boolean")
    got = {r.pattern: (r.score, r.support) for r in pii.pattern_scores(graph).collect()}
    assert {p: n for p, (_, n) in got.items()} == {p: len(m) for p, m in members.items()}
    assert {p: s for p, (s, _) in got.items()} == pytest.approx(score)
