import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None, sources=None):
        ids = range(len(texts)) if ids is None else ids
        sources = ["s"] * len(texts) if sources is None else sources
        rows = [(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources)]
        return spark.createDataFrame(rows, DDL)

    return make


@pytest.fixture(scope="session")
def awkward(make_docs):
    """Nulls in every column, empty and long texts, ties, repeated rows, other scripts."""
    long_text = " ".join(f"wort{i % 977} the und" for i in range(20_000))
    texts = [
        None, "", " \t\n", "one", "One", "one", "the the the the", "日本語 テキスト",
        "A b C d e f g h", "a B c D e f g h", long_text, long_text + " end", "x" * 5_000, None,
        "mail me.now@a-b.example.com or +1 (229) 555-4838", "é́ ß \U0001f600 naïve",
    ]
    ids = [1, 2, 3, 4, 5, 4, 7, 8, 9, 10, 11, 12, 13, None, None, 16]
    sources = [None, "b", "a", "a", "a", "a", "", "b", "c", "c", "a", "a", None, "a", "b", "é"]
    return make_docs(texts, ids, sources)


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def prose():
    """Texts with exact and near copies and shared passages."""
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(1, 7))) for _ in range(300)]
    passage = " ".join(draw.choice(words) for _ in range(70))

    def text(n):
        return " ".join(draw.choice(words) for _ in range(n))

    out = [text(draw.randint(1, 200)) for _ in range(60)]
    out += [out[3], out[3].upper(), out[4], out[5] + " tail", "head " + out[5]]
    out += [f"{text(20)} {passage} {text(30)}" for _ in range(6)]
    out += [out[6][:150] + "!" + out[6][151:] for _ in range(3)]
    return out


@pytest.fixture(scope="session")
def plain():
    """Rows as dicts, ordered by id."""

    def rows(df, key="doc_id"):
        got = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(got, key=lambda r: (r[key] is None, r[key] or 0))

    return rows
