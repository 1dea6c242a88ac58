import random
import zlib

import numpy as np
import pytest

from rawstar.llm import quality as q


def corpus(n=400):
    draw = random.Random(2)
    words = ["the", "of", "and", "in"] * 4 + ["".join(draw.choice("abcdef") for _ in range(5)) for _ in range(80)]
    texts, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        ws = [draw.choice(words) for _ in range(draw.randint(20, 80))]
        if not good:
            ws = [w + draw.choice(["!!", "$$$", "|"]) for w in ws] if i % 8 else [ws[0]] * 50
        texts.append(" ".join(ws))
        labels.append((i, int(good)))
    return texts, labels


@pytest.fixture(scope="module")
def labelled(spark, make_docs):
    texts, labels = corpus()
    return make_docs(texts), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = q.classify(docs, labels).collect()
    assert len(rows) == 400
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    apart = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in apart]) > 0.9


def test_reruns_agree_and_held_out_labels_do_not_matter(spark, labelled):
    docs, labels = labelled
    first = {r.doc_id: r.score for r in q.classify(docs, labels).collect()}
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) AS quality"
    )
    again = {r.doc_id: r.score for r in q.classify(docs.repartition(7), turned).collect()}
    assert first == pytest.approx(again, abs=1e-12)


def test_word_table_is_a_plain_sum(make_docs):
    texts = ["a b c", "b b", "", "x", "a b c"]
    got = q.word_table(make_docs(texts).repartition(3))
    place, sign = q.index_vectors()
    want = np.zeros_like(got)
    for t in texts:
        s = q.slots(t)
        for i in range(len(s)):
            want[s[i], q.DIM] += 1
            for j in range(max(0, i - q.REACH), min(len(s), i + q.REACH + 1)):
                if j != i:
                    for k in range(q.NONZERO):
                        want[s[i], place[s[j], k]] += int(sign[s[j], k])
    assert (got == want).all()


def test_awkward(spark, awkward, empty, labelled):
    labels = spark.createDataFrame(
        [(1, 1), (3, 0), (None, 1), (3, None), (8, 1), (8, 0), (11, 0)], "doc_id long, quality int"
    )
    assert q.classify(awkward, labels).count() == awkward.count()
    assert q.classify(empty, labels).collect() == []
    none = labels.limit(0)
    assert {r.score for r in q.classify(awkward, none).collect()} == {1.0}
    assert q.keep_good(awkward, none).count() == awkward.count()
    assert q.keep_good(empty, labels).collect() == []


def test_rejects_go_and_columns_stay(labelled):
    docs, labels = labelled
    kept = q.keep_good(docs, labels)
    want = {r.doc_id for r in q.classify(docs, labels).collect() if r.predicted}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want
