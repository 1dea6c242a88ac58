"""Quality classifier: random-indexing word vectors, pooled, under a small calibrated network.

Words (runs of letters and digits, and runs of other marks) are hashed to `VOCAB` slots. Every slot
has a fixed sparse ternary index vector; the vector of a word is the sum of the index vectors of its
neighbours, two to each side, over *all* texts. Tasks add up their own share, then Spark sums the
shares per slot, so the table has a fixed size (`VOCAB` x (`DIM` + 1) whole numbers) at any scale
and does not depend on the order of the rows.

A document is the weighted mean of its words' vectors, once over all words and once over its distinct
words; weights fall with a word's frequency in the corpus. A network of two layers is fitted in
numpy on at most `MAX_LABELLED` labelled rows, those with the smallest hash of their id. One row in
five of them is set apart to choose the temperature that makes the probabilities fit. Ids, sources,
languages and labels are never inputs of a score.

Results for odd input: a null text is empty; a text without words gets the score of a zero vector,
which is the score of an average word. Several labels of one id count as the largest, a null label
as none. Without any usable label every score is 1. Rows with equal ids are scored each. An empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.base import text_rows

VOCAB = 1 << 13
DIM = 32
NONZERO = 2
REACH = 2
MAX_LABELLED = 20_000
HIDDEN = 24
THRESHOLD = 0.3
SEED = 7
#: Occurrences that are added up before a task passes its sums on to wider counters.
FLUSH = 1 << 20

_TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^\sa-z0-9\x80-\xff]+")


def slots(text: str) -> np.ndarray:
    """Slot of each word of a text."""
    words = _TOKEN.findall(text.encode("utf-8", "surrogatepass").lower())
    return (np.fromiter(map(crc32, words), np.uint32, len(words)) % VOCAB).astype(np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries, VOCAB x NONZERO each."""
    draw = np.random.default_rng(SEED)
    place = np.argsort(draw.random((VOCAB, DIM)), axis=1)[:, :NONZERO]
    return place.astype(np.int64), draw.choice([-1.0, 1.0], (VOCAB, NONZERO))


def _add_contexts(total: np.ndarray, texts: list[np.ndarray], place, sign) -> None:
    """Adds the neighbours' index vectors of some texts to `total`, VOCAB x (DIM + 1)."""
    word = np.concatenate(texts)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    flat = np.zeros(VOCAB * DIM)
    for off in range(1, REACH + 1):
        same = text[off:] == text[:-off]
        left, right = word[:-off][same], word[off:][same]
        for a, b in ((left, right), (right, left)):
            for k in range(NONZERO):
                flat += np.bincount(a * DIM + place[b, k], sign[b, k], VOCAB * DIM)
    total[:, :DIM] += flat.reshape(VOCAB, DIM).astype(np.int64)
    total[:, DIM] += np.bincount(word, minlength=VOCAB)


def word_table(docs: DataFrame) -> np.ndarray:
    """Context sums and, in the last column, occurrences per slot; over all texts."""
    names = [f"d{i}" for i in range(DIM + 1)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, sign = index_vectors()
        total, held, n = np.zeros((VOCAB, DIM + 1), np.int64), [], 0
        for b in batches:
            for t in b["text"]:
                held.append(slots(t))
                n += len(held[-1])
                if n >= FLUSH:
                    _add_contexts(total, held, place, sign)
                    held, n = [], 0
        if n:
            _add_contexts(total, held, place, sign)
        used = np.flatnonzero(total[:, DIM])
        out = pd.DataFrame(total[used], columns=names)
        out.insert(0, "slot", used)
        yield out

    ddl = "slot long, " + ", ".join(f"{c} long" for c in names)
    sums = (
        docs.select("text")
        .mapInPandas(run, ddl)
        .groupBy("slot")
        .agg(*[F.sum(c).alias(c) for c in names])
    )
    table = np.zeros((VOCAB, DIM + 1), np.int64)
    for row in sums.collect():  # VOCAB rows at most
        table[row[0]] = row[1:]
    return table


def word_vectors(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the slots, without what all have in common, and their weights."""
    n = table[:, DIM].astype(float)
    v = table[:, :DIM] / np.maximum(n, 1)[:, None]
    v = v - (v * n[:, None]).sum(0) / max(n.sum(), 1)
    v = v / np.maximum(np.linalg.norm(v, axis=1), 1e-9)[:, None]
    share = n / max(n.sum(), 1)
    return v.astype(np.float32), (1e-3 / (1e-3 + share)).astype(np.float32)


def pool(word: np.ndarray, vectors: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted mean over all words, the same over distinct words, and the share of distinct ones."""
    out = np.zeros(2 * DIM + 2, np.float32)
    if len(word):
        n = np.bincount(word, minlength=VOCAB)
        at = np.flatnonzero(n)
        w, v = weight[at], vectors[at]
        heavy = w * n[at]
        out[:DIM] = heavy @ v / heavy.sum()
        out[DIM : 2 * DIM] = w @ v / w.sum()
        out[2 * DIM] = len(at) ** 0.5 / len(word) ** 0.5
        out[2 * DIM + 1] = heavy.sum() / len(word)
    return out


class Network:
    """Two layers on standardised inputs; probabilities at a fitted temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = 60):
        x = x.astype(float)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        apart = np.arange(len(y)) % 5 == 4
        if len(y) < 20 or len(set(y[~apart])) < 2:
            apart[:] = False
        draw = np.random.default_rng(SEED)
        d = x.shape[1]
        self.w = [draw.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN)]
        self.w += [draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        self._fit(self._standard(x[~apart]), y[~apart].astype(float), draw, epochs)
        if apart.any():
            z = self.logit(x[apart])
            grid = np.geomspace(0.25, 8, 60)
            loss = [np.logaddexp(0, np.where(y[apart] == 1, -z, z) / t).mean() for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _fit(self, x, y, draw, epochs) -> None:
        m, s, t = [np.zeros_like(p) for p in self.w], [np.zeros_like(p) for p in self.w], 0
        for _ in range(epochs):
            order = draw.permutation(len(y))
            for at in range(0, len(y), 256):
                rows = order[at : at + 256]
                h = np.tanh(x[rows] @ self.w[0] + self.w[1])
                p = 1 / (1 + np.exp(-np.clip(h @ self.w[2] + self.w[3], -40, 40)))
                e = (p - y[rows]) / len(rows)
                back = np.outer(e, self.w[2]) * (1 - h * h)
                grads = [x[rows].T @ back, back.sum(0), h.T @ e, e.sum(keepdims=True)]
                t += 1
                for i, g in enumerate(grads):
                    g = g + 1e-4 * self.w[i]
                    m[i] = 0.9 * m[i] + 0.1 * g
                    s[i] = 0.999 * s[i] + 0.001 * g * g
                    step = m[i] / (1 - 0.9**t) / (np.sqrt(s[i] / (1 - 0.999**t)) + 1e-8)
                    self.w[i] = self.w[i] - 3e-3 * step

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._standard(x) @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text leaves 0 when divided by 5."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def labelled_sample(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """_id, quality: at most `limit` labelled ids that are not held out, by the hash of the id."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int"))
        .filter("_id is not null and quality is not null")
        .filter(~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(limit)
    )


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED):
    """(vectors, weights, network); the network is None where no row has a label."""
    vectors, weight = word_vectors(word_table(docs))
    # at most `limit` rows of two numbers, so that the texts need no shuffle
    sample = F.broadcast(labelled_sample(labels, limit))
    names = "doc_id long, quality int, x array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = [pool(slots(t), vectors, weight) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "quality": b["quality"], "x": x})

    chosen = docs.join(sample, docs["doc_id"] == F.col("_id")).select("doc_id", "text", "quality")
    # ids that repeat bring no more rows than the limit allows
    got = chosen.mapInPandas(run, names).orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(limit)
    rows = got.select("quality", "x").collect()
    if not rows:
        return vectors, weight, None
    x, y = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    return vectors, weight, Network(x, y)


def keep_good(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """The documents that are predicted as 1, with all their columns."""
    vectors, weight, network = fit(text_rows(docs), labels, limit)
    if network is None:
        return docs

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = [pool(slots(t), vectors, weight) for t in texts.fillna("")]
        return pd.Series(network.score(np.array(x)) if x else np.zeros(0))

    return docs.filter(score(F.col("text").cast("string")) >= THRESHOLD)


def classify(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    rows = text_rows(docs)
    vectors, weight, network = fit(rows, labels, limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if network is None:
                score = np.ones(len(b))
            else:
                x = [pool(slots(t), vectors, weight) for t in b["text"]]
                score = network.score(np.array(x)) if x else np.zeros(0)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": score})

    scored = rows.mapInPandas(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
