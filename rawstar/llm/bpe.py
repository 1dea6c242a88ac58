"""Byte-level BPE: ids of whole texts and the bytes they stand for.

A text is cut by the pattern, and each distinct word is folded on its own: its bytes start apart
and the neighbours whose union has the lowest rank are joined, again and again, until no union has
a rank. The rank map is a literal of fixed size (the vocabulary), which every task holds once. The
ids of a word are kept for the next time it is met, up to `CACHE` words, so that the fold runs about
once per distinct word of a task. Decoding looks up the bytes of each id and concatenates them.

There is no shuffle: joining folded words back to the places of the texts would move several times
the input (see README for figures).

Results for odd input: a null text is empty and has no ids; the sums of an empty text are those of
the empty string. Rows with equal ids are encoded each. An empty table gives an empty result. A very
long word is folded with a heap, in n log n.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from rawstar.llm.base import text_rows

CACHE = 1 << 19
LONG_WORD = 200
NONE = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of lines `base64 rank`."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > LONG_WORD:
        return _fold_long(word, ranks)
    get = ranks.get
    parts = [word[i : i + 1] for i in range(len(word))]
    best = [get(word[i : i + 2], NONE) for i in range(len(word) - 1)]
    while best:
        low = min(best)
        if low == NONE:
            break
        i = best.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del best[i]
        if i:
            best[i - 1] = get(parts[i - 1] + parts[i], NONE)
        if i < len(best):
            best[i] = get(parts[i] + parts[i + 1], NONE)
    return [ranks[p] for p in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs over a linked list of parts."""
    n = len(word)
    end = list(range(1, n + 1))  # the part that starts at i ends at end[i]
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            r = ranks.get(word[i : end[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Rank map, pattern and the words folded so far, for one Python worker."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.piece = {r: b for b, r in self.ranks.items()}
        self.words = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def _ids_of(self, word: str) -> bytes:
        if len(self.known) >= CACHE:
            self.known.clear()
        ids = np.array(fold(word.encode("utf-8"), self.ranks), dtype="<u4").tobytes()
        self.known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        words = self.words(text)
        get = self.known.get
        found = [get(w) for w in words]
        if None in found:
            found = [self._ids_of(w) if f is None else f for w, f in zip(words, found)]
        return b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.piece.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def vocabulary() -> tuple[str, str]:
    """Path of the rank file and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) per document."""
    default = vocabulary()
    where, cut = path or default[0], pattern or default[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(where, cut)
        for b in batches:
            ids = [np.frombuffer(enc.encode(t), dtype="<i4") for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "ids": ids})

    return text_rows(docs).mapInPandas(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, data (binary): the bytes that the ids of `encode` stand for."""
    default = vocabulary()
    where, cut = path or default[0], pattern or default[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(where, cut)
        for b in batches:
            data = [enc.decode(np.asarray(x, dtype="<u4").tobytes()) for x in b["ids"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "data": data})

    return encoded.mapInPandas(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, then decoded from the ids."""
    default = vocabulary()
    where, cut = path or default[0], pattern or default[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(where, cut)
        for b in batches:
            n, ids_sum, text_sum = [], [], []
            for t in b["text"]:
                ids = enc.encode(t)
                n.append(len(ids) // 4)
                ids_sum.append(hashlib.sha256(ids).hexdigest())
                text_sum.append(hashlib.sha256(enc.decode(ids)).hexdigest())
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"].astype("Int64"),
                    "n_tokens": n,
                    "ids_sha256": ids_sum,
                    "decoded_sha256": text_sum,
                }
            )

    return text_rows(docs).mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
