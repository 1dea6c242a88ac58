"""Context-mixing range coder for token ids, many blocks at once.

Each block is coded on its own from a fresh state, so blocks can be decoded in any order and a damaged
one costs no other. The probability of an id is a mixture of three predictions:

- order 2: the id that followed the last two ids, found through a hash of both;
- order 1: the id that followed the last id;
- order 0: how often ids come at all, as `shares` of them that the caller counts over many blocks and
  keeps beside them; without, all ids alike.

How much the first two count for is learned in the block: for each level of confidence, how often the
prediction came true. All of it is integer arithmetic, so decoding repeats what encoding did. The
mixture gives an id an interval of 2^26 parts and a 64-bit range coder narrows its range to that; when
the range falls below 2^32 a word of 32 bits is put out.

Blocks are independent, so `LANES` of them are coded in step: one step codes the next id of every
block with numpy operations over the lanes. State is about 8 KB a lane, whatever the input, and one
table of order 0 for all.
"""

from __future__ import annotations

import numpy as np

BLOCK_IDS = 1 << 11
LANES = 1 << 11

_BASE = 18  # bits of the order-0 total
_TOTAL = _BASE + 8  # bits of the mixture's total: weights have 8
_SLOTS = 1 << 10  # contexts of an order that a lane tells apart
_WORD = np.uint64(32)
_LOW_WORD = np.uint64((1 << 32) - 1)
_FULL = np.uint64((1 << 64) - 1)

#: How often a prediction of each confidence (0: empty) comes true at first, of 65,536.
_START = np.array([0, *[1 << 14] * 2, *[1 << 15] * 5], dtype=np.int32)


def count_ids(ids: np.ndarray, size: int, step: int = 1 << 16) -> np.ndarray:
    """How often each id below `size` comes; a part that fits the cache is counted at a time."""
    counts = np.zeros(size, dtype=np.int64)
    for at in range(0, len(ids), step):
        counts += np.bincount(ids[at : at + step], minlength=size)
    return counts


def shares_of(counts: np.ndarray) -> np.ndarray:
    """Shares, of 2^18, of ids that come `counts` times: at least one of each that comes at all."""
    comes = counts > 0
    n = int(np.count_nonzero(comes))
    if n == 0 or len(counts) > 1 << (_BASE - 1):
        raise ValueError(f"shares of {n} of {len(counts)} ids")
    counts = counts.astype(np.int64)
    up_to = np.cumsum(counts) * ((1 << _BASE) - n) // int(counts.sum()) + np.cumsum(comes)
    return np.diff(up_to, prepend=0).astype("<u4")


class _Order0:
    """Where each id's share starts, its length, and the id at each place."""

    def __init__(self, size: int, shares: np.ndarray | None):
        if size > 1 << (_BASE - 1):
            raise ValueError(f"{size} ids are too many for this coder")
        given = shares_of(np.ones(size, dtype=np.int64)) if shares is None else shares
        if len(given) != size or int(given.sum(dtype=np.int64)) != 1 << _BASE:
            raise ValueError("shares of other ids")
        self.length = given.astype(np.int32)
        self.start = np.cumsum(self.length, dtype=np.int32) - self.length
        self.size = size

    def id_at(self) -> np.ndarray:
        return np.repeat(np.arange(self.size, dtype=np.int32), self.length)


class _Model:
    """The predictions of `lanes` blocks.

    Arrays of two rows hold order 1 in the first and order 2 in the second.
    """

    def __init__(self, lanes: int, order0: _Order0):
        self.order0 = order0
        both = np.arange(2 * lanes, dtype=np.int64)
        self.at_context, self.at_hit = (both * _SLOTS).reshape(2, -1), (both * 8).reshape(2, -1)
        self.entry = np.zeros(2 * lanes * _SLOTS, dtype=np.int32)  # id * 8 + confidence
        self.hit = np.tile(_START, 2 * lanes)
        self.last = np.zeros(lanes, dtype=np.int64)
        self.slot = self.at_context.copy()  # of the contexts, over all lanes

    def predict(self, n: int) -> None:
        """Predicted ids and weights for the next id of the first n lanes."""
        self.i = self.slot[:, :n]
        self.e = self.entry.take(self.i)
        self.p, self.sure = self.e >> 3, self.e & 7
        self.j = self.at_hit[:, :n] + self.sure
        self.h = self.hit.take(self.j)
        w2 = (self.h[1] * 250) >> 16
        w1 = ((255 - w2) * self.h[0]) >> 16
        self.w0 = 256 - w1 - w2
        self.w1, self.w2 = w1 << _BASE, w2 << _BASE

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length, of 2^26, of the given ids."""
        over = self.p - ids
        below = over >> 31  # all bits where the prediction is a smaller id
        self.true = ~((over | -over) >> 31)  # and where it is the id
        start = self.w0 * self.order0.start.take(ids)
        start += (below[0] & self.w1) + (below[1] & self.w2)
        length = self.w0 * self.order0.length.take(ids)
        length += (self.true[0] & self.w1) + (self.true[1] & self.w2)
        return start, length

    def find(self, target: np.ndarray, id_at: np.ndarray) -> np.ndarray:
        """The ids whose intervals hold the targets.

        What the predictions add lies at the start of their ids' intervals, order 1 first where both
        name one id. Taken out, it leaves the place within order 0.
        """
        at = self.w0 * self.order0.start.take(self.p)
        first = at[1] + (((self.p[0] - self.p[1] - 1) >> 31) & self.w1)
        rest = target - np.minimum(np.maximum(target - first, 0), self.w2)
        rest -= np.minimum(np.maximum(rest - at[0], 0), self.w1)
        return id_at.take(rest // self.w0)

    def update(self, ids: np.ndarray, n: int) -> None:
        """After `interval` of the same ids."""
        # a prediction that came true is surer; else one of 3 or more is less sure, and others go
        new = (ids << 3) + 1
        kept = new + ((self.e - 2 - new) & ((2 - self.sure) >> 31))
        surer = np.minimum(self.e + 1, self.e | 7)
        # flat places, which numpy writes faster
        self.entry[self.i.reshape(-1)] = (kept + ((surer - kept) & self.true)).reshape(-1)
        self.hit[self.j.reshape(-1)] = (self.h + (((self.true & 65535) - self.h) >> 5)).reshape(-1)
        last = ids.astype(np.int64)
        mixed = (self.last[:n] + last * 0x85EBCA6B) >> 11
        np.add(self.at_context[0, :n], last & (_SLOTS - 1), out=self.slot[0, :n])
        np.add(self.at_context[1, :n], mixed & (_SLOTS - 1), out=self.slot[1, :n])
        np.multiply(last, 0x9E3779B1, out=self.last[:n])


def _steps(lengths: np.ndarray):
    """(place, lanes still running) of each step; lanes are ordered from the longest block on."""
    n = len(lengths)
    for t in range(int(lengths[0]) if n else 0):
        while lengths[n - 1] <= t:
            n -= 1
        yield t, n


def _turned(a: np.ndarray, tile: int = 64) -> np.ndarray:
    """The transpose, copied by tiles that fit the cache."""
    out = np.empty(a.shape[::-1], dtype=a.dtype)
    for i in range(0, a.shape[0], tile):
        for j in range(0, a.shape[1], tile):
            out[j : j + tile, i : i + tile] = a[i : i + tile, j : j + tile].T
    return out


def encode_blocks(
    blocks: list[np.ndarray], size: int, shares: np.ndarray | None = None
) -> list[bytes]:
    """One payload per block of ids below `size`; `shares` (see `shares_of`) must know all of them."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    order0 = _Order0(size, shares)
    out: list[bytes] = [b""] * len(blocks)
    for at in range(0, len(order), LANES):
        mine = order[at : at + LANES]
        for i, payload in zip(mine, _encode([blocks[i] for i in mine], order0)):
            out[i] = payload
    return out


def _encode(blocks: list[np.ndarray], order0: _Order0) -> list[bytes]:
    lanes, lengths = len(blocks), np.array([len(b) for b in blocks], dtype=np.int64)
    longest = int(lengths.max(initial=0))
    ids = np.zeros((lanes, longest), dtype=np.int32)
    if longest >= 1 << 16:
        raise ValueError("a block holds fewer than 65536 ids")
    given = np.concatenate([*blocks, np.zeros(0, dtype=np.uint32)])
    if len(given) and not 0 <= given.min() <= given.max() < order0.size:
        raise ValueError(f"ids must lie in 0 to {order0.size - 1}")
    for i, b in enumerate(blocks):
        ids[i, : len(b)] = b
    ids = _turned(ids)
    model = _Model(lanes, order0)
    low, wide = np.zeros(lanes, dtype=np.uint64), np.full(lanes, _FULL)
    words = np.zeros((lanes, longest + 2), dtype="<u4")
    flat, row = words.reshape(-1), np.arange(lanes, dtype=np.int64) * (longest + 2)
    at_word = row.copy()
    shift, small = np.uint64(_TOTAL), np.uint64(1 << 32)
    for t, n in _steps(lengths):
        now = ids[t, :n]
        model.predict(n)
        start, length = model.interval(now)
        part = wide[:n] >> shift
        low[:n] += part * start.astype(np.uint64)
        wide[:n] = part * length.astype(np.uint64)
        full = np.flatnonzero(wide[:n] < small)
        if len(full):
            at = low[full]
            place = at_word[full]
            flat[place] = at >> _WORD
            at_word[full] = place + 1
            # a range over a word's border is cut there, so that the word is settled
            wide[full] = np.minimum(wide[full], small - (at & _LOW_WORD)) << _WORD
            low[full] = at << _WORD
        model.update(now, n)
    if not wide.all():  # a range that an id without a share makes empty stays so
        raise ValueError("an id has no share")
    out = []
    for i in range(lanes):
        k = int(at_word[i] - row[i])
        words[i, k : k + 2] = low[i] >> _WORD, low[i] & _LOW_WORD
        # words of zeros at the end are read as zeros anyway
        used = words[i, : k + 2].tobytes()
        out.append(used[: -(-len(used.rstrip(b"\0")) // 4) * 4])
    return out


def decode_blocks(
    payloads: list[bytes], lengths: list[int], size: int, shares: np.ndarray | None = None
) -> list[np.ndarray]:
    """The ids of each block, given their number and the shares they were encoded with."""
    order = sorted(range(len(payloads)), key=lambda i: -lengths[i])
    order0 = _Order0(size, shares)
    out: list[np.ndarray] = [np.empty(0, dtype="<u4")] * len(payloads)
    for at in range(0, len(order), LANES):
        mine = order[at : at + LANES]
        found = _decode([payloads[i] for i in mine], [lengths[i] for i in mine], order0)
        for i, ids in zip(mine, found):
            out[i] = ids
    return out


def _decode(payloads: list[bytes], counts: list[int], order0: _Order0) -> list[np.ndarray]:
    lanes, lengths = len(payloads), np.array(counts, dtype=np.int64)
    model, id_at = _Model(lanes, order0), order0.id_at()
    longest = int(lengths.max(initial=0))
    width = max([len(p) // 4 for p in payloads], default=0) + 2  # what comes after a payload is zero
    words = np.zeros((lanes, width), dtype="<u4")
    for i, p in enumerate(payloads):
        words[i, : len(p) // 4] = np.frombuffer(p, dtype="<u4")
    code = (words[:, 0].astype(np.uint64) << _WORD) | words[:, 1]
    flat, row = words.reshape(-1), np.arange(lanes, dtype=np.int64) * width
    at_word, end = row + 2, row + width - 1
    low, wide = np.zeros(lanes, dtype=np.uint64), np.full(lanes, _FULL)
    ids = np.zeros((longest, lanes), dtype=np.int32)
    shift, small, most = np.uint64(_TOTAL), np.uint64(1 << 32), np.uint64((1 << _TOTAL) - 1)
    for t, n in _steps(lengths):
        model.predict(n)
        part = wide[:n] >> shift
        target = np.minimum((code[:n] - low[:n]) // part, most).astype(np.int32)
        now = model.find(target, id_at)
        start, length = model.interval(now)
        low[:n] += part * start.astype(np.uint64)
        wide[:n] = part * length.astype(np.uint64)
        full = np.flatnonzero(wide[:n] < small)
        if len(full):
            at = low[full]
            wide[full] = np.minimum(wide[full], small - (at & _LOW_WORD)) << _WORD
            low[full] = at << _WORD
            place = at_word[full]
            code[full] = (code[full] << _WORD) | flat.take(np.minimum(place, end[full]))
            at_word[full] = place + 1
        ids[t, :n] = now
        model.update(now, n)
    each = _turned(ids).astype("<u4")
    return [each[i, :k].copy() for i, k in enumerate(counts)]
