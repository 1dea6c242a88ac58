"""Repeated passages of whole texts, found by a hash-compared suffix sort, and their removal.

A byte goes if a string of `length` bytes that covers it also starts anywhere else, in the same
document or in another. Which suffixes can share that many bytes is told by anchors: in each window
of `length` bytes the `gram`-byte string with the least hash (the leftmost on ties) is its anchor.
Equal windows have equal anchors at equal places, so only suffixes at an anchor that occurs again
have to be sorted; one anchor serves a whole run of windows, its segment.

1. Tasks list the segments: anchor hash, digest of the segment's bytes, place. Anchors that occur
   once are dropped by a grouped count.
2. A segment whose bytes occur again is repeated as a whole. That settles all exact copies without
   looking at their texts.
3. Of the other segments at a repeated anchor, one per distinct content is fetched. The text behind
   each anchor, and the text before it read backwards, are sorted in mergesort; two suffixes are
   compared by binary search for the longest prefix with equal polynomial hashes, so a comparison
   takes a logarithmic number of steps. Neighbours in both orders give, for each window, the classes
   of equal right and equal left parts; windows with equal classes on both sides are equal. The
   common extensions of neighbours are checked byte by byte; should a hash have lied, the bytes
   themselves are sorted.
4. An anchor with more than `HOT` distinct contents is not sorted in one task: its windows are
   counted by digest all over the cluster, with the same result.

Results for odd input: a null text is empty; texts shorter than `length` bytes lose nothing. Rows
that repeat id and text are repeats of each other. Bytes are removed wherever they lie, so what is
kept need not be valid UTF-8. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.base import stage, text_rows

LENGTH = 200
#: Bytes of a text that are hashed at a time; anchors lie within 24 bits of their start.
CHUNK = 1 << 20
#: Segments that one task sorts at a time, and distinct contents of an anchor that it may have.
BUCKET = 12_000
HOT = 12_000

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def gram_of(length: int) -> int:
    return max(1, length * 8 // 25)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def prefix_hashes(data: np.ndarray, power: np.ndarray) -> np.ndarray:
    """h[..., i]: polynomial hash of the first i bytes of each row, modulo 2**64."""
    out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
    terms = (data.astype(np.uint64) + np.uint64(1)) * power[: data.shape[-1]]
    np.cumsum(terms, axis=-1, out=out[..., 1:])
    return out


def anchors(data: np.ndarray, length: int, power: np.ndarray, inverse: np.ndarray):
    """anchor hash, anchor place, first and last window start of each segment of some bytes."""
    gram = gram_of(length)
    n = len(data) - gram + 1
    h = prefix_hashes(data, power)
    h = _mixed((h[gram:] - h[:-gram]) * inverse[:n])
    low = np.uint64(0xFFFFFF)
    best = (h & ~low) | np.arange(n, dtype=np.uint64)
    span, wide = 1, length - gram + 1
    while span * 2 <= wide:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < wide:
        rest = wide - span
        best = np.minimum(best[:-rest], best[rest:])
    place = (best & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.concatenate((first[1:], [len(place)])) - 1
    return h[place[first]].view(np.int64), place[first], first, last


def list_segments(docs: DataFrame, length: int) -> DataFrame:
    """`docs` has doc_id, row, text; anchor, digest, doc_id, row, place, first, last."""
    ddl = "anchor long, digest long, doc_id long, row long, place long, first long, last long"
    names = [c.split()[0] for c in ddl.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = CHUNK + length
        power, inverse = powers(_BASE, size), powers(_INVERSE, size)
        blake = hashlib.blake2b
        for b in batches:
            parts, ids, rows, many = [], [], [], []
            for doc_id, row, text in zip(b["doc_id"].astype("Int64"), b["row"], b["text"]):
                raw = text.encode("utf-8", "surrogatepass")
                whole = np.frombuffer(raw, np.uint8)
                for at in range(0, len(raw) - length + 1, CHUNK):
                    h, p, f, e = anchors(whole[at : at + CHUNK + length - 1], length, power, inverse)
                    p, f, e = p + at, f + at, e + at
                    sums = b"".join(
                        blake(raw[s:t], digest_size=8).digest()
                        for s, t in zip(f.tolist(), (e + length).tolist())
                    )
                    # the place of the anchor is part of what must agree
                    digest = np.frombuffer(sums, np.int64) ^ _mixed((p - f).astype(np.uint64)).view(
                        np.int64
                    )
                    parts.append((h, digest, p, f, e))
                    ids.append(doc_id)
                    rows.append(row)
                    many.append(len(h))
            if not parts:
                continue
            h, digest, p, f, e = (np.concatenate(x) for x in zip(*parts))
            key = pd.array(ids, "Int64").repeat(many)
            columns = [h, digest, key, np.repeat(np.array(rows, np.int64), many), p, f, e]
            yield pd.DataFrame(dict(zip(names, columns)))

    return docs.mapInPandas(run, ddl)


# --- sorting ---


def _common(h: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common extension of rows i and j: the longest prefix with equal hashes."""
    low, high = np.zeros(len(i), np.int64), np.minimum(size[i], size[j])
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) // 2
        same = h[i, mid] == h[j, mid]
        low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)


def _before(data, h, size, group, i, j, or_equal: bool) -> np.ndarray:
    """Whether row i sorts before row j (or with it)."""
    n = _common(h, size, i, j)
    ended = (n == size[i]) | (n == size[j])
    at = np.minimum(n, data.shape[1] - 1)
    by_byte = data[i, at] < data[j, at]
    by_size = (size[i] <= size[j]) if or_equal else (size[i] < size[j])
    less = np.where(ended, by_size, by_byte)
    return np.where(group[i] == group[j], less, group[i] < group[j])


def merge_sort(data: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by (group, bytes), and the bytes each shares with the row before it (-1 at
    the first of a group). All merges of a level run together: each element finds its place in the
    other run by binary search."""
    h = prefix_hashes(data, powers(_BASE, data.shape[1]))
    n = len(data)
    order, at, width = np.arange(n), np.arange(n), 1
    while width < n:
        start = at // (2 * width) * (2 * width)
        mid = np.minimum(start + width, n)
        end = np.minimum(start + 2 * width, n)
        left = at < mid
        low, high = np.where(left, mid, start), np.where(left, end, mid)
        from_ = low.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            probe = (low[open_] + high[open_]) // 2
            x, y, is_left = order[open_], order[probe], left[open_]
            # left elements come after those strictly before them, right ones also after equals
            goes = np.empty(len(open_), bool)
            goes[is_left] = _before(data, h, size, group, y[is_left], x[is_left], False)
            goes[~is_left] = _before(data, h, size, group, y[~is_left], x[~is_left], True)
            low[open_] = np.where(goes, probe + 1, low[open_])
            high[open_] = np.where(goes, high[open_], probe)
        own = np.where(left, at - start, at - mid)
        new = np.empty(n, np.int64)
        new[start + own + low - from_] = order
        order, width = new, width * 2
    shared = np.full(n, -1, np.int64)
    if n > 1:
        same = group[order[1:]] == group[order[:-1]]
        shared[1:][same] = _common(h, size, order[1:][same], order[:-1][same])
    return order, shared


def verified_sort(data, size, group) -> tuple[np.ndarray, np.ndarray]:
    """`merge_sort`, with every neighbour's common extension checked by its bytes."""
    order, shared = merge_sort(data, size, group)
    i, j, n = order[1:], order[:-1], shared[1:]
    cols = np.arange(data.shape[1])
    for at in range(0, len(n), 4096):
        part = slice(at, at + 4096)
        differs = (data[i[part]] != data[j[part]]) & (cols < n[part, None])
        if differs.any():
            break
    else:
        return order, shared
    rows = [(group[r], data[r, : size[r]].tobytes()) for r in range(len(data))]
    order = np.array(sorted(range(len(rows)), key=rows.__getitem__), np.int64)
    for k in range(1, len(order)):
        a, b = rows[order[k - 1]], rows[order[k]]
        if a[0] != b[0]:
            shared[k] = -1
            continue
        m = min(len(a[1]), len(b[1]))
        unlike = np.flatnonzero(data[order[k - 1], :m] != data[order[k], :m])
        shared[k] = unlike[0] if len(unlike) else m
    shared[:1] = -1
    return order, shared


def repeated_windows(contents: list[bytes], ahead: np.ndarray, group: np.ndarray, length: int):
    """flags[i, o]: whether the window of row i that starts o bytes before its anchor is repeated.

    `ahead` is where the anchor lies in each content.
    """
    n, wide = len(contents), length - gram_of(length) + 1
    size = np.array([len(c) for c in contents], np.int64)
    right = np.zeros((n, length), np.uint8)
    left = np.zeros((n, wide), np.uint8)
    for i, c in enumerate(contents):
        row = np.frombuffer(c, np.uint8)
        right[i, : size[i] - ahead[i]] = row[ahead[i] :]
        left[i, : ahead[i]] = row[: ahead[i]][::-1]
    right_size = size - ahead
    order_r, shared_r = verified_sort(right, right_size, group)
    order_l, shared_l = verified_sort(left, ahead, group)
    least = length - right_size  # the last window start, seen from the anchor
    flags = np.zeros((n, wide), bool)
    class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(wide):
        rows = np.flatnonzero((least <= o) & (o <= ahead))
        if len(rows) < 2:
            continue
        class_r[order_r] = np.cumsum(shared_r < length - o)
        class_l[order_l] = np.cumsum(shared_l < o)
        key = class_r[rows] * np.int64(n + 1) + class_l[rows]
        by = np.argsort(key, kind="stable")
        equal = key[by][1:] == key[by][:-1]
        twice = np.zeros(len(rows), bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        flags[rows[by], o] = twice
    return flags


SPAN_DDL = "doc_id long, row long, start long, end long"


def _spans_of(rows: pd.DataFrame, flags: np.ndarray, length: int) -> pd.DataFrame:
    """Byte spans of the flagged windows: one per run of neighbouring windows."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    i, low = np.nonzero(edge == 1)
    _, high = np.nonzero(edge == -1)
    place = rows["place"].to_numpy()[i]
    return pd.DataFrame(
        {
            "doc_id": rows["doc_id"].astype("Int64").to_numpy()[i],
            "row": rows["row"].to_numpy()[i],
            "start": place - (high - 1),
            "end": place - low + length,
        }
    ).astype({"doc_id": "Int64"})


def _sort_bucket(length: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.reset_index(drop=True)
        _, group = np.unique(rows["anchor"].to_numpy(), return_inverse=True)
        ahead = (rows["place"] - rows["first"]).to_numpy()
        flags = repeated_windows(rows["content"].tolist(), ahead, group, length)
        once = np.flatnonzero(rows["n"].to_numpy() == 1)  # the others are repeated as a whole
        return _spans_of(rows.iloc[once], flags[once], length)

    return run


def _window_rows(length: int):
    """One row per window of a segment, told apart by two digests."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            cols = ["anchor", "n", "doc_id", "row", "place", "first", "content"]
            for anchor, n, doc_id, row, place, first, c in b[cols].itertuples(index=False):
                for s in range(len(c) - length + 1):
                    d = hashlib.blake2b(c[s : s + length], digest_size=16).digest()
                    a, z = np.frombuffer(d, np.int64)
                    out.append((anchor, place - first - s, a, z, n, doc_id, row, first + s))
            names = ["anchor", "ahead", "d1", "d2", "n", "doc_id", "row", "start"]
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return run


def repeated_spans(docs: DataFrame, length: int, bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """`docs` has doc_id, row, text; doc_id, row, start, end of repeated bytes (they may overlap)."""
    segments = stage(list_segments(docs, length), "segments")
    per_anchor = (
        segments.groupBy("anchor")
        .agg(F.count("*").alias("m"), F.min("digest").alias("d0"), F.max("digest").alias("d1"))
        .filter("m > 1")
        .select("anchor", (F.col("d0") != F.col("d1")).alias("differ"))
    )
    hit = stage(segments.join(per_anchor, "anchor"), "segments-hit")
    per_content = stage(
        hit.groupBy("anchor", "digest").agg(
            F.count("*").alias("n"),
            F.min(F.struct("doc_id", "row", "place", "first", "last")).alias("one"),
            F.max("differ").alias("differ"),
        ),
        "segment-contents",
    )
    again = per_content.filter("n > 1").select("anchor", "digest")
    whole = hit.join(again, ["anchor", "digest"], "left_semi").select(
        "doc_id", "row", F.col("first").alias("start"), (F.col("last") + length).alias("end")
    )
    apart = per_content.filter("differ")
    crowded = apart.groupBy("anchor").count().filter(F.col("count") > hot).select("anchor")
    crowded = stage(crowded.withColumn("crowded", F.lit(True)), "segments-crowded")
    wanted = (
        apart.join(crowded, "anchor", "left")
        .select("anchor", "n", "one.*", F.coalesce("crowded", F.lit(False)).alias("crowded"))
        .groupBy("doc_id", "row")
        # segments of one document, as many as its own length allows
        .agg(F.collect_list(F.struct("anchor", "n", "place", "first", "last", "crowded")).alias("want"))
    )
    ddl = (
        "anchor long, n long, doc_id long, row long, place long, first long, content binary, "
        "crowded boolean"
    )
    names = [c.split()[0] for c in ddl.split(", ")]

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, row, text, want in zip(b["doc_id"].astype("Int64"), b["row"], b["text"], b["want"]):
                raw = text.encode("utf-8", "surrogatepass")
                for w in want:
                    content = raw[w["first"] : w["last"] + length]
                    out.append(
                        (w["anchor"], w["n"], doc_id, row, w["place"], w["first"], content, w["crowded"])
                    )
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    contents = (
        docs.join(
            wanted.withColumnsRenamed({"doc_id": "_d", "row": "_r"}),
            F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row") == F.col("_r")),
        )
        .select("doc_id", "row", "text", "want")
        .mapInPandas(fetch, ddl)
    )
    buckets = max(1, math.ceil(apart.count() / bucket))
    sorted_ = (
        contents.filter("not crowded")
        .withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(_sort_bucket(length), SPAN_DDL)
    )
    spans = whole.unionByName(sorted_)
    if crowded.isEmpty():
        return spans
    wddl = "anchor long, ahead long, d1 long, d2 long, n long, doc_id long, row long, start long"
    windows = stage(contents.filter("crowded").mapInPandas(_window_rows(length), wddl), "windows")
    keys = ["anchor", "ahead", "d1", "d2"]
    twice = windows.groupBy(*keys).agg(F.count("*").alias("m")).filter("m > 1").select(*keys)
    counted = windows.filter("n = 1").join(twice, keys, "left_semi")
    return spans.unionByName(
        counted.select("doc_id", "row", "start", (F.col("start") + length).alias("end"))
    )


def merge_spans(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """The union of spans, as maximal runs."""
    by = np.argsort(start, kind="stable")
    start, reach = start[by], np.maximum.accumulate(end[by])
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(start) - 1]))
    return list(zip(start[new].tolist(), reach[last].tolist()))


def remove_repeats(docs: DataFrame, length: int = LENGTH, bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, spans (removed runs of bytes), kept (the remaining bytes) per document."""
    rows = text_rows(docs).select("doc_id", F.xxhash64("text").alias("row"), "text")
    spans = (
        repeated_spans(rows, length, bucket, hot)
        .groupBy(F.col("doc_id").alias("_d"), F.col("row").alias("_r"))
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    joined = rows.join(
        spans, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row") == F.col("_r")), "left"
    ).select("doc_id", "text", "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes, runs, kept = [], [], []
            for text, found in zip(b["text"], b["spans"]):
                raw = text.encode("utf-8", "surrogatepass")
                sizes.append(len(raw))
                if found is None or not len(found):
                    runs.append([])
                    kept.append(raw)
                    continue
                ends = np.array([(s["start"], s["end"]) for s in found], np.int64)
                gone = merge_spans(ends[:, 0], ends[:, 1])
                at, parts = 0, []
                for s, e in gone:
                    parts.append(raw[at:s])
                    at = e
                parts.append(raw[at:])
                runs.append([{"start": s, "end": e} for s, e in gone])
                kept.append(b"".join(parts))
            yield pd.DataFrame(
                {"doc_id": b["doc_id"].astype("Int64"), "n_bytes": sizes, "spans": runs, "kept": kept}
            )

    return joined.mapInPandas(
        run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    )
