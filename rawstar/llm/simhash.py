"""SimHash near-duplicates by a self-join of the binary trie of the fingerprints.

A fingerprint bit is set where more than half of the hashes of a text's word shingles have it. The
distinct fingerprints form a binary trie, one level per bit from the highest. The join visits pairs
of nodes of one depth together, starting with the root and itself; a pair of children carries the
number of bits in which their paths differ, and is dropped once that exceeds the budget.

The upper part of the trie is traversed by Spark, `STRIDE` levels at a time: a step pairs each child
of one node with the children of the other that lie within what is left of the budget, by an
equi-join on the flipped prefix (37 flips for 8 levels and 2 bits, not all pairs). Only prefixes and
their counts take part. A pair of nodes that together hold at most `LEAF` fingerprints is not split
further: it becomes a row with the two nodes' fingerprints, and a task goes down the rest of the two
subtrees in numpy. A crowded subtree is thus split until it is small, whatever share of the rows it
holds, and at depth 64 a pair of nodes is a pair of fingerprints.

Each task reduces the links of a batch to a spanning forest, which keeps what is connected; the
components come from stars over the whole cluster (`graph.components`).

Results for odd input: a null text is empty; a text without words has fingerprint zero and links
like any other. Rows without an id share the components of their fingerprint. Rows with equal ids
are fingerprinted each. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.base import keep_keys, row_key, stage, text_rows
from rawstar.llm.graph import components

SHINGLE = 3
MAX_BITS = 2
STRIDE = 8
LEAF = 1 << 14
SEED = 42


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits, unsigned."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    hash_ = xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = [hash_(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
        hashes = [hash_(joined[a:b], SEED) for a, b in spans]
    h = np.array(hashes, dtype=">u8")
    set_ = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        set_ += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_ > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row (digest of the text), fp (the fingerprint's bits as a signed number)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["text"]], dtype=np.uint64)
            ids = b["doc_id"].astype("Int64")
            yield pd.DataFrame({"doc_id": ids, "row": b["row"], "fp": fp.view(np.int64)})

    rows = text_rows(docs).withColumn("row", F.xxhash64("text"))
    return rows.mapInPandas(run, "doc_id long, row long, fp long")


def _prefix(depth: int):
    return F.shiftrightunsigned(F.col("fp"), 64 - depth) if depth < 64 else F.col("fp")


def _flips(levels: int, bits: int) -> list[tuple[int, int]]:
    """(mask, number of bits) of all ways to differ in at most `bits` of `levels`."""
    return [
        (sum(1 << i for i in c), k) for k in range(bits + 1) for c in combinations(range(levels), k)
    ]


def _node_pairs(distinct: DataFrame, max_bits: int, leaf: int) -> list[tuple[int, DataFrame]]:
    """(depth, pairs): node pairs p <= q within the budget that are small enough for one task."""
    flips = F.array(
        *[F.struct(F.lit(m).cast("long").alias("m"), F.lit(k).alias("k")) for m, k in _flips(STRIDE, max_bits)]
    )
    out, depth = [], 0
    heavy = None  # p, q, err at `depth`; None stands for the root and itself
    while True:
        below = depth + STRIDE
        nodes = stage(distinct.groupBy(_prefix(below).alias("node")).agg(F.count("*").alias("n")), "trie")
        child = nodes.select(
            F.col("node").alias("p"),
            F.col("n").alias("np"),
            F.shiftrightunsigned("node", STRIDE).alias("up"),
            F.col("node").bitwiseAND((1 << STRIDE) - 1).alias("low"),
        )
        if heavy is None:
            pairs = child.withColumn("over", F.lit(0).cast("long")).withColumn("err", F.lit(0))
        else:
            pairs = child.join(
                heavy.select(F.col("p").alias("up"), F.col("q").alias("over"), "err"), "up"
            )
        pairs = (
            pairs.withColumn("f", F.explode(flips))
            .withColumn("err", F.col("err") + F.col("f.k"))
            .filter(F.col("err") <= max_bits)
            .withColumn("q", F.shiftleft("over", STRIDE).bitwiseOR(F.col("low").bitwiseXOR(F.col("f.m"))))
            .filter(F.expr("p <= q or up <> over"))
            .join(nodes.select(F.col("node").alias("q"), F.col("n").alias("nq")), "q")
            .select("p", "q", "np", "nq", "err")
        )
        pairs = stage(pairs, f"trie-pairs-{below}")
        fits = (F.col("np") + F.col("nq") <= leaf) | F.lit(below >= 64)
        out.append((below, pairs.filter(fits).select("p", "q", "err")))
        heavy, depth = pairs.filter(~fits).select("p", "q", "err"), below
        if depth >= 64 or heavy.isEmpty():
            return out


def trie_links(a: np.ndarray, b: np.ndarray, same: bool, depth: int, err: int, bits: int):
    """Index pairs of `a` and `b` (sorted, unsigned) within `bits` differing bits in all.

    `a` and `b` are the fingerprints below one node pair at `depth` whose paths differ in `err`
    bits. Pairs of subtrees are ranges of the two arrays. A level splits all of them at once; pairs
    of ranges whose product is small are compared outright.
    """
    full = [np.array([x]) for x in (0, len(a), 0, len(b), err)]
    found_a, found_b = [], []
    while len(full[0]) and len(a) and len(b):
        a0, a1, b0, b1, e = full
        small = ((a1 - a0) * (b1 - b0) <= 64) | (depth >= 64)
        if small.any():
            s0, s1, t0, t1 = a0[small], a1[small], b0[small], b1[small]
            size = (s1 - s0) * (t1 - t0)
            for at in range(0, len(size), 1 << 15):
                part = slice(at, at + (1 << 15))
                m = size[part]
                k = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                wide = np.repeat((t1 - t0)[part], m)
                i, j = np.repeat(s0[part], m) + k // wide, np.repeat(t0[part], m) + k % wide
                ok = np.bitwise_count(a[i] ^ b[j]) <= bits
                if same:
                    ok &= i < j
                found_a.append(i[ok])
                found_b.append(j[ok])
        big = ~small
        a0, a1, b0, b1, e = (x[big] for x in full)
        if not len(a0):
            break
        # where the next bit turns to 1 inside each range
        bit = np.uint64(63 - depth)
        ones_a = np.concatenate(([0], np.cumsum((a >> bit) & np.uint64(1)))).astype(np.int64)
        ones_b = np.concatenate(([0], np.cumsum((b >> bit) & np.uint64(1)))).astype(np.int64)
        am, bm = a1 - (ones_a[a1] - ones_a[a0]), b1 - (ones_b[b1] - ones_b[b0])
        kids = [(a0, am, b0, bm, e), (am, a1, bm, b1, e), (a0, am, bm, b1, e + 1), (am, a1, b0, bm, e + 1)]
        full = [np.concatenate(x) for x in zip(*kids)]
        keep = (full[0] < full[1]) & (full[2] < full[3]) & (full[4] <= bits)
        if same:  # the mirror image of a pair of subtrees
            keep &= full[0] <= full[2]
        full = [x[keep] for x in full]
        depth += 1
    none = np.zeros(0, np.int64)
    return np.concatenate(found_a or [none]), np.concatenate(found_b or [none])


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links with the same components: every node to the least of its component."""
    nodes, where = np.unique(np.concatenate((u, v)), return_inverse=True)
    x, y = where[: len(u)], where[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _leaf_links(depth: int, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            us, vs = [], []
            for p, q, err, fa, fb in batch[["p", "q", "err", "fa", "fb"]].itertuples(index=False):
                a = np.sort(np.asarray(fa, np.int64).view(np.uint64))
                same = p == q
                b = a if same else np.sort(np.asarray(fb, np.int64).view(np.uint64))
                i, j = trie_links(a, b, same, depth, err, bits)
                if len(i):
                    u, v = forest(a[i].view(np.int64), b[j].view(np.int64))
                    us.append(u)
                    vs.append(v)
            none = np.zeros(0, np.int64)
            u, v = forest(np.concatenate(us or [none]), np.concatenate(vs or [none]))
            yield pd.DataFrame({"u": u, "v": v})

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """`fps` has distinct fp; returns links u, v that connect all within `max_bits`."""
    out = None
    for depth, pairs in _node_pairs(fps, max_bits, leaf):
        # `leaf` fingerprints per node at most, at depth 64 one
        sides = pairs.select(F.col("p").alias("node")).union(pairs.select("q")).distinct()
        blobs = (
            fps.withColumn("node", _prefix(depth))
            .join(sides, "node", "left_semi")
            .groupBy("node")
            .agg(F.collect_list("fp").alias("fps"))
        )
        rows = pairs.join(blobs.select(F.col("node").alias("p"), F.col("fps").alias("fa")), "p").join(
            blobs.select(F.col("node").alias("q"), F.col("fps").alias("fb")), "q"
        )
        found = rows.mapInPandas(_leaf_links(depth, max_bits), "u long, v long")
        out = found if out is None else out.unionByName(found)
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, row, fp, root (a fingerprint that names the component), component_id (least doc_id
    that can be reached): one row per document."""
    prints = stage(fingerprints(docs, shingle), "simhash")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), max_bits))
    placed = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    placed = stage(placed, "simhash-roots")
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = placed.join(names, "root").select("fp", "root", "component_id")
    return prints.join(by_fp, "fp").select("doc_id", "row", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The document with the least id of each component, with all its columns."""
    found = near_duplicates(docs, shingle, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("one")
    kept = found.groupBy("root").agg(first)
    kept = kept.select(row_key(F.col("one.doc_id"), F.col("one.row")).alias("_key"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return keep_keys(docs, row_key(F.col("doc_id").cast("long"), F.xxhash64(text)), kept)
