"""SpotSigs fingerprints: chains of content words behind common words, compared as sets.

Wherever a common word stands, the common word and the next `CHAIN` words that are not common form a
spot. In a stretch without common words (`GAP` words or more) words whose digest is divisible by 4
take their place, so lists and symbols have spots too. The spots' 32-bit digests form the signature;
the fingerprint writes them in order, eight hex digits each. A text without any spot has the digest
of its words alone.

Two signatures are compared by Jaccard similarity. Below the threshold of a comparison it is pruned:
sets of lengths whose ratio is under the threshold cannot reach it, and the merge of two ordered
sets stops as soon as what is left cannot make up for what was missed. `length_class` cuts lengths
so that sets that can reach the threshold lie in the same class or in neighbouring ones.

`near_duplicates` links all documents whose signatures reach a threshold. Equal signatures are one
node. Spots are ordered from rare to frequent, by counts in 2^16 bins (a fixed size, whatever the
input; any order that all sets share is exact). Sets that reach the threshold share a spot among the
first n - ceil(threshold * n) + 1 of each, so these spots alone, with the length class and the one
above it, are the keys under which sets meet. What is shuffled there is ids, lengths and places, no
sets. A pair goes on only if its lengths and the places of its shared spot leave room for the
threshold; the first spot that two sets share is among those that say so. What is left meets both
signatures, and the pruned Jaccard decides. No pair is sampled or capped; a spot that many sets have is rare in
no set that has others, and a key that many sets share is one that adaptive execution may split.

`next_likeness` compares each document with its successor in descending id and with an edit that
puts the successor's start in place of its own second half. Documents are dealt by ranges of ids, and
the first document of each range also goes to the range before it: one shuffle of the texts, no task
with more than its range and one row.

Results for odd input: a null text is empty, and empty texts have the likeness 1. Rows without an id
come last; rows with equal ids follow each other by text. A single document is its own successor. An
empty table gives an empty result. In `near_duplicates` rows are told apart by id and text: rows with
equal ids keep theirs, rows without an id have the class of the others like them, and a class without
any id has none. All texts without words are alike.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.base import stage, text_rows
from rawstar.llm.graph import components

CHAIN = 2
GAP = 8
#: Bins in which spots are counted to order them by rarity.
BINS = 1 << 16

# Frequent function words of four languages.
COMMON = frozenset(
    "the a an of to and in is it that was for on with as at by from be this which or are had were "
    "not have has but they his her you all "
    "der die das und den von zu mit ein eine einer auf für ist im dem nicht sich des als auch es an "
    "le la les de des du un une et en que qui dans pour est pas par sur au aux avec elle il plus ce "
    "el los las y del se por con una su al lo como más pero sus o".split()
)


def signature(text: str, chain: int = CHAIN) -> np.ndarray:
    """Distinct spot digests in ascending order."""
    words = [w.strip(".,;:!?") for w in text.lower().split()]
    common = COMMON
    content = [i for i, w in enumerate(words) if w not in common]
    spots = set()
    last, k, m = -1, 0, len(content)  # the last common word, the next content word
    for i, w in enumerate(words):
        if w in common:
            last = i
        else:
            k += 1
            if i - last <= GAP or crc32(w.encode("utf-8", "surrogatepass")) % 4:
                continue
        if k < m:
            ahead = [words[j] for j in content[k : k + chain]]
            spots.add(crc32(" ".join([w, *ahead]).encode("utf-8", "surrogatepass")))
    if not spots:
        spots.add(crc32(" ".join(words).encode("utf-8", "surrogatepass")))
    return np.array(sorted(spots), np.uint32)


def length_class(n: int, threshold: float) -> int:
    """Sets that reach `threshold` have classes that differ by one at most."""
    return int(math.log(max(n, 1)) / -math.log(threshold)) if 0 < threshold < 1 else n


def jaccard(a: np.ndarray, b: np.ndarray, threshold: float = 0.0) -> float:
    """Similarity of two ordered sets, or 0 where it is below the threshold."""
    if min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return 0.0
    need = threshold / (1 + threshold) * (len(a) + len(b))
    shared, step = 0, max(64, len(a) // 4)
    for at in range(0, len(a), step):  # piece by piece, so that it can stop early
        if shared + min(len(a) - at, len(b)) < need:
            return 0.0
        piece = a[at : at + step]
        lo, hi = np.searchsorted(b, piece[0]), np.searchsorted(b, piece[-1], "right")
        shared += len(np.intersect1d(piece, b[lo:hi], assume_unique=True))
    likeness = shared / (len(a) + len(b) - shared) if len(a) + len(b) else 1.0
    return likeness if likeness >= threshold else 0.0


def fingerprint(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, n_spots for every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sigs = [signature(t) for t in b["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"].astype("Int64"),
                    "fingerprint": [fingerprint(s) for s in sigs],
                    "n_spots": [len(s) for s in sigs],
                }
            )

    return text_rows(docs).mapInPandas(run, "doc_id long, fingerprint string, n_spots int")


def edited(text: str, follower: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


def _ranges(rows: DataFrame, parts: int) -> DataFrame:
    """Rows with `part` (ranges of ids, descending) and `guest`: the first document of the next
    range, which is only a successor here."""
    ids = rows.select("doc_id")
    shares = [i / parts for i in range(1, parts)]
    known = ids.filter("doc_id is not null")
    cuts = known.approxQuantile("doc_id", shares, 0.1 / parts) if shares else []
    cuts = sorted({int(c) for c in cuts}, reverse=True)  # `parts` numbers at most
    above = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<long>")
    part = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(
        F.size(F.filter(above, lambda c: c > F.col("doc_id")))
    )
    first = (
        ids.withColumn("part", part)
        .groupBy("part")
        .agg(F.max("doc_id").alias("first"))
        .orderBy("part")
        .collect()  # one row per range
    )
    spark = rows.sparkSession
    ring = [(first[(i + 1) % len(first)]["first"], r["part"]) for i, r in enumerate(first)]
    guests = spark.createDataFrame(ring, "_first long, _host int")
    own = rows.withColumn("part", part).withColumn("guest", F.lit(False))
    # as many rows as there are ranges
    visiting = (
        rows.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("_first")))
        .withColumn("part", F.col("_host"))
        .withColumn("guest", F.lit(True))
        .select(own.columns)
    )
    return own.unionByName(visiting)


def next_likeness(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited, near_next."""
    rows = text_rows(docs)
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ddl = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, n_spots int"
    )
    names = [c.split()[0] for c in ddl.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # (part, id, text, signature) of the row that waits for its successor
        for b in batches:
            out = []
            for part, guest, doc_id, text in zip(
                b["part"], b["guest"], b["doc_id"].astype("Int64"), b["text"]
            ):
                sig = None
                if held is not None and held[0] == part:
                    sig = signature(text)
                    changed = edited(held[2], text)
                    changed_sig = signature(changed)
                    out.append(
                        (
                            held[1],
                            len(held[2]),
                            hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                            fingerprint(held[3]),
                            fingerprint(changed_sig),
                            jaccard(held[3], changed_sig),
                            jaccard(held[3], sig),
                            len(held[3]),
                        )
                    )
                if guest:  # the first guest ends its range
                    held = None
                else:
                    held = (part, doc_id, text, signature(text) if sig is None else sig)
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    dealt = _ranges(rows, parts).repartition(parts, "part")
    ordered = dealt.sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), "text")
    return ordered.select("part", "guest", "doc_id", "text").mapInPandas(run, ddl)


# --- near-duplicates among all documents --------------------------------------------------------


def from_fingerprint(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def _bin_counts(nodes: DataFrame) -> np.ndarray:
    """Spots in each bin over all nodes: BINS numbers, summed per task before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(BINS, np.int64)
        for b in batches:
            for text in b["fingerprint"]:
                counts += np.bincount(from_fingerprint(text) % BINS, minlength=BINS)
        some = np.flatnonzero(counts)
        yield pd.DataFrame({"bin": some, "n": counts[some]})

    sums = nodes.select("fingerprint").mapInPandas(run, "bin long, n long")
    counts = np.zeros(BINS, np.int64)
    for r in sums.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # BINS rows at most
        counts[r["bin"]] = r["n"]
    return counts


def prefix(sig: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """The rarest spots of a set, of which it shares one with every set that reaches the threshold."""
    n = len(sig)
    order = np.lexsort((sig, counts[sig % BINS]))
    return sig[order[: n - math.ceil(threshold * n - 1e-9) + 1]]


def _keys(nodes: DataFrame, counts: np.ndarray, threshold: float) -> DataFrame:
    """node, n, length class, and each spot of the prefix with its place."""
    shared = nodes.sparkSession.sparkContext.broadcast(counts)  # BINS numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sigs = [from_fingerprint(text) for text in b["fingerprint"]]
            first = [prefix(sig, shared.value, threshold) for sig in sigs]
            times = [len(f) for f in first]
            yield pd.DataFrame(
                {
                    "node": np.repeat(b["node"].to_numpy(), times),
                    "n": np.repeat([len(sig) for sig in sigs], times),
                    "class": np.repeat([length_class(len(sig), threshold) for sig in sigs], times),
                    "spot": np.concatenate([*first, np.zeros(0, np.uint32)]).astype(np.int64),
                    "place": np.concatenate([np.arange(t) for t in [*times, 0]]),
                }
            )

    ddl = "node long, n int, class int, spot long, place int"
    return nodes.select("node", "fingerprint").mapInPandas(run, ddl)


def near_links(nodes: DataFrame, threshold: float) -> DataFrame:
    """u < v of `nodes` (node long, fingerprint) that reach the threshold, with their likeness."""
    keys = stage(_keys(nodes, _bin_counts(nodes), threshold), "spot-keys")
    a = keys.select(*[F.col(c).alias(f"a_{c}") for c in keys.columns])
    # a set meets those of its own length class and of the one above
    own = F.explode(F.array(F.col("class"), F.col("class") - 1)).alias("meets")
    b = keys.select(*[F.col(c).alias(f"b_{c}") for c in keys.columns if c != "class"], "class")
    b = b.select("*", own).withColumnRenamed("class", "b_class")
    need = F.lit(threshold / (1 + threshold)) * (F.col("a_n") + F.col("b_n")) - 1e-9
    room = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    once = (F.col("a_class") < F.col("b_class")) | (F.col("a_node") < F.col("b_node"))
    met = a.join(
        b,
        (F.col("a_spot") == F.col("b_spot")) & (F.col("a_class") == F.col("meets"))
        & (F.col("a_node") != F.col("b_node")) & once
        & (F.least("a_n", "b_n") >= F.lit(threshold) * F.greatest("a_n", "b_n") - 1e-9)
        & (room >= need),
    )
    pairs = met.select(
        F.least("a_node", "b_node").alias("u"), F.greatest("a_node", "b_node").alias("v")
    ).distinct()
    sigs = nodes.select(F.col("node"), "fingerprint")
    sides = pairs.join(sigs.select(F.col("node").alias("u"), F.col("fingerprint").alias("a")), "u")
    sides = sides.join(sigs.select(F.col("node").alias("v"), F.col("fingerprint").alias("b")), "v")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            near = [
                jaccard(from_fingerprint(p), from_fingerprint(q), threshold)
                for p, q in zip(x["a"], x["b"])
            ]
            out = pd.DataFrame({"u": x["u"], "v": x["v"], "likeness": near})
            yield out[out["likeness"] > 0]

    return sides.select("u", "v", "a", "b").mapInPandas(run, "u long, v long, likeness double")


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, class_id (least id of those it reaches), n_links: other signatures it is near to."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie above 0 and not above 1")
    rows = stage(signatures(docs), "spot-signatures")
    found = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    # numbers, as several signatures may have the same least id, or none
    nodes = stage(found.withColumn("node", F.monotonically_increasing_id()), "spot-nodes")
    links = stage(near_links(nodes, threshold), "spot-links")
    both = links.select(F.col("u").alias("node")).unionByName(links.select(F.col("v").alias("node")))
    degree = both.groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    rooted = nodes.join(
        components(links.select("u", "v")).withColumnRenamed("u", "node"), "node", "left"
    ).select("node", "fingerprint", "least", F.coalesce("root", "node").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("class_id"))
    named = rooted.join(names, "root").join(degree, "node", "left")
    named = named.select("fingerprint", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.join(named, "fingerprint").select("doc_id", "class_id", "n_links")
