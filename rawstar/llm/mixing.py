"""Mixing sources to target weights by pivotal dependent rounding.

Sources in code point order (null last) weigh 1, 2, 3, repeating. They share all words; a target
stops at `max_copies` times its source's words and the excess goes to the others by weight. Each
document should be copied target / source words times. The whole part of that is given to all; the
fractional part is rounded by the pivotal method in words: two documents with fractional copies are
paired and words move from one to the other, in a direction drawn so that no expectation changes,
until one of them is integral. The sum of words stays as it was, so a source ends within one
document of its target. The second of a pair may stand for a pool of documents, which then all change
by the same fraction: a block goes from its longest document to its shortest and pairs each with the
pool of those behind it while that can take the words, so the document left over is a short one. A
document's copies are the whole number below or above its share; short ones may get one less or more
where they make up for a long one, never under 0 or over `max_copies`.

The pairing runs as a reduction tree: documents of a source are dealt to blocks of about `block`
rows, each block leaves one fractional document at most, those are dealt to blocks again, and so on
until every source has one left, which is rounded by a draw. No task holds more than a block, also
where one source has most rows. Draws depend on `seed`, source and document ids alone, so reruns
agree.

Results for odd input: null and empty texts have size 0 and are taken 0 times in words (their copy
number follows the same rounding). A null source is a source of its own, the last. Rows with equal
ids are rounded on their own and take the same place in the order, told apart by their texts'
digests. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rawstar.llm.base import WORD, free_names, row_key, stage

BLOCK = 20_000
MAX_COPIES = 3
SEED = 20_240_611
WEIGHTS = (1, 2, 3)
EPS = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, source_docs, target: one row per source.

    A source is at its stop when the water level that the others need, in words per unit of weight,
    is above its stop. With the sources in order of stop / weight, that is a running sum.
    """
    per = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_docs")
    )
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), nth + 1))
    per = per.withColumn("stop", F.col("source_size") * F.lit(float(max_copies)))
    # from the lowest stop per weight on: what is left for this source and all after it
    rise = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rise.rowsBetween(Window.unboundedPreceding, -1)
    after = rise.rowsBetween(0, Window.unboundedFollowing)
    everything = F.sum("source_size").over(Window.partitionBy())
    level = (everything - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(after)
    per = per.withColumn("level", level)
    open_ = F.col("level") * F.col("weight") < F.col("stop")
    # once one source is below its stop all later ones are, at the same level
    first = F.max(F.when(open_, F.col("level"))).over(Window.partitionBy())
    target = F.least(F.col("stop"), F.coalesce(first, F.lit(math.inf)) * F.col("weight"))
    return per.select("source", "source_size", "source_docs", target.cast("double").alias("target"))


def _pivot_pool(p: np.ndarray, size: np.ndarray, rng, least: float, most: float) -> int:
    """Pairs documents, in order, with the pool of all that follow, as long as the pool can take it.

    Words go from the document to the pool or back until the document is integral; all in the pool
    gain or lose the same fraction, and stay between `least` and `most`. Returns how many documents
    are done; sum of p * size is kept.
    """
    n = len(p)
    after = np.append(np.cumsum(size[::-1])[::-1][1:], 0.0)  # words of the pool
    low = np.append(np.minimum.accumulate(p[::-1])[::-1][1:], 0.0)
    high = np.append(np.maximum.accumulate(p[::-1])[::-1][1:], 0.0)
    draws, moved = rng.random(n), 0.0
    for i in range(n - 1):
        now = p[i] + moved
        base = math.floor(now + EPS)
        part = now - base
        if part > EPS:
            up, down = size[i] * (1 - part) / after[i], size[i] * part / after[i]
            if low[i] + moved - up < least or high[i] + moved + down > most:
                p[i:] += moved
                return i
            taken = draws[i] < part
            p[i], moved = (base + 1, moved - up) if taken else (base, moved + down)
        else:
            p[i] = base
    p[n - 1 :] += moved
    return n - 1


def _pivot_block(p: np.ndarray, size: np.ndarray, rng, least: float = 0, most: float = 1) -> None:
    """Rounds `p` in place until one fraction at most is left; sum of p * size is kept."""
    first = _pivot_pool(p, size, rng, least, most)
    whole = np.floor(p + EPS)
    p -= whole
    at = -1  # the document that is still fractional
    for i in range(first, len(p)):
        if p[i] <= EPS or p[i] >= 1 - EPS:
            p[i] = round(p[i])
            continue
        if at < 0:
            at = i
            continue
        a, b = size[at], size[i]
        wa, wb = a * p[at], b * p[i]
        # words that can go from b to a, and from a to b
        up, down = min(a - wa, wb), min(wa, b - wb)
        if rng.random() < down / (up + down):
            wa, wb = wa + up, wb - up
        else:
            wa, wb = wa - down, wb + down
        p[at], p[i] = wa / a, wb / b
        rest = [k for k in (at, i) if EPS < p[k] < 1 - EPS]
        for k in (at, i):
            if k not in rest:
                p[k] = round(p[k])
        at = rest[0] if rest else -1
    p += whole


def _round_level(seed: int, level: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # Long documents come first: the pool of all shorter ones takes up what rounding them leaves,
        # so that what stays fractional to the end is short.
        rows = rows.sort_values(["size", "mark", "doc_id", "row"], ascending=[False, True, True, True])
        draw = np.random.default_rng([seed, level, int(rows["mark"].iloc[0]) & (2**63 - 1)])
        p, size = rows["p"].to_numpy(copy=True), rows["size"].to_numpy(dtype=float)
        _pivot_block(p, size, draw, rows["least"].iloc[0], rows["most"].iloc[0])
        return rows.drop(columns=["blocks", "b"]).assign(p=p)

    return run


def pivotal_round(rows: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """`rows` has source, doc_id, row, size > 0, p, least and most; returns it with p integral.

    `row` tells rows of one id apart. p ends between `least` and `most`, which a source has in common:
    0 or 1, or the next number where short documents make up for a long one.
    """
    ddl = rows.select("source", "doc_id", "row", "size", "p", "least", "most", "mark").schema
    done, level = [], 0
    while True:
        counts = rows.groupBy("source").agg(F.count("*").alias("n"))
        blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
        dealt = rows.join(
            counts.withColumn("blocks", blocks).select(F.col("source").alias("_s"), "blocks"),
            F.col("source").eqNullSafe(F.col("_s")),
        ).drop("_s")
        mark = F.xxhash64(F.lit(seed), F.lit(level), "source", "doc_id", "row")
        dealt = dealt.withColumn("mark", mark).withColumn("b", F.pmod("mark", "blocks"))
        out = stage(
            dealt.groupBy("source", "b").applyInPandas(_round_level(seed, level), ddl),
            f"mix-level{level}",
        )
        done.append(out.filter("p = floor(p)"))
        left = out.filter("p <> floor(p)")
        if left.groupBy("source").count().filter("count > 1").isEmpty():
            draw = F.pmod(F.xxhash64(F.lit(seed + 1), "source", "doc_id", "row"), F.lit(1 << 30))
            part = F.col("p") - F.floor("p")
            last = F.floor("p") + F.when(draw / F.lit(float(1 << 30)) < part, 1.0).otherwise(0.0)
            done.append(left.withColumn("p", last))
            break
        rows, level = left, level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("mark", "least", "most")


def word_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words), row (digest that tells rows with one id apart)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text).alias("row"),
    )


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    max_copies: int = MAX_COPIES,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, row, source, size, source_size, target, copies: one row per document."""
    sizes = stage(word_sizes(docs), "mix-sizes")
    targets = source_targets(sizes, weights, max_copies)
    want = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # an exact whole number may come out a rounding error below it
    whole = F.floor(want + F.lit(EPS))
    rows = (
        sizes.join(
            targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
        )
        .drop("_s", "source_docs")
        .withColumn("whole", whole.cast("long"))
        .withColumn("p", F.greatest(want - whole, F.lit(0.0)))
    )
    part = F.col("p") > EPS
    split = rows.filter(part & (F.col("size") > 0))
    same = rows.filter(~(part & (F.col("size") > 0)))
    marked = split.select(
        "source",
        "doc_id",
        "row",
        "size",
        "p",
        F.greatest(-F.col("whole"), F.lit(-1)).cast("double").alias("least"),
        F.least(F.lit(max_copies) - F.col("whole"), F.lit(2)).cast("double").alias("most"),
        F.lit(0).cast("long").alias("mark"),
    )
    rounded = pivotal_round(marked, block, seed)
    scale = rows.select("source", "source_size", "target", "whole").distinct()
    got = rounded.join(
        scale.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
    ).drop("_s")
    cols = ["doc_id", "row", "source", "size", "source_size", "target"]
    return got.select(*cols, (F.col("whole") + F.col("p")).cast("long").alias("copies")).unionByName(
        same.select(*cols, F.col("whole").alias("copies"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    Rows that repeat id and text are taken as often as all of them together. Documents without
    words have nothing to take and stay as they are, once.
    """
    found = mix(docs, **options)
    times = F.when(F.max("size") == 0, F.lit(1)).otherwise(F.sum("copies")).cast("int")
    key, n, each = free_names(docs, 3)
    copies = found.groupBy(row_key(F.col("doc_id"), F.col("row")).alias(key)).agg(times.alias(n))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = row_key(F.col("doc_id").cast("long"), F.xxhash64(text))
    joined = docs.withColumn(key, own).join(copies.filter(F.col(n) > 0), key)
    repeated = joined.dropDuplicates([key]).withColumn(
        each, F.explode(F.array_repeat(F.lit(1), F.col(n)))
    )
    return repeated.select([F.col(f"`{c}`") for c in docs.columns])
