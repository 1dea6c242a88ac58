"""Filter interaction audit: what each filter removes, in every order in which they can be applied.

Five filters look at a text; which of them a document fails is a mask of five bits. All orders and
steps can be worked out from how many documents of a part have each mask, so the texts are read once
and what follows handles 32 cells a part:

1. masks: four conditions are expressions over the text. The fifth, a text that a smaller id has as
   well, needs all texts: rows are grouped by the text's digest, id and source, then by digest and
   source, so that a group of copies, however large, is combined before it meets in one place, and
   what meets there is one row per source and label. Copies have the other four bits in common.
2. folds: each cell is folded over the array of all orders, a literal, with `transform` over orders
   and `aggregate` over steps, into 600 structs weighted by the cell's counts.
3. merge: the arrays of a part, 32 at most, are added element by element and exploded once.

Nothing in step 2 or 3 grows with the documents, and no step holds more than a part's cells.

Texts are identical when their SHA-256 digests and lengths in bytes are. Labels are joined by id without
text; a document with several label rows is good (toxic) if any of them says so.

Results for odd input: a null text is empty and fails A (it has no words, so B and C do not apply: 0
is not below 0). A null source and an empty one are one part. Rows with a null id have no smaller and
no larger id: they pass E and make no other row fail it, and have no labels. Rows that repeat an id
are documents of their own; those with a text's smallest id all pass E. Only words of one text are
held at a time, whatever its length. Other columns of the input are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawstar.llm.base import WORD

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 2
SYMBOLS = r"[#$%&*|]"
FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def text_conditions(text: Column) -> list[Column]:
    """Failure of A, B, C and D; the text is not null."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.regexp_count(text, F.lit("[A-Z]"))
    return [
        n < MIN_WORDS,
        100 * distinct < DISTINCT_PERCENT * n,
        100 * upper > UPPER_PERCENT * F.length(text),
        text.rlike(SYMBOLS),
    ]


def _mask(conditions: list[Column]) -> Column:
    out = F.lit(0)
    for bit, fails in enumerate(conditions):
        out = out + F.when(fails, 1 << bit).otherwise(0)
    return out


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of a part by the filters that they fail."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    ).select(
        "doc_id",
        "part",
        F.concat_ws(":", F.sha2("text", 256), F.octet_length("text")).alias("digest"),
        _mask(text_conditions(F.col("text"))).alias("mask"),
    )
    marks = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
        )
    )
    kinds = ["part", "mask", "good", "toxic"]
    known = (
        rows.filter("doc_id IS NOT NULL")
        .groupBy("doc_id", "digest", "part", "mask")  # rows that repeat an id and its text
        .agg(F.count("*").alias("n"))
        .join(marks, "doc_id", "left")
        .fillna(0, ["good", "toxic"])
    )
    per_text = known.groupBy("digest", *kinds).agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),
    )
    smallest = F.min("first").over(Window.partitionBy("digest"))
    split = per_text.withColumn(
        "n_first", F.when(F.col("first") == smallest, F.col("n_first")).otherwise(0)
    )
    repeats = F.lit(1 << FILTERS.index("E"))
    cells = split.select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct("mask", F.col("n_first").alias("n")),
                F.struct(
                    (F.col("mask") + repeats).alias("mask"), (F.col("n") - F.col("n_first")).alias("n")
                ),
            )
        ).alias("cell"),
    ).select("part", "cell.mask", "cell.n", "good", "toxic")
    no_id = rows.filter("doc_id IS NULL").select(
        "part", "mask", F.lit(1).cast("long").alias("n"), F.lit(0).alias("good"), F.lit(0).alias("toxic")
    )
    return (
        cells.unionByName(no_id)
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("good")).alias("good"),
            F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
        )
        .filter("n > 0")
    )


def _steps(order: Column, mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """The five steps of one order for one cell: filters fold over the letters of the order."""
    zero = F.lit(0).cast("long")

    def step(acc: Column, at: Column) -> Column:
        letter = F.substring(order, at, F.lit(1))
        bit = F.pow(F.lit(2), F.instr(F.lit(FILTERS), letter) - 1).cast("int")
        alive, fails = acc["alive"], mask.bitwiseAND(bit) != 0
        lost, late, stays = alive & fails, ~alive & fails, alive & ~fails
        values = (
            F.when(stays, n),
            F.when(lost, n),
            F.when(late, n),
            F.when(mask == bit, n),
            F.when(lost, good),
            F.when(lost, toxic),
        )
        row = F.struct(
            order.alias("filter_order"),
            at.alias("step"),
            letter.alias("filter"),
            *[F.coalesce(v, zero).alias(f) for v, f in zip(values, FIELDS)],
        )
        return F.struct(
            stays.alias("alive"), F.concat(acc["rows"], F.array(row)).alias("rows")
        )

    ddl = "array<struct<filter_order:string,step:int,filter:string," + ",".join(
        f"{f}:bigint" for f in FIELDS
    )
    start = F.struct(F.lit(True).alias("alive"), F.from_json(F.lit("[]"), ddl + ">>").alias("rows"))
    places = F.array(*[F.lit(i) for i in range(1, len(FILTERS) + 1)])
    return F.aggregate(places, start, step, lambda acc: acc["rows"])


def _add(a: Column, b: Column) -> Column:
    return F.zip_with(
        a,
        b,
        lambda x, y: F.struct(
            *[x[c].alias(c) for c in ("filter_order", "step", "filter")],
            *[(x[f] + y[f]).alias(f) for f in FIELDS],
        ),
    )


def interactions(cells: DataFrame) -> DataFrame:
    """part, filter_order, step, filter, the counts and shapley, from (part, mask, n, good, toxic)."""
    orders = F.array(*[F.lit(o) for o in ORDERS])
    weights = [F.col(c) for c in ("mask", "n", "good", "toxic")]
    folded = cells.select(
        "part", F.flatten(F.transform(orders, lambda o: _steps(o, *weights))).alias("rows")
    )
    merged = folded.groupBy("part").agg(F.collect_list("rows").alias("all")).select(
        "part",
        F.reduce(F.slice("all", F.lit(2), F.size("all")), F.col("all")[0], _add).alias("rows"),
    )

    def removed_by(f: str) -> Column:
        mine = F.filter("rows", lambda r: r["filter"] == f)
        return F.reduce(mine, F.lit(0).cast("long"), lambda acc, r: acc + r["removed"])

    removed = [removed_by(f) for f in FILTERS]
    every = F.map_from_arrays(F.array(*[F.lit(f) for f in FILTERS]), F.array(*removed))
    return merged.withColumn("every", every).select(
        "part", "every", F.inline("rows")
    ).select(
        "part",
        "filter_order",
        "step",
        "filter",
        *FIELDS,
        F.col("every")[F.col("filter")].alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows a part: every step of every order, zeros included."""
    return interactions(masked(docs, labels))
