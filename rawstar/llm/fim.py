"""Fill-in-middle: two cuts of a text at unit boundaries, and its parts in another order.

A text is a run of units: `[A-Za-z]+` or any other single code point. The code points at which a unit
ends, and 0, are the text's boundaries, kept as a `BoundarySet`: containers of 65,536 code points,
each an array of offsets, a bitmap, or a list of runs, whichever is smallest, with the cumulative
cardinalities of the containers. The k-th boundary is found by a search in those and a select inside
one container. Both cuts are such selects.

Which units the cuts fall on, and which form a text takes, comes from the id's digest, so reruns and
lost tasks agree. Cutting is one pass over a row; there is no shuffle. Only the two offsets and the
number of units leave Python: the output is put together, and taken apart again, by Spark.

A set holds two bytes for each boundary at most, an eighth of a byte for each code point of a dense
text, or four bytes a run.

Results for odd input: a null text is empty; an empty text is plain, with no cuts. A null id counts
as an empty string in the digest. Rows with equal ids get the same draws; each is cut on its own. A
text that holds one of the marks is plain. Texts of any length are cut whole. Other columns of the
input, whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.llm.base import text_rows

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts, how many are cut, and how many of those get the suffix first.
CUT_RATE, SPM_RATE = 90, 20

SPAN = 1 << 16
ARRAY_MAX = 4096

_LETTER = np.zeros(128, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


class ArrayContainer:
    """Sorted 16-bit offsets."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit per offset; `before` counts the bits ahead of each 64-bit word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, dtype=bool)
        bits[low] = True
        self.bytes = np.packbits(bits, bitorder="little")
        per_word = bits.reshape(-1, 64).sum(axis=1)
        self.before = (np.cumsum(per_word) - per_word).astype(np.uint32)

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        set_bits = np.flatnonzero(np.unpackbits(self.bytes[8 * word : 8 * word + 8], bitorder="little"))
        return 64 * word + int(set_bits[k - int(self.before[word])])


class RunContainer:
    """Starts of runs of consecutive offsets; `before` counts the offsets ahead of each run."""

    def __init__(self, starts: np.ndarray, before: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.before = before.astype(np.uint32)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for sorted distinct offsets below SPAN."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    as_runs, as_array = 4 * len(first), 2 * len(low)
    if as_runs < min(as_array, SPAN // 8):
        return RunContainer(low[first], first)
    return ArrayContainer(low) if len(low) <= ARRAY_MAX else BitmapContainer(low)


class BoundarySet:
    """A sorted set of integers that answers select(k), the k-th smallest, k from 0."""

    def __init__(self, members: np.ndarray):
        high = members // SPAN
        keys, first = np.unique(high, return_index=True)
        self.keys = keys
        self.before = np.append(first, len(members))
        self.parts = [
            container(members[a:b] - key * SPAN)
            for key, a, b in zip(keys, self.before[:-1], self.before[1:])
        ]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.keys[at]) * SPAN + self.parts[at].select(k - int(self.before[at]))


def boundaries(text: str) -> np.ndarray:
    """Code points at which a unit ends, and 0, ascending."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _LETTER[np.minimum(points, 127)] & (points < 128)
    inside = np.zeros(len(points) + 1, dtype=bool)
    inside[1:-1] = letter[1:] & letter[:-1]
    return np.flatnonzero(~inside)


def cuts(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """Number of units, and the code points at which the prefix and the middle end."""
    found = BoundarySet(boundaries(text))
    n = len(found) - 1
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, found.select(a), found.select(b)


def _cut(text: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
    rows = [cuts(t, int(a), int(b)) for t, a, b in zip(text, h1, h2)]
    return pd.DataFrame(rows, columns=["n", "prefix_end", "middle_end"], dtype="int64")


def _draw(group: int) -> Column:
    """The group-th 8-digit group of the hex digest of the id, as an unsigned integer."""
    return F.conv(F.substring("digest", 8 * group - 7, 8), 16, 10).cast("long")


def transform(docs: DataFrame, cut_rate: int = CUT_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: one row per document.

    `form` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle).
    """
    text, form = F.col("text"), F.col("form")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (_draw(3) % 100 >= cut_rate)
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    cut_at = F.pandas_udf(_cut, "n long, prefix_end long, middle_end long")
    cut = (
        text_rows(docs)
        .withColumn("digest", digest)
        .withColumn("cut", cut_at("text", _draw(1), _draw(2)))
        .withColumn(
            "form", F.when(plain, "plain").when(_draw(4) % 100 < spm_rate, "spm").otherwise("psm")
        )
    )
    end, middle_end = F.col("cut.prefix_end").cast("int"), F.col("cut.middle_end").cast("int")
    prefix = F.substring(text, F.lit(1), end)
    middle = F.substring(text, end + 1, middle_end - end)
    suffix = F.substring(text, middle_end + 1, F.length(text) - middle_end)
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    output = (
        F.when(form == "plain", text)
        .when(form == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
    )
    return cut.select(
        "doc_id",
        F.col("cut.n").alias("n"),
        "form",
        F.when(form != "plain", F.col("cut.prefix_end")).alias("prefix_chars"),
        F.when(form != "plain", F.col("cut.middle_end") - F.col("cut.prefix_end")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of. Marks stand once in it, as no cut text has any."""
    out, kind = F.col(output), F.col(form)
    middle = F.substring_index(out, MIDDLE, -1)
    head = F.substring_index(out, MIDDLE, 1)
    psm = F.concat(
        F.substr(F.substring_index(head, SUFFIX, 1), F.lit(len(PREFIX) + 1)),
        middle,
        F.substring_index(head, SUFFIX, -1),
    )
    spm = F.concat(
        F.substring_index(head, PREFIX, -1),
        middle,
        F.substr(F.substring_index(head, PREFIX, 1), F.lit(len(SUFFIX) + 1)),
    )
    return F.when(kind == "plain", out).when(kind == "psm", psm).otherwise(spm)
