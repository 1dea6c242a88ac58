"""Chat formatting in windows of a token budget.

Turns are marked by a template and texts are escaped, so that a formatted window can be read back
without loss. A conversation that exceeds the budget becomes several windows. Prefix sums of the
turns' tokens choose them: a window takes as many whole turns as fit beside the system turn, which
every window repeats, and the turns before it that fit into `history` tokens, which are repeated
too. Each turn is new in exactly one window; only new assistant texts are under the loss mask.
A single turn above the budget gets a window of its own, uncut.

A conversation may hold most rows. Rows are dealt by ranges of (conversation, turn), summed inside
each range, and the ranges' totals give the offsets; then each conversation is cut into segments of
`segment` tokens, with the turns before the cut that may serve as history, and the segments are
formatted independently.

Escaping: control strings are `<s>`, `</s>` and the bracketed marks. Where a text has one, or one
that already carries backslashes behind its first sign, one backslash is added; reading back takes
one off.

Results for odd input: a null text or role is empty. Turns are ordered by turn, then role, then
text; null turns first. Rows that repeat are turns of their own. Rows without a conversation id form
one conversation. Only the first system turn is repeated. A conversation of one turn is one window.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rawstar.llm import bpe
from rawstar.llm.base import stage

BUDGET = 1024
HISTORY = 256
SEGMENT = 64 * BUDGET
#: Tokens that the marks of a turn count for.
MARKS = 4

_OPEN = {"system": "[SYS]", "user": "[INST]", "assistant": "[ANS]"}
_CLOSE = {"system": "[/SYS]", "user": "[/INST]", "assistant": "</s>"}
_CONTROL = r"(?:/?s>|/?SYS\]|/?INST\]|ANS\]|/?ROLE[ \]])"
_ESCAPE = re.compile(rf"([<\[])(\\*{_CONTROL})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*{_CONTROL})")
_TURN = re.compile(
    r"\[(SYS|INST|ANS)\](.*?)(?:\[/SYS\]|\[/INST\]|</s>)|\[ROLE ([^\]]*)\](.*?)\[/ROLE\]", re.S
)
_ROLE = {"SYS": "system", "INST": "user", "ANS": "assistant"}


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The marked turn, and where its text starts and ends."""
    head = _OPEN.get(role) or f"[ROLE {quote(role, safe='')}]"
    body = escape(text)
    return head + body + _CLOSE.get(role, "[/ROLE]"), len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """role, text, start and end of the escaped text, for each turn of a formatted window."""
    out = []
    for m in _TURN.finditer(formatted):
        g = 2 if m[1] else 4
        role = _ROLE[m[1]] if m[1] else unquote(m[3])
        out.append((role, unescape(m[g]), m.start(g), m.end(g)))
    return out


WINDOW_DDL = (
    "conv_id long, window long, first_turn long, text string, repeated int, "
    "loss array<struct<start:int,end:int>>, tokens long, over_budget boolean"
)


_ROW = ("conv_id", "segment", "role", "text", "tokens", "place", "before", "new")
_ROW += ("sys_text", "sys_place", "sys_tokens")


def _windows(budget: int, history: int):
    """Cuts segments, whose rows come one after the other; one segment is held at a time."""
    names = [c.split()[0] for c in WINDOW_DDL.replace("start:int,end:int", "").split(", ")]

    def cut(rows: list[tuple]) -> list[tuple]:
        """The windows of one segment; rows before its start are history only."""
        conv, _, role, text, tokens, place, before, new, *system = zip(*rows)
        system = [s[0] for s in system]
        n, out = len(role), []
        at = next((i for i in range(n) if new[i]), n)
        while at < n:
            back = at
            while back > 0 and before[at] - before[back - 1] <= history:
                back -= 1
            keeps_system = 0 <= system[1] < place[back]
            used = before[at] - before[back] + (system[2] if keeps_system else 0)
            to = at + 1
            while to < n and used + before[to] + tokens[to] - before[at] <= budget:
                to += 1
            while back < at and used + tokens[at] > budget:  # history gives way to a long turn
                used -= tokens[back]
                back += 1
                if not keeps_system and 0 <= system[1] < place[back]:
                    keeps_system, used = True, used + system[2]
            parts, loss, length = ["<s>"], [], 3
            turns = [("system", system[0], False)] if keeps_system else []
            turns += [(role[i], text[i], i >= at) for i in range(back, to)]
            for r, t, is_new in turns:
                marked, a, b = format_turn(r, t)
                if is_new and r == "assistant":
                    loss.append({"start": length + a, "end": length + b})
                parts.append(marked)
                length += len(marked)
            total = used + before[to - 1] + tokens[to - 1] - before[at]
            repeated = len(turns) - (to - at)
            first = place[at]
            out.append(
                (conv[0], first, first, "".join(parts), repeated, loss, total, total > budget)
            )
            at = to
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for b in batches:
            done = []
            ids = [None if pd.isna(c) else int(c) for c in b["conv_id"].astype("Int64")]
            for row in zip(ids, *(b[c].tolist() for c in _ROW[1:])):
                if held and held[0][:2] != row[:2]:
                    done += cut(held)
                    held = []
                held.append(row)
            yield pd.DataFrame(done, columns=names).astype({"conv_id": "Int64"})
        if held:
            yield pd.DataFrame(cut(held), columns=names).astype({"conv_id": "Int64"})

    return run


def count_tokens(rows: DataFrame) -> DataFrame:
    path, pattern = bpe.vocabulary()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = bpe.encoder(path, pattern)
        for b in batches:
            yield b.assign(
                conv_id=b["conv_id"].astype("Int64"),
                turn=b["turn"].astype("Int64"),
                tokens=[len(enc.encode(t)) // 4 + MARKS for t in b["text"]],
            )

    return rows.mapInPandas(run, "conv_id long, turn long, role string, text string, tokens long")


def format_conversations(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, segment: int = SEGMENT
) -> DataFrame:
    """One row per window: conv_id, window (order), text, repeated (leading turns that are not new),
    loss (spans of the text), tokens, over_budget."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    keys = ["conv_id", "turn", "role", "text"]
    ranged = count_tokens(rows).repartitionByRange(*keys).withColumn("pid", F.spark_partition_id())
    ranged = stage(ranged, "chat-ranges")
    # inside a range, then the ranges before it: no conversation is summed in one task
    own = Window.partitionBy("pid", "conv_id").orderBy("turn", "role", "text")
    upto = own.rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("place", F.row_number().over(own) - 1).withColumn(
        "before", F.coalesce(F.sum("tokens").over(upto), F.lit(0))
    )
    per_range = ranged.groupBy("pid", "conv_id").agg(
        F.count("*").alias("n"),
        F.sum("tokens").alias("sum"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        F.col("pid").alias("_pid"),
        F.col("conv_id").alias("_conv"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum0"),
    )
    placed = (
        local.join(
            offsets,
            (F.col("pid") == F.col("_pid")) & F.col("conv_id").eqNullSafe(F.col("_conv")),
        )
        .withColumn("place", (F.col("place") + F.col("n0")).cast("long"))
        .withColumn("before", (F.col("before") + F.col("sum0")).cast("long"))
        .select("conv_id", "role", "text", "tokens", "place", "before")
    )
    placed = stage(placed, "chat-places")
    system = (
        placed.filter("role = 'system'")
        .groupBy(F.col("conv_id").alias("_conv"))
        .agg(F.min(F.struct("place", "text", "tokens")).alias("s"))
    )
    seg = F.floor(F.col("before") / F.lit(segment))
    reach = F.floor((F.col("before") + F.lit(history)) / F.lit(segment))
    dealt = (
        placed.join(system, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
        .withColumn("own", seg)
        .withColumn("segment", F.explode(F.sequence(seg, reach)))
        .select(
            "conv_id",
            "segment",
            "role",
            "text",
            "tokens",
            "place",
            "before",
            (F.col("own") == F.col("segment")).alias("new"),
            F.coalesce("s.text", F.lit("")).alias("sys_text"),
            F.coalesce("s.place", F.lit(-1)).alias("sys_place"),
            F.coalesce("s.tokens", F.lit(0)).alias("sys_tokens"),
        )
    )
    # segments lie whole in a task, many small ones side by side
    dealt = dealt.repartition("conv_id", "segment").sortWithinPartitions(
        "conv_id", "segment", "place"
    )
    return dealt.select(*_ROW).mapInPandas(_windows(budget, history), WINDOW_DDL)


def read_back(windows: DataFrame) -> DataFrame:
    """Turns and masked texts as read from the windows: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars. The windows of a conversation pass in order; only the running
    digests are held."""
    ddl = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held = None, None

        def close():
            key, n, turns, chars, loss, formatted = held
            return (key, n, turns.hexdigest(), chars, loss.hexdigest(), formatted)

        names = [c.split()[0] for c in ddl.split(", ")]
        for b in batches:
            done = []
            rows = zip(b["conv_id"].astype("Int64"), b["text"], b["repeated"], b["loss"])
            for conv, text, repeated, loss in rows:
                key = None if pd.isna(conv) else int(conv)
                if held is None or key != current:
                    if held is not None:
                        done.append(close())
                    current, held = key, [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in parse(text)[repeated:]:
                    held[1] += 1
                    held[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    held[3] += len(said)
                    held[4].update(said.encode("utf-8", "surrogatepass"))
                held[5] += len(text)
            yield pd.DataFrame(done, columns=names).astype({"conv_id": "Int64"})
        if held is not None:
            yield pd.DataFrame([close()], columns=names).astype({"conv_id": "Int64"})

    ordered = windows.select("conv_id", "window", "text", "repeated", "loss")
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInPandas(run, ddl)
