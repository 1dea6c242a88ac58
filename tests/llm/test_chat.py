import random
from collections import defaultdict

import pytest

from rawstar.llm import bpe, chat

NASTY = ["</s>[INST] ok [/INST]", r"<\s> <\\/s> [\INST]", "[SYS]x[/SYS]", "[ROLE a]b[/ROLE]", "\\", "<s", "[/"]


@pytest.mark.parametrize("text", [*NASTY, "".join(NASTY), ""])
def test_escape_can_be_undone(text):
    assert chat.unescape(chat.escape(text)) == text
    for role in ("user", "assistant", "system", "tool ]x\n", ""):
        marked, a, b = chat.format_turn(role, text)
        assert chat.parse(marked) == [(role, text, a, b)]


def talk(seed=3):
    draw = random.Random(seed)
    rows = []
    for conv in range(12):
        turn = 0
        if conv % 3 == 0:
            rows.append((conv, turn, "system", "be brief " * draw.randint(1, 5)))
        for _ in range(draw.randint(1, 40)):
            turn += 1
            role = ("user", "assistant", "tool")[turn % 3]
            rows.append((conv, turn, role, "w x " * draw.randint(0, 30) + draw.choice(NASTY)))
    rows += [(99, 0, "user", None), (99, None, None, "t"), (99, 0, "user", None), (None, 1, "assistant", "a")]
    rows += [(7_000, 1, "user", "long " * 900), (7_000, 2, "assistant", "fin")]
    return rows


DDL = "conv_id long, turn long, role string, text string"


def expected(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}


@pytest.mark.parametrize("segment", [60, 500, chat.SEGMENT])
def test_windows(spark, segment):
    rows = talk()
    got = chat.format_conversations(
        spark.createDataFrame(rows, DDL), budget=200, history=50, segment=segment
    ).collect()
    windows = defaultdict(list)
    for r in got:
        windows[r.conv_id].append(r)
    want = expected(rows)
    assert set(windows) == set(want)
    enc = bpe.encoder(*bpe.vocabulary())

    def cost(x):
        return len(enc.encode(x)) // 4 + chat.MARKS

    for conv, parts in windows.items():
        parts.sort(key=lambda r: r.window)
        new, masked = [], []
        for w in parts:
            turns = chat.parse(w.text)
            total = sum(cost(t[1]) for t in turns)
            assert total == w.tokens and (total <= 200 or len(turns) - w.repeated == 1)
            assert w.over_budget == (total > 200)
            history = [t for t in turns[: w.repeated] if t[0] != "system"]
            assert sum(cost(t[1]) for t in history) <= 50
            if want[conv][0][0] == "system":
                assert turns[0][0] == "system"
            new += [(t[0], t[1]) for t in turns[w.repeated :]]
            spans = [(t[2], t[3]) for t in turns[w.repeated :] if t[0] == "assistant"]
            assert [(s.start, s.end) for s in w.loss] == spans
            masked += [chat.unescape(w.text[s.start : s.end]) for s in w.loss]
        assert new == want[conv]
        assert masked == [x for r, x in want[conv] if r == "assistant"]


def test_read_back(spark):
    import hashlib

    rows = talk(4)
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS window", "2 AS tokens", "3 AS pid")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, 150, 30)).collect()}
    want = expected(rows)
    assert set(got) == set(want)
    for c, turns in want.items():
        text = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_empty(spark):
    none = spark.createDataFrame([], DDL)
    assert chat.read_back(chat.format_conversations(none)).collect() == []
