"""Personal data: fixed patterns per kind, and spans found by bootstrapped contexts.

Base spans come from one regular expression per kind with a check (digits, ranges, Luhn). They are
the seed entities. Around every seed, and around every other token that looks like an identifier (it
holds a digit or an @ and has at least `MIN_TOKEN` characters), the task notes lexical patterns: the
word before with a mark for the word after it ("L"), the key of a value ("K"), and the token's own
lead of letters with its shape ("S"). Every value behind a key is a token of its own: `a=1&b=2` has two,
quotes may stand around key and value, and padding belongs to the value.

Patterns and instances form a bipartite graph, kept as counts in a Spark table. Seeds start at 1,
all others at 0. In each round a pattern's score is the mean score of its distinct instances,
lowered for rare ones, and an instance's score is that of its best pattern; seeds stay at 1. After
`ROUNDS` rounds the patterns that score `CONFIDENT` or more with at least `MIN_SUPPORT` distinct
instances mark the unseen instances in their contexts. A label word list starts the keys (password,
token, ...), as one more kind of seed, so that secrets behind other keys can be learned from it. What
stands behind such a key is marked whatever its characters and however rare it is; only a word of
letters behind a colon and a blank is taken for prose.

Only tokens that look like identifiers leave their tasks; both steps of a round are grouped sums and
joins by key, so neither a frequent pattern nor a frequent token meets in one task as a whole.

Results for odd input: a null text is empty and has no spans. Found spans that touch a base span are
dropped, so base spans stay as they are. Rows with equal ids are searched each, told apart by a
digest of the text. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.base import stage, text_rows

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
CONFIDENT = 0.6
MIN_SUPPORT = 5
MIN_TOKEN = 6

# The patterns of the base search. The part of an e-mail address before the @ is read
# backwards from there, and an ip starts at the first of its digits, so that neither takes quadratic
# time on long runs.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Keys that announce a secret.
SEED_KEYS = frozenset(
    {"password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "access_token", "secret_key"}
)

_DIGITS = str.maketrans("", "", " -().+")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_KEYED = re.compile(r"([A-Za-z_]{3,20})\s?[=:]\s?[\"']?$")
_SEPARATOR = re.compile(r"[=:]")
_KEY = re.compile(r"([A-Za-z_]{3,20})[\"']?\s?$")
_VALUE = re.compile(r"(\s?)(?:\"([^\"\n]*)\"|'([^'\n]*)'|([^\s&;,\"'<>{}()\[\]]+))")
_EDGE = "\"'.,;:()[]{}<>"
#: Shortest value behind a key that announces a secret.
MIN_SECRET = 4


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind as listed."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            free = m.end()
        at = text.find("@", at + 1)
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) < 4 and int(p) <= 255 for p in parts):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = m[0].translate(_DIGITS)
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(m[0].translate(_DIGITS)) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _marked_words(text: str) -> Iterator[tuple[int, int]]:
    """Words that hold a digit or an @."""
    m = _MARK.search(text)
    while m:
        start = m.start()
        while start and not text[start - 1].isspace():
            start -= 1
        space = _SPACE.search(text, m.end())
        end = space.start() if space else len(text)
        yield start, end
        m = _MARK.search(text, end)


def _shape(token: str) -> str:
    lead = re.match(r"[A-Za-z]{3,4}", token)
    kinds = re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "9", token))
    return f"{lead[0] if lead else ''}|{len(token)}|{''.join(sorted(set(kinds)))}"


def _patterns(text: str, start: int, end: int) -> list[str]:
    """Contexts of a token: key, words to both sides, own shape."""
    left, right = text[max(0, start - 48) : start], text[end : end + 24]
    keyed = _KEYED.search(left)
    if keyed:
        return [f"K:{keyed[1].lower()}"]
    before = left.rsplit(None, 1)
    after = right.split(None, 1)
    out = [f"L:{before[-1] if before else '^'} _ {after[0] if after else '$'}"]
    if text[start].isalpha():
        out.append("S:" + _shape(text[start:end]))
    return out


def _overlap(spans: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a range meets one of the spans, which are ordered; ask for ranges in order."""
    at = reach = 0

    def meets(start: int, end: int) -> bool:
        nonlocal at, reach
        while at < len(spans) and spans[at][0] < end:
            reach = max(reach, spans[at][1])
            at += 1
        return start < reach

    return meets


def keyed_values(text: str) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, key, announces a secret) of every value worth a look, in order."""
    free = 0
    for sep in _SEPARATOR.finditer(text):
        at = sep.start()
        if at < free:
            continue  # inside the value before
        key = _KEY.search(text, max(free, at - 24), at)
        value = key and _VALUE.match(text, at + 1)
        if not value:
            continue
        nth = value.lastindex
        start, end = value.span(nth)
        if nth == 4:
            while end > start and text[end - 1] in ".:!?":
                end -= 1
        token, name = text[start:end], key[1].lower()
        prose = nth == 4 and sep[0] == ":" and value[1] and token.isalpha()
        secret = name in SEED_KEYS and len(token) >= MIN_SECRET and not prose
        marked = len(token) >= MIN_TOKEN and _MARK.search(token) and not _SPACE.search(token)
        if secret or marked:
            yield start, end, name, secret
            free = end


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str, str, bool]]:
    """(start, end, kind, pattern, is seed): contexts of base spans and identifier-like tokens."""
    out, taken = [], []
    for start, end, kind in base:
        taken.append((start, end))
        out += [(start, end, kind, p, True) for p in _patterns(text, start, end) if p[0] != "S"]
    found, meets = [], _overlap(taken)
    for start, end, key, secret in keyed_values(text):
        if not meets(start, end):
            out.append((start, end, "id", f"K:{key}", secret))
            found.append((start, end))
    meets = _overlap(sorted(taken + found))
    for start, end in _marked_words(text):
        start = max(start, text.rfind("=", start, end) + 1, text.rfind(":", start, end) + 1)
        while start < end and text[start] in _EDGE:
            start += 1
        while end > start and text[end - 1] in _EDGE:
            end -= 1
        token = text[start:end]
        if len(token) < MIN_TOKEN or not any(c.isdigit() or c == "@" for c in token):
            continue
        if meets(start, end):
            continue
        out += [(start, end, "id", p, False) for p in _patterns(text, start, end)]
    return out


def search(docs: DataFrame) -> DataFrame:
    """doc_id, row (digest of the text), base spans, and candidates with their patterns."""
    ddl = (
        "doc_id long, row string, base array<struct<start:int,end:int,kind:string>>, "
        "near array<struct<start:int,end:int,kind:string,pattern:string,seed:boolean,instance:long>>"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            base, near, row = [], [], []
            for t in b["text"]:
                spans = base_spans(t)
                base.append([{"start": s, "end": e, "kind": k} for s, e, k in spans])
                found = []
                for s, e, k, p, seed in candidates(t, spans):
                    digest = hashlib.blake2b(t[s:e].encode("utf-8", "surrogatepass"), digest_size=8)
                    instance = int.from_bytes(digest.digest(), "big", signed=True)
                    found.append(
                        {"start": s, "end": e, "kind": k, "pattern": p, "seed": seed, "instance": instance}
                    )
                near.append(found)
                raw = t.encode("utf-8", "surrogatepass")
                row.append(hashlib.blake2b(raw, digest_size=12).hexdigest())
            yield pd.DataFrame(
                {"doc_id": b["doc_id"].astype("Int64"), "row": row, "base": base, "near": near}
            )

    return text_rows(docs).mapInPandas(run, ddl)


def pattern_scores(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """`graph` has distinct pattern, instance with seed; returns pattern, score, support."""
    conf = graph.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("c"))
    fixed = conf.select("instance", F.col("c").alias("seeded"))
    edges = graph.select("pattern", "instance").distinct()
    score = None
    for r in range(rounds):
        score = (
            edges.join(conf, "instance")
            .groupBy("pattern")
            .agg(F.sum("c").alias("s"), F.count("*").alias("support"))
            # one unseen instance more than there are, so rare patterns score lower
            .select("pattern", (F.col("s") / (F.col("support") + 1)).alias("score"), "support")
        )
        score = stage(score, f"pii-patterns-{r}")
        best = edges.join(score, "pattern").groupBy("instance").agg(F.max("score").alias("best"))
        conf = best.join(fixed, "instance").select(
            "instance", F.greatest("best", "seeded").alias("c")
        )
    return score


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, spans, base: arrays of (start, end, kind); `spans` also has what contexts brought."""
    found = stage(search(docs), "pii-search")
    # one row per document that has any; the same text twice brings the same candidates twice
    near = found.filter(F.size("near") > 0).select("row", F.explode("near").alias("n"))
    near = near.select("row", "n.*")
    graph = stage(
        near.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-graph"
    )
    good = pattern_scores(graph).filter(
        (F.col("score") >= CONFIDENT) & (F.col("support") >= MIN_SUPPORT)
    )
    new = (
        near.filter("kind = 'id'")
        .join(good.select("pattern", "score"), "pattern", "left")
        .filter("seed OR score IS NOT NULL")
        .select("row", F.struct("start", "end", "kind").alias("s"))
        .groupBy("row")
        # candidates of one text, as many as its own tokens
        .agg(F.collect_set("s").alias("added"))
    )
    joined = found.select("doc_id", "row", "base").join(new, "row", "left")
    none = F.expr("cast(array() as array<struct<start:int,end:int,kind:string>>)")
    return joined.select(
        "doc_id", "base", F.concat("base", F.coalesce("added", none)).alias("spans")
    )


def digest_columns(found: DataFrame) -> DataFrame:
    """The spans as text: counts per kind, digest of the base, all spans."""
    order = F.array(*map(F.lit, KINDS), F.lit("id"))

    def listed(col):
        # struct order: start, place of the kind, end
        keyed = F.transform(
            col,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.array_position(order, s["kind"]).alias("nth"),
                s["end"].alias("end"),
                s["kind"].alias("kind"),
            ),
        )
        text = F.transform(
            F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        )
        return F.array_join(text, ",")

    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}")
        for k in KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
