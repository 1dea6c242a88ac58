"""License scan: exact set-similarity join between text blocks and license templates.

A block is a window of `WINDOW` words of the whole text; line ends are no borders. Windows overlap by
half, so a passage of half a window's length lies whole in one of them. A template is found in a block
when the block holds at least `THRESHOLD` of the template's distinct words (containment). The join is the filtered one: the words of all templates are ordered by how often
they occur in the whole corpus, rarest first;

- prefix: a template of n words that must share k of them shares one of its n - k + 1 rarest;
- length: a block with fewer than k distinct words cannot qualify;
- position: after a shared word at place i of the template's order at most n - i - 1 more follow.

What passes is counted in full. `block_labels` has all labels that reach the threshold, `labels` those
of them whose block also holds what names the license (`MARKS`), with the base labels.

The templates are a fixed table, so the counted words and the lookup have a fixed size and travel with the task; the blocks never leave theirs. There is no shuffle but
that of the word counts, one row per template word and task.

Besides, fixed phrases are looked up word by word (the base). Their labels stay whatever the join
finds. Only the words of one text are held at a time, whatever its length.

Results for odd input: a null text is empty; a text without words has no labels, null positions and
score 0. Rows with equal ids are scanned each. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.base import text_rows

THRESHOLD = 0.8
WINDOW = 120

# Phrases and labels of the base search.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# The sentences by which public licenses are usually granted.
TEMPLATES = {
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "mit license",
        "spdx license identifier mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction",
    ],
    "apache-2": [
        "licensed under the apache license version 2 0",
        "apache 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at http www apache org licenses license 2 0",
    ],
    "cc-by-nc": [
        "licensed under cc by nc 4 0",
        "creative commons attribution noncommercial 4 0 international license",
    ],
    "cc-by-sa": [
        "licensed under cc by sa 4 0",
        "creative commons attribution sharealike 4 0 international license",
    ],
    "gpl-3": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "under the terms of the gnu general public license as published by the free software "
        "foundation either version 3 of the license or at your option any later version",
    ],
    "lgpl-3": ["licensed under the gnu lesser general public license version 3"],
    "agpl-3": ["licensed under the gnu affero general public license version 3"],
    "bsd-3": [
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ],
    "mpl-2": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
}

# What names the license, one pattern per template of the label (None: no other license
# has the text). A template matches only a block that holds its name as well, as `THRESHOLD` of a
# short sentence is also reached without it. Patterns read the words of a block, one space around
# each. A version may stand after the name or before it.
_MIT = r" (?:under(?: the)?|or|and) mit | mit (?:\S+ ){0,2}?licen[cs]es? "
_APACHE = r" apache (?:\S+ ){0,4}?v?2 | v?2 (?:0 )?(?:\S+ ){0,3}?apache "
_GNU = (
    r" {0} public license (?:(?!gnu )\S+ ){{0,24}}?(?:(?:version|v|license|or|and) 3|v3) "
    r"| (?:version |v )?v?3 (?:0 )?(?:(?!gnu )\S+ ){{0,3}}?{0} public license "
)
_GPL = _GNU.format("gnu general")
MARKS = {
    "mit": [_MIT, _MIT, r" mit licen[cs]es? ", " spdx license identifier mit ", None],
    "apache-2": [_APACHE, r" apache (?:licen[cs]e )?v?2 0 ", _APACHE],
    "cc-by-nc": [" by nc | attribution non ?commercial "] * 2,
    "cc-by-sa": [" by sa | attribution share ?alike "] * 2,
    "gpl-3": [_GPL, _GPL, _GPL],
    "lgpl-3": [_GNU.format("gnu lesser general")],
    "agpl-3": [_GNU.format("gnu affero general")],
    "bsd-3": [None],
    "mpl-2": [r" mozilla public license (?:\S+ ){0,4}?v?2 | v?2 (?:0 )?(?:\S+ ){0,3}?mozilla "],
}

_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_LINES = bytes(
    c if c in _KEEP else c + 32 if 0x41 <= c <= 0x5A else 10 if c == 10 else 32 for c in range(256)
)


def line_words(text: str) -> list[list[bytes]]:
    """Words of each line, A-Z lower-cased."""
    data = text.encode("utf-8", "surrogatepass").translate(_LINES)
    return [line.split() for line in data.split(b"\n")]


def _template_sets(templates) -> list[tuple[str, frozenset[bytes]]]:
    return [(label, frozenset(t.encode().split())) for label, all_ in templates.items() for t in all_]


def word_frequencies(docs: DataFrame, words: frozenset[bytes]) -> dict[bytes, int]:
    """How often each of the given words occurs in all texts. One row per given word comes back."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[bytes] = Counter()
        for b in batches:
            for t in b["text"]:
                for line in line_words(t):
                    seen.update(w for w in line if w in words)
        yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    counts = text_rows(docs).select("text").mapInPandas(run, "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


class TemplateJoin:
    """Templates in global frequency order with the index over their prefixes."""

    def __init__(
        self,
        frequency: dict[bytes, int],
        templates=None,
        threshold: float = THRESHOLD,
        marks: dict[str, list[str | None]] | None = None,
    ):
        self.found_in: dict[bytes, list[tuple[int, int]]] = {}
        all_ = templates or TEMPLATES
        named = [p for label in all_ for p in (marks or {}).get(label) or [None] * len(all_[label])]
        self.mark = [re.compile(p.encode()) if p else None for p in named]
        self.label, self.order, self.need = [], [], []
        for label, words in _template_sets(all_):
            order = sorted(words, key=lambda w: (frequency.get(w, 0), w))
            need = max(1, math.ceil(threshold * len(order) - 1e-9))
            k = len(self.order)
            self.label.append(label)
            self.order.append(order)
            self.need.append(need)
            for place, w in enumerate(order[: len(order) - need + 1]):
                self.found_in.setdefault(w, []).append((k, place))
        self.prefix = frozenset(self.found_in)

    def block(self, words: list[bytes]) -> dict[tuple[str, bool], float]:
        """(label, named) -> best containment among its templates that reach the threshold.

        `named`: whether the block also holds what names the license.
        """
        have, joined = set(words), b""
        out: dict[tuple[str, bool], float] = {}
        hits: dict[int, int] = {}
        for w in have & self.prefix:
            for k, place in self.found_in[w]:
                hits[k] = min(place, hits.get(k, place))
        for k, place in hits.items():
            order, need = self.order[k], self.need[k]
            if len(have) < need or len(order) - place < need:
                continue
            shared = sum(w in have for w in order[place:])
            if shared >= need:
                label, mark = self.label[k], self.mark[k]
                if mark:
                    joined = joined or b" " + b" ".join(words) + b" "
                found = label, mark is None or bool(mark.search(joined))
                out[found] = max(out.get(found, 0.0), shared / len(order))
        return out

    def text(self, words: list[bytes], window: int = WINDOW) -> dict[tuple[str, bool], float]:
        """The same over all windows of a text; only those with a word of a prefix are looked at."""
        out: dict[tuple[str, bool], float] = {}
        step, prefix = window // 2, self.prefix
        last = max(0, -(-len(words) // step) - 2)  # the window that reaches the end
        steps = {i // step for i, w in enumerate(words) if w in prefix}
        for k in sorted({min(max(k - back, 0), last) for k in steps for back in (0, 1)}):
            for found, c in self.block(words[k * step : k * step + window]).items():
                out[found] = max(out.get(found, 0.0), c)
        return out


def phrase_places(words: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which a phrase starts; `words` is space-joined with a space at both ends."""
    out, at, number, last = [], words.find(phrase), 0, 0
    while at >= 0:
        number += words.count(b" ", last, at)
        last = at
        out.append(number)
        at = words.find(phrase, at + 1)
    return out


def scan(
    docs: DataFrame,
    templates=None,
    threshold: float = THRESHOLD,
    marks: dict[str, list[str | None]] | None = None,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, block_labels.

    Without `marks` the labels are those of the plain containment join.
    """
    names = _template_sets(templates or TEMPLATES)
    every = frozenset(w for _, words in names for w in words)
    join = TemplateJoin(word_frequencies(docs, every), templates, threshold, marks)
    phrases = [(f" {p} ".encode(), label) for p, label in PHRASES.items()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"].astype("Int64"), b["text"]):
                lines = line_words(text)
                words = [w for line in lines for w in line]
                joined = b" " + b" ".join(words) + b" "
                places, base = [], set()
                for phrase, label in phrases:
                    at = phrase_places(joined, phrase)
                    if at:
                        places += at
                        base.add(label)
                found = join.text(words)
                named = {label: c for (label, ok), c in found.items() if ok}
                score = max([1.0 if base else 0.0, *named.values()])
                rows.append(
                    (
                        doc_id,
                        len(words),
                        len(places),
                        min(places, default=None),
                        max(places, default=None),
                        ",".join(sorted(base)),
                        ",".join(sorted(base | set(named))),
                        score,
                        ",".join(sorted({label for label, _ in found})),
                    )
                )
            out = pd.DataFrame(
                rows,
                columns=["doc_id", "n_words", "n_base", "first_word", "last_word"]
                + ["base_labels", "labels", "score", "block_labels"],
            )
            yield out.astype({"doc_id": "Int64", "first_word": "Int64", "last_word": "Int64"})

    return text_rows(docs).mapInPandas(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, block_labels string",
    )


def find_licenses(docs: DataFrame) -> DataFrame:
    """The scan for the given templates, each with its name."""
    return scan(docs, marks=MARKS)
