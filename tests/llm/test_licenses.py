import re
import textwrap

import pytest

from rawstar.llm import licenses as li

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORDS.findall(low)


def brute_base(text):
    words = words_of(text)
    places, labels = [], set()
    for phrase, label in li.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), places, ",".join(sorted(labels))


def brute_labels(text):
    """Every window of the text against every template."""
    best, words = {}, words_of(text)
    step = li.WINDOW // 2
    for at in range(0, max(1, len(words) - step), step):
        have = set(words[at : at + li.WINDOW])
        for label, templates in li.TEMPLATES.items():
            for t in templates:
                want = set(t.split())
                c = len(want & have) / len(want)
                if c >= li.THRESHOLD - 1e-12:
                    best[label] = max(c, best.get(label, 0))
    return best


TEXTS = [
    "Released under the MIT License.", "UNDER-THE-MIT-LICENSE under the mit license",
    "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "x " * 300 + "This work is licensed under the GNU General Public License, version 3. " + "y " * 300,
    "under the mité license", "under the mit\x7flicense", "cc by�nc cc by nc", "plain text",
    "version the of license under public general 3 gnu is licensed", "", " ",
    "apache license version 2 apache license version 2", "the license of the the of a is",
]


def check(docs):
    for r in li.scan(docs).collect():
        text = {x.doc_id: x.text for x in docs.collect()}[r.doc_id]
        n, places, labels = brute_base(text)
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(places), labels)
        assert (r.first_word, r.last_word) == (min(places, default=None), max(places, default=None))
        found = brute_labels(text)
        want = set(found) | set(filter(None, labels.split(",")))
        assert r.labels == ",".join(sorted(want))
        assert r.score == pytest.approx(max([1.0 if labels else 0.0, *found.values()]))


def test_scan(make_docs, prose):
    check(make_docs(TEXTS + prose[:20]))


def test_awkward(awkward, empty):
    assert li.scan(awkward).count() == awkward.count()
    check(awkward.filter("doc_id is not null and doc_id <> 4"))
    assert li.scan(empty).collect() == []


def test_filters_lose_nothing():
    """Whatever the order of the words by frequency, the filtered join finds the same."""
    for frequency in ({}, {w.encode(): i for i, w in enumerate("the license version 3 under".split())}):
        join = li.TemplateJoin(frequency)
        for t in TEXTS:
            words = [w.encode("utf-8", "surrogatepass") for w in words_of(t)]
            assert join.text(words) == pytest.approx({(k, True): c for k, c in brute_labels(t).items()})


GRANTS = {
    "Licensed under the MIT License.": {"mit"},
    "Released under the MIT/X11 licence, under the terms of the license": {"mit"},
    "Licensed under the Apache License, Version 2.0.": {"apache-2"},
    "Licensed under version 2.0 of the Apache License.": {"apache-2"},
    "Licensed under CC BY-NC 4.0.": {"cc-by-nc"},
    "Licensed under CC BY-SA 4.0.": {"cc-by-sa"},
    "Licensed under CC BY 4.0.": set(),
    "Creative Commons Attribution-NonCommercial 4.0 International License": {"cc-by-nc"},
    "Creative Commons Attribution-ShareAlike 4.0 International License": {"cc-by-sa"},
    "This work is licensed under the GNU General Public License, version 3.": {"gpl-3"},
    "Licensed under version 3 of the GNU General Public License.": {"gpl-3"},
    "Licensed under the GNU General Public License (GPL), version 2 or version 3.": {"gpl-3"},
    "Licensed under the GNU General Public License version 2": set(),
    "Licensed under the GNU Lesser General Public License version 3": {"lgpl-3"},
    "Licensed under the GNU Affero General Public License version 3": {"agpl-3"},
    "Licensed under the GNU General Public License version 2 and "
    "the GNU Lesser General Public License version 3": {"lgpl-3"},
    "Licensed under the BSD license": set(),
    "MIT License": {"mit"},
    "SPDX-License-Identifier: MIT": {"mit"},
    "SPDX-License-Identifier: Apache-2.0": {"apache-2"},
    "the MIT campus asks for a driver's license, under the law": set(),
    "er kam mit dem Zug. Licensed under the Apache License, Version 2.0": {"apache-2"},
}


def test_each_grant_gets_its_own_label_only(make_docs):
    texts = list(GRANTS) + [t for all_ in li.TEMPLATES.values() for t in all_]
    want = list(GRANTS.values()) + [{label} for label, all_ in li.TEMPLATES.items() for _ in all_]
    rows = {r.doc_id: r.labels for r in li.find_licenses(make_docs(texts)).collect()}
    for i, (text, labels) in enumerate(zip(texts, want)):
        assert rows[i] == ",".join(sorted(labels)), text


def test_wrapped_and_spread_texts(make_docs):
    texts, want = [], []
    for label, all_ in li.TEMPLATES.items():
        for t in all_:
            filler = "lorem ipsum dolor sit amet " * 40
            for width in (30, 72):
                texts.append(filler + "\n" + textwrap.fill(t, width, initial_indent=" * ") + "\n" + filler)
                want.append(label)
            texts.append(filler + t + " " + filler)
            want.append(label)
    for r in li.find_licenses(make_docs(texts)).collect():
        assert r.labels == want[r.doc_id], texts[r.doc_id]
        assert want[r.doc_id] in r.block_labels.split(",")


def test_blocks_keep_what_the_names_leave_out(make_docs):
    text = "licensed under the gnu general public license version 2"
    (row,) = li.find_licenses(make_docs([text])).collect()
    assert row.labels == "" and "gpl-3" in row.block_labels.split(",")
