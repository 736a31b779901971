"""Licence scan against plain versions: a search at every word, and a recursive parser."""

from __future__ import annotations

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sablefin.llm import license_kernel as kernel
from sablefin.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def plain_places(text):
    some = WORD.findall(lower(text or ""))
    out = []
    for kind, phrases in (("base", kernel.BASE), ("notice", kernel.NOTICES), ("name", kernel.NAMES)):
        for phrase, label in phrases.items():
            p = phrase.split()
            out += [(k, len(p), kind, label) for k in range(len(some) - len(p) + 1) if some[k : k + len(p)] == p]
    return len(some), sorted(out)


class Plain:
    """Recursive descent over or < and < with; for well formed input."""

    def __init__(self, text):
        self.t = re.findall(r"[A-Za-z0-9.+-]+|[()]", text)

    def take(self):
        return self.t.pop(0)

    def atom(self):
        if self.t[0] == "(":
            self.take()
            v = self.either()
            assert self.take() == ")"
            return v
        label = kernel.label_of(self.take()) or "other"
        v = (kernel.OPENNESS[label], {label})
        if self.t and self.t[0].lower() == "with":
            self.take(), self.take()
            v = (max(v[0], kernel.EXCEPTED) if label != "other" and v[0] >= kernel.OPENNESS["agpl"] else v[0], v[1])
        return v

    def both(self):
        v = self.atom()
        while self.t and self.t[0].lower() == "and":
            self.take()
            w = self.atom()
            v = (min(v[0], w[0]), v[1] | w[1])
        return v

    def either(self):
        v = self.both()
        while self.t and self.t[0].lower() == "or":
            self.take()
            w = self.both()
            v = v if v[0] >= w[0] else w
        return v


IDS = ("MIT", "Apache-2.0", "GPL-2.0-only", "GPL-3.0-or-later", "LGPL-2.1+", "BSD-3-Clause", "MPL-2.0", "CC-BY-NC-4.0", "AGPL-3.0", "CC0-1.0", "LicenseRef-own", "ISC")


def expressions(rng, depth=0):
    r = rng.random()
    if depth > 5 or r < 0.4:
        return rng.choice(IDS) + (" WITH Classpath-exception-2.0" if rng.random() < 0.2 else "")
    if r < 0.55:
        return f"({expressions(rng, depth + 1)})"
    return f"{expressions(rng, depth + 1)} {rng.choice(('AND', 'OR', 'and', 'or'))} {expressions(rng, depth + 1)}"


def test_expressions_against_a_recursive_parser():
    rng = random.Random(1)
    for _ in range(3000):
        e = expressions(rng)
        postfix, whole = kernel.to_postfix(e.encode())
        value, labels = kernel.evaluate(postfix)
        want = Plain(e).either()
        assert whole and (value, set(labels)) == want, e


@pytest.mark.parametrize(
    ("line", "postfix", "whole"),
    [
        ("MIT OR Apache-2.0 AND GPL-2.0", "MIT Apache-2.0 GPL-2.0 and or", True), ("(MIT OR Apache-2.0) AND GPL-2.0 */", "MIT Apache-2.0 or GPL-2.0 and", True),
        ("MIT and is free", "MIT", True), ("MIT AND Foo-1", "MIT Foo-1 and", True), ("MIT Apache-2.0", "MIT", True), ("(MIT OR ISC", "MIT ISC or", False), ("MIT)", "MIT", True),
        ("MIT OR", "MIT", True), ("(MIT OR", "MIT", False), ("", "", False), ("()", "", False), ("AND MIT", "", False), ("MIT.", "MIT", True), ("GPL-2.0 with Linux-syscall-note", "GPL-2.0", True),
        ("MIT\nOR ISC", "MIT", True), ("mit Or isc", "mit", True), ("MIT WITH (x)", "MIT", True),
    ],
)
def test_where_reading_ends(line, postfix, whole):
    assert kernel.to_postfix(line.encode()) == (postfix.split(), whole)
    kernel.evaluate(postfix.split()) if postfix else None


PIECES = ["mit", "MIT", "license", "License", "apache", "general", "public", "lesser", "cc", "by", "nc", "é", "x9", " ", " ", "-", "\n", ".", "SPDX-License-Identifier: ", " ", "(", ")", " OR ", " AND ", "GPL-2.0"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join))
def test_places_against_a_search_at_every_word(text):
    n, places, _, _ = kernel.find(text.encode())
    assert (n, sorted(map(tuple, places))) == plain_places(text)


def test_scan(docs_of, odd_rows, spark, dir_of):
    rows = odd_rows + [
        (100, "MIT License. mit license, the MIT-License; x", "en", "a"), (101, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only\ncode", "en", "a"),
        (102, "GNU Lesser General Public License", "en", "a"), (103, "Licensed under CC BY-NC 4.0.", "en", "a"), (104, "İMIT license éapache license", "en", "a"), (105, "license: (GPL-2.0", "en", "a"),
    ]
    docs = docs_of(rows, clash=True)
    got = licenses.scan(docs).collect()
    assert len(got) == len(rows)
    want = sorted((repr(i), *map(repr, plain_places(t))) for i, t, _, _ in rows)
    assert sorted((repr(r["doc_id"]), repr(r["n_words"]), repr([tuple(p) for p in r["found"]])) for r in got) == want
    by = {r["doc_id"]: r for r in got}
    assert by[101]["labels"] == ["apache", "gpl", "mit"] and by[101]["expressions"][0].postfix == "MIT Apache-2.0 or GPL-2.0-only and"
    assert by[101]["openness"] == kernel.OPENNESS["gpl"] and by[101]["expressions"][0].labels == ["gpl", "mit"]
    assert by[103]["labels"] == ["cc-by", "cc-by-nc"] and by[103]["openness"] == 0.1
    assert by[105]["labels"] == ["gpl"] and not by[105]["expressions"]
    assert by[1]["score"] == 0 and by[1]["openness"] is None and by[1]["labels"] == []
    assert all(0 <= r["score"] <= 1 for r in got)
    assert licenses.scan(docs_of([])).count() == 0
    q = {r["doc_id"]: r for r in licenses.op11_licenses(spark, dir_of(documents=docs_of(rows))).collect()}
    assert (q[100]["n_base"], q[100]["first_word"], q[100]["last_word"], q[100]["base_labels"], q[100]["labels"]) == (3, 0, 5, "mit", "mit")
    assert (q[102]["base_labels"], q[102]["labels"]) == ("gpl", "gpl,lgpl") and q[1]["first_word"] is None and q[1]["base_labels"] == ""
    assert (q[104]["n_base"], q[104]["n_words"]) == (0, 4)


def test_time_grows_with_the_text():
    """Tags, parentheses and phrases by the hundred thousand, all in one line."""
    for piece in ("license ", "license: (", "license: MIT OR ", "SPDX-License-Identifier: MIT OR LICENSE OR ", "mit license "):
        took = []
        for n in (20_000, 160_000):
            began = time.perf_counter()
            kernel.find((piece * n).encode())
            took.append(time.perf_counter() - began)
        assert took[1] < 24 * max(took[0], 0.02), piece
    postfix, whole = kernel.to_postfix(b"(" * 200_000 + b"MIT" + b")" * 200_000)
    assert (postfix, whole) == (["MIT"], True)
