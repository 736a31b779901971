"""Licence tags, notice phrases and licence expressions (no Spark here).

A text becomes its words, joined by single spaces; one Aho-Corasick automaton over all phrases and
tags passes over that once and reports every place, overlapping ones included. What follows a tag is read
as a licence expression by a shunting-yard parser, one pass over the tokens, and evaluated on a stack.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

# Phrases and labels that count as base places.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Phrases of notices: legal sentences that only the licence itself or its header has.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "licensed under the apache license version 2 0": "apache",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "it under the terms of the gnu general public license": "gpl",
    "it under the terms of the gnu lesser general public license": "lgpl",
    "it under the terms of the gnu affero general public license": "agpl",
    "subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: Names of licences.
NAMES = {
    "lesser general public license": "lgpl", "library general public license": "lgpl", "affero general public license": "agpl",
    "bsd license": "bsd", "isc license": "isc", "zlib license": "zlib", "boost software license": "bsl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "cc0": "cc0", "cc by": "cc-by", "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc", "cc by nc nd": "cc-by-nc", "the unlicense": "unlicense",
    "gnu gpl": "gpl", "gnu lgpl": "lgpl", "gnu agpl": "agpl",
}
#: What introduces an expression.
TAGS = ("spdx license identifier", "license expression", "licensed under", "license")
#: How freely a work under each licence may be used: 1 with a notice, less with a duty to share alike, 0 unknown.
OPENNESS = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "bsl": 1.0, "unlicense": 1.0, "cc0": 1.0, "cc-by": 0.9,
    "lgpl": 0.6, "mpl": 0.6, "epl": 0.6, "cc-by-sa": 0.5, "gpl": 0.3, "agpl": 0.2, "cc-by-nd": 0.1, "cc-by-nc": 0.1, "other": 0.0,
}
#: An exception lifts a licence that asks to share alike to this.
EXCEPTED = 0.6
# Identifiers without version and suffix; the public list writes them like this.
_IDS = {
    "mit": "mit", "mit-0": "mit", "x11": "mit", "apache": "apache", "bsd": "bsd", "0bsd": "bsd", "isc": "isc", "zlib": "zlib", "bsl": "bsl",
    "unlicense": "unlicense", "cc0": "cc0", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd",
    "cc-by-nc-sa": "cc-by-nc", "cc-by-nc-nd": "cc-by-nc", "lgpl": "lgpl", "mpl": "mpl", "epl": "epl", "gpl": "gpl", "agpl": "agpl",
}
_VERSION = re.compile(r"-[0-9]+(\.[0-9]+)*(-clause)?(-only|-or-later|-universal)?\+?$|-(only|or-later)$|\+$")
RANK = {"or": 1, "and": 2, "with": 3}

_WORDS = bytes((c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32) for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_TOKEN = re.compile(rb"[ \t]*(?:([A-Za-z0-9][A-Za-z0-9.+-]*)|([()]))")
_LEAD = re.compile(rb"[ \t:=\"'`]*")
#: Words that end a tag are never operands, so no stretch of text is read for more than one tag.
_RESERVED = frozenset(t.split()[-1] for t in TAGS)


class Place(NamedTuple):
    word: int
    n_words: int
    kind: str  # base, notice or name
    label: str


class Expression(NamedTuple):
    word: int
    postfix: str
    openness: float
    labels: tuple[str, ...]


@lru_cache(maxsize=1)
def automaton():
    """All phrases and tags in one automaton; a key has its (kind, label) pairs."""
    import ahocorasick

    keys: dict[str, list] = {}
    for kind, some in (("base", BASE), ("notice", NOTICES), ("name", NAMES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in some.items():
            keys.setdefault(phrase, []).append((kind, label))
    a = ahocorasick.Automaton()
    for phrase, found in keys.items():
        a.add_word(f" {phrase} ", (phrase.count(" ") + 1, found))
    a.make_automaton()
    return a


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z in lower case: digits, letters and all characters beyond ASCII."""
    return text.translate(_WORDS).split()


def label_of(token: str) -> str | None:
    """Label of an identifier of any case and version (None: not one)."""
    low = token.lower()
    if low in _IDS:
        return _IDS[low]
    if low.startswith("licenseref-") and len(low) > 11:
        return "other"
    return _IDS.get(_VERSION.sub("", low))


def _is_exception(token: str) -> bool:
    return "exception" in token.lower()


def to_postfix(text: bytes, at: int = 0) -> tuple[list[str], bool]:
    """(tokens in postfix order, whole): the longest expression from ``at`` on, within its line, by shunting-yard.

    Reading ends where the grammar does: at a second operand in a row, a character that belongs to no token, or an
    operand that is no identifier; after an operator in capitals such an operand is an unknown licence.
    An operator at the very end is left out. ``whole`` is false if a parenthesis stays open or nothing is read; the
    identifiers are returned all the same.
    """
    out: list[str] = []
    ops: list[str] = []
    open_, operand = 0, True  # operand: one is due
    while m := _TOKEN.match(text, at):
        word, mark = (m[1] or b"").decode(), m[2]
        if mark == b"(":
            if not operand or (ops and ops[-1].lower() == "with"):
                break
            ops.append("(")
            open_ += 1
        elif mark == b")":
            if operand or not open_:
                break
            while (op := ops.pop()) != "(":
                out.append(op.lower())
            open_ -= 1
        elif not operand:
            if word.lower() not in RANK or word not in (word.lower(), word.upper()):
                break
            while ops and ops[-1] != "(" and RANK[ops[-1].lower()] >= RANK[word.lower()]:
                out.append(ops.pop().lower())
            ops.append(word)
            operand = True
        else:
            word = word.rstrip(".-") or word
            last = ops[-1] if ops else ""
            if last.lower() == "with":
                if not _is_exception(word):
                    break
            elif word.lower() in RANK or word.lower() in _RESERVED or (label_of(word) is None and not last.isupper()):
                break
            out.append(word)
            operand = False
        at = m.end()
    if operand and ops and ops[-1] != "(":
        ops.pop()
        operand = False
    whole = bool(out) and not operand and not open_
    while ops:
        if (op := ops.pop()) != "(":
            out.append(op.lower())
    return out, whole


def evaluate(postfix: list[str]) -> tuple[float, tuple[str, ...]]:
    """(openness, labels that bind): of an ``or`` the freer side may be chosen (left on ties), an ``and`` binds to both and is
    as free as the stricter one, a ``with`` lifts what asks to share alike."""
    stack: list[tuple[float, frozenset]] = []
    for t in postfix:
        if t not in RANK:
            label = None if _is_exception(t) else label_of(t) or "other"
            stack.append((0.0, frozenset()) if label is None else (OPENNESS[label], frozenset((label,))))
            continue
        b, a = stack.pop(), stack.pop()
        if t == "or":
            stack.append(a if a[0] >= b[0] else b)
        elif t == "and":
            stack.append((min(a[0], b[0]), a[1] | b[1]))
        else:
            stack.append((max(a[0], EXCEPTED) if a[0] >= OPENNESS["agpl"] else a[0], a[1]))
    (value, labels), = stack
    return value, tuple(sorted(labels))


def find(text: bytes) -> tuple[int, list[Place], list[Expression], set[str]]:
    """(words, places, whole expressions, labels of all expressions) of a UTF-8 text."""
    some = words(text)
    line = " " + b" ".join(some).decode("latin-1") + " "  # one character a byte: phrases are ASCII
    places: list[Place] = []
    tags: list[int] = []  # words before the expression
    at = seen = 0
    for end, (n, found) in automaton().iter(line):
        seen += line.count(" ", at, end)  # ``seen`` words end before the space at ``end``
        at = end
        for kind, label in found:
            if kind == "tag":
                if not tags or tags[-1] != seen:
                    tags.append(seen)
            else:
                places.append(Place(seen - n, n, kind, label))
    expressions, labels = [], set()
    if tags:
        want, k = iter(tags), 0
        due = next(want)
        for m in _WORD.finditer(text):
            k += 1
            if k < due:
                continue
            postfix, whole = to_postfix(text, _LEAD.match(text, m.end()).end())
            ids = [t for t in postfix if t not in RANK and not _is_exception(t)]
            labels.update(label_of(t) or "other" for t in ids)
            if whole:
                expressions.append(Expression(due, " ".join(postfix), *evaluate(postfix)))
            if (due := next(want, 0)) == 0:
                break
    return len(some), places, expressions, labels - {"other"}


def score(kinds: set[tuple[str, str]]) -> float:
    """How surely a text carries a licence, from its distinct (kind, label): each is independent evidence."""
    weight = {"base": 0.5, "name": 0.4, "notice": 0.8, "expression": 0.9}
    doubt = 1.0
    for kind, _ in sorted(kinds):
        doubt *= 1.0 - weight[kind]
    return round(1.0 - doubt, 9)
