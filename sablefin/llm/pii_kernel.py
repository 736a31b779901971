"""Personal data patterns and their contexts (no Spark here). Positions are code points."""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import xxhash

KINDS = ("email", "ip", "card", "phone")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only begin where a run of digits begins, and no shorter run could succeed where the
# whole one fails, so the possessive forms find what the plain ones do, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0d]+")
_EDGE = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


def emails(text: str):
    """Leftmost non-overlapping matches of local part, @, dotted domain.

    The local part of a match is the whole run of its characters before the @, back to the last match:
    found from the @, which keeps a long run without one from being tried at each of its characters.
    """
    done = at = 0
    while m := _AT.search(text, at):
        a = m.start()
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        if a < m.start():
            yield a, m.end()
            done = at = m.end()
        else:
            at = m.start() + 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end), sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def signed(value: str) -> int:
    h = xxhash.xxh64_intdigest(value.encode())
    return h - (1 << 64) if h >> 63 else h


def term(word: str) -> str:
    """A word as the corpus counts it: lower case, without ASCII marks at its ends."""
    return word.strip(_EDGE).lower()


def contexts(text: str, spans: list[tuple[int, int, int]], width: int, reach: int, least: int):
    """(entity, term, start, end, window) for the words near each span.

    Near are the ``width`` words on each side that lie wholly within ``reach`` characters and touch no
    span. ``window`` is a hash of all of them, so that copies of a passage can be told from fresh evidence.
    """
    starts = [x for x, _, _ in spans]
    reached = list(accumulate((f for _, _, f in spans), max))  # furthest end of the spans so far
    for s, _, e in spans:
        near = []
        for low, high, left in ((max(0, s - reach), s, True), (e, min(len(text), e + reach), False)):
            found = [(low + m.start(), low + m.end()) for m in _WORD.finditer(text[low:high])]
            if left and found and found[0][0] == low > 0:
                found = found[1:]
            if not left and found and found[-1][1] == high < len(text):
                found = found[:-1]
            near += found[-width:] if left else found[:width]
        # a span touches a word if, of those that start before its end, one ends after its start
        clear = [(a, b) for a, b in near if not ((k := bisect_left(starts, b)) and reached[k - 1] > a)]
        window = signed(" ".join(term(text[a:b]) for a, b in clear))
        who = signed(text[s:e].lower())
        for a, b in clear:
            word = text[a:b]
            inner = word.strip(_EDGE)
            if len(inner) >= least:
                at = a + word.index(inner)
                yield who, inner.lower(), at, at + len(inner), window


def log2_bits(terms: int) -> int:
    """About 16 bits a term, from 128 kB to 16 MB."""
    return min(max((16 * max(terms, 1) - 1).bit_length(), 20), 27)


class Bloom:
    """Bits that say which terms can't be candidates; a term has two places by XXH64 with seed 42, as Spark hashes."""

    def __init__(self, log2_bits: int, words: list[tuple[int, int]]) -> None:
        self.mask, self.bits = (1 << log2_bits) - 1, bytearray(1 << (log2_bits - 3))
        for w, x in words:
            self.bits[8 * w : 8 * w + 8] = (x & (1 << 64) - 1).to_bytes(8, "little")

    def __contains__(self, t: str) -> bool:
        h = xxhash.xxh64_intdigest(t.encode(), 42)
        a, b = h & self.mask, h >> 32 & self.mask
        return bool(self.bits[a >> 3] >> (a & 7) & 1 and self.bits[b >> 3] >> (b & 7) & 1)
