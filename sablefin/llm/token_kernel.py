"""Exact tokenization by memoised pre-tokens (no Spark here).

The vocabulary's pre-tokenizer never joins characters across white space, and letters never join
with punctuation after them, so the ids of a text are the concatenated ids of its parts. Parts
are white-space chunks; ASCII punctuation that ends a chunk after an ASCII letter is its own part
and A-Z are folded beforehand, as the vocabulary's normalizer would, which makes parts repeat more.
Texts that hold the opening of a special string are cut at white space alone. Every distinct part
is given to the library once for as long as the bounded memo holds it.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections import Counter
from functools import lru_cache

import numpy as np

_TAIL = re.compile(rb"(?<=[a-z])([!-&(-/:-@\[-`{-~]+)(?=[\x20\x09-\x0d]|$)")
_LONG = 200
#: Parts a memo holds, about 200 bytes each.
MEMO = 1_000_000


@lru_cache(maxsize=4)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def parts(text: bytes) -> list[bytes]:
    """Pieces of ``text`` (UTF-8) whose tokens in order are the text's tokens."""
    if b"<|" not in text:
        text = _TAIL.sub(rb" \1", text.lower())
    return text.split()


class _Memo(dict):
    """part -> its ids as little-endian bytes; a missing part is encoded when it is asked for."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.encode = load(path).encode_batch_fast

    def __missing__(self, part: bytes) -> bytes:
        ids = array("I", self.encode([part.decode()], add_special_tokens=False)[0].ids)
        if sys.byteorder == "big":
            ids.byteswap()
        found = ids.tobytes()
        if len(part) <= _LONG:
            if len(self) >= MEMO:
                self.clear()
            self[part] = found
        return found


class Encoder:
    """Token ids of texts, each distinct part encoded once while the memo holds it."""

    def __init__(self, path: str) -> None:
        self.memo = _Memo(path)

    def ids(self, text: bytes) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.memo.__getitem__, parts(text))), "<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker process's own encoder: its memo outlives a task."""
    return Encoder(path)


def count_pieces(path: str, some: list[bytes]) -> list[int]:
    got = load(path).encode_batch_fast([p.decode() for p in some], add_special_tokens=False)
    return [len(e.ids) for e in got]


def frequencies(text: bytes) -> Counter:
    return Counter(parts(text))


def pieces(ids: np.ndarray, end_id: int, limit: int):
    """(piece, start, length, crc32) of ``ids`` and ``end_id``, cut at ``limit``."""
    whole = np.append(ids, np.uint32(end_id)).astype("<u4")
    for k, a in enumerate(range(0, len(whole), limit)):
        some = whole[a : a + limit]
        yield k, a, len(some), zlib.crc32(some.tobytes())
