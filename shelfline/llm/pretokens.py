"""Cutting texts where the split pattern of byte-level vocabularies always cuts."""

from __future__ import annotations

import re

#: White space other than space and line feed, in Unicode's sense or Python's.
RARE_SPACE = re.compile("[\\t\\x0b-\\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def chunks(text: str) -> list[str]:
    """Pieces whose concatenation is the text, each cut a boundary of the split pattern.

    A space between two characters that are no white space always begins a match: no
    alternative of the pattern holds a space after another character but runs of white
    space. So a text is cut before every such space. Most chunks are words, which recur.
    """
    first, rest = after_spaces(text)
    return [first, *[" " + p for p in rest]] if first or rest else []


def after_spaces(text: str) -> tuple[str, list[str]]:
    """The first of these pieces, and each later one without the space that it begins with."""
    parts = text.split(" ")
    if "" not in parts and "\n " not in text and " \n" not in text and not RARE_SPACE.search(text):
        return parts[0], parts[1:]
    out, now = [], parts[0]
    for p in parts[1:]:
        if now and p and not now[-1].isspace() and not p[0].isspace():
            out.append(now)
            now = p
        else:
            now += " " + p
    out.append(now)
    return out[0], out[1:]


def of_worker(key: str, make):
    """``make()``, kept by the Python process for later tasks of the same job or another."""
    import sys
    import types

    kept = vars(sys.modules.setdefault("_shelfline_llm_worker", types.ModuleType("_shelfline_llm_worker")))
    if key not in kept:
        kept[key] = make()
    return kept[key]


class ChunkIds(dict):
    """Chunk to its ids, packed as little-endian 32-bit integers.

    A chunk that is not held is encoded when asked for. Up to ``limit`` short chunks are
    kept; as words recur, the first ones met are most of the frequent ones.
    """

    def __init__(self, encode, limit: int = 500_000):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, chunk: str) -> bytes:
        import numpy as np

        packed = np.asarray(self.encode(chunk), "<u4").tobytes()
        self.keep(chunk, packed)
        return packed

    def keep(self, chunk: str, packed: bytes) -> None:
        if len(self) < self.limit and len(chunk) <= 64:
            self[chunk] = packed

    def text(self, text: str | None) -> bytes:
        """The packed ids of a text."""
        return b"".join(map(self.__getitem__, chunks(text))) if text else b""
