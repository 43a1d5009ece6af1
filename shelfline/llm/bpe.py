"""Byte-level BPE encoding by monoid tree reduction, and decoding.

The tokens of a byte string form a monoid: the tokens of two neighbours are joined by
encoding a window around their border again, growing the window until the tokens outside it
are settled. A sequence of tokens is the encoding of its bytes exactly if every two
neighbours encode, together, to themselves; so a window is wide enough as soon as its first
and last token are settled with the tokens beside it, and no token further away can change.
A piece is encoded by halves down to short leaves and joined upwards. Pieces, the matches of
the split pattern, never merge with each other: joining them is concatenation, and so is
decoding, from tokens to pieces to texts.

Words recur: their ids are looked up in a table of bounded size, kept by a Python worker. Very long pieces cost about n log n.

Defined results: null and empty texts have no tokens. Texts are encoded row by row, so
repeated rows get equal results and further columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.pretokens import ChunkIds, of_worker

CACHE = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Monoid:
    """Token lists of byte strings, and how to join them."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = 6):
        self.ranks, self.leaf = ranks, leaf
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.leaves: dict[bytes, list[bytes]] = {}
        self.pairs: dict[tuple[bytes, bytes], list[bytes]] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """Merge the neighbours of lowest rank, leftmost first, until none is left."""
        if len(data) > 64:
            return self._merged_long(data)
        parts, rank = [data[i : i + 1] for i in range(len(data))], self.ranks.get
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merged_long(self, data: bytes) -> list[bytes]:
        """The same with a heap of pairs over a linked list."""
        n, rank = len(data), self.ranks.get
        parts: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, data[i : i + 2]) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or parts[j] is None or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j], after[i] = both, None, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    pair = parts[k] + parts[after[k]]
                    if (r := rank(pair)) is not None:
                        heapq.heappush(heap, (r, k, pair))
        return [p for p in parts if p is not None]

    def _leaf(self, data: bytes) -> list[bytes]:
        found = self.leaves.get(data)
        if found is None:
            found = self.merged(data)
            if len(self.leaves) < CACHE:
                self.leaves[data] = found
        return found

    def _pair(self, a: bytes, b: bytes) -> list[bytes]:
        """The tokens of two tokens side by side; the two themselves if they are settled."""
        found = self.pairs.get((a, b))
        if found is None:
            found = self.merged(a + b)
            if len(self.pairs) < CACHE:
                self.pairs[(a, b)] = found
        return found

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The tokens of the concatenation."""
        if not left or not right:
            return left or right
        i, j, step = len(left) - 1, 1, 1
        middle = self._pair(left[-1], right[0])
        while True:
            low = i == 0 or self._pair(left[i - 1], middle[0]) == [left[i - 1], middle[0]]
            high = j == len(right) or self._pair(middle[-1], right[j]) == [middle[-1], right[j]]
            if low and high:
                return left[:i] + middle + right[j:]
            i, j = (i if low else max(i - step, 0)), (j if high else min(j + step, len(right)))
            step *= 2
            middle = self.merged(b"".join(left[i:]) + b"".join(right[:j]))

    def encode(self, data: bytes) -> list[bytes]:
        if len(data) <= self.leaf:
            return self._leaf(data) if data else []
        middle = len(data) // 2
        return self.join(self.encode(data[:middle]), self.encode(data[middle:]))

    def ids(self, data: bytes) -> list[int]:
        return [self.ranks[t] for t in self.encode(data)]


class TextEncoder:
    """Encodes whole texts: chunks, the matches of the pattern in them, their tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.monoid, self.find = Monoid(ranks), regex.compile(pattern).findall
        self.known = ChunkIds(self.chunk_ids)
        top = max(ranks.values(), default=0) + 1
        self.decimal = [str(i) for i in range(top)]
        self.bytes_of = [self.monoid.bytes_of.get(i, b"") for i in range(top)]

    def chunk_ids(self, chunk: str) -> list[int]:
        # A space and letters are one match of the pattern.
        if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
            return self.monoid.ids(chunk.encode())
        return [i for piece in self.find(chunk) for i in self.monoid.ids(piece.encode())]

    def ids(self, text: str | None) -> list[int]:
        return np.frombuffer(self.known.text(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the tokens, concatenated up the tree."""
        if len(ids) <= 4096:
            return b"".join([self.bytes_of[i] for i in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def tokens(text: Column, spark: SparkSession, ranks: dict[bytes, int], pattern: str, with_ids: bool = False) -> Column:
    """A struct of n_tokens, ids_sha256, decoded_sha256, and ids if asked for."""
    # Broadcast: the vocabulary's size is fixed.
    sent = spark.sparkContext.broadcast(ranks)
    key = f"bpe:{hash((pattern, frozenset(ranks.items())))}"
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    @F.pandas_udf(kind)
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = of_worker(key, lambda: TextEncoder(sent.value, pattern))
        for texts in batches:
            rows = []
            for text in texts:
                ids = encoder.ids(text)
                listed = " ".join([encoder.decimal[i] for i in ids])
                row = (len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest())
                rows.append((*row, ids) if with_ids else row)
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)

    return encoded(text)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row of ``docs``."""
    found = tokens(F.col("text"), docs.sparkSession, ranks, pattern)
    return docs.select("doc_id", found.alias("t")).select("doc_id", "t.*")
