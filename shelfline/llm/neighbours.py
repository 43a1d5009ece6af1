"""Approximate nearest neighbours with a hash-prefix forest.

Each of ``trees`` trees gives a vector a hash string of ``bits`` bits, the signs of its
products with random directions, and keeps the strings in a sorted array, where vectors that
share a prefix lie side by side. A query descends in all trees at once to the longest prefix
that any tree shares with it, and then ascends, one bit in all trees at a time, until the
vectors under its prefixes number ``share`` of the forest (``least`` at least). These are
measured exactly, in double precision. Equal vectors count as one.

Hash strings see the angle alone, the inner product also the length. So the vectors of a block
are parted into bands of similar length with a forest each; a band of up to ``least`` vectors
is measured whole. Longer vectors are near at wider angles, and more of them are looked at:
``share`` grows with the square of their length against the middle length of the block.

Vectors are dealt to blocks of about ``block`` rows by a hash, each with a forest of its own,
and queries to groups of about ``block``. Every group meets every block in one task, which
returns the ``k`` nearest it found; these are merged by query. A task's memory is bounded by
the block size, the shuffle by ``k`` rows per query and block. Directions come from a seed,
so the index needs no fitting and reruns agree.

Recall depends on the data. Random directions without any structure in 64 dimensions are the
hardest case; the defaults are set for it, and structured vectors need a smaller share.

Defined results: vectors that are null, empty, zero or hold null or non-finite components,
and rows with a null id, take no part. Vectors of another length than a query's are no
candidates for it. Ties go to the smaller id; equal vectors have equal scores. A query's own
id is no candidate, so repeated rows of an id never meet; each repeated query row counts
once, and a candidate id once, with its best score. Only the id and vector columns are read.
Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import staged


#: Each band of lengths begins at this part of the one before; the last holds all shorter ones.
BAND, BANDS = 0.8, 12


class Forest:
    """Sorted arrays of hash strings over the rows of a matrix."""

    def __init__(self, x: np.ndarray, trees: int, bits: int, seed: int):
        random = np.random.default_rng(seed)
        self.directions = random.standard_normal((trees, x.shape[1], bits))
        self.bits = bits
        codes = self.codes(x)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """One hash string per tree and row, its first bit the highest."""
        weights = (np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64))[None, :]
        return np.stack([((x @ d > 0) * weights).sum(axis=1, dtype=np.uint64) for d in self.directions])

    def candidates(self, q: np.ndarray, wanted: int):
        """For each query which rows lie under its prefixes at the first depth that has enough."""
        codes = self.codes(q)
        n = len(q)
        low = np.zeros((len(codes), n), np.int64)
        high = np.full_like(low, self.order.shape[1])
        settled = np.zeros(n, bool)
        for depth in range(self.bits, -1, -1):
            rest = np.flatnonzero(~settled)
            if not len(rest):
                break
            gap = np.uint64(self.bits - depth)
            first = codes[:, rest] >> gap << gap
            last = first | ((np.uint64(1) << gap) - np.uint64(1))
            for t, line in enumerate(self.sorted):
                low[t, rest] = np.searchsorted(line, first[t], "left")
                high[t, rest] = np.searchsorted(line, last[t], "right")
            settled[rest] = (high[:, rest] - low[:, rest]).sum(axis=0) >= wanted
        for i in range(n):
            seen = np.zeros(self.order.shape[1], bool)
            for t, line in enumerate(self.order):
                seen[line[low[t, i] : high[t, i]]] = True
            yield seen


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of each distinct vector, and for each row the place of its vector among them."""
    rows = np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.shape[1] * x.itemsize))).ravel()
    _, one, copy_of = np.unique(rows, return_index=True, return_inverse=True)
    return one, copy_of.ravel()


def candidates(x: np.ndarray, q: np.ndarray, trees: int, bits: int, share: float, least: int, seed: int):
    """For each query which of the distinct rows are to be measured."""
    lengths = np.maximum(np.linalg.norm(x / np.abs(x).max(), axis=1), 1e-100)
    # Equal lengths may differ in their last bits.
    band = np.minimum(np.floor(np.log(lengths / lengths.max()) / np.log(BAND) + 1e-6), BANDS - 1)
    found = []
    for b in np.unique(band):
        rows = np.flatnonzero(band == b)
        # The count is over trees: a row may be met in several.
        longer = float(np.median(lengths[rows]) / np.median(lengths)) ** 2
        wanted = max(int(share * min(longer, trees) * len(rows)), least)
        small = len(rows) <= least
        found.append((rows, repeat(True) if small else Forest(x[rows], trees, bits, seed).candidates(q, wanted)))
    for _ in range(len(q)):
        seen = np.zeros(len(x), bool)
        for rows, each in found:
            seen[rows] = next(each)
        yield seen


def _search(trees: int, bits: int, share: float, least: int, k: int, seed: int):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(queries) and len(rows):
            queries = queries.drop_duplicates("query_id")
            ids, x = rows["vec_id"].to_numpy(np.int64), np.stack(rows["v"].to_numpy()).astype(float)
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            repeats = bool((ids[1:] == ids[:-1]).any())
            q = np.stack(queries["q"].to_numpy()).astype(float)
            # Equal vectors are one in the forests, and count once.
            one, copy_of = distinct(x)
            for qid, v, seen in zip(queries["query_id"], q, candidates(x[one], q, trees, bits, share, least, seed)):
                at = np.flatnonzero(seen[copy_of])
                at = at[ids[at] != qid]
                if not len(at):
                    continue
                rough = x[at] @ v
                if len(at) > k and not repeats:
                    edge = np.partition(rough, len(at) - k)[len(at) - k]
                    at = at[rough >= edge - 1e-9 * (1 + abs(edge))]
                # Row by row, so that equal vectors get equal sums.
                exact = (x[at] * v).sum(axis=1)
                best = np.lexsort((ids[at], -exact))
                _, once = np.unique(ids[at][best], return_index=True)
                best = best[np.sort(once)][:k]
                out += [(int(qid), int(i), float(s)) for i, s in zip(ids[at][best], exact[best])]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def nearest(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    trees: int = 32,
    bits: int = 32,
    share: float = 0.6,
    least: int = 400,
    block: int = 8192,
    seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found by inner product."""
    v = F.col("v")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    usable = F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, number) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    rows = rows.filter(usable).withColumn("dims", F.size("v"))
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n"), F.sum(is_query(F.col("vec_id")).cast("long")).alias("q"))
    parts = lambda c: F.greatest(F.ceil(F.col(c) / block), F.lit(1)).cast("int")
    sizes = sizes.select("dims", parts("n").alias("blocks"), parts("q").alias("groups"))
    dealt = staged(rows.join(sizes, "dims").withColumn("h", F.xxhash64("vec_id", "v")), "dealt-vectors")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt_rows = dealt.select("dims", "vec_id", "v", F.pmod("h", "blocks").cast("int").alias("block"), each("groups").alias("group"))
    queries = dealt.filter(is_query(F.col("vec_id"))).select(
        F.col("dims").alias("q_dims"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"),
        F.pmod(F.xxhash64("h"), "groups").cast("int").alias("q_group"), each("blocks").alias("q_block"),
    )
    found = queries.groupBy("q_dims", "q_block", "q_group").cogroup(dealt_rows.groupBy("dims", "block", "group")).applyInPandas(
        _search(trees, bits, share, least, k, seed), "query_id long, vec_id long, score double"
    )
    # Rows of an id may differ; the best of them counts.
    found = staged(found, "neighbours").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
