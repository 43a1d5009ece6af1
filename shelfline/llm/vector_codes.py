"""Vectors as one byte a part: codebooks by exact k-means on integers, memoised by grid cells.

Components become ``floor(1024 * x)``. Vectors are cut into four parts; the codebook of a part
starts from the first rows by vec_id. Each round assigns every part to its nearest entry and
moves the entries to the floor of their parts' mean; a last pass gives the codes.

The nearest entry is found through a grid. A part falls into the cell of its components'
slices of ``side``. For a cell met first, each entry's least and greatest distance to the
cell's box are summed up by component; entries whose least distance exceeds the smallest
greatest distance lose everywhere in the box, the others are kept under the cell. Parts in a
known cell, as of copies, take its entries from the memory. Only these are evaluated exactly,
in 64-bit integers, so codes are those of a full search, with ties to the lower entry. The
memory belongs to a task and a round and starts anew beyond ``most_cells`` cells.

Rounds run over a staged table of integer vectors; a task sends one row per part and entry
that it used, at most 4 * 256, whatever its number of vectors. The codebooks, 256 vectors,
are all that reaches the driver and goes out with the next round.

Defined results: vectors that are null or hold null, NaN or infinite components are left out,
as are vectors of another length than most have (of equally many, the longest). Where the
length is no multiple of four the first parts are shorter. With fewer than 256 vectors each is
an entry. Ids that are null come last among the first rows, rows that share an id are ordered
by their components. Integers are held within a bound at which squared distances still fit 64
bits (180,000 in the vector's own scale at 64 components); a sum of errors that does not fit
is null. Null labels are one label. Repeated rows count as often as they occur. Only vec_id,
label and the vector are read, so further columns cannot clash. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import staged

PARTS = 4
ENTRIES = 256
SCALE = 1024


def integers(vector: Column) -> Column:
    """floor(1024 * x) of each component, held where squared distances could overflow."""
    most = F.floor(F.sqrt(F.lit(float(2**63)) / (4 * F.greatest(F.size(vector), F.lit(1)))) - 1)

    def whole(x: Column) -> Column:
        x = x.cast("double") * SCALE
        return F.floor(F.greatest(F.least(x, most.cast("double")), -most.cast("double")))

    return F.transform(vector, whole)


def kept_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, v): finite vectors of the usual length, as integers."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = df.filter(F.col(vector).isNotNull() & finite).select("vec_id", "label", integers(F.col(vector)).alias("v"))
    rows = staged(whole, "integer-vectors")
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.filter(F.size("v") == (usual[0]["d"] if usual else 0))


class Grid:
    """Nearest entries of one codebook, by the entries kept for the grid cells met so far."""

    def __init__(self, book: np.ndarray, side: int, most_cells: int = 50_000, at_once: int = 1 << 18):
        self.book, self.side, self.most, self.at_once = book, side, most_cells, at_once
        self.memory: dict[bytes, np.ndarray] = {}

    def _undominated(self, cells: np.ndarray) -> list[np.ndarray]:
        """Per cell, the entries that may be nearest to a point of its box, ascending."""
        near = np.zeros((len(cells), len(self.book)), np.int64)
        far = np.zeros_like(near)
        for i in range(cells.shape[1]):
            # Cells share the slices of a component, so these are measured once.
            slices, of = np.unique(cells[:, i], return_inverse=True)
            low = slices[:, None] * self.side
            below, above = low - self.book[None, :, i], self.book[None, :, i] - (low + self.side - 1)
            near += (np.maximum(np.maximum(below, above), 0) ** 2)[of]
            far += (np.maximum(-below, -above) ** 2)[of]
        keep = near <= far.min(axis=1)[:, None]
        cell, entry = np.nonzero(keep)
        return np.split(entry, np.searchsorted(cell, np.arange(1, len(cells))))

    def _entries(self, cells: np.ndarray) -> list[np.ndarray]:
        """Per cell its kept entries, from the memory or measured now."""
        names = [c.tobytes() for c in cells]
        found = [self.memory.get(name) for name in names]
        new = [i for i, f in enumerate(found) if f is None]
        step = max(self.at_once // len(self.book), 1)
        for at in range(0, len(new), step):
            some = new[at : at + step]
            if len(self.memory) + len(some) > self.most:
                self.memory.clear()
            for i, entries in zip(some, self._undominated(cells[some])):
                found[i] = self.memory[names[i]] = entries
        return found

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of ``x``."""
        entry, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        if not len(x) or not x.shape[1]:
            return entry, error
        cell = np.ascontiguousarray(x // self.side)
        names = cell.view(np.dtype((np.void, cell.dtype.itemsize * cell.shape[1]))).ravel()
        _, first, of = np.unique(names, return_index=True, return_inverse=True)
        lists = self._entries(cell[first])
        sizes = np.array([len(e) for e in lists])
        flat, starts = np.concatenate(lists), np.cumsum(sizes) - sizes
        pairs = np.cumsum(sizes[of])
        at = 0
        while at < len(x):
            stop = max(int(np.searchsorted(pairs, (pairs[at - 1] if at else 0) + self.at_once)), at + 1)
            own = of[at:stop]
            n = sizes[own]
            begin = np.cumsum(n) - n
            row = np.repeat(np.arange(at, stop), n)
            tried = flat[np.arange(n.sum()) - np.repeat(begin - starts[own], n)]
            apart = ((x[row] - self.book[tried]) ** 2).sum(axis=1)
            least = np.minimum.reduceat(apart, begin)
            # Entries ascend, so the first of the nearest is the lowest.
            best = np.flatnonzero(apart == np.repeat(least, n))
            _, lowest = np.unique(row[best], return_index=True)
            entry[at:stop], error[at:stop] = tried[best[lowest]], least
            at = stop
        return entry, error


def bounds(d: int) -> list[tuple[int, int]]:
    """Where the parts of a vector of ``d`` components begin and end."""
    return [(k * d // PARTS, (k + 1) * d // PARTS) for k in range(PARTS)]


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(batch.num_rows, d)


def _sums(books: list[np.ndarray], d: int, side: int):
    """Per task: part, entry, the number of its parts, and their sums by component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(b, side) for b in books]
        number = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros_like(b) for b in books]
        for batch in batches:
            x = _matrix(batch, d)
            for p, (lo, hi) in enumerate(bounds(d)):
                if not len(x):
                    continue
                entry, _ = grids[p].nearest(x[:, lo:hi])
                order = np.argsort(entry, kind="stable")
                used, begin, n = np.unique(entry[order], return_index=True, return_counts=True)
                number[p][used] += n
                total[p][used] += np.add.reduceat(x[order, lo:hi], begin, axis=0)
        rows = [(p, e, int(n), total[p][e].tolist()) for p in range(PARTS) for e, n in enumerate(number[p]) if n]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SUMS)], names=["part", "entry", "n", "sums"])

    return run


_SUMS = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]


def _codes(books: list[np.ndarray], d: int, side: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(b, side) for b in books]
        for batch in batches:
            x = _matrix(batch, d)
            found = [grid.nearest(x[:, lo:hi]) for grid, (lo, hi) in zip(grids, bounds(d))]
            code = ["".join(f"{e:02x}" for e in entries) for entries in zip(*(e.tolist() for e, _ in found))]
            error = sum(e for _, e in found)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return run


def fit(rows: DataFrame, rounds: int = 4, side: int = 32) -> list[np.ndarray]:
    """The codebooks of the parts, given kept_vectors()."""
    # At most ENTRIES vectors, each task sorting out its own first ones.
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    if not first:
        return []
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), -1)
    d = start.shape[1]
    books = [np.ascontiguousarray(start[:, lo:hi]) for lo, hi in bounds(d)]
    for _ in range(rounds if d else 0):
        parts = rows.select("v").mapInArrow(_sums(books, d, side), "part int, entry int, n long, sums array<long>")
        wide = max(hi - lo for lo, hi in bounds(d))
        sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(wide)]
        # A row per part and entry.
        for r in parts.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():
            book = books[r["part"]]
            book[r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(book.shape[1])]
    return books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    """Of all components as decimal integers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(c) for b in books for c in b.ravel().tolist()).encode()).hexdigest()


def compress(df: DataFrame, rounds: int = 4, side: int = 32, vector: str = "embedding") -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 per kept vector."""
    rows = kept_vectors(df, vector)
    books = fit(rows, rounds, side)
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"
    d = sum(b.shape[1] for b in books)
    coded = staged((rows if books else rows.limit(0)).mapInArrow(_codes(books, d, side), schema), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).drop("of").withColumn("codebooks_sha256", F.lit(codebooks_sha256(books)))
