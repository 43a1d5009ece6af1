"""How filters act on each other: what each removes, at every place of every order.

Each row gets a mask of the filters that it fails. Rows are counted by part and mask, at most
32 cells a part, each with its numbers of rows, of good and of toxic rows. A walk through the
32 subsets of filters in Gray-code order toggles one filter a step: each cell holds how many
of the filters now on it fails, and joins or leaves the running survivors where that number
becomes 0 or ceases to be. The survivors of all 32 subsets are kept; what a filter removes
after others is the difference of two of them, so none of the 120 orders is run.

Filters, over words ``[^\\x20\\x09-\\x0D]+``: A under ``min_words`` words; B distinct words
under ``distinct_percent`` of the words; C capitals A-Z over ``capital_percent`` of the code
points; D any of ``#$%&*|``; E a row with the same text and a smaller doc_id exists, wherever.

Failures are found by DataFrame functions; texts are not shuffled but their SHA-256. Rows are
counted by text, id and part before anything is gathered by text, so a text that a third of
all rows hold costs a row per task, and labels meet an id once for each of its texts and
parts. The walk runs per part on 32 cells.

Defined results: null texts are empty; empty texts fail A alone, and E where another empty
text has a smaller id. A null doc_id is smaller than none and none is smaller than it, so its
row never fails E. Rows that repeat an id and a text are as small as each other, and count
each. A label that an id has in any of its rows holds; labels without quality or toxicity
count as neither. A null lang is the part ''. Very long texts stay in their task. Only doc_id,
text, lang, quality and toxic are read, so further columns cannot clash. Parts are those of
the documents; an empty table gives no rows, empty labels no good or toxic ones.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import UPPER, let, words

FILTERS = "ABCDE"
SIGNS = "[#$%&*|]"
COUNTS = ["n", "good", "toxic"]
SCHEMA = """part string, filter_order string, step int, kept long, removed long, redundant long,
    unique_fails long, good_lost long, toxic_lost long, shapley long"""


def own_failures(text: Column, min_words: int, distinct_percent: int, capital_percent: int) -> Column:
    """The mask of the filters A to D, which look at the text alone: A is bit 0."""
    text = F.coalesce(text, F.lit(""))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))

    def by_words(w: Column) -> Column:
        few = F.size(w) < min_words
        same = 100 * F.size(F.array_distinct(w)) < distinct_percent * F.size(w)
        return few.cast("int") + 2 * same.cast("int")

    loud = 100 * capitals.cast("long") > capital_percent * F.length(text)
    return let(words(text), by_words) + 4 * loud.cast("int") + 8 * text.rlike(SIGNS).cast("int")


def mask_cells(docs: DataFrame, labels: DataFrame, min_words: int = 200, distinct_percent: int = 50, capital_percent: int = 3) -> DataFrame:
    """(part, mask, n, good, toxic): rows by the set of filters that they fail."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        own_failures(text, min_words, distinct_percent, capital_percent).alias("mask"),
    )
    rows = rows.groupBy("digest", "mask", "doc_id", "part").agg(F.count("*").alias("n"))
    marked = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0))
    marks = labels.filter("quality = 1 or toxic = 1").groupBy(F.col("doc_id").alias("of"))
    marks = marks.agg(marked("quality").alias("good"), marked("toxic").alias("toxic"))
    rows = rows.join(marks, F.col("doc_id") == F.col("of"), "left").fillna(0, ["good", "toxic"])

    # Of a text's rows those with its smallest id pass E, and those without an id.
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    no_id = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0))
    by_text = rows.groupBy("digest", "mask", "part", "good", "toxic").agg(F.sum("n").alias("n"), first.alias("first"), no_id.alias("no_id"))
    # A text's cells differ by part and labels only; the smallest id of each text is taken from them.
    least = by_text.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    by_text = by_text.join(least, "digest")
    unlike = F.col("no_id") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.explode(F.array(F.struct(unlike.alias("n"), F.lit(0).alias("e")), F.struct((F.col("n") - unlike).alias("n"), F.lit(16).alias("e"))))
    cells = by_text.select("part", "mask", "good", "toxic", split.alias("s")).filter("s.n > 0")
    sums = [F.sum("s.n").alias("n"), F.sum(F.col("s.n") * F.col("good")).alias("good"), F.sum(F.col("s.n") * F.col("toxic")).alias("toxic")]
    return cells.groupBy("part", (F.col("mask") + F.col("s.e")).alias("mask")).agg(*sums)


def survivors(masks: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts of the cells that fail none of a subset's filters, for each of the subsets.

    Subsets are met in Gray-code order, so that each differs from the one before in one filter.
    """
    n = len(FILTERS)
    states = np.zeros((1 << n, counts.shape[1]), np.int64)
    failing, alive, subset = np.zeros(len(masks), np.int64), counts.sum(axis=0), 0
    states[0] = alive
    for turn in range(1, 1 << n):
        bit = (turn & -turn).bit_length() - 1
        subset ^= 1 << bit
        hit = (masks >> bit) & 1 == 1
        if subset >> bit & 1:
            failing[hit] += 1
            alive = alive - counts[hit & (failing == 1)].sum(axis=0)
        else:
            failing[hit] -= 1
            alive = alive + counts[hit & (failing == 0)].sum(axis=0)
        states[subset] = alive
    return states


def audit(states: np.ndarray) -> list[tuple]:
    """A row for each order and step: the order, the step, and its numbers."""
    n, everything = len(FILTERS), len(states) - 1
    removed = lambda before, f: states[before] - states[before | 1 << f]
    failed = [int(removed(0, f)[0]) for f in range(n)]
    unique = [int(removed(everything ^ 1 << f, f)[0]) for f in range(n)]
    # A subset stands before a filter in as many orders as it and the rest can be arranged.
    ways = lambda s: factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())
    shapley = [sum(ways(s) * int(removed(s, f)[0]) for s in range(len(states)) if not s >> f & 1) for f in range(n)]
    rows = []
    for order in permutations(range(n)):
        name, before = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order, 1):
            gone, good, toxic = map(int, removed(before, f))
            before |= 1 << f
            rows.append((name, step, int(states[before][0]), gone, failed[f] - gone, unique[f], good, toxic, shapley[f]))
    return rows


def _walk(cells: pd.DataFrame) -> pd.DataFrame:
    found = audit(survivors(cells["mask"].to_numpy(np.int64), cells[COUNTS].to_numpy(np.int64)))
    columns = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    out = pd.DataFrame(found, columns=columns)
    out.insert(0, "part", cells["part"].iloc[0])
    return out


def filter_audit(docs: DataFrame, labels: DataFrame, min_words: int = 200, distinct_percent: int = 50, capital_percent: int = 3) -> DataFrame:
    """A row per part, order of the filters, and step; see the module."""
    cells = mask_cells(docs, labels, min_words, distinct_percent, capital_percent)
    return cells.groupBy("part").applyInPandas(_walk, SCHEMA)
