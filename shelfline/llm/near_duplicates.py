"""MinHash near-duplicates with tensored banding.

Two collections of ``tables_side`` half keys, each of ``half`` MinHash values, are computed
per text. Every pair of an A half and a B half is the key of one table: ``tables_side``
squared tables from ``2 * tables_side`` half keys. Texts that meet in a table are candidates;
a link needs the exact Jaccard similarity of the full shingle sets.

With the default of 24 halves of 4 values, a pair at similarity s is missed in all 576
tables with a probability below 2 * (1 - s**4)**24: 5e-6 at 0.8, 2e-11 at 0.9.

Steps, all over every text:

1. Texts with the same set form a class; the class's first row stands for it. Copies, however
   many, cost one row per task in the aggregation.
2. A table key needs both its halves shared with another class, so halves that only one
   class has are dropped before halves are combined.
3. ``star_rounds`` rounds compare each class with one class that it shares most tables with,
   out of one per table, and join what links into components. This is linear in the table
   entries and closes most tables of near copies.
4. Classes in tables that still hold several components are settled by group, a group being
   all that can be reached through such tables. They are held against what most of the group
   shares, see differences(): those close enough to it are linked for certain, by the bound
   that two full sets differ in no more than both differ from a third. Of the others those
   pairs are compared that differ from the group in enough common shingles, see
   remaining_pairs(). Groups of texts that are alike, but not enough, meet in many tables and
   would otherwise be compared pair by pair. After this step no pair of such classes is left
   that could be linked; there is no cap.

Component ids are the smallest doc_id of the component.

Defined results: a text with fewer words than a shingle has one shingle, its whole sequence;
null, empty and blank texts have none and link with nothing. Rows that share a doc_id and a
set are one class. Null doc_ids take part; a component id is null only if all its ids are.
Only doc_id and text are read, so further columns cannot clash. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import staged, text_hash
from shelfline.llm.components import components
from shelfline.llm.shingles import Hasher, mixed, numbers

SIGNATURE = "n long, d1 long, d2 long, halves array<long>"


def _digest(s: np.ndarray) -> tuple[int, int]:
    """Two sums over the set: equal for equal sets, in 128 bits."""
    one = np.add.reduce(mixed(s + np.uint64(0x51ED270B)))
    two = np.add.reduce(mixed(s ^ np.uint64(0x2545F4914F6CDD1D)))
    return int(np.uint64(one).view(np.int64)), int(np.uint64(two).view(np.int64))


def _signature(size: int, half: int, side: int):
    @F.pandas_udf(SIGNATURE)
    def signature(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hasher, factors = Hasher(), numbers(2 * side * half, 3)[:, None] | np.uint64(1)
        weights = (numbers(half, 4) | np.uint64(1))[None, :]
        for texts in batches:
            rows = []
            for text in texts:
                s = hasher.shingles(text, size)
                if not len(s):
                    rows.append((0, 0, 0, None))
                    continue
                least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(s), 2048):
                    np.minimum(least, (factors * s[None, at : at + 2048]).min(axis=1), out=least)
                halves = mixed((mixed(least).reshape(-1, half) * weights).sum(axis=1, dtype=np.uint64))
                rows.append((len(s), *_digest(s), halves.view(np.int64)))
            yield pd.DataFrame(rows, columns=["n", "d1", "d2", "halves"])

    return signature


def signatures(docs: DataFrame, shingle: int, half: int, tables_side: int, key: Column | None = None) -> DataFrame:
    """Per row: doc_id, set size, set digest, half keys (A's, then B's), a row number, and ``key``."""
    key = text_hash() if key is None else key
    found = docs.select(F.col("doc_id").cast("long"), text_hash().alias("text_hash"), key.alias("row_key"), _signature(shingle, half, tables_side)(F.col("text").cast("string")).alias("s"))
    return staged(found.select("doc_id", "text_hash", "row_key", "s.*", F.monotonically_increasing_id().alias("row")), "signatures")


def table_entries(classes: DataFrame, tables_side: int) -> DataFrame:
    """(key, node): the tables in which at least two classes meet."""
    halves = classes.select("node", F.posexplode("halves").alias("place", "half"))
    shared = staged(halves.groupBy("place", "half").agg(F.count("*").alias("n")).filter("n > 1").select("place", "half"), "halves")
    held = halves.join(shared, ["place", "half"]).groupBy("node").agg(F.collect_list(F.struct("place", "half")).alias("h"))
    side = lambda first: F.filter("h", lambda x: (x["place"] < tables_side) == F.lit(first))
    keys = held.select("node", F.explode(side(True)).alias("x"), side(False).alias("ys")).select("node", "x", F.explode("ys").alias("y"))
    keys = staged(keys.select(F.xxhash64("x.place", "y.place", "x.half", "y.half").alias("key"), "node"), "keys")
    met = staged(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "met")
    return staged(keys.join(met, "key"), "tables")


def _sets(size: int):
    def run(batches):
        hasher = Hasher()
        for pdf in batches:
            rows = []
            for node, d1, d2, text in zip(pdf["node"], pdf["d1"], pdf["d2"], pdf["text"]):
                s = hasher.shingles(text, size)
                if _digest(s) == (d1, d2):
                    rows.append((node, s.view(np.int64)))
            yield pd.DataFrame(rows, columns=["node", "set"])

    return run


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) whose full sets reach the similarity."""

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        found = []
        for u, v in zip(x, y):
            u, v = u.view(np.uint64), v.view(np.uint64)
            if len(u) > len(v):
                u, v = v, u
            at = np.searchsorted(v, u)
            at[at == len(v)] = 0
            both = int((v[at] == u).sum())
            found.append(100 * both >= percent * (len(u) + len(v) - both))
        return pd.Series(found, dtype=bool)

    left = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"), F.col("n").alias("na"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"), F.col("n").alias("nb"))
    return pairs.join(left, "a").join(right, "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).filter(alike("sa", "sb")).select("a", "b")


def candidate_groups(open_now: DataFrame, rounds: int = 2) -> DataFrame:
    """(node, group): the components of classes that meet in open tables.

    Classes first take the smallest label of their tables, by aggregation alone, so that the
    graph that is left has few different edges also where many classes share many tables.
    """
    entries = open_now.select("key", "node", F.col("node").alias("label"))
    for _ in range(rounds):
        low = entries.groupBy("key").agg(F.min("label").alias("low"))
        heard = entries.join(low, "key").groupBy("node").agg(F.min("low").alias("label"))
        entries = staged(entries.select("key", "node").join(heard, "node"), "entries")
    labels = entries.select("key", "label").distinct()
    edges = labels.join(labels.groupBy("key").agg(F.min("label").alias("low")), "key").filter("label <> low")
    roots = components(edges.select(F.col("label").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "label")
    own = entries.select("node", "label").distinct()
    return own.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("group"))


def differences(open_now: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """What tells the open classes of a candidate group apart, and what needs no telling.

    Classes that can be reached from each other through tables are a group. Its middle holds
    the shingles that more than half of its classes hold; a class differs from the middle by
    d shingles, which it has more or less. Two classes differ in d + d' shingles at most, so
    one whose d is small against its size is linked with the group's most central class
    without a comparison, however many there are.

    Returns (a, b), those links, and (group, node, root, n, d, slack, most, near, diff): the
    classes with their differences; ``near`` holds for those that are linked with the central
    class, ``slack`` is by how much d is below what would link two classes of equal slack.
    """
    groups = candidate_groups(open_now)
    members = open_now.select("node", "root").distinct().join(groups, "node")
    held = staged(members.join(sets, "node"), "open-sets")
    size = held.groupBy("group").agg(F.count("*").alias("members"))
    common = held.select("group", F.explode("set").alias("token")).groupBy("group", "token").agg(F.count("*").alias("c"))
    # More than half hold each, so there are at most twice as many as an average class has.
    # Groups have two classes or more, so one class alone is no majority.
    middle = common.filter("c > 1").join(size, "group").filter("2 * c > members").groupBy("group").agg(F.collect_list("token").alias("middle"))
    apart = F.concat(F.array_except("set", "middle"), F.array_except("middle", "set"))
    told = held.join(middle, "group", "left").withColumn("middle", F.coalesce("middle", F.array().cast("array<long>")))
    told = told.select("group", "node", "root", "n", apart.alias("diff")).withColumn("d", F.size("diff").cast("long"))
    told = staged(told.withColumn("slack", (100 - percent) * F.col("n") - (100 + percent) * F.col("d")), "differences")
    centre = told.groupBy("group").agg(F.max(F.struct("slack", "node")).alias("centre"))
    told = told.join(centre, "group").withColumn("most", F.col("centre.slack")).withColumn("near", F.col("slack") + F.col("centre.slack") >= 0)
    links = told.filter("near and node <> centre.node").select(F.col("node").alias("a"), F.col("centre.node").alias("b"))
    return links, told.drop("centre")


def remaining_pairs(told: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of a group that can still reach the similarity.

    Exact. If two classes are not linked through the centre, their differences from the middle
    must overlap, by t = ((100 + percent) * (d + d') - (100 - percent) * (n + n')) /
    (2 * (100 + percent)) shingles at least. What a whole group shares is in no difference, so
    texts that are alike, but not enough, meet only where they are unlike the rest in the same
    way. Differences have one order, rare ones first: the first common one of two similar
    classes lies so early in both that as many as t follow. Only early ones are joined, and
    only where the places allow for t. Differences that one component holds alone are left
    out.
    """
    unit = 2 * (100 + percent)
    spread = told.withColumn("side", F.when(F.col("near"), F.lit(-1)).otherwise(F.col("root"))).select("*", F.explode("diff").alias("token")).drop("diff")
    ends = [f(c).alias(f"{c}_{name}") for c in ("side", "root") for name, f in (("low", F.min), ("high", F.max))]
    counts = spread.groupBy("group", "token").agg(F.count("*").alias("c"), *ends)
    counts = counts.select("group", "token", "c", ((F.col("side_low") < F.col("side_high")) & (F.col("root_low") < F.col("root_high"))).alias("mixed"))
    # The partner of a class near the centre is not near it, that of another as near as any.
    least = F.when(F.col("near"), F.col("most") - F.col("slack")).otherwise(-F.col("slack") - F.col("most"))
    least = F.greatest(F.lit(1), F.ceil(least / unit))
    place = F.row_number().over(Window.partitionBy("node").orderBy("c", "token")) - 1
    early = spread.join(counts, ["group", "token"]).withColumn("p", place).filter("mixed").filter(F.col("p") <= F.col("d") - least)
    early = staged(early.select("group", "token", "node", "root", "n", "d", "slack", "near", "p"), "early-differences")
    other = early.select("group", "token", *(F.col(c).alias(f"o_{c}") for c in ("node", "root", "n", "d", "slack", "near", "p")))
    t = F.greatest(F.lit(1), F.ceil(-(F.col("slack") + F.col("o_slack")) / unit))
    fits = (
        (F.col("node") < F.col("o_node")) & (F.col("root") != F.col("o_root")) & ~(F.col("near") & F.col("o_near"))
        & (100 * F.least("n", "o_n") >= percent * F.greatest("n", "o_n"))
        & (F.least(F.col("d") - F.col("p"), F.col("o_d") - F.col("o_p")) >= t)
    )
    met = early.alias("e").join(other.alias("o"), (F.col("e.group") == F.col("o.group")) & (F.col("e.token") == F.col("o.token")) & fits)
    return met.select(F.col("node").alias("a"), F.col("o_node").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    half: int = 4,
    tables_side: int = 24,
    star_rounds: int = 1,
    key: Column | None = None,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, row, first (the row to keep), and
    row_key, the value of ``key`` or a hash of the text.

    ``first`` holds for one row of each component, that with the smallest doc_id, the first
    of equal ones.
    """
    rows = signatures(docs, shingle, half, tables_side, key)
    by_set = ["n", "d1", "d2"]
    classes = staged(
        rows.filter("n > 0").groupBy(by_set).agg(F.min(F.struct("row", "doc_id", "text_hash", "halves")).alias("one")).select(
            *by_set, F.col("one.row").alias("node"), F.col("one.doc_id").alias("doc_id"), F.col("one.text_hash").alias("text_hash"), F.col("one.halves").alias("halves")
        ),
        "classes",
    )
    tables = table_entries(classes, tables_side)
    links = staged(_links(docs, classes, tables, shingle, percent, star_rounds), "links")
    roots = staged(
        classes.join(links, "node", "left").select(*by_set, F.coalesce("root", "node").alias("root")), "roots"
    )
    members = staged(rows.filter("n > 0").join(roots, by_set).select("doc_id", "row_key", "n", "row", "root"), "members")
    heads = staged(members.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("head")), "heads")
    grouped = members.join(heads, "root").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("head.doc_id").alias("component_id"), "row", (F.col("row") == F.col("head.row")).alias("first"), "row_key"
    )
    alone = rows.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), "row", F.lit(True).alias("first"), "row_key")
    return grouped.union(alone)


def _links(docs, classes, tables, shingle, percent, star_rounds) -> DataFrame:
    """(node, root) of all classes that link with another."""
    spark = docs.sparkSession
    none = spark.createDataFrame([], "node long, root long")
    if tables.isEmpty():
        return none
    # The full sets of the classes that meet another, computed again from their texts.
    met = classes.join(tables.select("node").distinct(), "node").select("node", "doc_id", "text_hash", "n", "d1", "d2")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_hash().alias("hash"), F.col("text").cast("string"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    found = texts.join(met, same).select("node", "d1", "d2", "text").mapInPandas(_sets(shingle), "node long, set array<long>")
    # Rows that share a doc_id and a text give a set more than once.
    sets = staged(found, "found-sets").groupBy("node").agg(F.first("set").alias("set"))
    sets = staged(sets.withColumn("n", F.size("set").cast("long")), "sets")
    roots = none
    for turn in range(star_rounds + 1):
        now = tables.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        spread = now.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        spread = staged(spread.filter("low < high").select("key"), "open-keys")
        if spread.isEmpty():
            break
        open_now = staged(now.join(spread, "key"), "open")
        if turn < star_rounds:
            edges = staged(linked(_to_centres(open_now, turn), sets, percent), "edges")
        else:
            near, told = differences(open_now, sets, percent)
            told = staged(told, "told")
            edges = staged(near.union(linked(remaining_pairs(told, percent), sets, percent)), "edges")
        if not edges.isEmpty():
            roots = staged(_merged(edges, roots), "roots")
    return roots


def _to_centres(open_now: DataFrame, turn: int) -> DataFrame:
    """(a, b): each open class with that centre of another component that it meets most often.

    Every table has one of its classes for a centre, another one each turn.
    """
    centre = [F.min, F.max, lambda c: F.min_by(c, F.xxhash64(c))][turn % 3]
    centres = staged(open_now.groupBy("key").agg(centre(F.struct("node", "root")).alias("c")), "centres")
    met = open_now.join(centres, "key").filter("root <> c.root").groupBy("node", F.col("c.node").alias("b")).agg(F.count("*").alias("n"))
    return met.groupBy(F.col("node").alias("a")).agg(F.max_by("b", F.struct("n", "b")).alias("b"))


def _merged(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``roots`` after joining what ``edges`` links: components of the graph of old roots."""
    for side in ("a", "b"):
        old = roots.select(F.col("node").alias(side), F.col("root").alias("r"))
        edges = edges.join(old, side, "left").withColumn(side, F.coalesce("r", side)).drop("r")
    joined = staged(components(edges), "joined")
    moved = joined.select(F.col("node").alias("root"), F.col("root").alias("to"))
    known = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    new = joined.join(roots.select("node"), "node", "left_anti")
    return known.union(new)
