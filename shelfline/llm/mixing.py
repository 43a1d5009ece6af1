"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document has an exponential key, -ln(u) / w: u is uniform and fixed by a hash of the
document's id and text and the seed, w its quality weight. Within a source, documents in ascending
key order are a weighted sample without replacement of any size. A source's target is met
by complete epochs first; what is left is taken in key order up to the budget.

Order statistics are taken in two steps so that no source is sorted whole: the keys are cut
into ``bins`` ranges whose sums show in which range the budget ends; ranges below it are
taken entirely, and only the range that holds the end is sorted and summed row by row. A
source that holds a third of all rows sorts one ``bins``-th of them. Built of DataFrame
functions only; the text is read once and a few numbers per row are written to the shared
folder.

Targets: source i may hold ``cap`` times its size at most. The level L with
sum(min(cap_i, L * weight_i)) = share * total is found by sorting sources by cap per weight.
The document on which a budget ends is taken if that comes nearer to it.

Defined results: null texts have size 0 and are never taken; a null source is a source of its
own, last in order; a source without words has target 0. Equal keys are ordered by id and
size; rows equal in all that count the same whichever is taken. Only doc_id, text and the
source column are read, so further columns cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import let, staged, text_hash, words

PLAIN = "#*$%&|<>0123456789"


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """In (0, 1), fixed by the id, the text and the seed: 52 bits of an MD5 digest.

    The text spreads rows that share an id, or have none, over all keys.
    """
    parts = [F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("")) for c in (doc_id, text))]
    digest = F.md5(F.concat_ws(":", *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def measured(text: Column) -> Column:
    """A struct of size, the number of words, and distinct, that of different ones."""
    return let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("size"), F.size(F.array_distinct(w)).alias("distinct")))


def quality_weight(text: Column, measures: Column) -> Column:
    """Share of the characters that are neither digits nor symbols, times the root of the share
    of words that differ: texts that repeat themselves weigh less. 0.05 at least."""
    share = F.length(F.translate(text, PLAIN, "")).cast("double") / F.greatest(F.length(text), F.lit(1))
    own = F.sqrt(measures["distinct"].cast("double") / F.greatest(measures["size"], F.lit(1)))
    return F.coalesce(F.greatest(share * own, F.lit(0.05)), F.lit(0.05))


def targets(sizes: DataFrame, weights: list[int], share_percent: int, cap: int) -> DataFrame:
    """(source, source_size, target): one row per source, so windows over all of them are small."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("at", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int")).cast("long")
    )
    by_cap = Window.orderBy(F.col("limit") / F.col("weight"), "at")
    rows = rows.withColumn("limit", cap * F.col("source_size"))
    everything = Window.partitionBy()
    rows = (
        rows.withColumn("wanted", F.sum("source_size").over(everything) * share_percent / 100)
        .withColumn("spent", F.sum("limit").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("heavy", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("wanted") - F.coalesce("spent", F.lit(0))) / F.col("heavy"))
        # The level of the first source that it doesn't fill holds for all.
        .withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct(F.col("limit") / F.col("weight"), "at", "level"))).over(everything)["level"])
    )
    even = F.col("level") * F.col("weight")
    return rows.select("source", "source_size", F.when(F.col("level").isNull() | (even >= F.col("limit")), F.col("limit").cast("double")).otherwise(even).alias("target"))


def mix(
    docs: DataFrame,
    source: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share_percent: int = 150,
    cap: int = 2,
    seed: int = 7,
    bins: int = 65_536,
    key: Column | None = None,
) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, taken, copies, and
    row_key, the value of ``key`` or a hash of the text."""
    own = text_hash() if key is None else key
    rows = docs.select("doc_id", "text", own.alias("row_key"), F.col(source).alias("source"), F.explode(F.array(measured(F.col("text")))).alias("m"))
    drawn = -F.log(uniform(F.col("doc_id"), F.col("text"), seed)) / quality_weight(F.col("text"), F.col("m"))
    rows = rows.select("doc_id", "row_key", "source", "m.size", drawn.alias("key"))
    # 1 - exp(-key) lies in [0, 1) and grows with the key.
    rows = staged(rows.withColumn("bin", F.least(F.floor((1 - F.exp(-F.col("key"))) * bins), F.lit(bins - 1))), "sizes")
    summed = staged(rows.groupBy("source", "bin").agg(F.sum("size").alias("held")), "bins")
    goals = targets(summed.groupBy("source").agg(F.sum("held").alias("source_size")), list(weights), share_percent, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = staged(goals.withColumn("epochs", epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "goals")
    # The range in which a source's budget ends, and what lies before it.
    upto = F.sum("held").over(Window.partitionBy("source").orderBy("bin"))
    ranges = summed.withColumn("before", upto - F.col("held"))
    g, r = goals.alias("g"), ranges.alias("r")
    ends = r.join(g, F.col("r.source").eqNullSafe(F.col("g.source"))).filter("r.before <= g.budget").groupBy("r.source").agg(F.max(F.struct("r.bin", "r.before")).alias("end"))
    e = ends.select(F.col("source").alias("of"), F.col("end.bin").alias("end"), F.col("end.before").alias("before"))
    plan = staged(goals.join(e, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumnRenamed("source", "name"), "plan")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    last = joined.filter("bin = `end`")
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    last = last.withColumn("chosen", F.col("before") + running + F.col("size") / 2 <= F.col("budget"))
    rest = joined.filter("bin <> `end`").withColumn("chosen", F.col("bin") < F.col("end"))
    copies = F.col("epochs") + F.when(F.col("chosen"), 1).otherwise(0)
    return rest.unionByName(last).withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("int")).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", "row_key"
    )
