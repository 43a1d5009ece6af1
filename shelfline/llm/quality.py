"""Quality rules with host-level verdicts.

Every text gets its counts and the verdict of the base rules. Failures are then summed by
host (the ``host`` column); each host's failure rate is shrunk towards the corpus by a beta
prior whose two parameters are fitted to the hosts by the method of moments, less what hosts
differ by chance, so that a host of few documents is judged by the corpus rather than by
accident. A host fails as a whole if its shrunk rate exceeds ``max_host_rate``, or if that
rate, less ``sureness`` standard deviations, exceeds ``max_ratio`` times the prior's mean. The
more hosts differ, the less a host's size counts in that mean, so that a bad host with a third
of all rows shields neither itself nor others. The verdict is joined back to its documents.

Built of DataFrame functions only. Texts are read once; the counts are written to the
shared folder. Sums per host are taken before the shuffle, so a host that holds a third of
all rows costs one row per task, and the join back meets one row per host, on which
adaptive execution splits a hot host.

Defined results: null and empty texts have no words and fail the base rules. A null host is
a host of its own. Very long texts are counted whole, each within one row. Repeated rows count as often
as they occur. Only the named columns are read, so further columns cannot clash. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import SPACE, let, staged, words

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


def _repeated(grams: Column) -> Column:
    """Words covered by windows of three that occur twice or more, given the windows' hashes."""
    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda s, x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
    twice = lambda s: F.filter(s, lambda x, j: same(s, x, j - 1) | same(s, x, j + 1))
    starts = let(pairs, lambda s: F.sort_array(F.transform(twice(s), lambda x: x["i"])))
    # Each window covers three words, less what the next window covers again.
    covered = lambda p: F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
    total = let(starts, lambda p: F.aggregate(covered(p), F.lit(0), lambda a, b: a + b))
    # Most texts repeat no window: those need no sorting.
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(total)


def windows(w: Column) -> Column:
    """A 64-bit hash of each window of three words."""
    return F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    ).otherwise(F.array().cast("array<long>"))


def _word_counts(w: Column) -> Column:
    return F.struct(F.size(w).alias("n_words"), let(windows(w), _repeated).alias("n_repeat_words"))


def counts(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE[1:-1]}]"))
    by_words = let(words(text), _word_counts)
    left = lambda signs: F.length(F.translate(text, signs, ""))
    return F.struct(
        by_words["n_words"].cast("long").alias("n_words"),
        left(WHITE).cast("long").alias("word_chars"),
        (F.length(text) - left(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        by_words["n_repeat_words"].cast("long").alias("n_repeat_words"),
    )


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(a, b) of the beta distribution of the hosts' failure rates.

    Its spread is that between the rates less what chance adds by the hosts' numbers of
    documents, as an analysis of variance has it. In its mean, a host weighs as its rate is
    sure: by its documents if hosts agree, nearly one vote each if they differ.
    """
    row = hosts.agg(
        F.sum("n").alias("n"),
        F.sum("failed").alias("failed"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("square"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("sizes"),
        (F.count("*") - 1).alias("others"),
    ).collect()[0]
    if not row["n"]:
        return 0.5, 0.5
    mean = row["failed"] / row["n"]
    chance = mean * (1 - mean)
    room = row["n"] - row["others"] - row["sizes"] / row["n"]
    spread = row["square"] - mean * row["failed"]
    share = (spread / chance - row["others"]) / room if chance > 0 and room > 0 else 0.0
    # As strong as the hosts agree, between one and a thousand documents.
    strength = min(max(1 / max(share, 1e-9) - 1, 1.0), 1000.0)
    weight = 1 / (F.col("n") + strength)
    votes = hosts.agg(F.sum(F.col("failed") * weight).alias("failed"), F.sum(F.col("n") * weight).alias("n")).collect()[0]
    mean = votes["failed"] / votes["n"]
    return max(mean * strength, 1e-6), max((1 - mean) * strength, 1e-6)


def host_rates(hosts: DataFrame, max_host_rate: float, max_ratio: float, sureness: float) -> DataFrame:
    """host, host_rate (shrunk), and host_failed, given each host's n and failed."""
    a, b = beta_prior(hosts)
    size = F.col("n") + (a + b)
    rate = (F.col("failed") + a) / size
    worse = rate - sureness * F.sqrt(rate * (1 - rate) / (size + 1)) > max_ratio * a / (a + b)
    return hosts.select("host", rate.alias("host_rate"), ((rate > max_host_rate) | worse).alias("host_failed"))


def judge(
    docs: DataFrame,
    host: str = "source",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_host_rate: float = 0.5,
    max_ratio: float = 1.5,
    sureness: float = 2.0,
) -> DataFrame:
    """doc_id, the counts, base_failed, host_rate, and kept, per row of ``docs``."""
    rows = docs.select(F.col("doc_id"), F.col(host).alias("host"), counts(F.col("text")).alias("c")).select("doc_id", "host", "c.*")
    bad = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    rows = staged(rows.withColumn("base_failed", bad), "quality-counts")
    hosts = staged(rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")), "hosts")
    rates = host_rates(hosts, max_host_rate, max_ratio, sureness).withColumnRenamed("host", "of")
    return rows.join(rates, F.col("host").eqNullSafe(F.col("of"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate",
        (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
    )
