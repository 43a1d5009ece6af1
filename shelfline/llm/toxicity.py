"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

1. A bounded sample of labelled rows (``max_fit_rows``, by a hash of the id), near copies
   taken once, is split by that hash: eight tenths for the trees, two tenths for the calibration.
2. The lexicon holds words and word beginnings whose document frequency differs between the
   classes by a smoothed log odds ratio of many standard errors, and that are surely found
   in toxic rows more often than not. For fitting, each half of
   the sample is described with the lexicon of the other half; texts are scored with that
   of the whole sample.
3. Features are rates of a text: lexicon words, lexicon words near the second person,
   capitals, punctuation, obfuscated spellings.
4. Trees are fitted to log loss on the one part; an isotonic step function turns their
   sum into a probability on the other.

Fitting sees the sample only; scoring reads every whole text once, without a shuffle.

Defined results: null and empty texts get the score of a text without words. Where a fold
lacks a class the score is the sample's share of toxic rows. Several labels of an id count
as toxic if one does; null labels are ignored. Rows are scored one by one, so repeated rows
get equal scores and further columns are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import let, staged, words
from shelfline.llm.quality import windows

#: Common insults, known without any label.
SEEDS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers pathetic worthless trash garbage scum "
    "clown disgusting fool imbecile jerk creep filth vermin dumbass bastard bitch asshole".split()
)
SECOND_PERSON = frozenset(
    "you your yours you're youre u ur yourself du dich dir dein deine ihr euch tu te toi ton ta "
    "tes vous votre vos usted ustedes tú ti tus".split()
)
#: Digits and signs that stand for letters in disguised words.
LEET = str.maketrans("013457@$!|+", "oieastasiit")
EDGES = ".,;:!?\"'()[]{}<>|*#%&~-_/\\"
FEATURES = 18
CACHE = 400_000


@dataclass(frozen=True)
class Model:
    """Bounded by its parameters: at most ``lexicon_size`` terms, ``trees`` small trees."""

    lexicon: dict[str, float]
    cuts: list[np.ndarray]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    base: float
    steps: tuple[np.ndarray, np.ndarray]
    prior: float


def terms_of(word: str) -> tuple[str, ...]:
    """A word, and its beginnings of four and five letters marked with a star."""
    return (word,) + tuple(f"{word[:n]}*" for n in (4, 5) if len(word) > n)


class WordInfo(dict):
    """Per word: None for a plain one, else (z of the lexicon, seed, disguised, person)."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def best(self, word: str) -> float:
        return max([self.lexicon.get(t, 0.0) for t in terms_of(word)])

    def __missing__(self, raw: str):
        word = raw.strip(EDGES)
        z, seed, person = self.best(word), word in SEEDS, word in SECOND_PERSON
        disguised = 0
        if not word.isalpha() and any(c.isalpha() for c in word):
            plain = word.translate(LEET).replace("*", "").replace(".", "").replace("-", "")
            if plain != word:
                disguised = 1
                z, hit = max(z, self.best(plain)), plain in SEEDS
                disguised += hit and not seed
                seed = seed or hit
        info = (z, seed, disguised, person) if z or seed or disguised or person else None
        if len(self) >= CACHE:
            self.clear()
        self[raw] = info
        return info


def features(text: str | None, info: WordInfo) -> list[float]:
    text = text or ""
    lowered = text.lower().split()
    n, chars = len(lowered), len(text)
    hits, people = [], []
    z_max = z_sum = 0.0
    seeds = strong = weak = disguised = seen_through = 0
    for at, w in enumerate(map(info.__getitem__, lowered)):
        if w is not None:
            z, seed, hidden, person = w
            seeds += seed
            strong += z >= 5
            weak += 0 < z < 5
            z_max, z_sum = max(z_max, z), z_sum + z
            disguised += hidden > 0
            seen_through += hidden > 1
            if person:
                people.append(at)
            if seed or z >= 5:
                hits.append(at)
    near = 0
    if hits and people:
        gaps = np.abs(np.asarray(people)[np.clip(np.searchsorted(people, hits), 0, len(people) - 1)] - hits)
        before = np.clip(np.searchsorted(people, hits) - 1, 0, len(people) - 1)
        near = int((np.minimum(gaps, np.abs(np.asarray(people)[before] - hits)) <= 4).sum())
    per = 100 / max(n, 1)
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    shouted = sum(1 for w in text.split() if len(w) > 2 and w.isupper()) if upper > 2 else 0
    marks = text.count("!"), text.count("?")
    signs = sum(map(text.count, ".,;:\"'()*#%&$|"))
    long_runs = sum(map(text.count, ("!!", "??", "...", "**")))
    size = max(chars, 1)
    return [
        seeds * per, min(seeds, 50), strong * per, min(strong, 50), weak * per, z_max,
        z_sum * per, near * per, len(people) * per, upper / size, shouted * per,
        marks[0] / size, marks[1] / size, signs / size, disguised * per, seen_through * per,
        long_runs / size, float(np.log1p(n)),
    ]


# --- trees -------------------------------------------------------------------------------


def fit_trees(x, y, trees=60, depth=3, rate=0.2, bins=32, leaf=1.0, least=2):
    """Boosted trees of equal depth on binned features. Returns cuts, trees, and the base."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    cuts = [np.unique(np.append(c, 0.0)) for c in cuts]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    raw, grown = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.full(2**depth - 1, -1), np.zeros(2**depth - 1, np.int64)
        for level in range(depth):
            first = 2**level - 1
            for k in range(first, 2 * first + 1):
                rows = np.flatnonzero(node == k)
                best, at = 1e-6, None
                if len(rows) >= 2 * least:
                    total_g, total_h = g[rows].sum(), h[rows].sum()
                    whole = total_g**2 / (total_h + leaf)
                    for f in range(x.shape[1]):
                        m = len(cuts[f]) + 1
                        b = binned[rows, f]
                        left_g = np.cumsum(np.bincount(b, g[rows], m))[:-1]
                        left_h = np.cumsum(np.bincount(b, h[rows], m))[:-1]
                        count = np.cumsum(np.bincount(b, minlength=m))[:-1]
                        gain = left_g**2 / (left_h + leaf) + (total_g - left_g) ** 2 / (total_h - left_h + leaf) - whole
                        gain[(count < least) | (len(rows) - count < least)] = 0
                        if len(gain) and gain.max() > best:
                            best, at = gain.max(), (f, int(gain.argmax()))
                if at:
                    feature[k], cut[k] = at
                    node[rows] = 2 * k + 1 + (binned[rows, at[0]] > at[1])
                else:
                    node[rows] = 2 * k + 1
        leaves = node - (2**depth - 1)
        value = -rate * np.bincount(leaves, g, 2**depth) / (np.bincount(leaves, h, 2**depth) + leaf)
        raw = raw + value[leaves]
        grown.append((feature, cut, value))
    return cuts, grown, base


def raw_scores(x: np.ndarray, cuts, trees, base: float) -> np.ndarray:
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    out, rows = np.full(len(x), base), np.arange(len(x))
    for feature, cut, value in trees:
        node = np.zeros(len(x), np.int64)
        for _ in range(len(value).bit_length() - 1):
            f = feature[node]
            node = 2 * node + 1 + ((f >= 0) & (binned[rows, f] > cut[node]))
        out += value[node - (len(value) - 1)]
    return out


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: places and rising values, to be interpolated."""
    places, at = np.unique(raw, return_inverse=True)
    total, count = np.bincount(at, y), np.bincount(at).astype(float)
    blocks: list[list[float]] = []
    for place, s, c in zip(places, total, count):
        blocks.append([place, place, s, c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, high, s1, c1 = blocks.pop()
            blocks[-1] = [blocks[-1][0], high, blocks[-1][2] + s1, blocks[-1][3] + c1]
    x = np.array([v for low, high, _, _ in blocks for v in (low, high)])
    return x, np.repeat([s / c for _, _, s, c in blocks], 2)


def calibrated(model: Model, x: np.ndarray) -> np.ndarray:
    """0 to 1. A hundredth of the uncalibrated value keeps the order inside a step."""
    if not model.trees:
        return np.full(len(x), model.prior)
    raw = raw_scores(x, model.cuts, model.trees, model.base)
    return 0.99 * np.interp(raw, *model.steps) + 0.01 / (1 + np.exp(-raw))


# --- Spark -------------------------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column, max_fit_rows: int) -> DataFrame:
    """(text, toxic, fold) of the ``max_fit_rows`` labelled ids with the smallest hashes.

    Of texts that are copies or nearly so one is taken, as every word of a copied text would
    seem to tell its label.
    """
    chosen = (
        labels.filter(train & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("h", F.xxhash64("doc_id"))
        .orderBy("h", "doc_id")
        .limit(max_fit_rows)
    )
    # Broadcast: max_fit_rows bounds it.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Near copies share their least window of words, most of the time.
    least = let(words(F.lower("text")), lambda w: F.array_min(windows(w)))
    alike = F.coalesce(least, F.xxhash64("text"))
    one = rows.groupBy("toxic", alike.alias("alike")).agg(F.min(F.struct("h", "doc_id", "text")).alias("r"))
    return one.select("r.text", "toxic", F.pmod("r.h", F.lit(10)).cast("int").alias("fold"))


def _term_counts(batches):
    counts = {0: Counter(), 1: Counter()}
    rows = Counter()
    for pdf in batches:
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            seen = {t for w in (text or "").lower().split() for t in terms_of(w.strip(EDGES)) if t}
            counts[toxic].update(seen)
            rows[toxic] += 1
    # A term without a toxic row cannot enter the lexicon.
    yield pd.DataFrame(
        [(t, c, counts[0][t]) for t, c in counts[1].items()], columns=["term", "n1", "n0"]
    )
    yield pd.DataFrame(
        [(t, 0, c) for t, c in counts[0].items() if t not in counts[1]], columns=["term", "n1", "n0"]
    )


def lexicon_of(sample: DataFrame, lexicon_size: int, least_z: float) -> dict[str, float]:
    """Terms by z of the smoothed log odds ratio of their document frequencies."""
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return {}
    a = F.lit(0.5)
    odds = F.log((F.col("n1") + a) / (n1 - F.col("n1") + a)) - F.log((F.col("n0") + a) / (n0 - F.col("n0") + a))
    z = odds / F.sqrt(1 / (F.col("n1") + a) + 1 / (F.col("n0") + a))
    # Lower bound of the share of toxic rows among those with the term: words that are merely
    # more frequent in one class, as longer texts or a language bring about, stay out.
    n, p, q = F.col("n1") + F.col("n0"), F.col("n1") / (F.col("n1") + F.col("n0")), 1.96
    sure = (p + q * q / (2 * n) - q * F.sqrt(p * (1 - p) / n + q * q / (4 * n * n))) / (1 + q * q / n)
    rows = (
        sample.mapInPandas(_term_counts, "term string, n1 long, n0 long")
        .groupBy("term")
        .agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
        .filter("n1 >= 3")
        .filter(sure >= 0.5)
        .select("term", z.alias("z"))
        .filter(F.col("z") >= least_z)
        .orderBy(F.desc("z"), "term")
        .limit(lexicon_size)
        .collect()
    )
    return {r["term"]: r["z"] for r in rows}


def _feature_rows(low: dict[str, float], high: dict[str, float]):
    """Features of a half's rows by the lexicon of the other half."""

    def run(batches):
        info = {True: WordInfo(high), False: WordInfo(low)}
        for pdf in batches:
            x = [features(t, info[f < 5]) for t, f in zip(pdf["text"], pdf["fold"])]
            yield pd.DataFrame({"x": x, "toxic": pdf["toxic"], "fold": pdf["fold"]})

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    max_fit_rows: int = 20_000,
    lexicon_size: int = 1_000,
    least_z: float = 2.5,
) -> Model:
    """Fit on at most ``max_fit_rows`` labelled rows for which ``train`` holds."""
    sample = staged(labelled_sample(docs, labels, F.lit(True) if train is None else train, max_fit_rows), "toxic-sample")
    low, high, lexicon = (lexicon_of(sample.filter(part), lexicon_size, least_z) for part in ("fold < 5", "fold >= 5", "true"))
    rows = sample.mapInPandas(_feature_rows(low, high), "x array<double>, toxic int, fold int").toPandas()
    prior = float(rows["toxic"].mean()) if len(rows) else 0.0
    empty = (np.array([0.0]), np.array([prior]))
    if rows["toxic"].nunique() < 2:
        return Model(lexicon, [], [], 0.0, empty, prior)
    rows = rows.sort_values("x", key=lambda s: s.map(tuple))
    x, y = np.array(rows["x"].tolist(), dtype=float), rows["toxic"].to_numpy(float)
    grow = rows["fold"].to_numpy() % 5 > 0
    if len(set(y[grow])) < 2 or len(set(y[~grow])) < 2 or (~grow).sum() < 30:
        grow = np.ones(len(y), bool)  # too few rows to hold some back
    cuts, trees, base = fit_trees(x[grow], y[grow])
    rest = ~grow if not grow.all() else grow
    return Model(lexicon, cuts, trees, base, isotonic(raw_scores(x[rest], cuts, trees, base), y[rest]), prior)


def score(text: Column, spark: SparkSession, model: Model) -> Column:
    """The score of a text column, computed in batches beside the other columns."""
    sent = spark.sparkContext.broadcast(vars(model))

    @F.pandas_udf(T.DoubleType())
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = Model(**sent.value)
        info = WordInfo(found.lexicon)
        for texts in batches:
            x = np.array([features(t, info) for t in texts], dtype=float).reshape(-1, FEATURES)
            yield pd.Series(calibrated(found, x))

    return scores(text)
