"""Scoring texts with a recurrent language model, beside a smoothed unigram base.

1. Words of all training texts are counted, exactly; a text ends with an end token.
2. Every text is turned once into the network's inputs, which later steps read instead of it.
3. A gated recurrent network (gru.py) with a class-factored softmax learns by truncated
   backpropagation: first on about ``warm_documents`` training texts, so that the copies
   have a common start, then every task trains a copy on all training texts of its
   partition, and the copies are averaged, weighted by their tokens.
4. Every text is scored from its first token to its end token with the state carried along.

The network lists the ``listed`` most frequent words that are held. All other words share ``tails`` classes
by their last two bytes; within its class a word has its share of the class's counts, each
0.1 higher, with 0.1 for any word never seen. So the model's probability of a text needs the
corpus count of every word, as the base does. Counts of up to ``held`` of the most frequent words
go to the tasks that make inputs (a fixed size), where a Python worker keeps its table of them from
task to task; the other words of a text are summed, joined with the counts by word, and added
back by text. Nothing else that is gathered goes to the driver but the
averaged weights.

Defined results: null and empty texts consist of the end token. Without any training text
all counts are 0, base_score follows its formula, and the model is untrained. Rows are
scored one by one; repeated rows get equal scores. Only doc_id and text are read, so further
columns cannot clash. Null ids belong to the fold of the empty text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import LOWER, UPPER, staged
from shelfline.llm.gru import CLASS, Net, Trainer, document_scores

LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: The end token; no word holds a space.
END = b" "
#: Each copy's weights are sent and averaged in parts, so that no task holds all copies.
PARTS = 32


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, then the end token."""
    found = (text or "").encode().translate(LOWERED).split()
    found.append(END)
    return found


def tail_of(word: bytes, tails: int) -> int:
    return zlib.crc32(word[-2:]) % tails


@dataclass(frozen=True)
class Vocabulary:
    """The ``held`` most frequent training words with their counts, and corpus totals."""

    words: list[bytes]
    counts: np.ndarray
    tail_sums: np.ndarray
    tokens: int
    distinct: int
    listed: int

    def net(self, hidden: int, vector: np.ndarray | None = None) -> Net:
        """A network that starts from the corpus frequencies, or has the given weights."""
        net = Net(min(self.listed, len(self.words)), len(self.tail_sums), hidden, vector=vector)
        if vector is None:
            counts = np.zeros(net.wb.size)
            counts[: net.words] = self.counts[: net.words] + 0.1
            if net.words:
                net.wb.reshape(-1)[: net.words] = np.log(counts[: net.words] / counts[: net.words].mean())
            masses = np.concatenate([counts.reshape(net.wb.shape).sum(axis=1), self.tail_sums])
            net.cb[:] = np.log((masses + 0.1) / masses.mean())
        return net


# --- counting ----------------------------------------------------------------------------


def _count(batches):
    held: Counter = Counter()
    for pdf in batches:
        for text in pdf["text"]:
            held.update(words_of(text))
        if len(held) > 500_000:
            yield pd.DataFrame({"word": list(held.keys()), "c": list(held.values())})
            held.clear()
    yield pd.DataFrame({"word": pd.Series(list(held.keys()), dtype=object), "c": pd.Series(list(held.values()), dtype="int64")})


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of all words of ``texts``, the end token among them."""
    return texts.mapInPandas(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, listed: int, held: int, tails: int) -> Vocabulary:
    spark = counts.sparkSession
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    # The lowest count of which all words still fit: a row per distinct count tells it, so
    # that no more than ``held`` words are sent.
    fit, least = 0, 1
    for r in counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(held).collect():
        fit += r["n"]
        if fit > held:
            least = r["c"] + 1
            break
    top = counts.filter(F.col("c") >= least).collect()
    top.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    # A binary's last two bytes, as tail_of() takes them.
    tail = F.crc32(F.substring("word", -2, 2)) % tails
    inside = spark.createDataFrame([(bytes(r["word"]),) for r in top[:listed]], "word binary")
    sums = counts.join(F.broadcast(inside), "word", "left_anti").groupBy(tail.alias("tail")).agg(F.sum(F.col("c") + 0.1).alias("s")).collect()
    tail_sums = np.full(tails, 0.1)
    for r in sums:
        tail_sums[r["tail"]] += r["s"]
    return Vocabulary([bytes(r["word"]) for r in top], np.array([r["c"] for r in top], dtype=np.int64), tail_sums, total["n"] or 0, total["v"], listed)


# --- inputs of the network ---------------------------------------------------------------


class Ids:
    """Words to inputs of the network: listed words, then tail classes."""

    def __init__(self, v: Vocabulary):
        words, self.tails = min(v.listed, len(v.words)), len(v.tail_sums)
        self.first = -(-max(words, 1) // CLASS) * CLASS
        self.place = {w: i for i, w in enumerate(v.words)}
        self.inputs = np.array([i if i < words else self.first + tail_of(w, self.tails) for i, w in enumerate(v.words)] + [-1], np.int64)
        # One more entry, for words that are not held: they are summed elsewhere.
        self.logs = np.append(np.log10(v.counts + 0.1), 0.0)
        self.tail_logs = np.where(np.arange(len(self.logs)) >= words, self.logs, 0.0)
        self.kind = kind_of(self.first + self.tails)

    def rows(self, documents: list[list[bytes]]) -> pd.DataFrame:
        """Per document what ``ENCODED`` lists; all are looked up at a time."""
        lengths = np.array([len(d) for d in documents])
        ends = np.cumsum(lengths)
        words = [w for d in documents for w in d]
        # Places in the vocabulary; one past its end for words that it lacks.
        lacking = len(self.place)
        places = np.fromiter(map(self.place.get, words, repeat(lacking)), np.int64, len(words))
        inputs, missed = self.inputs[places], np.flatnonzero(places == lacking)
        rare = [words[i] for i in missed.tolist()]
        inputs[missed] = [self.first + tail_of(w, self.tails) for w in rare]
        sent, cuts = inputs.astype(self.kind).tobytes(), np.searchsorted(missed, ends).tolist()
        # Every document has its end token, so no sum is of nothing.
        sums = lambda values: np.add.reduceat(values[places], ends - lengths)
        width = self.kind.itemsize
        return pd.DataFrame({
            "n_tokens": lengths,
            "n_held": lengths - np.diff(cuts, prepend=0),
            "base": sums(self.logs),
            "tail": sums(self.tail_logs),
            "rare": [END.join(rare[i:j]) or None for i, j in zip([0, *cuts], cuts)],
            "inputs": [sent[width * (e - n) : width * e] for e, n in zip(ends.tolist(), lengths.tolist())],
        })


def kind_of(start: int) -> np.dtype:
    """How inputs are stored that do not exceed ``start``."""
    return np.dtype("<u2" if start < 1 << 16 else "<u4")


@lru_cache(maxsize=1)
def _ids(sent) -> Ids:
    """The table of a broadcast vocabulary, kept by a worker between tasks."""
    return Ids(Vocabulary(**sent.value))


ENCODED = "n_tokens long, n_held long, base double, tail double, rare binary, inputs binary"


def _encode(sent, most: int = 1 << 18):
    @F.pandas_udf(ENCODED)
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ids = _ids(sent)
        for texts in batches:
            found, documents, held = [], [], 0
            for text in texts:
                documents.append(words_of(text))
                held += len(documents[-1])
                # Texts may be long: few words are looked up at a time.
                if held >= most:
                    found.append(ids.rows(documents))
                    documents, held = [], 0
            if documents:
                found.append(ids.rows(documents))
            yield pd.concat(found, ignore_index=True)

    return encoded


# --- learning ----------------------------------------------------------------------------


def _net(shape: tuple[int, int, int], vector_sent) -> tuple[Net, np.dtype]:
    net = Net(*shape, vector=vector_sent.value)
    return net, kind_of(net.start)


def _train(shape: tuple[int, int, int], vector_sent, passes: int, streams: int, buffer: int = 1 << 20):
    def run(batches):
        net, kind = _net(shape, vector_sent)
        trainer, seen = Trainer(net, rate=0.1, streams=streams), 0
        documents: list[np.ndarray] = []
        held = 0

        def learn():
            flat = np.concatenate(documents).astype(np.int64)
            first = np.zeros(len(flat), bool)
            first[np.cumsum([0] + [len(d) for d in documents[:-1]])] = True
            for _ in range(passes):
                trainer.learn(flat, first)
            return len(flat)

        for pdf in batches:
            for inputs in pdf["inputs"]:
                documents.append(np.frombuffer(inputs, kind))
                held += len(documents[-1])
                if held >= buffer:
                    seen += learn()
                    documents, held = [], 0
        if documents:
            seen += learn()
        if seen:
            parts = np.array_split(net.vector(), PARTS)
            yield pd.DataFrame({"part": range(PARTS), "n": seen, "weights": [(p * np.float64(seen)).tobytes() for p in parts]})

    return run


def _summed(key, pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(w, np.float64) for w in pdf["weights"]], axis=0)
    return pd.DataFrame({"part": [key[0]], "n": [int(pdf["n"].sum())], "weights": [total.tobytes()]})


def averaged(copies: DataFrame) -> np.ndarray | None:
    """The mean of the copies' weights by tokens; summed in two steps, each of few rows."""
    schema = "part int, n long, weights binary"
    salted = copies.groupBy("part", (F.spark_partition_id() % 16).alias("salt")).applyInPandas(_summed, schema)
    parts = salted.groupBy("part").applyInPandas(_summed, schema).collect()
    if not parts:
        return None
    parts = sorted(parts, key=lambda r: r["part"])
    return np.concatenate([np.frombuffer(r["weights"], np.float64) / r["n"] for r in parts]).astype(np.float32)


def learned(texts: DataFrame, documents: int, net: Net, warm_documents: int) -> np.ndarray:
    """Weights after a common start and one pass over all ``texts`` (doc_id, inputs), so many,
    from those of ``net``."""
    # Broadcast: the weights of a network of fixed size.
    context = texts.sparkSession.sparkContext
    shape, start = (net.words, net.tails, net.hidden), net.vector()
    schema = "part int, n long, weights binary"
    if not documents:
        return start
    share = min(1.0, warm_documents / documents)
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < max(int(share * (1 << 20)), 1)
    warm = staged(texts.filter(chosen), "warm-texts").coalesce(1).mapInPandas(_train(shape, context.broadcast(start), 3, 64), schema)
    common = averaged(warm)
    sent = context.broadcast(start if common is None else common)
    return averaged(texts.mapInPandas(_train(shape, sent, 1, 1024), schema))


# --- scoring -----------------------------------------------------------------------------


def _score(shape: tuple[int, int, int], vector_sent, tail_cost: np.ndarray, buffer: int = 1 << 22):
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net, kind = _net(shape, vector_sent)
        documents, held = [], 0
        for column in batches:
            found = [np.frombuffer(inputs, kind) for inputs in column]
            documents += found
            held += sum(map(len, found))
            # Many documents at a time keep the batch wide while long ones go on.
            if held >= buffer:
                yield pd.Series(document_scores(net, documents, tail_cost) / np.log(10))
                documents, held = [], 0
        if documents:
            yield pd.Series(document_scores(net, documents, tail_cost) / np.log(10))

    return scored


def score(
    docs: DataFrame,
    train: Column,
    listed: int = 2048,
    held: int = 200_000,
    tails: int = 64,
    hidden: int = 16,
    warm_documents: int = 1000,
) -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` is true for the rows to learn from.
    """
    rows = docs.select("doc_id", F.coalesce(train, F.lit(False)).alias("train"), F.col("text").cast("string").alias("text"))
    counts = staged(word_counts(rows.filter("train").select("text")), "word-counts")
    v = vocabulary(counts, listed, held, tails)
    ends = counts.filter(F.col("word") == F.lit(END)).first()
    context = docs.sparkSession.sparkContext
    encoded = rows.select("doc_id", "train", F.monotonically_increasing_id().alias("row"), _encode(context.broadcast(vars(v)))("text").alias("s"))
    found = staged(encoded.select("doc_id", "train", "row", "s.*"), "inputs")
    net = v.net(hidden)
    vector = learned(found.filter("train").select("doc_id", "inputs"), ends["c"] if ends else 0, net, warm_documents)
    scored = _score((net.words, net.tails, hidden), context.broadcast(vector), np.log(v.tail_sums))
    rare = found.select("row", F.explode(F.split(F.col("rare").cast("string"), " ")).alias("word")).withColumn("word", F.col("word").cast("binary"))
    joined = rare.join(counts, "word", "left")
    log = F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))
    sums = joined.groupBy("row").agg(F.sum(log).alias("rare_log"), F.count("c").alias("rare_known"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    norm = float(np.log10(v.tokens + 0.1 * (v.distinct + 1)))
    scores = staged(found.select("row", "n_tokens", "n_held", "base", "tail", "doc_id", scored("inputs").alias("score")), "scores")
    return scores.join(sums, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_held") + zero("rare_known")).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_log") - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("score") + F.col("tail") + zero("rare_log")).alias("score"),
    )
