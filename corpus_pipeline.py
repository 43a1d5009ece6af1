"""Documents to training tokens, in stages that each write a table for the next.

Toxic documents go; of each group of near-duplicates one document stays; secrets in the text
are replaced; sources are mixed to their target weights, a document that is taken twice
standing twice in the table; texts become tokens.

Every stage keeps rows whose text is null or empty, except for mixing: a document without
words is never taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import bpe, mixing, near_duplicates, secrets, toxicity
from shelfline.llm.common import fold, repeated, row_key, staged, table
from shelfline.llm.queries import PATTERN, configured, vocabulary

CAP = 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below a toxicity score of 0.3; the model learns from three quarters of the labels."""
    configured(spark)
    train = fold(F.col("doc_id"), 4) != 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), train)
    return docs.filter(toxicity.score(F.col("text"), spark, model) < 0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    configured(spark)
    found = near_duplicates.near_duplicates(docs, shingle=5, percent=80, key=row_key(docs))
    return repeated(docs, found.withColumn("times", F.col("first").cast("int")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    found = mixing.mix(docs, cap=CAP, key=row_key(docs))
    return repeated(docs, found.withColumnRenamed("copies", "times"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids_sha256, decoded_sha256, ids."""
    ranks = bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    found = bpe.tokens(F.col("text"), configured(spark), ranks, PATTERN, with_ids=True)
    return docs.select("doc_id", "source", found.alias("t")).select("doc_id", "source", "t.*")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("tokens", encode),
]
#: No SQL can fit the trees or merge the tokens; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configured(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
