"""Registered queries of this subpackage: ``opN_<name>`` and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.config import new_shared_path
from shelfline.llm import (
    bpe,
    filter_audit,
    language_model,
    line_dedup,
    mixing,
    near_duplicates,
    neighbours,
    quality,
    secrets,
    token_files,
    toxicity,
    vector_codes,
    warc,
)
from shelfline.llm.common import fold, table
from shelfline.llm.oracles import ORACLES  # noqa: F401
from shelfline.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: The public vocabulary's split pattern, for machines without its package.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def configured(spark: SparkSession) -> SparkSession:
    # Texts may be long: few of them go to Python at a time.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return prepare(spark)


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configured(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


# Where the public vocabularies lie; SHELFLINE_TOKENIZERS names another folder.
def vocabulary(name: str) -> str:
    folder = os.environ.get("SHELFLINE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 10) == 0
    found = language_model.score(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    return bpe.encode(table(spark, sf_dir, "documents"), ranks, PATTERN)


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("host_rate")


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    records, _ = warc.read(spark, path, keep_payload=False, whole=True)
    return records.select(F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return docs.select("doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), spark, model).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int")
    )


@query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "token-files")
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        token_files.write(table(spark, sf_dir, "documents"), path, file.read())
    return token_files.read(spark, path)


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("parts", lambda x: x["kind"] < secrets.STRONG)
    number = lambda kind: F.size(F.filter("parts", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("parts")).alias("spans"),
    )


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).drop("label")


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"), min_documents=10)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
