"""Lines that many documents share are dropped from all of them.

Texts are split at line feeds. A line's key is the line without the white space
``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in lower case. Each document's distinct keys
are exploded, hashed (128 bits) and counted: a row per document and key, so the count is one
of documents. Lines whose key at least ``min_documents`` documents hold go, in every document
and wherever they stand; the others are joined again in their order.

Built of DataFrame functions only. Keys are counted before the shuffle, so a line that most
documents hold costs one row per task. Positions are looked up by hash without their text,
in a join whose larger side adaptive execution splits at a hot key; only hits go on. They are
gathered per id and text, one list of numbers per document, and meet the text once.

Defined results: a null or empty text is one empty line. Empty keys, as of blank lines, never
go. Every row is a document, so repeated rows count as often as they occur; rows with the same
id and text, null ids included, get the same result. A text's lines are gathered for that text
alone, so a very long one costs a task its own length. Where all lines go, the text is empty.
Only doc_id and text are read, so further columns cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import LOWER, UPPER, let, staged

WHITE = " \t\n\x0b\x0c\r"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keys(text: Column) -> Column:
    """The key of each line of a text, in order."""
    text = F.coalesce(text, F.lit(""))
    # lower() is by far the faster one, and the same where each character is a byte.
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.transform(F.split(lowered, "\n", -1), lambda x: F.trim(x, F.lit(WHITE)))


def _hashed(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")]


def _text_key() -> list[Column]:
    return [F.col("doc_id").alias("_id"), *_hashed("_text")]


def shared_lines(docs: DataFrame, min_documents: int = 10, min_chars: int = 1) -> DataFrame:
    """(h1, h2, documents): hashed keys that at least ``min_documents`` rows hold."""
    held = docs.select(F.explode(F.array_distinct(keys(F.col("text")))).alias("key"))
    held = held.filter(F.length("key") >= min_chars).select(*_hashed("key"))
    return held.groupBy("h1", "h2").agg(F.count("*").alias("documents")).filter(F.col("documents") >= min_documents)


def drop_shared_lines(docs: DataFrame, min_documents: int = 10, min_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped, and the text that is left, per row of ``docs``."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shared = staged(shared_lines(docs, min_documents, min_chars).select("h1", "h2"), "shared-lines")
    whole = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    places = whole.select(F.col("doc_id").alias("_id"), F.xxhash64("_text").alias("t1"), F.xxhash64(F.lit("line"), "_text").alias("t2"), F.posexplode(keys(F.col("_text"))).alias("at", "key"))
    places = places.filter(F.length("key") >= min_chars).select("_id", "t1", "t2", "at", *_hashed("key"))
    hits = places.join(shared, ["h1", "h2"]).groupBy("_id", "t1", "t2").agg(F.collect_set("at").alias("gone"))
    hits = staged(hits, "dropped-lines")
    keyed = whole.select("doc_id", "_text", F.xxhash64("_text").alias("u1"), F.xxhash64(F.lit("line"), "_text").alias("u2"))
    met = keyed.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("u1") == F.col("t1")) & (F.col("u2") == F.col("t2")), "left")

    def without(all_lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("gone"))
        return F.array_join(F.transform(left, lambda i: F.get(all_lines, i)), "\n")

    n_dropped = F.coalesce(F.size("gone"), F.lit(0))
    kept = F.when(F.col("gone").isNull(), F.col("_text")).otherwise(let(lines(F.col("_text")), without))
    n_lines = F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1
    return met.select("doc_id", n_lines.cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"), kept.alias("text"))
