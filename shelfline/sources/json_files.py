"""Files that are a JSON array, one object, or JSON Lines, as one record per row.

A file is good or bad as a whole: one broken line fails it. Lines are read by Spark's
splittable text source, and an array is cut into its top-level elements by bracket depth. A JSON string cannot hold a raw line break,
so every line starts outside of strings and its brackets can be counted on their own; depth
is then a running sum, taken inside read blocks and carried over between them. Lines that
may hold a top-level comma within are first cut at all their commas outside of strings.

Staged tables repeat their files' names, so they take a small part of their rows' size on disk,
by which Spark would take a table of all lines for small enough to be sent through the driver.
Joins are of kinds that can send the side with a row per file or read block only.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.config import new_shared_path, release, stage
from shelfline.functions.columns import once
from shelfline.functions.payload import starts_array, starts_object, with_strict_json

NO_DATA = "contains no data"
BROKEN = "unable to parse as JSON or JSON Lines"
SCALAR = "unexpected JSON structure"
#: Text of an element, or of a document that is one object, beyond which it is not brought
#: together: Spark's variants hold 128 MiB, so it could not become a record.
LONGEST_RECORD = 1 << 30

@dataclass(frozen=True)
class NormalizedFiles:
    """Records and verdicts. Both read staged tables until ``close``."""

    records: DataFrame  # file, record (variant), output_name
    status: DataFrame  # file, status, reason, records_converted, output_location
    work: str

    def close(self) -> None:
        for name in ("shapes", "lines", "lines-places", "elements", "status"):
            release(self.status.sparkSession, f"{self.work}/{name}")


def _lines(text: DataFrame) -> DataFrame:
    """Non-blank lines with their place: file, read block, and order inside the block."""
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.trim("value").alias("line"),
    ).filter(F.col("line").rlike(r"\S"))


def _lines_of(text: DataFrame, files: DataFrame, wanted: Column) -> DataFrame:
    """Lines of the files (file, ...) for which ``wanted`` holds.

    A file has one row on one side, so a file that holds most lines is split by Spark.
    """
    return _lines(text).join(files.filter(wanted).select("file"), "file", "left_semi")


def _files(text: DataFrame) -> DataFrame:
    """Every file of the scan. Scans leave out empty files, so the names come from the
    listing the scan is planned from."""
    names = pa.table({"file": pa.array(text.inputFiles(), pa.string())})
    listed = text.sparkSession.createDataFrame(names)
    return listed.select(F.regexp_replace("file", "^file:/*", "file:/").alias("file"))


def _shape(n: Column, bad: Column, opens_array: Column) -> Column:
    """Lines that are records each; one line that is an object or a scalar; or a document to
    be cut, which lies over several lines or is an array."""
    spread = (bad > 0) | ((n == 1) & opens_array)
    return F.when(spread, "spread").when(n == 1, "document").otherwise("lines")


def _carry(df: DataFrame, value: str, into: str, inclusive: bool) -> DataFrame:
    """Running sum of ``value`` over each file's lines.

    Summed inside blocks, whose size the reader bounds, plus the total of earlier blocks,
    of which there is one row each; so a file of any size spreads over tasks.
    """
    within = Window.partitionBy("file", "block").orderBy("row", "part")
    last = Window.currentRow if inclusive else -1
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = (
        df.groupBy("file", "block")
        .agg(F.sum(value).alias("total"))
        .select("file", "block", F.sum("total").over(before).alias("base"))
    )
    running = F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, last))
    return (
        df.withColumn("running", running)
        .join(bases, ["file", "block"], "left")
        .withColumn(
            into, F.coalesce(F.col("running"), F.lit(0)) + F.coalesce(F.col("base"), F.lit(0))
        )
        .drop("running", "base")
    )


def _bare(line: str) -> Column:
    """The line with 0 for each string."""
    return F.regexp_replace(F.regexp_replace(line, r"\\.", ""), r'"[^"]*"', "0")


def _fragments(lines: DataFrame) -> DataFrame:
    """Lines of arrays, cut after each comma outside of strings where one within the line may
    stand between top-level elements; ``part`` is the order inside the line.

    Values whose brackets close on the line hide their commas, but for a bracket that opens
    the line, as that may be the document's own. Control characters, which no JSON text
    holds, stand for escapes and cuts on the way; lines that have them stay whole and fail.
    """
    flat = F.regexp_replace("bare", r"^\s*\[", "")
    for _ in range(3):
        flat = F.regexp_replace(flat, r"[\[{][^\[\]{}]*[\]}]", "0")
    pair, quote, cut = "\x01", "\x02", "\x03"
    divided = (
        F.col("opens_array")
        & F.col("flat").rlike(r",\s*[^\s]")
        & ~F.col("line").rlike("[\x01-\x03]")
    )
    plain = F.replace(F.replace("line", F.lit("\\\\"), F.lit(pair)), F.lit('\\"'), F.lit(quote))
    # Every second part between quotes is outside of strings.
    marked = F.transform(
        F.split(plain, '"'),
        lambda x, i: F.when(i % 2 == 0, F.replace(x, F.lit(","), F.lit("," + cut))).otherwise(x),
    )
    whole = F.replace(F.array_join(marked, '"'), F.lit(quote), F.lit('\\"'))
    cuts = F.split(F.replace(whole, F.lit(pair), F.lit("\\\\")), cut)
    parts = F.when(divided, cuts).otherwise(F.array("line"))
    ready = once(once(lines, "bare", _bare("line")), "flat", flat)
    return (
        ready.select("file", "block", "row", "opens_array", F.posexplode(parts).alias("part", "line"))
        .withColumn("line", F.trim("line"))
        .filter(F.col("line").rlike(r"\S"))
    )


def _places(counted: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """For each line of files that may be one document, the piece it belongs to; and the last
    piece of each of these files.

    Takes and stages numbers only, no text. A document is closed by its last line and by no
    other, so a second value beside it, an end too many, or one that is missing settles a
    file's verdict here: lines of broken JSON Lines are never brought together. Nor are those
    of a piece that is too long for a record.
    """
    deep = _carry(counted, "delta", "depth", inclusive=True)
    # Both are cuts: those before a line count for it, those at its end for the next one.
    ends = (F.col("comma") & (F.col("depth") == 1)).cast("int")
    leads = (F.col("leading") & (F.col("depth") - F.col("delta") == 1)).cast("int")
    marked = deep.withColumn("ends", ends).withColumn("leads", leads)
    marked = marked.withColumn("cuts", F.col("ends") + F.col("leads"))
    cut = _carry(marked, "cuts", "before", inclusive=False)
    places = stage(
        cut.withColumn("piece", F.col("before") + F.col("leads")).select(
            "file", "block", "row", "part", "piece", "ends", "leads", "delta", "depth", "size"
        ),
        f"{path}-places",
    )
    pieces = places.groupBy("file", "piece").agg(
        F.sum("delta").alias("delta"),
        F.count_if(F.col("depth") <= 0).alias("closed"),
        F.sum("size").alias("size"),
    )
    files = pieces.groupBy("file").agg(
        F.max("piece").alias("top"),
        F.sum("delta").alias("left_open"),
        F.sum("closed").alias("closed"),
        F.max("size").alias("size"),
    )
    whole = (F.col("left_open") == 0) & (F.col("closed") == 1) & (F.col("size") <= LONGEST_RECORD)
    lasts = files.filter(whole).select("file", F.col("top").alias("piece"), F.lit(True).alias("last"))
    # A file has one row on the right, so one that holds most lines is split by Spark.
    return places.drop("delta", "depth", "size").join(lasts, "file", "left_semi"), lasts


def _elements(lines: DataFrame, path: str) -> DataFrame:
    """Top-level elements of documents spread over lines, per piece of whole fragments.

    A comma between elements of the top-level array that ends a line ends a piece, one that
    begins a line begins a piece. A document that is one object is one piece, as it is one
    record. Put in brackets, each piece must be a non-empty array; then, and only then, the
    pieces in order are the whole document. Two commas in a row leave out a number.
    """
    opened = F.regexp_count("bare", F.lit(r"[\[{]"))
    closed = F.regexp_count("bare", F.lit(r"[\]}]"))
    # The sums read the numbers several times, the text is read once.
    counted = stage(
        once(_fragments(lines), "bare", _bare("line")).select(
            "file",
            "block",
            "row",
            "part",
            "line",
            (opened - closed).alias("delta"),
            # A comma alone on its line is one that begins it.
            (F.col("opens_array") & F.col("bare").rlike(r"^.*\S.*,\s*$")).alias("comma"),
            (F.col("opens_array") & F.col("bare").startswith(",")).alias("leading"),
            F.octet_length("line").cast("long").alias("size"),
        ),
        path,
    )
    place = ["file", "block", "row", "part"]
    places, lasts = _places(counted.drop("line"), path)
    # Both sides hold a row per line, so neither is to be sent whole.
    cut = counted.select(*place, "line").join(places.hint("merge"), place)
    pieces = cut.groupBy("file", "piece").agg(
        F.array_sort(F.collect_list(F.struct("block", "row", "part", "line"))).alias("parts"),
        F.max("ends").alias("ends"),
        F.max("leads").alias("leads"),
    ).join(lasts, ["file", "piece"], "left")
    text = F.array_join("parts.line", "\n")
    first, last = F.col("piece") == 0, F.col("last").isNotNull()
    body = F.when(F.col("leads") > 0, F.regexp_replace("text", r"^\s*,", "")).otherwise(F.col("text"))
    body = F.when(F.col("ends") > 0, F.regexp_replace(body, r",\s*$", "")).otherwise(body)
    bracketed = F.concat(
        F.when(first, "").otherwise("["), F.col("body"), F.when(last, "").otherwise("]")
    )
    whole = (
        pieces.withColumn("text", text)
        .withColumn("body", body)
        .select(
            "file",
            "piece",
            first.alias("first"),
            (last & (F.col("ends") == 0)).alias("final"),
            bracketed.alias("text"),
        )
    )
    return with_strict_json(whole, "text", "doc").select(
        "file", "piece", "first", "final", _items(F.col("doc"), F.col("text")).alias("items")
    )


def _no_elements(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "file string, piece long, first boolean, final boolean, items array<variant>"
    )


def _items(doc: Column, text: Column) -> Column:
    """Records of one document: the array's elements, or the object; NULL for others."""
    return F.when(starts_array(text), doc.try_cast("array<variant>")).when(
        starts_object(text) & doc.isNotNull(), F.array(doc)
    )


def output_name(file: Column, processing_date: str | None) -> Column:
    escaped = F.element_at(F.split(file, "/"), -1)
    name = F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))
    return F.concat(F.lit(f"{processing_date}_"), name) if processing_date else name


def normalize_json_files(
    spark: SparkSession,
    path: str,
    target_prefix: str,
    processing_date: str | None = None,
) -> NormalizedFiles:
    """Read every file under ``path`` but those already under ``target_prefix``.

    A first pass over the lines settles all files whose documents lie on one line each, but
    for arrays. Only elements of the others are staged, as their verdict needs all of them.
    """
    work = new_shared_path(spark, "json")
    # One listing for all passes, so that they agree on the files.
    text = spark.read.text(path, recursiveFileLookup=True)
    prefix = target_prefix.rstrip("/")
    inside = F.col("file").contains(prefix)
    lines = _lines(text).filter(~inside)

    first = with_strict_json(lines, "line", "item").withColumn(
        "size", F.coalesce(F.size(_items(F.col("item"), F.col("line"))), F.lit(-1))
    )
    shapes = stage(
        first.groupBy("file")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("item").isNull()).alias("bad"),
            F.max("size").alias("size"),
            F.min_by(starts_array(F.col("line")), F.struct("block", "row")).alias("opens_array"),
        )
        .select(
            "file",
            "n",
            "size",
            "opens_array",
            _shape(*map(F.col, ("n", "bad", "opens_array"))).alias("shape"),
        ),
        f"{work}/shapes",
    )
    shaped = _files(text).join(shapes, "file", "left")
    is_spread = F.col("shape") == "spread"
    if shapes.filter(is_spread).isEmpty():
        pieces = _no_elements(spark)
    else:
        spread = _lines_of(text, shaped, is_spread)
        opening = shapes.select("file", "opens_array")
        pieces = _elements(spread.join(opening, "file", "left"), f"{work}/lines")
    parts = stage(
        pieces.withColumn("size", F.coalesce(F.size("items"), F.lit(-1))), f"{work}/elements"
    )

    # An empty first-and-final piece is the document []. An empty one between commas is not.
    alone = F.col("first") & F.col("final")
    broken = (F.col("size") < 0) | ((F.col("size") == 0) & ~alone)
    pieced = parts.groupBy("file").agg(
        F.sum(F.greatest(F.col("size"), F.lit(0))).alias("found"),
        (F.count_if(broken) == 0).alias("sound"),
        F.bool_or("final").alias("ended"),
        (F.count(F.lit(1)) == F.max("piece") + 1).alias("unbroken"),
    )
    whole = F.col("sound") & F.col("ended") & F.col("unbroken")
    found = (
        F.when(F.col("shape") == "lines", F.col("n"))
        .when(F.col("shape") == "document", F.col("size"))
        .when(whole, F.col("found"))
        .otherwise(F.lit(-1))
    )
    files = (
        shaped.join(pieced, "file", "left")
        .select("file", "shape", F.when(F.col("shape").isNull(), 0).otherwise(found).alias("n"))
    )
    ok = ~inside & (F.col("n") > 0)
    reason = (
        F.when(F.col("n") == 0, NO_DATA)
        .when(F.col("shape") == "document", SCALAR)
        .otherwise(BROKEN)
    )
    name = output_name(F.col("file"), processing_date)
    status = stage(
        files.select(
            "file",
            "shape",
            F.when(inside, "skipped").when(ok, "SUCCESS").otherwise("FAILED").alias("status"),
            F.when(~inside & ~ok, reason).alias("reason"),
            F.when(ok, F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("records_converted"),
            F.when(ok, F.concat(F.lit(f"{prefix}/output_name="), name)).alias("output_location"),
        ),
        f"{work}/status",
    )
    good = F.col("status") == "SUCCESS"
    by_line = _lines_of(text, status, good & (F.col("shape") == "lines"))
    documents = _lines_of(text, status, good & (F.col("shape") == "document"))
    good_spread = status.filter(good & is_spread).select("file")
    records = (
        with_strict_json(by_line, "line", "record")
        .select("file", "record")
        .unionByName(
            with_strict_json(documents, "line", "item").select(
                "file", F.explode(_items(F.col("item"), F.col("line"))).alias("record")
            )
        )
        .unionByName(
            parts.join(good_spread, "file", "left_semi").select(
                "file", F.explode("items").alias("record")
            )
        )
        .withColumn("output_name", name)
    )
    return NormalizedFiles(records, status.drop("shape"), work)


def write_json_lines(normalized: NormalizedFiles, path: str) -> None:
    """One compact JSON record per line, in a folder per source file."""
    (
        normalized.records.select("output_name", F.to_json("record").alias("value"))
        .hint("rebalance", F.col("output_name"))
        .write.mode("overwrite")
        .partitionBy("output_name")
        .text(path)
    )
