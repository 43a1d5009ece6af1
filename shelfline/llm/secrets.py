"""Secret scans with linking of credentials that come in several parts.

Strong kinds are reported wherever they occur: ``assign`` (a value given to a password,
secret, token or API key), ``access`` (access key ids) and ``hex`` (long hexadecimal runs).
Weak kinds are too common to report alone: ``login`` (an account or client id that is
assigned), ``key`` (a long run of mixed letters and digits), ``endpoint`` (an address of a
service). A weak candidate is reported only where a complementary part lies within
``scope`` characters of it: a secret beside an identifier or an endpoint, an identifier or
an endpoint beside a secret. A weak key inside a strong span is part of that span.

Linking is an interval join: parts are dealt to cells of ``scope`` characters of their text
and meet complementary parts of the same cell, so the work follows the number of parts, and
a text with very many parts is spread over its cells.

Built of DataFrame functions only. Matches are found without offsets; their places follow
from the lengths of the pieces between them, summed along the text. Texts are read once;
what was found in them is written to the shared folder.

Defined results: null and empty texts have no spans. Repeated rows are scanned one by one
and get equal spans. Only doc_id and text are read, so further columns cannot clash. Spans
count code points, ends exclusive. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import staged

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LOGIN = r"""(?i)(?:user(?:_?name|_?id)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})"""
ENDPOINT = r"""(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://[^\x20\x09-\x0D"'<>]+"""
#: Kind, pattern, group whose length counts, least length, category; in reporting order.
KINDS = [
    ("assign", ASSIGN, 2, 12, "secret"),
    ("access", "AKIA[A-Z0-9]+", 0, 18, "id"),
    ("hex", "[0-9a-f]{16,}", 0, 16, "secret"),
    ("login", LOGIN, 1, 3, "id"),
    ("key", "[A-Za-z0-9+/_-]{24,}", 0, 24, "secret"),
    ("endpoint", ENDPOINT, 0, 8, "endpoint"),
]
STRONG = 3
CATEGORY = [k[4] for k in KINDS]
EMPTY = "array<struct<kind:int,i:int,gap:int,len:int,ok:boolean>>"


def _found(text: Column, at: int) -> Column:
    """The matches of a kind, each with the length of the piece before it."""
    kind, pattern, group, least, _ = KINDS[at]
    matched = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    parts = F.arrays_zip(matched(0).alias("m"), matched(group).alias("g"), F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matched(0))).alias("p"))
    ok = lambda x: F.length(x["g"]) >= least
    if kind == "key":
        ok = lambda x: x["m"].rlike("[A-Z]") & x["m"].rlike("[a-z]") & x["m"].rlike("[0-9]")
    rows = F.transform(
        parts,
        lambda x, i: F.struct(F.lit(at).alias("kind"), i.alias("i"), F.length(x["p"]).alias("gap"), F.length(x["m"]).alias("len"), ok(x).alias("ok")),
    )
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast(EMPTY))


def _parts(rows: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the matches that are long enough."""
    each = rows.select("row", F.explode("found").alias("x")).select("row", "x.*")
    along = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum((F.col("gap") + F.col("len")).cast("long")).over(along)
    return each.withColumn("end", end).filter("ok").select("row", "kind", (F.col("end") - F.col("len")).alias("start"), "end")


def _category(kind: str) -> Column:
    return F.element_at(F.array(*map(F.lit, CATEGORY)), F.col(kind) + 1)


def _supported(parts: DataFrame, scope: int) -> DataFrame:
    """The weak parts with a complementary part in their scope."""
    strong = parts.filter(F.col("kind") < STRONG).select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"))
    cells = lambda a, b: F.explode(F.sequence(F.floor(a / scope), F.floor(b / scope)))
    weak = parts.filter(F.col("kind") >= STRONG).withColumn("category", _category("kind"))
    # Weak parts within a strong span go.
    inside = strong.withColumn("cell", cells(F.col("s"), F.col("e")))
    weak = weak.withColumn("cell", F.floor(F.col("start") / scope))
    weak = weak.join(inside.withColumnRenamed("cell", "c"), (F.col("row") == F.col("r")) & (F.col("cell") == F.col("c")) & (F.col("start") < F.col("e")) & (F.col("end") > F.col("s")) & (F.col("start") >= F.col("s")), "left_anti")
    weak = weak.drop("cell").withColumn("cell", cells(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope))
    near = parts.select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"), _category("kind").alias("other"), cells(F.col("start"), F.col("end")).alias("c"))
    linked = weak.join(
        near,
        (F.col("row") == F.col("r")) & (F.col("cell") == F.col("c"))
        & (F.col("s") < F.col("end") + scope) & (F.col("e") > F.col("start") - scope)
        & (F.col("category") != F.col("other")) & ((F.col("category") == "secret") | (F.col("other") == "secret")),
        "left_semi",
    )
    return linked.select("row", "kind", "start", "end").distinct()


def scan(docs: DataFrame, scope: int = 200) -> DataFrame:
    """Per row of ``docs``: row, doc_id, text_hash, parts (kind, start, end), by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.concat(*(_found(text, at) for at in range(len(KINDS))))
    rows = staged(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"), F.xxhash64("text").alias("text_hash"), found.alias("found")), "secret-matches"
    )
    parts = staged(_parts(rows.filter(F.size("found") > 0)), "secret-parts")
    kept = parts.filter(F.col("kind") < STRONG).union(_supported(parts, scope))
    lists = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("parts"))
    return rows.select("row", "doc_id", "text_hash").join(lists, "row", "left").withColumn(
        "parts", F.coalesce("parts", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    )


def spans_text(parts: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*(F.lit(k[0]) for k in KINDS))
    return F.array_join(F.transform(parts, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", scope: int = 200) -> DataFrame:
    """``docs`` with every reported span replaced by ``mark``; overlapping spans become one."""
    found = scan(docs, scope).filter(F.size("parts") > 0)
    each = found.select("doc_id", "text_hash", "row", F.explode("parts").alias("p"))
    before = Window.partitionBy("row").orderBy("p.start", "p.end").rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce(F.col("p.start") >= F.max("p.end").over(before), F.lit(True)).cast("int")
    island = F.sum("new").over(Window.partitionBy("row").orderBy("p.start", "p.end").rowsBetween(Window.unboundedPreceding, 0))
    cuts = each.withColumn("new", new).withColumn("island", island)
    cuts = cuts.groupBy("doc_id", "text_hash", "row", "island").agg(F.min("p.start").alias("start"), F.max("p.end").alias("end"))
    # Repeated rows have equal spans: one of them tells for all.
    cuts = cuts.groupBy("doc_id", "text_hash", "row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    cuts = staged(cuts.groupBy(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")).agg(F.first("cuts").alias("cuts")), "secret-cuts")
    text, name = F.col("text"), {c: docs[c] for c in docs.columns}
    piece = lambda cuts, x, i: F.substring(text, (F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0)) + 1).cast("int"), (x["start"] - F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0))).cast("int"))
    cut = F.col("cuts")
    head = F.array_join(F.transform(cut, lambda x, i: F.concat(piece(cut, x, i), F.lit(mark))), "")
    tail = F.substring(text, (F.element_at(cut, -1)["end"] + 1).cast("int"), F.length(text))
    joined = docs.join(cuts, docs["doc_id"].eqNullSafe(F.col("of_id")) & (F.xxhash64(docs["text"]) == F.col("of_hash")), "left")
    clean = F.when(F.col("cuts").isNull(), text).otherwise(F.concat(head, tail))
    rows = joined.withColumn("_clean", clean)
    size = lambda c: F.length("_clean").cast(docs.schema[c].dataType)
    return rows.select(*(F.col("_clean").alias(c) if c == "text" else size(c).alias(c) if c == "n_chars" else name[c] for c in docs.columns))
