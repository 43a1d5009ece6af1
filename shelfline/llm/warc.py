"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Each page becomes one record, a gzip member of its own. Of pages with equal payloads of at
least ``min_payload`` bytes, the one with the largest id is stored as a response; the others
become revisit records that name it and carry no payload. Shorter payloads are stored with
every page. Payload digests are SHA-1 in base 32; the block digest covers what is stored.

The reader checks each record: version line, headers, lengths, block digest. Where a check
fails it goes on at the next gzip member or version line, in the file or in what the member
holds, whose record passes all checks, and reports the bytes skipped as a gap with the reason.
Of a damaged or cut member it keeps the records that pass, as far as zlib unpacks it.
Nothing that can be read is lost to damage before it. No digest covers headers: a single
record whose member fails its checksum is left out, of several the gap tells of the failure.

Digests are taken in a pass of their own. Payloads are compressed before the shuffle that
joins them with their verdicts, where a hot payload meets one row per digest, on which
adaptive execution splits it. Archives hold ``records_per_file`` records at most and each is
read by one task, so a foreign archive must fit into a task's memory (and into the 2 GB that
Spark allows for a binary value).

Files are written and read by Spark, in any store it can reach. A line feed, which belongs
to no member, would end every row of a text file; instead each row lacks its last byte,
a zero, and zero ends every row. The last byte of a gzip member is the top byte of the
stored length, zero below 16 MiB; after a longer record an empty member follows.

Defined results: a null html is an empty payload, a null url an empty target. Null ids sort
before all others; a page whose id equals that of its response is itself a response, so
repeated rows are stored each time. Further columns are not read. An empty table gives an
archive without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import staged

VERSION = b"WARC/1.1\r\n"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
DATE = "2025-01-01T00:00:00Z"
RECORD = "page_id string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary, gap_start long, gap_end long, reason string"


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: str | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(kind: str, page_id: str | None, url: str, digest: str, size: int, block: bytes, refers_to: str | None) -> bytes:
    """One record, uncompressed."""
    lines = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{digest32(block)}",
        f"X-Payload-Length: {size}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""])
    return VERSION + head.encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member that ends in a zero byte."""
    packed = gzip.compress(data, 1, mtime=0)
    return packed if packed[-1] == 0 else packed + EMPTY_MEMBER


# --- reading -----------------------------------------------------------------------------


GZIP = b"\x1f\x8b\x08"
DAMAGED = "gzip member is damaged"


class Damaged(ValueError):
    pass


def _header_end(data: bytes, at: int) -> int:
    """Place of the blank line that ends the headers, before any next version line, or -1."""
    width = 1 << 16
    while True:
        stop = data.find(b"\r\n\r\n", at, at + width)
        if data.find(b"\nWARC/1.", at, at + width if stop < 0 else stop) >= 0:
            return -1
        if stop >= 0 or at + width >= len(data):
            return stop
        width *= 2


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``; raises Damaged where a check fails."""
    if data[at : at + 7] != b"WARC/1.":
        raise Damaged("no version line")
    stop = _header_end(data, at)
    if stop < 0:
        raise Damaged("headers do not end")
    headers = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header without a colon")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise Damaged("no content length")
    start, end = stop + 4, stop + 4 + int(length)
    block = data[start:end]
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("record does not end where its length says")
    kind, _, value = headers.get("warc-block-digest", "").partition(":")
    if kind == "sha1" and value != digest32(block):
        raise Damaged("block digest differs")
    return headers, block, end + 4


def _unpack(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at ``at`` holds, where reading it ended, and what is wrong with it.

    A damaged member gives all that zlib can unpack before the damage.
    """
    unpack, view, size, width = zlib.decompressobj(31), memoryview(data), len(data), 1 << 16
    parts = []
    while at < size and not unpack.eof:
        chunk, before = view[at : at + width], unpack.copy()
        try:
            parts.append(unpack.decompress(chunk))
        except zlib.error:
            # An error takes the output of its call along, so bytes go in one by one.
            for i in range(len(chunk)):
                try:
                    parts.append(before.decompress(chunk[i : i + 1]))
                except zlib.error:
                    return b"".join(parts), at + i, DAMAGED
        at += len(chunk)
    return b"".join(parts), at - len(unpack.unused_data), "" if unpack.eof else "gzip member is cut off"


def _plain(data: bytes) -> Iterator[tuple]:
    at, bad, reason, size = 0, None, "", len(data)
    while at < size:
        try:
            headers, block, end = parse(data, at)
        except Damaged as error:
            if bad is None:
                bad, reason = at, str(error)
            at = data.find(b"WARC/1.", at + 1)
            at = size if at < 0 else at
            continue
        if bad is not None:
            yield ("gap", bad, at, reason)
            bad = None
        yield ("record", headers, block)
        at = end
    if bad is not None:
        yield ("gap", bad, size, reason)


def _member(data: bytes, at: int) -> tuple[list[tuple], int, str]:
    """Records and inner gaps of the gzip member at ``at``, where it ended and what is wrong with it."""
    content, end, wrong = _unpack(data, at)
    found = list(_plain(content))
    if wrong == DAMAGED and [f[0] for f in found] == ["record"]:
        # The damage lies in this record's headers, which no digest covers, or in the checksum.
        found = []
    place = "of the member's content"
    return [f if f[0] == "record" else ("gap", at, end, f"{f[3]}, bytes {f[1]} to {f[2]} {place}") for f in found], end, wrong


def salvage(data: bytes) -> Iterator[tuple]:
    """("record", headers, block) and ("gap", start, end, reason) of an archive, in order.

    The bytes at each position tell a gzip member from a plain record. A gap inside of a member
    has the member's place and names the bytes of its content; a damaged member is a gap itself.
    """
    at, bad, reason, size = 0, None, "", len(data)
    ahead = dict.fromkeys((GZIP, b"WARC/1."), -1)
    # Records of damaged members; up to where zlib read, they may lie there uncompressed.
    given: set[tuple] = set()
    until = 0
    while at < size:
        found, wrong, resume = [], "", 0
        if data.startswith(GZIP, at):
            found, end, wrong = _member(data, at)
            if not wrong:
                resume = end
                if found and not any(f[0] == "record" for f in found):
                    found, wrong = [], found[0][3]
        else:
            try:
                headers, block, resume = parse(data, at)
                if at >= until or tuple(headers.items()) not in given:
                    found = [("record", headers, block)]
            except Damaged as error:
                wrong = str(error)
        if any(f[0] == "record" for f in found):
            if bad is not None:
                yield ("gap", bad, at, reason)
            yield from found
            bad = None
            if wrong:
                given |= {tuple(f[1].items()) for f in found if f[0] == "record"}
                until = max(until, end)
        if wrong and bad is None:
            bad, reason = at, wrong
        if resume:
            at = resume
            continue
        for mark, place in ahead.items():
            if place <= at:
                place = data.find(mark, at + 1)
                ahead[mark] = size if place < 0 else place
        at = min(ahead.values())
    if bad is not None:
        yield ("gap", bad, size, reason)


def _named(uri: str) -> str | None:
    return uri.removeprefix("<urn:page:").removesuffix(">") or None


def _read(keep_payload: bool, whole: bool):
    def run(batches):
        for pdf in batches:
            for file, data in zip(pdf["path"], pdf["content"]):
                rows = []
                for found in salvage(bytes(data)):
                    if found[0] == "gap":
                        if whole:
                            raise Damaged(f"{file}, bytes {found[1]} to {found[2]}: {found[3]}")
                        rows.append((None,) * 6 + found[1:])
                        continue
                    headers, block = found[1:]
                    kind = headers.get("warc-type", "")
                    size = headers.get("x-payload-length", "")
                    rows.append((
                        _named(headers.get("warc-record-id", "")),
                        kind,
                        _named(headers["warc-refers-to"]) if "warc-refers-to" in headers else None,
                        int(size) if kind == "revisit" and size.isdigit() else len(block),
                        headers.get("warc-payload-digest", "").removeprefix("sha1:"),
                        block if keep_payload else None,
                        None, None, None,
                    ))
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD.split(", ")])
                for name in ("payload_bytes", "gap_start", "gap_end"):
                    out[name] = pd.array(out[name].tolist(), dtype="Int64")
                out.insert(0, "file", file)
                yield out

    return run


def read(spark: SparkSession, path: str, keep_payload: bool = True, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of the archives under ``path``; gaps: file, gap_start, gap_end, reason.

    With ``whole`` the archives are held to be undamaged, and a gap fails the job.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    everything = files.select("path", "content").mapInPandas(_read(keep_payload, whole), f"file string, {RECORD}")
    records = everything.filter("reason is null").drop("file", "gap_start", "gap_end", "reason")
    return records, everything.filter("reason is not null").select("file", "gap_start", "gap_end", "reason")


# --- writing -----------------------------------------------------------------------------


def _packed(batches):
    for pdf in batches:
        rows = []
        for page_id, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
            payload = (html or "").encode()
            whole = record("response", page_id, url or "", digest32(payload), len(payload), payload, None)
            rows.append((page_id, url, hashlib.sha1(payload).hexdigest(), len(payload), member(whole)))
        yield pd.DataFrame(rows, columns=["page_id", "url", "hex", "size", "member"])


def _verdicts(batches):
    for pdf in batches:
        rows = []
        for page_id, url, hexed, size, packed, refers in zip(pdf["page_id"], pdf["url"], pdf["hex"], pdf["size"], pdf["member"], pdf["refers"]):
            if refers is not None:
                digest = base64.b32encode(bytes.fromhex(hexed)).decode()
                packed = member(record("revisit", page_id, url or "", digest, size, b"", refers))
            rows.append(bytes(packed)[:-1])
        yield pd.DataFrame({"value": rows})


def write(pages: DataFrame, path: str, min_payload: int = 0, records_per_file: int = 2000) -> None:
    """Write the pages (page_id, url, html) as gzipped WARC files of up to ``records_per_file``."""
    rows = pages.select(F.col("page_id").cast("string"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    digests = rows.select(F.sha1(F.col("html").cast("binary")).alias("d"), F.octet_length("html").alias("s"), F.col("page_id").cast("long").alias("number"))
    firsts = digests.filter(F.col("s") >= min_payload).groupBy("d", "s").agg(F.count("*").alias("n"), F.max("number").alias("first"))
    firsts = staged(firsts.filter("n > 1").select("d", "s", F.col("first").cast("string").alias("first")), "warc-digests")
    packed = rows.mapInPandas(_packed, "page_id string, url string, hex string, size int, member binary")
    joined = packed.join(firsts, (F.col("hex") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    refers = F.when(F.col("d").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    records = joined.select("page_id", "url", "hex", "size", "member", refers.alias("refers"))
    files = records.mapInPandas(_verdicts, "value binary").select(F.col("value").cast("string"))
    files.write.option("maxRecordsPerFile", records_per_file).option("lineSep", "\x00").text(path)
