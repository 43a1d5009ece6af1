"""Token files: ids of many documents in one array, boundaries in Elias-Fano code.

A token file holds, for consecutive documents in ascending id order:

    bytes   content
    4       b"SLT1"
    8 x 6   little-endian 64-bit: partition, sequence number in it, documents, ids, bytes
            per id, bytes of the block of document ids
    ...     the ids, 2 bytes each where all are below 65536, else 4, little-endian
    ...     Elias-Fano block: end of each document in ids, from the start of the file
    ...     document ids: a byte per document (0: null), then an Elias-Fano block of the
            ids that are not null, less the smallest, which comes first in 8 bytes
    1       a line feed

An Elias-Fano block of n rising numbers up to u: n and u (8 bytes each), the place of every
256th set bit of the upper part (4 bytes each), the lower floor(log2(u / n)) bits of each
number, packed, and the upper parts in unary. That is about 2.1 + log2(u / n) bits a document,
where a table of offsets has 64. Number i is found by selecting the i-th set bit of the upper
part from the sample before it. Readers select too, one boundary after another: no file is
decoded into a table.

Files follow each other by partition, then sequence number; a file ends after
``ids_per_file`` ids, so that reading and writing hold one file at a time. A longer document
fills a file of its own. Files are written and read by Spark, in any store it can reach.

Defined results: null and empty texts hold the end id only. Documents with a null id come
first; those that share an id follow each other in any order, and may fill any number of
tasks, as texts' hashes part them too. A text of any length is one document, in one file.
Only doc_id and text are read, so further columns cannot clash. An empty table gives no
documents.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.common import staged, text_hash
from shelfline.llm.pretokens import after_spaces, of_worker

MAGIC = b"SLT1"
SAMPLE = 256
STOPS = ".,;:!?"


class EliasFano:
    """A rising sequence of non-negative numbers."""

    def __init__(self, block: bytes, at: int = 0):
        self.n, self.u = struct.unpack_from("<QQ", block, at)
        self.low_bits = low_bits(self.n, self.u)
        self.samples = np.frombuffer(block, "<u4", -(-self.n // SAMPLE), at + 16)
        at += 16 + self.samples.nbytes
        size = (self.n * self.low_bits + 7) // 8
        self.low = np.frombuffer(block, np.uint8, size, at)
        high = (self.n + (self.u >> self.low_bits) + 8) // 8
        self.high = np.frombuffer(block, np.uint8, high, at + size)
        self.end = at + size + high

    @staticmethod
    def pack(values: np.ndarray, u: int) -> bytes:
        n, bits = len(values), low_bits(len(values), u)
        values = values.astype(np.uint64)
        low = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        upper = np.zeros((n + (u >> bits) + 8) // 8 * 8, np.uint8)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        upper[ones] = 1
        packed = np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes()
        head = struct.pack("<QQ", n, u) + ones[::SAMPLE].astype("<u4").tobytes()
        return head + packed + np.packbits(upper, bitorder="little").tobytes()

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        part = self.low[first // 8 : (first + self.low_bits + 7) // 8].tobytes()
        return (int.from_bytes(part, "little") >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The place of the i-th set bit of the upper part, from 0."""
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at // 8
        now = int(self.high[byte]) >> (at % 8) << (at % 8)
        while (held := now.bit_count()) <= left:
            left, byte = left - held, byte + 1
            now = int(self.high[byte])
        for _ in range(left):
            now &= now - 1
        return byte * 8 + (now & -now).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return ((self.select(i) - i) << self.low_bits) | self._low(i)

    def __len__(self) -> int:
        return self.n

    def all(self) -> np.ndarray:
        return np.array([self[i] for i in range(self.n)], np.uint64)


def low_bits(n: int, u: int) -> int:
    return max((u // n).bit_length() - 1, 0) if n else 0


class TokenFile:
    """An opened token file: ``start(i)``, ``ids(i)``, ``doc_ids`` without a table of offsets."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token file")
        self.partition, self.sequence, self.documents, self.n_ids, self.width, _ = struct.unpack_from("<6Q", data, 4)
        self.array = np.frombuffer(data, f"<u{self.width}", self.n_ids, 52)
        self.ends = EliasFano(data, 52 + self.n_ids * self.width)
        at = self.ends.end
        self.known = np.frombuffer(data, np.uint8, self.documents, at)
        (self.least,) = struct.unpack_from("<q", data, at + self.documents)
        self.numbers = EliasFano(data, at + self.documents + 8)

    def start(self, i: int) -> int:
        return self.ends[i - 1] if i else 0

    def ids(self, i: int) -> np.ndarray:
        return self.array[self.start(i) : self.ends[i]]

    def doc_ids(self) -> Iterator[int | None]:
        numbers = iter(self.numbers)
        return (next(numbers) + self.least if k else None for k in self.known)


def pack_file(partition: int, sequence: int, doc_ids: list, arrays: list[bytes]) -> bytes:
    """A token file of documents in ascending order; ``arrays`` are packed 32-bit ids."""
    ids = np.frombuffer(b"".join(arrays), "<u4")
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    ends = np.cumsum([len(a) // 4 for a in arrays], dtype=np.uint64)
    numbers = [d for d in doc_ids if d is not None]
    least = numbers[0] if numbers else 0
    above = np.array([d - least for d in numbers], np.uint64)
    block = bytes(d is not None for d in doc_ids) + struct.pack("<q", least)
    block += EliasFano.pack(above, int(above[-1]) if numbers else 0)
    head = MAGIC + struct.pack("<6Q", partition, sequence, len(doc_ids), len(ids), width, len(block))
    return head + ids.astype(f"<u{width}").tobytes() + EliasFano.pack(ends, len(ids)) + block + b"\n"


class LibraryIds(dict):
    """Packed ids by the tokenizers library: of each chunk that begins with a space, under its
    name without that space, for ``limit`` short chunks; of others for one batch of texts.
    """

    def __init__(self, tokenizer_json: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit = Tokenizer.from_str(tokenizer_json), limit
        # Strings that name special tokens are these tokens, as the library has it.
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.named = [t.content for t in added if t.special]
        # The characters by which byte-level vocabularies write bytes: printable ones of
        # Latin-1 stand for themselves, the others follow from 256 on.
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in plain]
        signs = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.written = "".join(signs[b] for b in range(256))
        self.model = self.tokenizer.model
        top = max(self.tokenizer.get_vocab().values(), default=0) + 1
        self.packed_id = [struct.pack("<I", i) for i in range(top)]
        self.stops: dict[str, bytes] = {}
        self.batch: dict[str, bytes] = {}

    def new_batch(self) -> None:
        self.batch = {}

    def text(self, text: str) -> bytes:
        """The text's packed ids. A text that names a special token stays whole, as what stands
        next to the name is split as at the end of a text."""
        if any(name in text for name in self.named):
            return self._whole(text)
        first, rest = after_spaces(text)
        return self._packed(first) + b"".join(map(self.__getitem__, rest)) if first or rest else b""

    def __missing__(self, after: str) -> bytes:
        packed = self.batch.get(after)
        if packed is None:
            packed = self._packed(" " + after)
            (self if len(self) < self.limit and len(after) < 64 else self.batch)[after] = packed
        return packed

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _packed(self, chunk: str) -> bytes:
        """Ids of a chunk. Where the split pattern cuts it in a plain way, of its pieces:
        at a single line feed within, and between letters and the stops after them."""
        word = chunk.rstrip(STOPS)
        if len(chunk) <= 64 and (word[1:] if word[:1] == " " else word).isalpha():
            if len(word) == len(chunk):
                return self._piece(word)
            return ((self.get(word[1:]) if word[0] == " " else None) or self._piece(word)) + self._stops(chunk[len(word) :])
        head, cut, rest = chunk.partition("\n")
        if cut and head and rest and not head[-1].isspace() and not rest[0].isspace():
            return self._packed(head) + self._stops("\n") + self._packed(rest)
        return self._whole(chunk)

    def _stops(self, stops: str) -> bytes:
        packed = self.stops.get(stops)
        if packed is None:
            packed = self._piece(stops)
            if len(self.stops) < 10_000:
                self.stops[stops] = packed
        return packed

    def _piece(self, piece: str) -> bytes:
        """Ids of a single match of the split pattern."""
        signs = piece.encode().decode("latin-1").translate(self.written)
        return b"".join([self.packed_id[t.id] for t in self.model.tokenize(signs)])


def _files(key: str, sent, end_id: int, ids_per_file: int):
    def run(batches):
        from pyspark import TaskContext

        known = of_worker(key, lambda: LibraryIds(sent.value))
        end, partition = struct.pack("<I", end_id), TaskContext.get().partitionId()
        doc_ids, arrays, held, sequence = [], [], 0, 0
        for pdf in batches:
            known.new_batch()
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                packed = known.text(text or "") + end
                if held and held + len(packed) // 4 > ids_per_file:
                    yield pd.DataFrame({"value": [pack_file(partition, sequence, doc_ids, arrays)[:-1]]})
                    doc_ids, arrays, held, sequence = [], [], 0, sequence + 1
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                arrays.append(packed)
                held += len(packed) // 4
        if arrays:
            yield pd.DataFrame({"value": [pack_file(partition, sequence, doc_ids, arrays)[:-1]]})

    return run


def write(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = 0, ids_per_file: int = 1 << 21) -> None:
    """Write the token files of ``docs`` (doc_id, text) to ``path``."""
    spark = docs.sparkSession
    # Broadcast: the vocabulary's size is fixed.
    sent = spark.sparkContext.broadcast(tokenizer_json)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # Many rows may share an id, or have none.
    order = ["doc_id", text_hash()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    nullable = ordered.select(F.col("doc_id").cast("decimal(20,0)").alias("doc_id"), "text")
    files = nullable.mapInPandas(_files(f"json:{hash(tokenizer_json)}", sent, end_id, ids_per_file), "value binary")
    # A row is a file; its last byte is the line feed that Spark writes after a row.
    files.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def _documents(batches):
    for pdf in batches:
        for data in pdf["content"]:
            if not len(data):
                continue
            file = TokenFile(bytes(data))
            rows, start = [], 0
            for doc_id, end in zip(file.doc_ids(), file.ends):
                ids = file.array[start:end].astype("<u4")
                rows.append((file.partition, file.sequence, file.n_ids, doc_id, start, end - start, zlib.crc32(ids)))
                start = end
            out = pd.DataFrame(rows, columns=["partition", "sequence", "n_ids", "doc_id", "within", "n_tokens", "ids_crc32"])
            out["doc_id"] = pd.array([r[3] for r in rows], dtype="Int64")
            yield out


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files under ``path``: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    columns = "partition long, sequence long, n_ids long, doc_id long, within long, n_tokens long, ids_crc32 long"
    rows = staged(files.mapInPandas(_documents, columns), "token-documents")
    each = ["partition", "sequence"]
    # One row per file: a window over all of them is small.
    totals = rows.groupBy(each).agg(F.max("n_ids").alias("n_ids"))
    before = F.sum("n_ids").over(Window.orderBy(*each).rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select(*each, F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(staged(starts, "token-files"), each).select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
