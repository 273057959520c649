"""Token ids in binary files with Elias-Fano encoded document boundaries.

A file holds the ids of consecutive documents one after another.  The start of
each document in that array is a rising sequence; it is stored in two parts,
the low bits packed and the high bits in unary, which takes about
``2 + log2(ids / documents)`` bits a document.  A sample of every 256th one-bit
lets :meth:`TokenFile.start` answer from a few bytes, so no 64-bit table is
needed to find a document.

Layout, little-endian: header ``HEADER``; doc ids as int64; the number of high
bytes and of samples; samples as uint32; low bits; high bits; ids.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import encoder
from tidemark.llm.texts import bounded, for_python, id_back, partitions
from tidemark.session import materialize, shared_dir

MAGIC = b"EFT1"
#: magic, bytes per id, low bits, (unused), part, file in part, start in part, documents, ids, high bytes
HEADER = struct.Struct("<4sBBHIIqqqq")
#: Ids in a file before the next one is begun; a longer document has a file for itself.
FILE_IDS = 4_000_000
EVERY = 256
BATCH = 4_000_000


def pack_low(values: np.ndarray, bits: int) -> bytes:
    if not bits or not len(values):
        return b""
    spread = (values[:, None] >> np.arange(bits)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_low(raw: bytes, n: int, bits: int) -> np.ndarray:
    if not bits or not n:
        return np.zeros(n, np.int64)
    spread = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return spread.astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))


def low_bits(n: int, universe: int) -> int:
    return max(0, (universe // max(n, 1)).bit_length() - 1)


@dataclass
class Boundaries:
    """A rising sequence, Elias-Fano encoded."""

    n: int
    bits: int
    low: bytes
    high: bytes
    samples: np.ndarray

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> Boundaries:
        n, bits = len(values), low_bits(len(values), universe)
        places = (values >> bits) + np.arange(n)
        ones = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        ones[places] = 1
        return cls(n, bits, pack_low(values, bits), np.packbits(ones, bitorder="little").tobytes(), places[::EVERY].astype(np.uint32))

    def select(self, i: int) -> int:
        """Value ``i`` alone: from the nearest sampled one-bit, counting on byte by byte."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self.samples[i // EVERY])
        left, byte = i % EVERY, place >> 3
        held = self.high[byte] >> (place & 7) << (place & 7)
        while (ones := held.bit_count()) <= left:
            left -= ones
            byte += 1
            held = self.high[byte]
        for _ in range(left):
            held &= held - 1
        place = byte * 8 + (held & -held).bit_length() - 1
        first = i * self.bits
        window = int.from_bytes(self.low[first >> 3 : (first + self.bits + 7) >> 3], "little") >> (first & 7)
        return (place - i) << self.bits | window & ((1 << self.bits) - 1)

    def all(self) -> np.ndarray:
        """Every value, each run of ``EVERY`` from its sampled one-bit on."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        i = np.arange(self.n)
        places = ones[np.searchsorted(ones, self.samples)[i // EVERY] + i % EVERY]
        return (places - np.arange(self.n)) << self.bits | unpack_low(self.low, self.n, self.bits)


@dataclass
class TokenFile:
    """A written file, read back; ``ids`` is a view of its bytes."""

    part: int
    start_in_part: int
    doc_ids: np.ndarray
    bounds: Boundaries
    ids: np.ndarray

    @staticmethod
    def to_bytes(part: int, number: int, start: int, doc_ids: list, texts: list[bytes], dtype: np.dtype) -> bytes:
        sizes = np.array([len(x) // dtype.itemsize for x in texts], np.int64)
        starts, total = np.cumsum(sizes) - sizes, int(sizes.sum())
        bounds = Boundaries.encode(starts, total)
        head = HEADER.pack(MAGIC, dtype.itemsize, bounds.bits, 0, part, number, start, len(texts), total, len(bounds.high))
        return b"".join([head, np.array(doc_ids, "<i8").tobytes(), bounds.samples.astype("<u4").tobytes(), bounds.low, bounds.high, *texts])

    @classmethod
    def from_bytes(cls, raw: bytes) -> TokenFile:
        magic, width, bits, _, part, _, start, n, total, high = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEADER.size
        doc_ids = np.frombuffer(raw, "<i8", n, at)
        at += 8 * n
        samples = np.frombuffer(raw, "<u4", -(-n // EVERY), at)
        at += 4 * len(samples)
        low = (n * bits + 7) // 8
        bounds = Boundaries(n, bits, raw[at : at + low], raw[at + low : at + low + high], samples)
        return cls(part, start, doc_ids, bounds, np.frombuffer(raw, f"<u{width}", total, at + low + high))

    def start(self, i: int) -> int:
        return self.bounds.select(i) if i < self.bounds.n else len(self.ids)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.start(i) : self.start(i + 1)]


MANIFEST = "part int, file string, start_in_part long, n_docs long, n_ids long"
READ = "part int, start_in_part long, doc_id long, n_tokens long, ids_crc32 long"


def _put(folder: str, name: str, raw: bytes) -> None:
    """Write under a name of this attempt, then move: a repeated task replaces a file by the same bytes."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    store.create_dir(base, recursive=True)
    attempt = f"{base}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(attempt) as out:
        out.write(raw)
    store.move(attempt, f"{base}/{name}")


def _writer(content: bytes, folder: str, end: int | None, file_ids: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        coder = encoder.encoder(content)
        part, number, start, held = TaskContext.get().partitionId(), 0, 0, 0
        last = np.array([] if end is None else [end], coder.dtype).tobytes()
        doc_ids: list = []
        ids: list[bytes] = []

        def flush() -> pd.DataFrame:
            name = f"part-{part:06d}-{number:06d}.eft"
            _put(folder, name, TokenFile.to_bytes(part, number, start, doc_ids, ids, coder.dtype))
            return pd.DataFrame({"part": [part], "file": [name], "start_in_part": [start], "n_docs": [len(ids)], "n_ids": [held]})

        for frame in bounded(frames, "text", BATCH):
            for doc_id, raw in zip(frame["doc_id"].tolist(), coder.encode(frame["text"].tolist()), strict=True):
                size = (len(raw) + len(last)) // coder.dtype.itemsize
                if ids and held + size > file_ids:
                    yield flush()
                    number, start, held, doc_ids, ids = number + 1, start + held, 0, [], []
                doc_ids.append(doc_id)
                ids.append(raw + last)
                held += size
        if ids:
            yield flush()

    return write


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int | None, folder: str, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode every text and write the ids to ``folder`` in ascending ``doc_id`` order; gives the list of files.

    Documents are range-partitioned by id (null ids first), so a part's files
    and the parts themselves follow each other in order.  A file is written by
    one task under a temporary name and moved when whole; a task that runs
    again writes the same bytes.  Memory is bounded by one file and one batch.
    """
    ranged = for_python(docs).repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(ranged.mapInPandas(_writer(encoder.load(tokenizer_path), folder, end_id, file_ids), MANIFEST), "token-files")


def _reader(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for raw in frame["content"]:
            held = TokenFile.from_bytes(raw)
            starts = held.bounds.all()
            for i in range(EVERY - 1, len(starts), EVERY):
                if held.start(i) != starts[i]:
                    raise ValueError("a document's boundary is not where its sample leads")
            ends = np.append(starts[1:], len(held.ids))
            wide = held.ids.astype("<u4")
            crc = [zlib.crc32(wide[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            found = {"start_in_part": starts + held.start_in_part, "doc_id": held.doc_ids, "n_tokens": ends - starts, "ids_crc32": crc}
            yield pd.DataFrame({"part": held.part, **found})


def read_token_files(docs: DataFrame, manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, from the files alone: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it, over all files: the
    files know their start within a part, and the parts' totals (one row each)
    are summed up in order.
    """
    spark = docs.sparkSession
    totals = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.eft").load(folder).select("content")
    read = files.mapInPandas(_reader, READ)
    return read.join(F.broadcast(bases), "part").select(id_back(), (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the token files below the cluster's shared folder and read them back.

    A null text is empty: it has the end id alone, or no id.  Rows that share
    an id follow each other by text; null ids come first.  Very long texts get
    a file of their own.  Other columns are not read.  An empty table writes no
    file and gives no rows.
    """
    folder = shared_dir(docs.sparkSession, "token-ids")
    manifest = write_token_files(docs, tokenizer_path, end_id, folder, file_ids)
    if manifest.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(docs, manifest, folder)
