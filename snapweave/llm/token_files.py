"""Operator 10, token ids in binary files with Elias-Fano coded document boundaries.

Documents are range-partitioned and sorted by doc_id; each partition encodes its texts and writes files
of concatenated ids. A file holds, after a small JSON header, the ids in 2 or 4 bytes each, the running
ends of its documents and their doc_ids, both as Elias-Fano sequences: low bits packed, high bits unary
with sampled select positions of 4 bytes, so the i-th boundary is found without a table of 64-bit offsets.

Files are named at random by each task attempt; only those in the manifest, which holds one row for each
file, belong to the result. A retried task leaves at most files that nothing reads.

Defined results: null is the empty text, which still gets its end id; documents without a doc_id come first and keep
their null; repeated doc_ids are ordered by a hash of their text and each gets its row; a very long text may make a
file longer than the rest; an empty table gives an empty manifest and no rows; columns other than doc_id and text,
whatever their names, are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapweave.llm.bpe import encoder
from snapweave.llm.shared import BLOCK_BYTES, blocks, partitions, record, scratch_path, stored, utf8
from snapweave.llm.tokens import BYTE_BPE, tokenizer

MAGIC = b"SNAPTOK1"
FILE_IDS = 1 << 25  # ids of a file at most, beyond a single longer document
SAMPLE = 256


class EliasFano:
    """An ascending sequence of non-negative integers in about 2 + log2(largest / n) bits each."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, sample: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.sample = n, low_bits, low, high, sample

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, np.empty(0, np.uint8), np.empty(0, np.uint8), np.empty(0, np.uint32))
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def _lows(self, at: int, n: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(n, np.uint64)
        first, last = at * self.low_bits, (at + n) * self.low_bits
        bits = np.unpackbits(self.low[first // 8 : -(-last // 8)], bitorder="little")[first % 8 : first % 8 + n * self.low_bits]
        return (bits.reshape(n, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The i-th value, from the sampled position before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, rank = int(self.sample[i // SAMPLE]), i % SAMPLE
        byte, skip = divmod(at, 8)
        seen, base = 0, byte * 8
        while True:
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 64], bitorder="little"))
            ones = ones[ones >= skip] if skip else ones
            if seen + len(ones) > rank:
                place = base + int(ones[rank - seen])
                return (place - i << self.low_bits) | int(self._lows(i, 1)[0])
            seen, byte, base, skip = seen + len(ones), byte + 64, base + 512, 0

    def all(self) -> np.ndarray:
        """All values, by one select over the whole of the high bits."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | self._lows(0, self.n)

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.sample.astype("<u4").tobytes()]


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, width: int) -> None:
    """One file; of the documents, those without a doc_id come first and have no entry in doc_ids."""
    low = int(doc_ids[0]) if len(doc_ids) else 0  # ascending, so the differences to the first are not negative
    sequences = [EliasFano.build(np.cumsum(counts)), EliasFano.build((doc_ids.astype(np.int64) - low).view(np.uint64))]
    parts = [ids.astype(f"<u{width}").tobytes(), *(p for s in sequences for p in s.parts())]
    head = json.dumps({"docs": [len(counts), len(doc_ids)], "width": width, "first_doc": low, "low_bits": [s.low_bits for s in sequences], "sizes": list(map(len, parts))}).encode()
    fs, path = _filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(MAGIC + len(head).to_bytes(4, "little") + head)
        for p in parts:
            out.write(p)


class TokenFile:
    """A file read back: ids, ends (EliasFano) and doc_ids (EliasFano, less first_doc)."""

    def __init__(self, uri: str):
        fs, path = _filesystem(uri)
        with fs.open_input_stream(path) as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        size = int.from_bytes(raw[8:12], "little")
        head = json.loads(raw[12 : 12 + size])
        at, parts = 12 + size, []
        for n in head["sizes"]:
            parts.append(raw[at : at + n])
            at += n
        self.ids = np.frombuffer(parts[0], f"<u{head['width']}")
        self.first_doc = head["first_doc"]
        self.ends, self.docs = (EliasFano(n, bits, np.frombuffer(p[0], np.uint8), np.frombuffer(p[1], np.uint8), np.frombuffer(p[2], "<u4")) for n, bits, p in zip(head["docs"], head["low_bits"], (parts[1:4], parts[4:7]), strict=True))

    def doc_ids(self) -> list[int | None]:
        return [None] * (self.ends.n - self.docs.n) + (self.docs.all().view(np.int64) + self.first_doc).tolist()

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


MANIFEST = pa.schema([("first_doc", pa.int64()), ("first_tie", pa.int64()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
MANIFEST_DDL = "first_doc long, first_tie long, uri string, n_docs long, n_ids long"
ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write(docs: DataFrame, folder: str, name: str = BYTE_BPE, end_id: int = 2, file_ids: int = FILE_IDS) -> DataFrame:
    """Write docs as token files under folder; returns the stored manifest with `base`, the ids before each file."""
    spark = docs.sparkSession
    n = partitions(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, 1 << 16, offsets=False)
        width = 2 if tokenizer(name).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        first, size = None, 0

        def flush():
            uri = f"{folder}/tokens-{uuid.uuid4().hex}.bin"
            doc_ids, counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            write_file(uri, doc_ids, counts, ids, width)
            return record(MANIFEST, {"first_doc": [first[0]], "first_tie": [first[1]], "uri": [uri], "n_docs": [len(counts)], "n_ids": [len(ids)]})

        for b in blocks(batches, "text", 2 * BLOCK_BYTES):
            if first is None:
                first = b.column("doc_id")[0].as_py(), b.column("tie")[0].as_py()
            each = [np.append(x, end_id).astype(np.int32) for x in enc(utf8(b, "text"))]
            held.append((b.column("doc_id").drop_null().to_numpy(zero_copy_only=False).astype(np.int64), np.fromiter(map(len, each), np.int64, len(each)), np.concatenate(each)))
            size += len(held[-1][2])
            if size >= file_ids:
                yield flush()
                held, first, size = [], None, 0
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    manifest = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").mapInArrow(run, MANIFEST_DDL)
    before = Window.orderBy(F.col("first_doc").asc_nulls_first(), "first_tie").rowsBetween(Window.unboundedPreceding, -1)
    return stored(manifest, "token-manifest").withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids of each document, from the files."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                f = TokenFile(row["uri"])
                ends = f.ends.all().astype(np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                raw = memoryview(f.ids.astype("<u4").tobytes())
                yield record(ROWS, {"doc_id": f.doc_ids(), "start": row["base"] + starts, "n_tokens": ends - starts, "ids_crc32": [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]})

    return manifest.select("uri", "base").repartition(partitions(manifest.sparkSession)).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "tokens")
