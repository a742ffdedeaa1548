"""What several operators of this subpackage share: scratch tables, Arrow blocks, vectorised words.

Words are found and hashed with numpy over whole blocks of UTF-8 bytes, never one by one in Python.
A span's hash is two polynomials over its bytes modulo the prime 2**31 - 1, at two fixed points, with a
final mix; spans of more than LONG bytes take a BLAKE2b digest instead. It depends on the bytes alone
and is the same in every task. (Modulo a power of two, some long words would collide at every point.)
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
PIECE = 1 << 16  # bytes hashed at a time, so that the arrays stay in the cache
U64 = np.uint64
PRIME = U64((1 << 31) - 1)
_POINTS = (1_583_458_089, 784_588_716)
LONG = 256  # bytes from which a span is hashed by a digest


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for tables that cut lineage: spark.checkpoint.dir.

    Where it is unset, a session on this machine alone (master local) gets a temporary folder; any other is refused,
    for its executors would write to disks that nobody else sees.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        root = "file://" + tempfile.mkdtemp(prefix="snapweave-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/snapweave/{name}-{uuid.uuid4().hex}"


#: Spark's own setting that removes the shuffle files of a query when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to a table in the scratch folder and return what is read back; its path is in .scratch.

    The shuffle files of the write go when it has ended, for whatever follows reads the table. While it runs, lost ones are made again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def discard(*frames: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "scratch", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def free_name(name: str, taken: Iterable[str]) -> str:
    """A column name like `name` that clashes with none of the taken ones, in any case of letters."""
    taken = {x.lower() for x in taken}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about `limit` bytes of a column; a longer value is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """Values of a string column as UTF-8; null is empty."""
    col = pc.fill_null(batch.column(column), "")
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for x below 2**62."""
    x = (x & PRIME) + (x >> U64(31))
    x = (x & PRIME) + (x >> U64(31))
    return np.where(x == PRIME, U64(0), x)


_BYTES = tuple(_mod(mix(np.arange(1, 257, dtype=U64) * U64(p)) >> U64(3)) for p in _POINTS)
_powers: dict[int, tuple] = {}


def powers(n: int) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """For each point its powers 0..n, at least, and those of its inverse, modulo PRIME."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        if size > 1 << 22:
            _powers.clear()
        out = []
        for x in _POINTS:
            both = []
            for y in (x, pow(x, -1, int(PRIME))):
                p = np.ones(size, U64)
                done, step = 1, y  # p[:done] is ready, step is y**done
                while done < size:
                    p[done : 2 * done] = _mod(p[:done] * U64(step))
                    done, step = 2 * done, step * step % int(PRIME)
                both.append(p)
            out.append(tuple(both))
        _powers[size] = tuple(out)
    return _powers[size]


def byte_class(members: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Bytes of words between ASCII white space.
NOT_SPACE = byte_class(b for b in range(256) if not (b == 0x20 or 9 <= b <= 0x0D))
#: Bytes of words of lower-case letters, digits and all that is not ASCII.
WORD_BYTES = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes in the class."""
    flag = np.empty(len(data) + 2, np.int8)
    flag[0] = flag[-1] = 0
    flag[1:-1] = inside[data]
    edge = np.flatnonzero(np.diff(flag))
    return edge[::2], edge[1::2]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; spans ascend. Works through pieces, so memory follows the spans."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, lo + PIECE, "right")))
        s, e = starts[at:to] - lo, ends[at:to] - lo
        n = int(e.max())
        piece, sides = data[lo : lo + n], []
        for table, (up, down) in zip(_BYTES, powers(n + 1), strict=True):
            total = np.zeros(n + 1, U64)
            product = table[piece]
            product *= up[:n]
            low = product & PRIME
            product >>= U64(31)
            product += low  # below 2**32, so sums of 2**30 bytes stay exact
            np.cumsum(product, out=total[1:])
            sides.append(_mod(_mod(total[e] - total[s]) * down[s]))
        out[at:to] = mix(((sides[0] << U64(31)) | sides[1]) ^ mix((e - s).astype(U64)))
        for k in np.flatnonzero(e - s > LONG).tolist():
            out[at + k] = int.from_bytes(hashlib.blake2b(piece[s[k] : e[k]].tobytes(), digest_size=8).digest(), "little")
        at = to
    return out


class Words:
    """The words of a block of texts: hash, doc (index of the text), start and end in `data`; first: words before each text."""

    def __init__(self, texts: list[bytes], inside: np.ndarray, lower: bool):
        joined = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(joined.lower() if lower else joined, np.uint8)  # bytes.lower() is ASCII only
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_start = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.start, self.end = spans(self.data, inside)
        self.first = np.searchsorted(self.start, self.text_start)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hash = hash_spans(self.data, self.start, self.end)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


_TURNS = mix(np.arange(1, 65, dtype=U64) * U64(0xD6E8FEB86659FD93)) | U64(1)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words; len(words) - n + 1 values, none if fewer."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, U64)
    out = np.full(m, n, U64)
    for k in range(n):
        out += words[k : k + m] * _TURNS[k % 64]
    return mix(out)


def code_points(data: np.ndarray) -> np.ndarray:
    """Running count of code points before each byte; one more value than bytes."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def record(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


_SPACE = byte_class([*range(9, 14), 0x20])
_LETTER = byte_class([*range(0x41, 0x5B), *range(0x61, 0x7B)])
_PUNCT = byte_class(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Positions where no word pattern of the public tokenizers spans the two bytes around.

    Before ASCII white space that follows no white space of any kind, and between an ASCII letter and
    ASCII punctuation. A text that holds the opening of a special token must not be cut in this way.
    """
    if len(data) < 2:
        return np.empty(0, np.int64)
    p1, here = data[:-1], data[1:]
    p2, p3 = np.concatenate(([0], data[:-2])).astype(np.uint8), np.concatenate(([0, 0], data[:-3])).astype(np.uint8)[: len(p1)]
    wide = (p2 == 0xC2) & ((p1 == 0xA0) | (p1 == 0x85))
    wide |= (p3 == 0xE1) & (p2 == 0x9A) & (p1 == 0x80)
    wide |= (p3 == 0xE2) & (p2 == 0x80) & (((p1 >= 0x80) & (p1 <= 0x8A)) | (p1 == 0xA8) | (p1 == 0xA9) | (p1 == 0xAF))
    wide |= (p3 == 0xE2) & (p2 == 0x81) & (p1 == 0x9F)
    wide |= (p3 == 0xE3) & (p2 == 0x80) & (p1 == 0x80)
    before = _SPACE[here] & (p1 > 0x20) & (p1 != 0x7F) & ~wide
    return np.flatnonzero(before | (_LETTER[p1] & _PUNCT[here])) + 1


class Units:
    """Ids of text units for one tokenizer, kept by a worker between blocks and bounded in number.

    Units are found by their hash and taken only if their bytes agree as well. When the table is full it starts afresh.
    """

    def __init__(self, encode, limit: int = 1 << 20):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, U64)
        self.order = np.empty(0, np.int64)
        self.begin = np.zeros(1, np.int64)
        self.ids = np.empty(0, np.int32)
        self.text_begin = np.zeros(1, np.int64)
        self.text = np.empty(0, np.uint8)

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in a row, how many each unit has). The units follow one another without a gap."""
        key, first, inverse = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(key) > self.limit:
            self.clear()
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        missing = np.flatnonzero(self.keys[at] != key) if len(self.keys) else np.arange(len(key))
        if len(missing):
            raw = data.tobytes()
            pieces = [raw[starts[k] : ends[k]] for k in first[missing]]
            new = self.encode([x.decode("utf-8") for x in pieces])
            sizes = np.fromiter(map(len, new), np.int64, len(new))
            slots = len(self.begin) - 1 + np.arange(len(new))
            self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(sizes)))
            self.ids = np.concatenate((self.ids, np.fromiter((x for ids in new for x in ids), np.int32, int(sizes.sum()))))
            self.text_begin = np.concatenate((self.text_begin, self.text_begin[-1] + np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))))
            self.text = np.concatenate((self.text, np.frombuffer(b"".join(pieces), np.uint8)))
            keys, order = np.concatenate((self.keys, key[missing])), np.concatenate((self.order, slots))
            by = np.argsort(keys, kind="stable")
            self.keys, self.order = keys[by], order[by]
            at = np.searchsorted(self.keys, key)
        slot = self.order[at][inverse]
        length = ends - starts
        if (self.text_begin[slot + 1] - self.text_begin[slot] != length).any() or not self._same(data[starts[0] : ends[-1]], starts - starts[0], length, slot):
            return self._one_by_one(data.tobytes(), starts, ends)
        begin, size = self.begin[slot], self.begin[slot + 1] - self.begin[slot]
        out_end = np.cumsum(size)
        total = int(out_end[-1]) if len(out_end) else 0
        return self.ids[np.repeat(begin - (out_end - size), size) + np.arange(total)], size

    def _same(self, data: np.ndarray, starts: np.ndarray, length: np.ndarray, slot: np.ndarray) -> bool:
        return bool((self.text[np.repeat(self.text_begin[slot] - starts, length) + np.arange(len(data))] == data).all())

    def _one_by_one(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without hashes, for a block in which two units have one."""
        pieces = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        different = list(dict.fromkeys(pieces))
        ids = dict(zip(different, self.encode([x.decode("utf-8") for x in different]), strict=True))
        sizes = np.fromiter((len(ids[x]) for x in pieces), np.int64, len(pieces))
        return np.fromiter((t for x in pieces for t in ids[x]), np.int32, int(sizes.sum())), sizes


def unit_starts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts in a row, first byte of each unit between safe cuts, end of each text)."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    text_end = np.cumsum(lengths)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return data, np.empty(0, np.int64), text_end
    cuts = np.unique(np.concatenate(([0], safe_cuts(data), text_end[text_end < len(data)])))
    if b"<|" in data.tobytes():  # a special token may be near: such texts stay whole
        at, keep = 0, np.ones(len(cuts), bool)
        for size, text in zip(lengths, texts, strict=True):
            if b"<|" in text:
                lo, hi = np.searchsorted(cuts, [at + 1, at + size])
                keep[lo:hi] = False
            at += size
        cuts = cuts[keep]
    return data, cuts, text_end


def encode_units(texts: list[bytes], units: Units) -> tuple[np.ndarray, np.ndarray]:
    """(all ids in a row, number of ids of each text), through units between safe cuts."""
    data, cuts, text_end = unit_starts(texts)
    if not len(data):
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    ids, size = units.lookup(data, cuts, np.append(cuts[1:], len(data)))
    run = np.concatenate(([0], np.cumsum(size)))
    text_first = np.searchsorted(cuts, np.concatenate(([0], text_end)))
    return ids, run[text_first[1:]] - run[text_first[:-1]]


KEY_BITS = 1 << 23


def key_bitmap(keys: DataFrame, name: str) -> np.ndarray:
    """A bitmap of fixed size (1 MB) that holds the keys; at most KEY_BITS / 32 rows reach the driver.

    It only saves work: what passes is joined exactly later.
    """
    rows = keys.select(F.pmod(F.col(name), F.lit(KEY_BITS)).alias("s")).groupBy(F.expr("s div 32").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 32 as int))")).alias("bits")).toArrow()
    out = np.zeros(KEY_BITS // 32, np.uint32)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return out


def passes(bitmap: np.ndarray, keys: pa.Array) -> pa.Array:
    slot = np.mod(keys.to_numpy(zero_copy_only=False), KEY_BITS)
    return pa.array((bitmap[slot // 32] >> (slot % 32).astype(np.uint32)) & 1 == 1)
