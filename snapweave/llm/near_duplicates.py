"""Operator 3, n-gram Jaccard join with size-banded tiles and hashed bitmap signatures.

Exact links between word-shingle sets with 100 * |A & B| >= 75 * |A | B|, and the components they make.

1. A sketch of fixed size counts shingle hashes over the whole corpus; its coarse counts give every shingle a
   rank, rare first. It is summed in streams and is the only thing sent to all tasks (256 KB).
2. Each text gives its set size, a set id (hash of the sorted set) and its prefix: the |A| - ceil(0.75 |A|) + 1 lowest-ranked shingles. Two linked sets share one of
   these. Equal sets have one id, so copies melt into one before anything is compared.
3. Prefix entries are packed by tile (a range of shingle hashes) and each tile finds the groups of different
   sets that share an entry. Groups of up to four sets give their pairs, larger ones lists of members in chunks.
4. Of each large group the hub is the member that sits in most and largest groups, which for near copies is the text
   nearest to their origin; all sets in the groups of one hub are its family. One more scan gives bitmaps of the
   sets that share a group with any other. First each set meets one partner, the hub or the set of a small group with which
   it shares most entries. The pair goes through the bitmaps - each bit that only one set has is a shingle that the other lacks, which
   bounds the overlap from above - and is verified exactly. This joins most of a family of near copies at the cost of
   one pair a set.
5. Then rounds follow until nothing is left. The pairs of small groups that still lie in two components are
   verified. Each outlier of a family (a set in another component than the hub) is compared with the whole
   family in tiles of bounded size: so many outliers and members a task, the members streamed past the outliers' bitmaps. An outlier puts forward its best
   partners; for those that have more than a round allows another round follows that allows more. The last
   round leaves nothing out, so every pair that shares a prefix entry and lies in two components was compared, and no
   link is lost, though a family of near copies costs about its number of members.

Exact means: sorted 64-bit shingle hashes intersected as arrays; a false link needs a hash collision inside
a pair. Set ids are 64-bit hashes of those arrays as well.

Defined results: null, empty and blank texts have size 0 and no links, and are their own component; a text
of one to four words has one shingle, the whole; a very long text is one set like any other, its bitmap grows
with it; repeated rows share a component; a null doc_id is never a component's name unless all its members have
none; an empty table gives no rows; other columns, whatever their names, are ignored or, in `keep_one`, passed on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from snapweave.llm.shared import NOT_SPACE, U64, Words, blocks, discard, free_name, key_bitmap, mix, ngram_hashes, partitions, passes, record, stored, utf8

WORDS = 5
PERCENT = 75
SKETCH_BITS = 18
_PARTS = 16


def shingles(texts: list[bytes], n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles in text order, where each text's begin); not yet distinct."""
    w = Words(texts, NOT_SPACE, lower=True)
    counts = w.counts
    grams = ngram_hashes(w.hash, n)
    out, first = [], np.zeros(len(texts) + 1, np.int64)
    for k, c in enumerate(counts):
        s = w.first[k]
        if c >= n:
            out.append(grams[s : s + c - n + 1])
        elif c:
            out.append(ngram_hashes(w.hash[s : s + c], int(c)))
        first[k + 1] = first[k] + (max(c - n + 1, 1) if c else 0)
    return (np.concatenate(out) if out else np.empty(0, U64)), first


def sets_of(texts: list[bytes], n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    all_of, first = shingles(texts, n)
    return [np.unique(all_of[first[k] : first[k + 1]]) for k in range(len(texts))]


def least_overlap(a, b, percent: int = PERCENT):
    """The smallest intersection of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def width_of(size: int) -> int:
    """Bits of a signature: a power of two that follows the size, so that bands of sizes share a width."""
    return 1 << max(8, int(8 * size).bit_length())


def signature(values: np.ndarray) -> bytes:
    width = width_of(len(values))
    bits = np.zeros(width, np.uint8)
    bits[((values >> U64(8)) & U64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bitmap: np.ndarray, width: int) -> np.ndarray:
    """A signature at a smaller width: bits that meet are joined by OR."""
    while len(bitmap) * 8 > width:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] | bitmap[half:]
    return bitmap


def set_id(values: np.ndarray) -> int:
    """A signed 64-bit hash of a sorted set."""
    h = mix(values ^ mix(np.arange(1, len(values) + 1, dtype=U64)))
    return int(mix(np.array([h.sum(dtype=U64) + U64(len(values))], U64)).view(np.int64)[0])


def sketch(docs: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """The rank of each sketch slot: the logarithm of how many shingles fall into it, in steps of a tenth."""
    slots = 1 << bits

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for b in blocks(batches, "text"):
            hashes, _ = shingles(utf8(b, "text"))
            total += np.bincount((hashes >> U64(64 - bits)).astype(np.int64), minlength=slots)
        if total.any():
            parts = np.split(total, _PARTS)
            yield pa.RecordBatch.from_pydict({"part": pa.array(range(_PARTS), pa.int32()), "counts": pa.array([p.tobytes() for p in parts], pa.binary())})

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for part, counts in zip(b.column("part").to_pylist(), b.column("counts").to_pylist(), strict=True):
                more = np.frombuffer(counts, np.int64)
                totals[part] = totals[part] + more if part in totals else more
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(totals), pa.int32()), "counts": pa.array([t.tobytes() for t in totals.values()], pa.binary())})

    rows = docs.select("text").mapInArrow(count, "part int, counts binary").repartition(_PARTS, "part").mapInArrow(add, "part int, counts binary").collect()
    total = np.zeros(slots, np.int64)
    for r in rows:
        size = slots // _PARTS
        total[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(255, np.log2(total + 1) * 7).astype(np.uint8)


PROFILE = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64()), ("prefix", pa.binary())])
PROFILE_DDL = "doc_id long, row_key long, n_shingles long, set_id long, prefix binary"


def _plain(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("row_key"), text.alias("text"))


def packed(hashes: np.ndarray) -> bytes:
    """The upper 48 bits of each hash, which are enough to find candidates."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    """What `packed` left of the hashes, as numbers below 2**48."""
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def profile(docs: DataFrame, ranks: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """Size, set id and prefix of each row. Of equal sets that a task meets only the first has its prefix."""
    shift = 64 - (len(ranks).bit_length() - 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in blocks(batches, "text"):
            sizes, ids, prefixes = [], [], []
            if len(seen) > REMEMBERED:
                seen.clear()
            for values in sets_of(utf8(b, "text")):
                n = len(values)
                sizes.append(n)
                if not n:
                    ids.append(None), prefixes.append(None)
                    continue
                ids.append(set_id(values))
                if ids[-1] in seen:
                    prefixes.append(None)
                    continue
                seen.add(ids[-1])
                order = (ranks[(values >> U64(shift)).astype(np.int64)].astype(U64) << U64(56)) | (values >> U64(8))
                keep = np.argsort(order, kind="stable")[: n + (-percent * n // 100) + 1]
                prefixes.append(packed(values[keep]))
            yield record(PROFILE, {"doc_id": b.column("doc_id"), "row_key": b.column("row_key"), "n_shingles": sizes, "set_id": ids, "prefix": prefixes})

    return docs.mapInArrow(run, PROFILE_DDL)


_ENTRY = np.dtype([("hash", "<u4"), ("set", "<i8"), ("band", "u1")])


def band(size: int) -> int:
    """The size in steps of an eighth of a power of two."""
    return min(255, int(8 * np.log2(size)))


def bands_apart(percent: int = PERCENT) -> int:
    """How far the bands of linked sets can be from each other."""
    return int(np.ceil(8 * np.log2(100 / percent))) + 1


def _tiles(profiles: DataFrame, tiles: int) -> DataFrame:
    """Prefix entries packed by tile, each set once within a flush."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        tile_of: list[np.ndarray] = []
        seen: set[int] = set()
        count = 0

        def flush() -> pa.RecordBatch:
            entries, tile = np.concatenate(held), np.concatenate(tile_of)
            order = np.argsort(tile, kind="stable")
            entries, tile = entries[order], tile[order]
            cut = np.flatnonzero(np.diff(tile)) + 1
            return pa.RecordBatch.from_pydict({"tile": pa.array(tile[np.concatenate(([0], cut))], pa.int64()), "entries": pa.array([e.tobytes() for e in np.split(entries, cut)], pa.binary())})

        for b in batches:
            for sid, size, raw in zip(b.column("set_id").to_pylist(), b.column("n_shingles").to_pylist(), b.column("prefix").to_pylist(), strict=True):
                if raw is None or sid in seen:
                    continue
                seen.add(sid)
                hashes = unpacked(raw)
                entry = np.empty(len(hashes), _ENTRY)
                entry["hash"], entry["set"], entry["band"] = (hashes >> U64(16)).astype(np.uint32), sid, band(size)
                held.append(entry)
                tile_of.append((hashes % U64(tiles)).astype(np.int64))
                count += len(hashes)
                if count >= 1 << 20:
                    yield flush()
                    held, tile_of, seen, count = [], [], set(), 0
        if held:
            yield flush()

    return profiles.select("set_id", "n_shingles", "prefix").mapInArrow(run, "tile long, entries binary")


REMEMBERED = 1 << 18  # sets of which a task knows that their prefix is out
SMALL = 4  # sets of a group that gives all its pairs
CHUNK = 4096  # members in one row of a large group
FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sig", pa.int64()), ("chunk", pa.int32()), ("members", pa.int64()), ("sets", pa.list_(pa.int64())), ("times", pa.int64())])
FOUND_DDL = "a long, b long, sig long, chunk int, members long, sets array<long>, times long"


def _groups(tiles: DataFrame, n: int, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of small groups and large groups in chunks, with how many entries of the tile each stands for."""
    apart = bands_apart(percent)

    def of_tile(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        entries = np.concatenate([np.frombuffer(p, _ENTRY) for p in parts])
        entries = entries[np.lexsort((entries["set"], entries["hash"]))]
        again = (entries["hash"][1:] == entries["hash"][:-1]) & (entries["set"][1:] == entries["set"][:-1])
        entries = entries[np.concatenate(([True], ~again))]
        cut = np.flatnonzero(np.diff(entries["hash"])) + 1
        begins, ends = np.concatenate(([0], cut)), np.append(cut, len(entries))
        count = ends - begins
        sets, bands = entries["set"], entries["band"].astype(np.int64)
        found = []
        for m in range(2, SMALL + 1):
            at = begins[count == m]
            for i in range(m):
                for j in range(i + 1, m):
                    x, y = at + i, at + j
                    ok = np.abs(bands[x] - bands[y]) <= apart
                    found.append(np.column_stack((sets[x[ok]], sets[y[ok]])))
        pairs, times = np.unique(np.concatenate(found), axis=0, return_counts=True)
        for s in range(0, len(pairs), 100_000):
            some = pairs[s : s + 100_000]
            none = [None] * len(some)
            yield record(FOUND, {"a": some[:, 0], "b": some[:, 1], "sig": none, "chunk": none, "members": none, "sets": none, "times": times[s : s + 100_000]})
        groups: dict[int, list[int]] = {}
        for s, e in zip(begins[count > SMALL].tolist(), ends[count > SMALL].tolist(), strict=True):
            groups.setdefault(set_id(np.ascontiguousarray(sets[s:e]).view(U64)), [s, e, 0])[2] += 1
        rows = [(sig, (k - s) // CHUNK, e - s, sets[k : min(e, k + CHUNK)], t) for sig, (s, e, t) in groups.items() for k in range(s, e, CHUNK)]
        for s in range(0, len(rows), 200):
            some = list(zip(*rows[s : s + 200], strict=True))
            none = [None] * len(some[0])
            yield record(FOUND, {"a": none, "b": none, **dict(zip(("sig", "chunk", "members", "sets", "times"), some, strict=True))})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for tile, raw in zip(b.column("tile").to_pylist(), b.column("entries").to_pylist(), strict=True):
                if tile != now and held:
                    yield from of_tile(held)
                    held = []
                now = tile
                held.append(raw)
        if held:
            yield from of_tile(held)

    return tiles.repartition(n, "tile").sortWithinPartitions("tile").mapInArrow(run, FOUND_DDL)


def _per_set(docs: DataFrame, wanted: DataFrame, value, name: str) -> DataFrame:
    """set_id and value(sorted shingles) of the rows whose row_key is wanted: one more scan that hashes only those."""
    bitmap = key_bitmap(wanted, "row_key")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for b in blocks(batches, "text"):
            b = b.filter(passes(bitmap, b.column("row_key")))
            out = {set_id(v): v for v in sets_of(utf8(b, "text")) if len(v)} if b.num_rows else {}
            out = {k: value(v) for k, v in out.items() if k not in done}
            done.update(out)
            if out:
                yield pa.RecordBatch.from_pydict({"set_id": pa.array(list(out), pa.int64()), name: pa.array(list(out.values()), pa.binary())})

    # a row may stand in the table many times, so its value is taken once
    return docs.mapInArrow(run, f"set_id long, {name} binary").groupBy("set_id").agg(F.first(name).alias(name))


def _close(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that their bitmaps let pass."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, m, y, n in zip(*(b.column(c).to_pylist() for c in ("left", "size_a", "right", "size_b")), strict=True):
                width = 8 * min(len(x), len(y))
                x, y = folded(np.frombuffer(x, np.uint8), width), folded(np.frombuffer(y, np.uint8), width)
                most = min(m - int(np.bitwise_count(x & ~y).sum()), n - int(np.bitwise_count(y & ~x).sum()))
                ok.append(most >= least_overlap(m, n, percent))
            yield b.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    one = sets.select(F.col("set_id").alias("a"), F.col("size").alias("size_a"), F.col("bitmap").alias("left"))
    two = sets.select(F.col("set_id").alias("b"), F.col("size").alias("size_b"), F.col("bitmap").alias("right"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInArrow(run, "a long, b long")


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, name: str, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that are linked, by intersecting their sorted arrays."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct().join(sets.select("set_id", "row_key"), "set_id")
    arrays = _per_set(docs, wanted, np.ndarray.tobytes, "shingles")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = b.column("left").to_pylist(), b.column("right").to_pylist()
            ok = []
            for x, y in zip(left, right, strict=True):
                both = np.concatenate((np.frombuffer(x, U64), np.frombuffer(y, U64)))
                both.sort()
                ok.append(int((both[1:] == both[:-1]).sum()) >= least_overlap(len(x) // 8, len(y) // 8, percent))
            yield b.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    one = arrays.withColumnsRenamed({"set_id": "a", "shingles": "left"})
    two = arrays.withColumnsRenamed({"set_id": "b", "shingles": "right"})
    return stored(pairs.select("a", "b").join(one, "a").join(two, "b").mapInArrow(run, "a long, b long"), name)


def components(edges: DataFrame) -> DataFrame:
    """id and label, the smallest id reachable, of every id in edges (a, b).

    Labels spread to neighbours and jump along themselves until nothing changes; each round is a table.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    now = stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near")).select("id", F.least("id", "near").alias("label")), "labels")
    while True:
        near = both.join(now.withColumnsRenamed({"id": "b", "label": "near"}), "b").groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near"))
        hooked = now.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = now.select(F.col("id").alias("label"), F.col("label").alias("further"))
        moved = hooked.join(jump, "label").select("id", F.least("label", "further").alias("label"), (F.least("label", "further") != F.col("old")).alias("changed"))
        seen = Observation()
        nxt = stored(moved.observe(seen, F.count_if("changed").alias("changed")).select("id", "label"), "labels")
        changed = seen.get["changed"]
        discard(now)
        now = nxt
        if not changed:
            discard(both)
            return now


def _families(members: DataFrame) -> DataFrame:
    """hub, set_id and its size, and how often they share a group: a family is what meets in the groups of one hub.

    The hub of a group is the member that sits in most and largest groups. Two sets that share a large group are in one family.
    """
    weight = members.groupBy("set_id").agg(F.sum(F.col("times") * (F.col("members") - 1)).alias("weight"))
    hubs = members.join(weight, "set_id").groupBy("sig").agg(F.max_by(F.struct("set_id", "size"), F.struct("weight", "set_id")).alias("hub"))
    led = members.join(hubs, "sig").select(F.col("hub.set_id").alias("hub"), F.col("hub.size").alias("hub_size"), "set_id", "size", "times")
    return led.groupBy("hub", "set_id").agg(F.first("hub_size").alias("hub_size"), F.first("size").alias("size"), F.sum("times").alias("times"))


def _partners(families: DataFrame, small: DataFrame) -> DataFrame:
    """(a, b): each set that shares a group with another, and the one that shares most with it."""
    led = families.where((F.col("hub") != F.col("set_id")) & fitting("size", "hub_size")).select(F.col("set_id").alias("x"), F.col("hub").alias("y"), "times")
    each = led.unionByName(small.select(F.col("a").alias("x"), F.col("b").alias("y"), "times")).unionByName(small.select(F.col("b").alias("x"), F.col("a").alias("y"), "times"))
    best = each.groupBy("x").agg(F.max_by("y", F.struct("times", "y")).alias("y"))
    return best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def fitting(a: str, b: str, percent: int = PERCENT):
    """`fits` as a column."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


OUTLIERS = 2048  # outliers of a family held by one task
STREAMED = 1 << 16  # about so many members pass them


class Outliers:
    """Outliers of a family with their bitmaps, by the width of these, and the partners that they found."""

    def __init__(self, allowed: int, percent: int):
        self.allowed, self.percent = allowed, percent
        self.rows: list[tuple[int, int, int, np.ndarray]] = []
        self.best: list[list[tuple[int, int]]] = []  # (spare, set_id) of each
        self.cut: set[int] = set()
        self.own: list[tuple[int, int, int, bytes]] = []  # those that still have to go past

    def add(self, set_id: int, label: int, size: int, bitmap: bytes, passing: bool) -> None:
        self.rows.append((set_id, label, size, np.frombuffer(bitmap, np.uint8)))
        self.best.append([])
        if passing:
            self.own.append((set_id, label, size, bitmap))

    def meet_own(self) -> None:
        """When all are there, those that pass as well go past."""
        if self.own:
            ids, labels, sizes, bitmaps = zip(*self.own, strict=True)
            self.own = []
            self.meet(np.array(ids), np.array(labels), np.array(sizes), np.ones(len(ids), bool), list(bitmaps))

    def meet(self, ids: np.ndarray, labels: np.ndarray, sizes: np.ndarray, outlying: np.ndarray, bitmaps: list[bytes]) -> None:
        """Members go past, in order of size."""
        order = np.argsort(sizes, kind="stable")
        ids, labels, sizes, outlying = ids[order], labels[order], sizes[order], outlying[order]
        bits = [np.frombuffer(bitmaps[k], np.uint8) for k in order]
        narrow: dict[int, tuple[int, np.ndarray]] = {}
        for mine, (x, label, size, own) in zip(self.best, self.rows, strict=True):
            low = int(np.searchsorted(sizes, -(-size * self.percent // 100), "left"))
            high = int(np.searchsorted(sizes, size * 100 // self.percent, "right"))
            # two outliers meet twice; the smaller of their ids looks
            j = low + np.flatnonzero((labels[low:high] != label) & (~outlying[low:high] | (ids[low:high] > x)))
            if not len(j):
                continue
            width = min(len(own), len(bits[low]))
            if width not in narrow:
                wide = [folded(v, 8 * width) if len(v) >= width else None for v in bits]
                first = next(k for k, v in enumerate(wide) if v is not None)
                narrow[width] = first, np.array(wide[first:])
            first, matrix = narrow[width]
            others, here = matrix[j - first], folded(own, 8 * width)
            most = np.minimum(size - np.bitwise_count(here & ~others).sum(axis=1, dtype=np.int64), sizes[j] - np.bitwise_count(others & ~here).sum(axis=1, dtype=np.int64))
            spare = most - least_overlap(size, sizes[j], self.percent)
            good = spare >= 0
            mine += zip(spare[good].tolist(), ids[j[good]].tolist(), strict=True)
            if len(mine) > self.allowed:
                mine.sort(reverse=True)
                del mine[self.allowed :]
                self.cut.add(x)

    def pairs(self) -> Iterator[tuple[int, int]]:
        for (x, *_), mine in zip(self.rows, self.best, strict=True):
            for _, y in mine:
                yield min(x, y), max(x, y)


CROSS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("family", pa.int64())])  # a pair, or an outlier that was cut


def _cross(families: DataFrame, sets: DataFrame, labels: DataFrame, n: int, allowed: int, percent: int = PERCENT) -> DataFrame:
    """(a, b) of the best partners of outliers that sizes and bitmaps let pass; (a, family) with cut of those with more.

    An outlier of a family is a set in another component than the hub. Of `families` only the rows with `open` can be one:
    the others have put forward all their partners before.
    """
    known = families.select(F.col("hub").alias("family"), "set_id", "size", "open")
    known = known.join(labels.withColumnRenamed("id", "set_id"), "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    known = known.join(labels.withColumnsRenamed({"id": "family", "label": "main"}), "family", "left").withColumn("main", F.coalesce("main", "family"))
    known = stored(known, "labelled")
    outlying = F.col("label") != F.col("main")
    seeking = outlying & F.col("open")
    own = F.when(seeking, F.col("size"))
    tiles = known.groupBy("family").agg(F.ceil(F.count_if(seeking) / OUTLIERS).alias("buckets"), F.ceil(F.count("*") / STREAMED).alias("chunks"), F.min(own).alias("least"), F.max(own).alias("most")).where("buckets > 0")
    near = known.join(tiles, "family").where(fitting("size", F.greatest("least", F.least("size", "most")), percent))
    place = F.xxhash64("set_id")
    bucket, chunk = F.pmod(place, "buckets"), F.pmod(F.shiftright(place, 20), "chunks")
    # where a set both seeks and passes, it is sent once
    past = F.transform(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1), lambda k: F.struct(k.alias("bucket"), chunk.alias("chunk"), (~seeking | (k != bucket)).alias("streamed"), F.lit(True).alias("passing")))
    kept = F.transform(F.filter(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda k: seeking & (k != chunk)), lambda k: F.struct(bucket.alias("bucket"), k.alias("chunk"), F.lit(False).alias("streamed"), F.lit(False).alias("passing")))
    columns = ["family", "bucket", "chunk", "streamed", "passing", "set_id", "label", "size", "outlying", "bitmap"]
    rows = near.withColumn("outlying", outlying).withColumn("at", F.concat(past, kept)).join(sets.select("set_id", "bitmap"), "set_id").withColumn("at", F.explode("at"))
    dealt = rows.select("*", "at.*").select(columns).repartition(n, "family", "bucket", "chunk").sortWithinPartitions("family", "bucket", "chunk", "streamed", "size")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, one, out = (None,), Outliers(allowed, percent), set()

        def done() -> None:
            one.meet_own()
            out.update((*p, None) for p in one.pairs())
            out.update((x, None, now[0]) for x in one.cut)

        def found() -> pa.RecordBatch:
            rows = list(out)
            out.clear()
            return record(CROSS, {f.name: [r[k] for r in rows] for k, f in enumerate(CROSS)})

        for b in batches:
            family, bucket, chunk, streamed, passing, ids, labels, sizes, outlying = (b.column(c).to_numpy(zero_copy_only=False) for c in columns[:-1])
            bitmaps = b.column("bitmap").to_pylist()
            new = (family[1:] != family[:-1]) | (bucket[1:] != bucket[:-1]) | (chunk[1:] != chunk[:-1]) | (streamed[1:] != streamed[:-1])
            edges = np.concatenate(([0], np.flatnonzero(new) + 1, [len(family)]))
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                key = (int(family[s]), bucket[s], chunk[s])
                if key != now:
                    done()
                    now, one = key, Outliers(allowed, percent)
                    if len(out) > 1 << 16:
                        yield found()
                if streamed[s]:
                    one.meet_own()
                    one.meet(ids[s:e], labels[s:e], sizes[s:e], outlying[s:e], bitmaps[s:e])
                else:
                    for k in range(s, e):
                        one.add(int(ids[k]), int(labels[k]), int(sizes[k]), bitmaps[k], passing[k])
        done()
        yield found()

    out = stored(dealt.mapInArrow(run, "a long, b long, family long"), "cross-pairs")
    discard(known)
    return out


ALLOWED = (8, 64, 1 << 62)  # partners that an outlier puts forward, by round


def join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of each row of docs."""
    spark, plain = docs.sparkSession, _plain(docs)
    n = partitions(spark)
    profiles = stored(profile(plain, sketch(plain), percent), "profiles")
    sets = stored(profiles.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min("doc_id").alias("first_doc"), F.min("row_key").alias("row_key"), F.first("n_shingles").alias("size")), "sets")
    rows = stored(profiles.select("doc_id", "n_shingles", "set_id"), "sizes")
    found = stored(_groups(_tiles(profiles, 2 * n), n, percent), "groups")
    discard(profiles)
    small = stored(found.where("a is not null").groupBy("a", "b").agg(F.sum("times").alias("times")), "pairs")
    groups = found.where("sig is not null").groupBy("sig", "chunk").agg(F.first("members").alias("members"), F.first("sets").alias("sets"), F.sum("times").alias("times"))
    members = groups.select("sig", "members", "times", F.explode("sets").alias("set_id"))
    members = stored(members.join(sets.select("set_id", "size"), "set_id"), "group-members")
    discard(found)
    families = stored(_families(members), "families")
    discard(members)
    active = small.select(F.explode(F.array("a", "b")).alias("set_id")).unionByName(families.select("set_id")).distinct().join(sets, "set_id").select("set_id", "size", "row_key")
    active = stored(active, "active")
    bitmaps = stored(_per_set(plain, active, signature, "bitmap").join(active.select("set_id", "size"), "set_id"), "bitmaps")
    first = stored(_partners(families, small), "partners")
    tried = stored(_close(first, bitmaps, percent), "close-pairs")
    linked = _verified(plain, active, tried, "links", percent)
    labels = components(linked)
    waiting = families.withColumn("open", F.lit(True))
    for k, allowed in enumerate(ALLOWED):
        cross = _cross(waiting, bitmaps, labels, n, allowed, percent)
        more = cross.where("family is null").select("a", "b")
        if not k:
            of = lambda c: labels.withColumnsRenamed({"id": c, "label": f"label_{c}"})
            apart = small.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")
            apart = stored(apart.join(first, ["a", "b"], "left_anti"), "apart")
            more = more.unionByName(_close(apart, bitmaps, percent))
        more = stored(more.distinct().join(tried, ["a", "b"], "left_anti"), "cross-new")
        again = cross.where("family is not null").select(F.col("family").alias("hub"), F.col("a").alias("set_id"), F.lit(True).alias("open")).distinct()
        left = not again.isEmpty()
        if left:  # the families of those that were cut, in which only they still look for partners
            waiting = stored(families.join(again.select("hub").distinct(), "hub", "left_semi").join(again, ["hub", "set_id"], "left").withColumn("open", F.coalesce("open", F.lit(False))), "waiting")
        discard(cross)
        if not more.isEmpty():
            fresh = _verified(plain, active, more, "cross-links", percent)
            tried = tried.unionByName(more)
            if not fresh.isEmpty():
                linked = linked.unionByName(fresh)
                labels = components(linked)
        if not left:
            break
    whole = labels.join(sets.select(F.col("set_id").alias("id"), "first_doc"), "id")
    named = whole.groupBy("label").agg(F.min("first_doc").alias("name")).join(labels, "label").select(F.col("id").alias("set_id"), "name")
    per_set = stored(sets.select("set_id", "first_doc").join(named, "set_id", "left").select("set_id", F.coalesce("name", "first_doc").alias("component_id")), "components")
    discard(small, sets, families, active, bitmaps, labels)
    return rows.join(per_set, "set_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay: of each component the one with the smallest doc_id, once; all columns.

    Rows without a doc_id can't be named, so they stay.
    """
    name = free_name("kept", docs.columns)
    kept = join(docs.select("doc_id", "text"), percent).where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    rows = docs.withColumn(name, F.col("doc_id").cast("long"))
    return rows.join(kept, name, "left_semi").dropDuplicates([name]).drop(name).select(docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
