"""Operator 2, benchmark decontamination with a positional inverted index.

`build_index` turns the corpus into a document-partitioned index: each row holds, for about a megabyte of
texts, every distinct word and the sorted positions of its postings. Positions leave a gap between texts, so
that no phrase runs from one into the next. `search` looks up every window of the benchmark in every row:
the windows' posting lists are shifted by the word's offset and intersected from the rarest word on, which
gives exact phrases; with a tolerance on the offsets it gives proximity matches. The index is a stored table, which
can be searched again; postings stay in rows of one block of texts, so there is no shuffle and no hot word or hot source.

The benchmark goes to the tasks in blocks of at most `block_bytes` of text, one after the other, so what the driver
holds and sends is bounded however large it is.

Words are the maximal runs of lower-case ASCII letters, digits and non-ASCII characters after A-Z are
lower-cased; they are compared by 64-bit hashes of whole words, ten in a row for a window.

Defined results: a null or empty text has no words, no hits and is not contaminated; benchmark rows with
null or no words have no windows; a null item_id is the empty string; repeated item_ids are one item;
repeated documents give repeated rows; a very long text is one document in an index row of its own; an empty table of
documents gives no rows, an empty benchmark no hits; other columns, whatever their names, are ignored or, in
`filter_documents`, passed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.llm.shared import BLOCK_BYTES, WORD_BYTES, Words, blocks, discard, record, stored, utf8

WINDOW = 10
GAP = 64  # free positions between texts; more than a window and its tolerance


@dataclass(frozen=True)
class Near:
    """Proximity of a window of three words or more: there is a place at which at least `share` of the words, rounded
    up, each stand within `slop` words of their own offset."""

    slop: int = 3
    share: float = 0.8


class Postings:
    """Words of a block of texts with the ascending positions of each."""

    def __init__(self, terms: np.ndarray, offsets: np.ndarray, positions: np.ndarray, counts: np.ndarray):
        self.terms, self.offsets, self.positions, self.counts = terms, offsets, positions, counts
        self.first = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else np.empty(0, np.int64)
        self.base = self.first + GAP * np.arange(len(counts))

    @classmethod
    def of(cls, texts: list[bytes]) -> Postings:
        w = Words(texts, WORD_BYTES, lower=True)
        order = np.argsort(w.hash, kind="stable")
        ordered = w.hash[order]
        begins = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.empty(0, np.int64)
        place = np.arange(len(w.hash)) + GAP * w.doc
        return cls(ordered[begins], np.append(begins, len(ordered)).astype(np.int32), place[order].astype(np.int32), w.counts.astype(np.int64))

    def list_of(self, term: int) -> np.ndarray:
        return self.positions[self.offsets[term] : self.offsets[term + 1]]

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, places, "right") - 1


@dataclass
class Queries:
    """Windows of benchmark items: hashes (one row each, padded), lengths and the item that each is of."""

    hashes: np.ndarray
    lengths: np.ndarray
    item: np.ndarray
    names: list[str]

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int = WINDOW) -> Queries:
        names = sorted({name for name, _ in items})
        number = {name: k for k, name in enumerate(names)}
        w = Words([text for _, text in items], WORD_BYTES, lower=True)
        rows, lengths, item = [], [], []
        for k, (name, _) in enumerate(items):
            words = w.hash[w.first[k] : w.first[k + 1]]
            size = min(window, len(words))
            for s in range(len(words) - size + 1 if size else 0):
                rows.append(np.concatenate((words[s : s + size], np.zeros(window - size, np.uint64))))
                lengths.append(size)
                item.append(number[name])
        hashes = np.array(rows, np.uint64).reshape(-1, window)
        if len(hashes):
            key = np.column_stack((hashes, np.array(lengths, np.uint64), np.array(item, np.uint64)))
            keep = np.unique(key, axis=0, return_index=True)[1]
            hashes, lengths, item = hashes[keep], np.array(lengths)[keep], np.array(item)[keep]
        lengths = np.asarray(lengths, np.int64)
        return cls(hashes, lengths, np.asarray(item, np.int64), names)


def _holds(sorted_places: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each wanted place is among the sorted ones."""
    at = np.searchsorted(sorted_places, wanted)
    at[at == len(sorted_places)] = 0
    return sorted_places[at] == wanted


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... size[0] of them, then those of the next."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def match_near(index: Postings, queries: Queries, term: np.ndarray, there: np.ndarray, order: np.ndarray, near: Near) -> np.ndarray:
    """(document, item) of the proximity matches.

    Of a window's words at most `spare` may miss, so of its spare + 2 rarest ones two stand within 2 * slop of one
    another's offset. Only windows with two such postings are looked at word by word.
    """
    need = np.ceil(near.share * queries.lengths - 1e-9).astype(np.int64)
    spare = queries.lengths - need
    some = np.flatnonzero((there.sum(axis=1) >= need) & (queries.lengths >= 3))
    out: set[tuple[int, int]] = set()
    if not len(some):
        return np.empty((0, 2), np.int64)
    size = np.diff(index.offsets)
    window, diagonal, word = [], [], []
    missing = queries.lengths - there.sum(axis=1)  # these would be the rarest
    for rank in range(int((spare - missing)[some].max()) + 2):
        q = some[(spare - missing)[some] + 2 > rank]
        k = order[q, rank]
        t = term[q, k]
        n = size[t].astype(np.int64)
        window.append(np.repeat(q, n))
        word.append(np.repeat(k, n))
        diagonal.append(index.positions[_ranges(index.offsets[t].astype(np.int64), n)] - np.repeat(k, n))
    window, diagonal, word = (np.concatenate(x).astype(np.int64) for x in (window, diagonal, word))
    by = np.lexsort((diagonal, window))
    window, diagonal, word = window[by], diagonal[by], word[by]
    # between two such postings others may lie, but then the next one is as near
    at = np.flatnonzero((window[1:] == window[:-1]) & (diagonal[1:] - diagonal[:-1] <= 2 * near.slop))
    begins = np.flatnonzero(np.concatenate(([True], window[at[1:]] != window[at[:-1]]))) if len(at) else at
    for s, e in zip(begins.tolist(), np.append(begins[1:], len(at)).tolist(), strict=False):
        some = at[s:e]
        q = int(window[some[0]])
        places = (diagonal[some][:, None] + np.arange(-near.slop, near.slop + 1)).ravel()
        held = np.zeros(len(places), np.int64)
        for k in order[q, : there[q].sum()].tolist():
            mine = index.list_of(term[q, k])
            j = np.searchsorted(mine, places + (k - near.slop))
            held += (j < len(mine)) & (mine[np.minimum(j, len(mine) - 1)] <= places + (k + near.slop))
        good = (held >= need[q]).reshape(len(some), -1).any(axis=1)
        out.update((d, int(queries.item[q])) for d in index.document(diagonal[some][good] + word[some][good]).tolist())
    return np.array(sorted(out), np.int64).reshape(-1, 2)


def match(index: Postings, queries: Queries, near: Near | None = Near()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, start) of every exact occurrence, and (document, item) pairs of proximity matches."""
    none = np.empty(0, np.int64)
    if not len(queries.hashes) or not len(index.terms):
        return none, none, np.empty((0, 2), np.int64)
    term = np.searchsorted(index.terms, queries.hashes)
    term[term == len(index.terms)] = 0
    used = np.arange(queries.hashes.shape[1]) < queries.lengths[:, None]
    there = (index.terms[term] == queries.hashes) & used
    size = np.where(there, np.diff(index.offsets)[term], np.iinfo(np.int32).max)
    order = np.argsort(size, axis=1, kind="stable")
    present = there.sum(axis=1)
    windows, starts, close = [], [], np.empty((0, 2), np.int64)
    for q in np.flatnonzero(present == queries.lengths):
        first = order[q, 0]
        at = index.list_of(term[q, first]) - first
        for k in order[q, 1 : queries.lengths[q]]:
            at = at[_holds(index.list_of(term[q, k]), at + k)]
            if not len(at):
                break
        if len(at):
            windows.append(np.full(len(at), q))
            starts.append(at.astype(np.int64))
    if near:
        close = match_near(index, queries, term, there, order, near)
    return (np.concatenate(windows) if windows else none), (np.concatenate(starts) if starts else none), close


def hits_by_document(index: Postings, queries: Queries, near: Near | None = Near()) -> list[dict]:
    """For each document of an index row: covered word ranges, item names and names of near items."""
    window, start, close = match(index, queries, near)
    out = [{"n_words": int(c), "begins": [], "ends": [], "items": [], "near_items": []} for c in index.counts]
    if len(window):
        doc = index.document(start)
        begin = start - index.base[doc]
        length = queries.lengths[window]
        for d, b, e in np.unique(np.column_stack((doc, begin, begin + length)), axis=0).tolist():
            out[d]["begins"].append(b)
            out[d]["ends"].append(e)
        for d, i in np.unique(np.column_stack((doc, queries.item[window])), axis=0).tolist():
            out[d]["items"].append(queries.names[i])
    for d, i in close.tolist():
        out[d]["near_items"].append(queries.names[i])
    return out


INDEX = pa.schema([("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("terms", pa.binary()), ("offsets", pa.binary()), ("positions", pa.binary())])
INDEX_DDL = "ids array<long>, counts array<long>, terms binary, offsets binary, positions binary"
HITS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("begins", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])
HITS_DDL = "row long, doc_id long, n_words long, begins array<long>, ends array<long>, items array<string>, near_items array<string>"
ROWS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("n_near_items", pa.int64()), ("near_items", pa.string())])


def build_index(docs: DataFrame) -> DataFrame:
    """The positional inverted index of docs(doc_id, text); one row for each block of texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            p = Postings.of(utf8(b, "text"))
            yield record(INDEX, {"ids": [b.column("doc_id").to_pylist()], "counts": [p.counts.tolist()], "terms": [p.terms.tobytes()], "offsets": [p.offsets.tobytes()], "positions": [p.positions.tobytes()]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, INDEX_DDL)


def search(index: DataFrame, queries: Queries, near: Near | None = Near()) -> DataFrame:
    """Hits of one block of queries in each document of the index; `row` is the index row's key if it has one."""
    keyed = "row" in index.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                p = Postings(np.frombuffer(r["terms"], np.uint64), np.frombuffer(r["offsets"], np.int32), np.frombuffer(r["positions"], np.int32), np.array(r["counts"], np.int64))
                found = hits_by_document(p, queries, near)
                yield record(HITS, {"row": [(r["row"] << 24) + k if keyed else 0 for k in range(len(found))], "doc_id": r["ids"], **{c: [x[c] for x in found] for c in ("n_words", "begins", "ends", "items", "near_items")}})

    return index.mapInArrow(run, HITS_DDL)


def summarise(hits: DataFrame) -> DataFrame:
    """The result row of each document from its hits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            covered = []
            for r in rows:
                n, reach = 0, 0
                for s, e in sorted(zip(r["begins"], r["ends"], strict=True)):
                    n, reach = n + max(0, e - max(s, reach)), max(reach, e)
                covered.append(n)
            items = [sorted(set(r["items"])) for r in rows]
            near = [sorted(set(r["near_items"])) for r in rows]
            yield record(ROWS, {"doc_id": [r["doc_id"] for r in rows], "n_words": [r["n_words"] for r in rows], "n_hit": covered, "n_items": list(map(len, items)), "items_sha256": [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], "contaminated": [n > 0 for n in covered], "n_near_items": list(map(len, near)), "near_items": list(map(",".join, near))})

    return hits.mapInArrow(run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, n_near_items long, near_items string")


def query_blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = 8 * BLOCK_BYTES) -> Iterator[Queries]:
    """The benchmark's windows, in blocks of at most about block_bytes of text at a time on the driver."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    held, size = [], 0
    for name, text in rows.toLocalIterator():
        raw = text.encode("utf-8")
        held.append((name, raw))
        size += len(raw)
        if size >= block_bytes:
            yield Queries.of(held, window)
            held, size = [], 0
    if held:
        yield Queries.of(held, window)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: Near | None = Near(), block_bytes: int = 8 * BLOCK_BYTES) -> DataFrame:
    """One row for each document: its words, hit words, items with exact windows, and near items."""
    index = stored(build_index(docs).withColumn("row", F.monotonically_increasing_id()), "postings")
    hits: list[DataFrame] = []
    for queries in query_blocks(benchmark, window, block_bytes):
        hits.append(stored(search(index, queries, near), "hits"))
    if not hits:
        hits.append(stored(search(index, Queries.of([], window), near), "hits"))
    if len(hits) == 1:
        found = hits[0]
    else:
        found = hits[0]
        for more in hits[1:]:
            found = found.unionByName(more)
        found = found.groupBy("row", "doc_id").agg(F.max("n_words").alias("n_words"), *(F.flatten(F.collect_list(c)).alias(c) for c in ("begins", "ends", "items", "near_items")))
    out = stored(summarise(found), "contamination")
    discard(index, *hits)
    return out


def filter_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = 8 * BLOCK_BYTES, near: Near | None = None) -> DataFrame:
    """The rows of docs without any benchmark window, and with `near` without any proximity match, with all their columns."""
    for queries in query_blocks(benchmark, window, block_bytes):

        def run(batches: Iterable[pa.RecordBatch], queries: Queries = queries) -> Iterator[pa.RecordBatch]:
            for b in blocks(batches, "text"):
                index = Postings.of(utf8(b, "text"))
                _, start, close = match(index, queries, near)
                clean = np.ones(b.num_rows, bool)
                clean[index.document(start)] = False
                clean[close[:, 0]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
