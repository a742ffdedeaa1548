"""Operator 1, information-theoretic sanitisation of personal data.

Base spans (e-mail addresses, IP addresses, payment cards, phone numbers) are found in each text by fixed
patterns, in time linear in the text. Each is a protected entity, known by its normalised value. The method
then asks which other terms give an entity away: for every term within `reach` words of an entity,

    PMI(term; entity) = log2( p(entity | term) / p(entity) ),   IC(entity) = -log2 p(entity)

with probabilities from counts of different texts in the whole corpus. A term whose PMI is at least `remove` times the
entity's information content is removed, from `generalise` times on it is generalised, wherever it occurs. Copies are
no evidence: equal texts count once, and a pair must be seen in `contexts` texts that differ in each of two sketches
(the smallest hash of the text's word triples, in two orders), which near copies mostly share.

Shape of the work: one scan finds base spans; entities are counted, and only those in enough different texts go on. A
second scan takes the terms around them, pairs are counted with map-side combining. Two more scans count the texts
of the candidate terms and mark the disclosing ones; both keep a word only if a bitmap of fixed size may hold it,
and an exact join follows. What is known of a text is keyed by its hash, so rows of equal texts share it.

Defined results: a null or empty text has no spans; a very long text is treated like any other; text with spans of
two kinds that overlap keeps both, but a term inside a base span is not marked; repeated rows repeat and change no
count, nor does a null doc_id; an empty table gives no rows; columns other than doc_id and text, whatever their names,
are ignored by `find` and passed on by `sanitise`.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.llm.shared import NOT_SPACE, U64, Words, blocks, byte_class, code_points, discard, free_name, hash_spans, key_bitmap, mix, ngram_hashes, passes, record, stored, utf8

KINDS = ("email", "ip", "card", "phone")
ADDED = ("generalise", "remove")
#: What takes a span's place in sanitised text.
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalise": "[TERM]", "remove": ""}

# Possessive forms of the contract's patterns: a digit run is never entered in its middle.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){12,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_NOT_DIGIT = re.compile(r"[^0-9]+")


@dataclass(frozen=True)
class Disclosure:
    reach: int = 50
    contexts: int = 3
    generalise: float = 0.90
    remove: float = 0.97
    min_chars: int = 3


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, floor = 0, 0
    at = text.find("@")
    while at >= 0:
        low = max(done, floor)
        local = at - low - len(text[low:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at) if local else None
        if m:
            yield at - local, m.end()
            done = m.end()
        floor = at + 1
        at = text.find("@", max(floor, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds, by kind as listed, then start; code points, end exclusive."""
    out = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if any(map(text.__contains__, "0123456789")):
        if "." in text:
            out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        out += [("card", *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def entity_of(kind: str, value: str) -> str:
    return kind + ":" + (value.lower() if kind == "email" else value if kind == "ip" else _NOT_DIGIT.sub("", value))


def word_hash(words: list[bytes]) -> np.ndarray:
    """The hash that `Words` gives to each of these words."""
    data = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    return hash_spans(np.frombuffer(data, np.uint8), ends - sizes, ends) if len(words) else np.empty(0, np.uint64)


_WORD = re.compile(r"[^\x09-\x0D ]+")
_EDGES = ".,;:!?\"'()[]{}<>"


class Outside:
    """Whether a range of a text is free of its base spans."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        merged = sorted((s, e) for _, s, e in spans)
        self.begins, self.reached = [s for s, _ in merged], list(accumulate((e for _, e in merged), max))

    def __call__(self, start: int, end: int) -> bool:
        k = bisect_left(self.begins, end)
        return k == 0 or self.reached[k - 1] <= start


def mentions(text: str, spans: list[tuple[str, int, int]], rules: Disclosure) -> set[tuple[str, str]]:
    """(entity, term) of the terms within reach of each base span."""
    out: set[tuple[str, str]] = set()
    outside = Outside(spans)
    words = [m.span() for m in _WORD.finditer(text)]
    begins, ends = [s for s, _ in words], [e for _, e in words]
    for kind, start, end in spans:
        entity = entity_of(kind, text[start:end])
        before, after = bisect_right(ends, start), bisect_left(begins, end)
        for s, e in (*words[max(0, before - rules.reach) : before], *words[after : after + rules.reach]):
            bare = text[s:e].strip(_EDGES)
            if len(bare) >= rules.min_chars and outside(s, e):
                out.add((entity, bare.encode().lower().decode()))
    return out


def sketches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two minimum hashes over the word triples of each text; of fewer words, over what there is."""
    w = Words(texts, NOT_SPACE, lower=True)
    out = np.zeros((2, len(texts)), np.int64)
    for k in range(len(texts)):
        words = w.hash[w.first[k] : w.first[k + 1]]
        grams = ngram_hashes(words, min(3, len(words))) if len(words) else words
        if len(grams):
            out[0, k], out[1, k] = grams.min().view(np.int64), mix(grams ^ U64(0x5851F42D4C957F2D)).min().view(np.int64)
    return out[0], out[1]


FOUND = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))), ("entities", pa.list_(pa.string())), ("one", pa.int64()), ("two", pa.int64())])
FOUND_DDL = "doc_id long, tie long, base array<struct<kind:string,start:long,end:long>>, entities array<string>, one long, two long"


def _plain(docs: DataFrame) -> DataFrame:
    """doc_id, text and `tie`, a hash of the text."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))


def scan(docs: DataFrame) -> DataFrame:
    """Base spans of every text, its entities and, where it has any, its sketches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            texts = [x or "" for x in b.column("text").to_pylist()]
            spans = [base_spans(x) for x in texts]
            some = [k for k, x in enumerate(spans) if x]
            one, two = np.zeros((2, len(texts)), np.int64)
            one[some], two[some] = sketches([texts[k].encode() for k in some])
            yield record(FOUND, {"doc_id": b.column("doc_id"), "tie": b.column("tie"), "base": [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans], "entities": [sorted({entity_of(k, t[s:e]) for k, s, e in x}) for t, x in zip(texts, spans, strict=True)], "one": one, "two": two})

    return _plain(docs).mapInArrow(run, FOUND_DDL)


BITS = 1 << 26


def term_bitmap(terms: DataFrame) -> np.ndarray:
    """A bitmap of BITS bits (8 MB) that holds `terms(term)`; it only saves work, an exact join follows its use."""

    def marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = (word_hash([x.encode() for x in b.column("term").to_pylist()]) % np.uint64(BITS)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"at": pa.array(slot // 32, pa.int64()), "bits": pa.array(np.int64(1) << slot % 32, pa.int64())})

    rows = terms.select("term").mapInArrow(marks, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()  # BITS / 32 rows at most
    bitmap = np.zeros(BITS // 32, np.uint32)
    bitmap[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return bitmap


def _document_counts(docs: DataFrame, terms: DataFrame, copied: DataFrame) -> DataFrame:
    """How many different texts hold each of `terms(term)`. Rows whose tie is in `copied(tie)` may stand for one text."""
    bitmap, repeated = term_bitmap(terms), key_bitmap(copied, "tie")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            ties, again = b.column("tie").to_pylist(), passes(repeated, b.column("tie")).to_pylist()
            totals: Counter = Counter()
            for d, term in {(d, term) for d, _, _, term in held_terms(utf8(b, "text"), bitmap)}:
                totals[term, ties[d] if again[d] else None] += 1
            texts = [t for _, t in totals]
            yield pa.RecordBatch.from_pydict({"term": pa.array([x for x, _ in totals], pa.string()), "tie": pa.array(texts, pa.int64()), "docs": pa.array([n if t is None else 0 for n, t in zip(totals.values(), texts, strict=True)], pa.int64())})

    held = _plain(docs).select("tie", "text").mapInArrow(count, "term string, tie long, docs long")
    counted = held.groupBy("term", "tie").agg(F.sum("docs").alias("docs")).groupBy("term").agg((F.sum("docs") + F.count("tie")).alias("term_docs"))
    return terms.join(counted, "term")


_EDGE_BYTES = byte_class(_EDGES.encode())


def held_terms(texts: list[bytes], bitmap: np.ndarray) -> list[tuple[int, int, int, str]]:
    """(text, start, end, term) of the terms that the bitmap may hold; code points."""
    w = Words(texts, NOT_SPACE, lower=True)
    start, end = w.start.copy(), w.end.copy()
    while (cut := (start < end) & _EDGE_BYTES[w.data[np.minimum(start, len(w.data) - 1)]]).any():
        start[cut] += 1
    while (cut := (start < end) & _EDGE_BYTES[w.data[np.maximum(end - 1, 0)]]).any():
        end[cut] -= 1
    alive = np.flatnonzero(end > start)
    start, end, doc = start[alive], end[alive], w.doc[alive]
    slot = hash_spans(w.data, start, end) % np.uint64(len(bitmap) * 32)
    keep = np.flatnonzero((bitmap[(slot // np.uint64(32)).astype(np.int64)] >> (slot % np.uint64(32)).astype(np.uint32)) & 1)
    if not len(keep):
        return []
    raw, points = w.data.tobytes(), code_points(w.data)
    zero = points[w.text_start[doc]]
    return [(int(doc[k]), int(points[start[k]] - zero[k]), int(points[end[k]] - zero[k]), raw[start[k] : end[k]].decode("utf-8")) for k in keep]


def disclosing_pairs(docs: DataFrame, found: DataFrame, rules: Disclosure = Disclosure()) -> DataFrame:
    """entity, term and action of the pairs over the thresholds, with their PMI and IC in bits."""
    enough = F.least(F.count_distinct("one"), F.count_distinct("two")) >= rules.contexts
    texts = found.where(F.size("entities") > 0).select("tie", "one", "two", F.explode("entities").alias("entity"))
    recurring = texts.groupBy("entity").agg(enough.alias("enough"), F.count_distinct("tie").alias("entity_docs")).where("enough").drop("enough")
    recurring = stored(recurring, "pii-entities")
    holders = stored(texts.join(recurring.select("entity"), "entity").select("tie").distinct(), "pii-holders")
    holding = key_bitmap(holders, "tie")

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            b = b.filter(passes(holding, b.column("tie")))
            rows, columns = [], {}
            if b.num_rows:
                values = b.column("text").to_pylist()
                one, two = sketches(utf8(b, "text"))
                for k, t in enumerate(values):
                    rows += [(b.column("tie")[k].as_py(), int(one[k]), int(two[k]), *x) for x in mentions(t or "", base_spans(t or ""), rules)]
            for k, (c, kind) in enumerate({"tie": pa.int64(), "one": pa.int64(), "two": pa.int64(), "entity": pa.string(), "term": pa.string()}.items()):
                columns[c] = pa.array([r[k] for r in rows], kind)
            yield pa.RecordBatch.from_pydict(columns)

    each = _plain(docs).select("tie", "text").mapInArrow(near, "tie long, one long, two long, entity string, term string").join(recurring.select("entity"), "entity")
    pairs = stored(each.groupBy("entity", "term").agg(enough.alias("enough"), F.count_distinct("tie").alias("both_docs")).where("enough"), "pii-counts")
    copies = found.groupBy("tie").agg(F.count("*").alias("n"))
    total = copies.count()
    terms = pairs.select("term").distinct()
    counted = pairs.join(recurring, "entity").join(_document_counts(docs, terms, copies.where("n > 1").select("tie")), "term")
    ic = F.log2(F.lit(float(max(total, 2))) / F.col("entity_docs"))
    given = F.least(F.col("both_docs") / F.greatest("term_docs", "both_docs"), F.lit(1.0))
    scored = counted.withColumn("ic", ic).withColumn("pmi", F.log2(given) + F.col("ic")).where((F.col("ic") > 0) & (F.col("pmi") >= rules.generalise * F.col("ic")))
    out = scored.select("entity", "term", F.when(F.col("pmi") >= rules.remove * F.col("ic"), "remove").otherwise("generalise").alias("action"), "pmi", "ic")
    out = stored(out, "pii-disclosing")
    discard(recurring, holders, pairs)
    return out


def added_spans(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """tie and `added`, the spans of disclosing terms, of each text that has any."""
    actions = pairs.groupBy("term").agg(F.max("action").alias("kind"))
    bitmap = term_bitmap(actions)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            ties, texts, free = b.column("tie").to_pylist(), b.column("text"), {}
            rows = []
            for d, s, e, term in held_terms(utf8(b, "text"), bitmap):
                if d not in free:
                    free[d] = Outside(base_spans(texts[d].as_py()))
                if free[d](s, e):
                    rows.append((ties[d], term, s, e))
            yield pa.RecordBatch.from_pydict({c: pa.array([r[k] for r in rows], kind) for k, (c, kind) in enumerate({"tie": pa.int64(), "term": pa.string(), "start": pa.int64(), "end": pa.int64()}.items())})

    hits = _plain(docs).select("tie", "text").mapInArrow(run, "tie long, term string, start long, end long")
    marked = hits.join(actions, "term").select("tie", "kind", "start", "end").distinct()
    return stored(marked.groupBy("tie").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added")), "pii-added")


def find(docs: DataFrame, rules: Disclosure = Disclosure()) -> DataFrame:
    """doc_id, base spans and added spans of every row of docs."""
    found = stored(scan(docs), "pii-found")
    extra = added_spans(docs, disclosing_pairs(docs, found, rules))
    empty = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    return found.join(extra, "tie", "left").select("doc_id", "base", F.coalesce("added", empty).alias("added"))


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from the spans of `find`."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, KINDS), F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.concat("base", "added")).alias("spans"))


def replace(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Text with each span's placeholder; of overlapping spans the first, and at one place the longest, counts."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], PLACEHOLDERS[kind]]
            at = e
        elif e > at:
            at = e  # the rest of a span that begins inside another goes with it
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, rules: Disclosure = Disclosure()) -> DataFrame:
    """docs with personal data and disclosing terms replaced in text; a null text stays null."""
    found = stored(scan(docs), "pii-found")
    tie, added = (free_name(x, docs.columns) for x in ("tie", "added"))
    extra = added_spans(docs, disclosing_pairs(docs, found, rules)).withColumnsRenamed({"tie": tie, "added": added})
    discard(found)
    joined = docs.join(extra, F.xxhash64(F.col("text").cast("string")) == F.col(tie), "left").drop(tie)
    names, place = docs.columns, docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            texts = []
            for t, more in zip(b.column("text").to_pylist(), b.column(added).to_pylist(), strict=True):
                spans = [*(base_spans(t) if t else ()), *((x["kind"], x["start"], x["end"]) for x in more or ())]
                texts.append(replace(t, spans) if spans else t)
            rest = b.select(names)
            yield rest.set_column(place, rest.schema.field(place), pa.array(texts, rest.schema.field(place).type))

    return joined.mapInArrow(run, docs.schema)
