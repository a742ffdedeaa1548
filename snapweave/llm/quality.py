"""Operator 9, quality rules by repetition coverage.

Rolling hashes of word n-grams (2 to 10 words) are made with numpy over blocks of texts. A text's
coverage by an n-gram length is the share of its word characters that lie inside n-grams found at
least twice in the same text; for 2 to 4 words it is the share of the single most frequent n-gram.
Duplicate lines are measured in the same way. Each text is judged alone: no shuffle, no state between
rows, so a lost executor only repeats its own partitions.

Defined results: a null or empty text has no words and fails the base rules; a very long text is measured as a whole;
ties between equally frequent n-grams go to the one that covers more characters; repeated rows give repeated results;
an empty table gives no rows; columns other than the two named ones, whatever their names, are ignored by `measure` and
passed on by `filter_documents`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.llm.shared import NOT_SPACE, U64, Words, blocks, byte_class, code_points, hash_spans, mix, ngram_hashes, record, utf8

SYMBOLS = byte_class(b"#*$%&|<>")


@dataclass(frozen=True)
class Rules:
    """Limits. top: n -> share of characters in the most frequent n-gram; dup: n -> in all repeated n-grams."""

    min_words: int = 50
    max_repeat_percent: int = 50
    top: dict = field(default_factory=lambda: {2: 0.20, 3: 0.18, 4: 0.16})
    dup: dict = field(default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})
    max_dup_line_chars: float = 0.20
    max_dup_lines: float = 0.30
    max_symbols_per_word: float = 0.10
    slack_chars: int = 200  # word characters a text may repeat beyond each share: one line of a short text
    slack_lines: int = 1


SCHEMA = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("dup_line_chars", pa.float64()), ("top_ngram_chars", pa.float64()), ("dup_ngram_chars", pa.float64())])
DDL = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, dup_line_chars double, top_ngram_chars double, dup_ngram_chars double"


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def _repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key how often it occurs, and a dense number for it."""
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    return counts[inverse], inverse


def _windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where an n-gram starts inside one text, and a key of n-gram and text."""
    if len(words.hash) < n:
        return np.empty(0, np.int64), np.empty(0, U64)
    at = np.flatnonzero(words.doc[: len(words.doc) - n + 1] == words.doc[n - 1 :])
    return at, mix(ngram_hashes(words.hash, n)[at] ^ mix(words.doc[at].astype(U64) + U64(1)))


def _covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Flags of the words inside the windows that start at the given positions."""
    step = np.zeros(size + 1, np.int32)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step[:-1]) > 0


def measure_texts(texts: list[bytes], rules: Rules) -> dict[str, np.ndarray]:
    """The columns of SCHEMA but doc_id for a list of texts."""
    w = Words(texts, NOT_SPACE, lower=False)
    points = code_points(w.data)
    chars = points[w.end] - points[w.start]
    n_words, word_chars = w.counts, _sums(chars, w.first)
    total = np.maximum(word_chars, 1)
    symbols = np.concatenate(([0], np.cumsum(SYMBOLS[w.data])))
    n_symbols = symbols[w.text_start[1:]] - symbols[w.text_start[:-1]]

    breaks = np.flatnonzero(w.data == 10)
    line_start = np.concatenate(([0], breaks[:-1] + 1))
    line_words = np.searchsorted(w.start, breaks + 1) - np.searchsorted(w.start, line_start)
    real = np.flatnonzero(line_words)
    start, end = line_start[real], breaks[real]
    doc = np.searchsorted(w.text_start, start, "right") - 1
    key = mix(hash_spans(w.data, start, end) ^ mix(doc.astype(U64) + U64(1)))
    _, first_seen, inverse = np.unique(key, return_index=True, return_inverse=True)
    again = first_seen[inverse] != np.arange(len(key))
    line_first = np.searchsorted(doc, np.arange(len(texts) + 1))
    n_lines, n_dup_lines = np.diff(line_first), _sums(again.astype(np.int64), line_first)
    run = np.concatenate(([0], np.cumsum(chars)))
    line_chars = run[np.searchsorted(w.start, end)] - run[np.searchsorted(w.start, start)]
    dup_line_chars = _sums(line_chars * again, line_first) / total

    n_repeat_words = np.zeros(len(texts), np.int64)
    top_worst, dup_worst = np.zeros(len(texts)), np.zeros(len(texts))
    bad = np.zeros(len(texts), bool)
    for n in sorted({3, *rules.top, *rules.dup}):
        at, key = _windows(w, n)
        count, number = _repeats(key)
        twice = count >= 2
        hit = _covered(at[twice], n, len(w.hash))
        if n == 3:
            n_repeat_words = _sums(hit.astype(np.int64), w.first)
        if n in rules.dup:
            share = _sums(chars * hit, w.first) / total
            dup_worst, bad = np.maximum(dup_worst, share), bad | ((share - rules.dup[n]) * total > rules.slack_chars)
        if n in rules.top and len(at):
            size = (run[at + n] - run[at]) * twice
            gram = np.bincount(number, weights=size)
            most = np.zeros(len(texts))
            np.maximum.at(most, w.doc[at], gram[number])
            share = np.minimum(most / total, 1.0)
            top_worst, bad = np.maximum(top_worst, share), bad | ((share - rules.top[n]) * total > rules.slack_chars)
    base_failed = (n_words < rules.min_words) | (100 * n_repeat_words > rules.max_repeat_percent * n_words)
    bad |= ((dup_line_chars - rules.max_dup_line_chars) * total > rules.slack_chars) | (n_dup_lines > rules.max_dup_lines * n_lines + rules.slack_lines) | (n_symbols > rules.max_symbols_per_word * n_words)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words, "base_failed": base_failed, "kept": ~(base_failed | bad), "dup_line_chars": dup_line_chars, "top_ngram_chars": top_worst, "dup_ngram_chars": dup_worst}


def measure(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of measurements and a verdict for each row of docs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            yield record(SCHEMA, {"doc_id": b.column("doc_id"), **measure_texts(utf8(b, "text"), rules)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, DDL)


def filter_documents(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text_col):
            yield b.filter(pa.array(measure_texts(utf8(b, text_col), rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)
