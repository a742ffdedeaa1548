"""Operator 7, BPE encoding and decoding by tree concatenation.

A text longer than a leaf is cut into halves until the parts are leaves; the leaves of a block of texts, which need nothing of
one another, are encoded as one batch, and neighbours are then joined pairwise up the tree. At a join a window
around the cut is encoded again and grown until its tokens agree with the left part's on one side and
with the right part's on the other; what lies between comes from the window. A BPE encoding is right if
every two neighbouring tokens are an encoding of their own text, so agreement on an overlap proves the
joined tokens: each adjacent pair lies inside one encoding. The overlap must also start and end with a
run of tokens that covers a break the tokenizer makes in both, or the window grows, up to the whole.

Texts of one leaf, leaves and windows are encoded in units between cuts that no word pattern spans, each distinct unit once.

The encoding of a text depends on that text alone, in one pass without shuffle; tasks work on different texts side by
side, and one text stays in one task. Defined results: null is the empty text, with no ids and the decoded text empty;
a very long text has the ids of one encoding of the whole; repeated rows repeat; an empty table gives no rows; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.llm.shared import BLOCK_BYTES, Units, blocks, code_points, encode_units, record, unit_starts, utf8
from snapweave.llm.tokens import WORD_BPE, tokenizer

LEAF = 4096  # bytes of a text that is one leaf, and characters of a part
WINDOW = 128  # characters of the first window on each side of a cut
AGREE = 4  # tokens that must agree on each side


class Part:
    """A text's ids with the code-point offsets of each."""

    __slots__ = ("at", "ends", "ids", "starts", "to")

    def __init__(self, at: int, to: int, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.at, self.to, self.ids, self.starts, self.ends = at, to, ids, starts, ends

    def tokens(self, first: int = 0, last: int | None = None) -> list[tuple[int, int, int]]:
        return list(zip(self.starts[first:last].tolist(), self.ends[first:last].tolist(), self.ids[first:last].tolist(), strict=True))


def _tail_agrees(left: Part, window: Part, cut: int) -> tuple[int, int] | None:
    """(i, j): left's tokens before i, then window's from j on. The AGREE tokens from i equal the window's from j."""
    first = int(np.searchsorted(left.starts, window.at + (WINDOW // 4 if window.at > left.at else 0)))
    mine, its = left.tokens(first), window.tokens()
    where = {token: k for k, token in enumerate(its)}
    for i in range(len(mine) - AGREE + 1):
        j = where.get(mine[i])
        if j is not None and mine[i : i + AGREE] == its[j : j + AGREE] and mine[i + AGREE - 1][1] <= cut:
            return first + i, j
    return None


def _head_agrees(right: Part, window: Part, cut: int) -> tuple[int, int] | None:
    """(i, j): window's tokens before j, then right's from i on. The AGREE tokens before them are equal."""
    mine = right.tokens(0, int(np.searchsorted(right.ends, window.to - (WINDOW // 4 if window.to < right.to else 0), "right")))
    its = window.tokens()
    where = {token: k for k, token in enumerate(its)}
    for i in range(len(mine), AGREE - 1, -1):
        j = where.get(mine[i - 1], -1) + 1
        if j >= AGREE and mine[i - AGREE : i] == its[j - AGREE : j] and mine[i - AGREE][0] >= cut:
            return i, j
    return None


def _around(left: Part, right: Part, reach: int) -> tuple[int, int]:
    return max(left.at, left.to - reach), min(right.to, left.to + reach)


def _join(text: str, left: Part, right: Part, window: Part, encode) -> Part:
    """Both parts as one. `window` is the first one; encode((text, from, to)) makes the wider ones."""
    cut, reach = left.to, WINDOW
    while True:
        tail = (0, 0) if window.at == left.at else _tail_agrees(left, window, cut)
        head = (len(right.ids), len(window.ids)) if window.to == right.to else _head_agrees(right, window, cut)
        if tail and head and tail[1] <= head[1]:
            (i, j), (m, n) = tail, head
            return Part(left.at, right.to, *(np.concatenate([x[:i], y[j:n], z[m:]]) for x, y, z in ((left.ids, window.ids, right.ids), (left.starts, window.starts, right.starts), (left.ends, window.ends, right.ends))))
        reach *= 2
        window = encode((text, *_around(left, right, reach)))


class Encoder:
    """Encodes blocks of texts; long ones through the tree. Leaves, windows and short texts are encoded in units between safe cuts, which it remembers.

    Only leaves and windows need the offsets of their tokens; where few texts are long, `offsets` false leaves them out for the others.
    """

    def __init__(self, name: str = WORD_BPE, long_text: int = LEAF, leaf: int = LEAF, offsets: bool = True):
        t = tokenizer(name)
        self.long_text, self.leaf = long_text, leaf
        self.plain = None if offsets else Units(lambda texts: [one.ids for one in t.encode_batch_fast(texts, add_special_tokens=False)])
        # of each token its id, start and end
        self.units = Units(lambda texts: [[x for i, (s, e) in zip(one.ids, one.offsets, strict=True) for x in (i, s, e)] for one in t.encode_batch(texts, add_special_tokens=False)])

    def _tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, start and end of all tokens, a row for each; code points before its unit; number of tokens of each text)."""
        data, cuts, text_end = unit_starts(texts)
        if not len(data):
            return np.empty((0, 3), np.int32), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
        found, size = self.units.lookup(data, cuts, np.append(cuts[1:], len(data)))
        run = np.concatenate(([0], np.cumsum(size // 3)))
        first = np.searchsorted(cuts, np.concatenate(([0], text_end)))
        return found.reshape(-1, 3), np.repeat(code_points(data)[cuts], size // 3), run[first[1:]] - run[first[:-1]]

    def parts(self, pieces: list[tuple[str, int, int]]) -> list[Part]:
        """The Part of each (text, from, to), of a block of pieces at a time."""
        out: list[Part] = []
        while len(out) < len(pieces):
            raw, size = [], 0
            for text, a, b in pieces[len(out) :]:
                if raw and size + b - a > BLOCK_BYTES:
                    break
                raw.append(text[a:b].encode())
                size += b - a
            tokens, before, counts = self._tokens(raw)
            begin, points = 0, 0
            for count, (_, a, b) in zip(counts.tolist(), pieces[len(out) : len(out) + len(raw)], strict=True):
                to = begin + count
                shift = before[begin:to] + (a - points)
                out.append(Part(a, b, tokens[begin:to, 0].astype(np.int64), tokens[begin:to, 1] + shift, tokens[begin:to, 2] + shift))
                begin, points = to, points + b - a
        return out

    def trees(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, joined level by level; what one level of all texts needs is encoded together."""
        leaves = []
        for text in texts:
            bounds = [0, len(text)]
            while max(b - a for a, b in zip(bounds, bounds[1:], strict=False)) > self.leaf:
                bounds = sorted({*bounds, *((a + b) // 2 for a, b in zip(bounds, bounds[1:], strict=False) if b - a > self.leaf)})
            leaves.append([(text, a, b) for a, b in zip(bounds, bounds[1:], strict=False)])
        made = iter(self.parts([x for one in leaves for x in one]))
        rows = [[next(made) for _ in one] for one in leaves]
        while any(len(row) > 1 for row in rows):
            windows = iter(self.parts([(text, *_around(row[k], row[k + 1], WINDOW)) for text, row in zip(texts, rows, strict=True) for k in range(0, len(row) - 1, 2)]))
            rows = [[_join(text, row[k], row[k + 1], next(windows), lambda piece: self.parts([piece])[0]) if k + 1 < len(row) else row[k] for k in range(0, len(row), 2)] for text, row in zip(texts, rows, strict=True)]
        return [row[0].ids for row in rows]

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        short = [b"" if len(x) > self.long_text else x for x in texts]
        if self.plain:
            ids, counts = encode_units(short, self.plain)
        else:
            tokens, _, counts = self._tokens(short)
            ids = tokens[:, 0]
        out = np.split(ids, np.cumsum(counts)[:-1]) if texts else []
        long = [k for k, x in enumerate(texts) if len(x) > self.long_text]
        for k, ids in zip(long, self.trees([texts[k].decode("utf-8") for k in long]), strict=True):
            out[k] = ids
        return out


def encode_long(text: str, name: str = WORD_BPE, leaf: int = LEAF) -> np.ndarray:
    """The ids of a long text through the tree; equal to those of one encoding of the whole."""
    return Encoder(name, leaf=leaf).trees([text])[0]


@lru_cache(maxsize=2)
def encoder(name: str, long_text: int, offsets: bool = True) -> Encoder:
    """One encoder for a worker process, so that later tasks use what earlier ones remember."""
    return Encoder(name, long_text, offsets=offsets)


@lru_cache(maxsize=2)
def decimals(name: str) -> list[str]:
    return [str(k) for k in range(max(tokenizer(name).get_vocab().values(), default=0) + 1)]


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode(docs: DataFrame, name: str = WORD_BPE, digests: bool = False, long_text: int = LEAF) -> DataFrame:
    """doc_id, n_tokens, ids and the decoded text of each row; with digests their SHA-256 in place of the last two."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, enc, digits = tokenizer(name), encoder(name, long_text), decimals(name)
        for b in blocks(batches, "text", 2 * BLOCK_BYTES):
            ids = [x.tolist() for x in enc(utf8(b, "text"))]
            decoded = t.decode_batch(ids, skip_special_tokens=False)
            base = {"doc_id": b.column("doc_id"), "n_tokens": list(map(len, ids))}
            if digests:
                yield record(DIGEST, base | {"ids_sha256": [hashlib.sha256(" ".join([digits[i] for i in x]).encode()).hexdigest() for x in ids], "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in decoded]})
            else:
                yield record(SCHEMA, base | {"ids": ids, "decoded": decoded})

    ddl = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ddl)
