import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from snapweave.llm import bpe, token_files
from snapweave.llm.shared import Units, encode_units, scratch_path
from snapweave.llm.tokens import BYTE_BPE, WORD_BPE, tokenizer

ALPHABET = st.text(alphabet="ab'stm .,!\n\t 　éÅΣσß日本\U0001f600<|endoftx>0\x85́", max_size=200)


@settings(max_examples=250, deadline=None)
@given(ALPHABET, st.sampled_from([WORD_BPE, BYTE_BPE]), st.sampled_from([3, 16, 50]))
def test_tree_equals_one_encoding(text, name, leaf):
    assert bpe.encode_long(text, name, leaf).tolist() == tokenizer(name).encode(text, add_special_tokens=False).ids


@settings(max_examples=250, deadline=None)
@given(st.lists(ALPHABET, max_size=5), st.sampled_from([WORD_BPE, BYTE_BPE]))
def test_units_equal_one_encoding(texts, name):
    t = tokenizer(name)
    units = Units(lambda xs: [e.ids for e in t.encode_batch_fast(xs, add_special_tokens=False)], limit=40)
    for _ in range(2):
        ids, counts = encode_units([x.encode() for x in texts], units)
        want = [t.encode(x, add_special_tokens=False).ids for x in texts]
        assert ids.tolist() == [i for x in want for i in x] and counts.tolist() == list(map(len, want))


def test_bpe_table(make_docs, edge_rows):
    t = tokenizer(WORD_BPE)
    want = []
    for i, x in edge_rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.encode(make_docs(edge_rows), digests=True, long_text=1000).collect()), key=repr) == sorted(want, key=repr)
    row = bpe.encode(make_docs([(1, "Hello there")])).collect()[0]
    assert row["ids"] == t.encode("Hello there").ids and row["decoded"] == t.decode(row["ids"])
    assert bpe.encode(make_docs([(1, "x")]).where("doc_id = 2")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**6), max_size=700).map(sorted))
def test_elias_fano(values):
    ef = token_files.EliasFano.build(np.array(values, np.int64))
    assert ef.all().tolist() == values
    assert [ef.select(i) for i in range(0, len(values), 7)] == values[::7]


def test_token_files(spark, make_docs, edge_rows):
    rows = edge_rows + [(-5, "before zero"), (10**15, "far")]
    t = tokenizer(BYTE_BPE)
    manifest = token_files.write(make_docs(rows), scratch_path(spark, "tokens"), file_ids=50)
    first = lambda i: -(10**18) if i is None else i
    got = sorted(map(tuple, token_files.read(manifest).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in rows), key=first)
    start = 0
    for r in got:
        assert r[1] == start
        start += r[2]
    want = sorted((first(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, x in rows for ids in [[*t.encode(x or "", add_special_tokens=False).ids, 2]])
    assert sorted((first(r[0]), r[2], r[3]) for r in got) == want
    f = token_files.TokenFile(manifest.collect()[0]["uri"])
    assert f.document(0)[-1] == 2
    assert token_files.read(token_files.write(make_docs(rows).where("doc_id = 77"), scratch_path(spark, "tokens"))).count() == 0


def twins(bits):
    """Two words that one polynomial modulo a power of two can't tell apart."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(1 << bits))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("bits", [10, 12])
@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
def test_twin_words_keep_their_ids(make_docs, spark, bits, name):
    t = tokenizer(name)
    want = [t.encode(x, add_special_tokens=False).ids for x in twins(bits)]
    units = Units(lambda xs: [e.ids for e in t.encode_batch_fast(xs, add_special_tokens=False)])
    ids, counts = encode_units([x.encode() for x in twins(bits)], units)
    assert ids.tolist() == want[0] + want[1] and counts.tolist() == list(map(len, want))
    assert [r["ids"] for r in bpe.encode(make_docs(list(enumerate(twins(bits)))), name).orderBy("doc_id").collect()] == want
    manifest = token_files.write(make_docs(list(enumerate(twins(bits)))), scratch_path(spark, "tokens"), name)
    assert [r["ids_crc32"] for r in token_files.read(manifest).orderBy("doc_id").collect()] == [zlib.crc32(np.array([*x, 2], "<u4").tobytes()) for x in want]


def test_units_with_one_hash_are_told_apart(monkeypatch):
    from snapweave.llm import shared

    monkeypatch.setattr(shared, "hash_spans", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    t = tokenizer(WORD_BPE)
    units = Units(lambda xs: [e.ids for e in t.encode_batch_fast(xs, add_special_tokens=False)])
    for texts in (["one two six", "ten"], ["red ant", "", "six"]):
        ids, _ = encode_units([x.encode() for x in texts], units)
        assert ids.tolist() == [i for x in texts for i in t.encode(x, add_special_tokens=False).ids]


def test_every_text_beyond_a_leaf_goes_through_the_tree(monkeypatch):
    import pyarrow.parquet as pq

    texts = [(x or "").encode() for x in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()]
    joins, tree = [], bpe._join
    monkeypatch.setattr(bpe, "_join", lambda *a: joins.append(1) or tree(*a))
    ids = bpe.Encoder()(texts)
    long = [k for k, x in enumerate(texts) if len(x) > bpe.LEAF]
    assert len(long) > 50 and len(joins) > len(long)
    t = tokenizer(WORD_BPE)
    assert all(ids[k].tolist() == t.encode(texts[k].decode(), add_special_tokens=False).ids for k in long)


def test_leaves_and_windows_cost_only_their_new_units():
    import random

    r, t = random.Random(3), tokenizer(WORD_BPE)
    words = ["Straße", "it's", "naïve", "e\u0301", "日本", "word", "<p>", "x1", "ÅΣ", "\U0001f600"]
    texts = [" ".join(r.choices(words, k=6000)) for _ in range(3)]
    one = bpe.Encoder()
    encode, asked = one.units.encode, []
    one.units.encode = lambda pieces: asked.extend(pieces) or encode(pieces)
    for _ in range(2):
        assert [x.tolist() for x in one([x.encode() for x in texts])] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert len(asked) == len(set(asked)) and sum(map(len, asked)) < 5000 < bpe.LEAF * 3


def test_missing_vocabulary():
    with pytest.raises(Exception):
        tokenizer("/nowhere.json")


def test_ids_without_offsets():
    """Texts below the long ones cost the tokenizer no offsets; the ids are those of one encoding either way."""
    t = tokenizer(BYTE_BPE)
    r = random.Random(8)
    texts = ["", "one <|endoftext|> two", *(" ".join(r.choices(["über", "the", "x1", "…", "don't", "a\n\n b"], k=k)) for k in (5, 60, 900))]
    for e in (bpe.Encoder(BYTE_BPE, 2000, 300, offsets=False), bpe.Encoder(BYTE_BPE, 2000, 300)):
        assert [x.tolist() for x in e([x.encode() for x in texts])] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    e = bpe.Encoder(BYTE_BPE, 2000, 300, offsets=False)
    e([x.encode() for x in texts[:-1]])
    assert not len(e.units.keys) and len(e.plain.keys)
