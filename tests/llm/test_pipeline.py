"""The pipeline against its stages done in plain Python on a small corpus."""

import hashlib
import random

import corpus_pipeline
from snapweave.llm.tokens import WORD_BPE, tokenizer
from tests.llm import test_decontaminate, test_near_duplicates, test_pii, test_sharding_quality
from snapweave.llm import pii, quality


def corpus():
    r = random.Random(21)
    words = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(r.choices(words, k=14))) for k in range(4)]
    rows = []
    for k in range(70):
        w = r.choices(words, k=r.randint(60, 140))
        if k % 10 == 3:
            w[20:20] = items[k % 4][1].split()
        if k % 7 == 2:
            w[30:30] = [f"u{k}@corp.example"]
        if k % 5 == 1 and rows:
            w = (r.choice(rows)[1] or "x").split()
            w[r.randrange(len(w))] = "edited"
        rows.append((k, " ".join(w)))
    rows += [(100, None), (101, ""), (102, "short text"), (103, "again and " * 60), (104, "# $ %" * 80), (None, rows[4][1]), (5, rows[5][1]), (None, None)]
    return rows, items


def brute(rows, items):
    rules = quality.Rules()
    kept = [(i, t) for i, t in rows if t and test_sharding_quality.brute_coverage(t, rules)[3]]
    names = [c for _, _, c in test_near_duplicates.brute([(i, t) for i, t in kept if i is not None])]
    first = {i for i in names}
    unique = {i: t for i, t in kept if i is not None and i in first}
    kept = list(unique.items()) + [(i, t) for i, t in kept if i is None]
    hit = test_decontaminate.brute([(k, t) for k, (_, t) in enumerate(kept)], items)
    near = test_decontaminate.brute_near([(k, t) for k, (_, t) in enumerate(kept)], items)
    dirty = {k for k, *_, bad in hit if bad} | {k for k, x in near.items() if x}
    kept = [row for k, row in enumerate(kept) if k not in dirty]
    added = test_pii.brute_added([t for _, t in kept])
    tok = tokenizer(WORD_BPE)
    out = []
    for i, t in kept:
        ids = tok.encode(pii.replace(t, [*test_pii.brute(t), *added[t]]), add_special_tokens=False).ids
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return out


def test_run(spark, make_docs, tmp_path):
    rows, items = corpus()
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    want = brute(rows, items)
    assert 30 < len(want) < 65 and sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_stages_keep_the_columns(spark, make_docs, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make_docs([(1, "x")]).where("doc_id = 2")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0
