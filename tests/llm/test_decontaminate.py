import hashlib
import random
import re

from snapweave.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    wins = {}
    for name, text in items:
        w = words(text)
        for s in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[s : s + 10]), set()).add(str(name) if name is not None else "")
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in wins}:
            for s in range(len(w) - size + 1):
                if (x := tuple(w[s : s + size])) in wins:
                    hit.update(range(s, s + size))
                    found |= wins[x]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def case(seed):
    r = random.Random(seed)
    vocabulary = ["the", "Of", "é", "b1", "zz", "q"]
    items = [(k, " ".join(r.choices(vocabulary, k=r.choice([0, 1, 5, 9, 10, 11, 25])))) for k in range(12)] + [(None, "null id item of some words"), (3, "again three"), (99, None)]
    docs = []
    for k in range(60):
        parts = r.choices(vocabulary, k=r.randint(0, 60))
        if k % 2:
            parts.insert(r.randint(0, len(parts)), r.choice(items)[1] or "")
        docs.append((k, ", ".join(parts)))
    return docs, items


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect()), key=repr)


def test_against_brute_force(spark, make_docs, edge_rows):
    docs, items = case(1)
    docs += [(1000 + i if i is not None else None, t) for i, t in edge_rows]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert result(d.decontaminate(make_docs(docs), bench)) == want
    assert result(d.decontaminate(make_docs(docs), bench, block_bytes=60)) == want  # many blocks of queries, a stored index
    kept = d.filter_documents(make_docs(docs), bench)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((x[0] for x in want if not x[5]), key=repr) and kept.columns == make_docs(docs).columns


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = make_docs([(1, "some words"), (2, None)])
    assert result(d.decontaminate(docs, none)) == brute([(1, "some words"), (2, None)], [])
    assert d.filter_documents(docs, none).count() == 2
    assert d.decontaminate(docs.where("doc_id = 7"), none).count() == 0


def test_proximity(spark, make_docs):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    near = "x alpha beta gamma delta extra epsilon zeta other eta theta iota y"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = {r["doc_id"]: r for r in d.decontaminate(make_docs([(1, near), (2, "alpha far " + "w " * 50 + "beta"), (3, item)]), bench).collect()}
    assert (rows[1]["n_near_items"], rows[1]["contaminated"]) == (1, False) and rows[2]["n_near_items"] == 0 and rows[3]["n_near_items"] == 1


def brute_near(docs, items, slop=3):
    """Items near each document: at some place 8 in 10 of a window's words stand within slop of their own offset."""
    wins = set()
    for name, text in items:
        w = words(text)
        for s in range(max(1, len(w) - 9) if w else 0):
            wins.add((tuple(w[s : s + 10]), str(name) if name is not None else ""))
    out = {}
    for i, text in docs:
        w, found = words(text), set()
        for win, name in wins:
            n = len(win)
            if n >= 3 and any(sum(x in w[max(0, at + j - slop) : max(0, at + j + slop + 1)] for j, x in enumerate(win)) >= -(-8 * n // 10) for at in range(-n - slop, len(w) + slop + 1)):
                found.add(name)
        out[i] = ",".join(sorted(found))
    return out


def test_proximity_equals_brute_force_on_random_words(spark, make_docs):
    docs, items = case(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_near(docs, items)
    for block_bytes in (1 << 20, 60):
        assert {x["doc_id"]: x["near_items"] for x in d.decontaminate(make_docs(docs), bench, block_bytes=block_bytes).collect()} == want


def test_long_words_with_one_polynomial_do_not_meet(spark, make_docs):
    for bits in (10, 12):
        thue = "".join("ab"[bin(k).count("1") % 2] for k in range(1 << bits))
        other = thue.translate(str.maketrans("ab", "ba"))
        tail = " f1 f2 f3 f4 f5 f6 f7 f8 f9"
        bench = spark.createDataFrame([(1, other + tail)], "item_id long, text string")
        assert [r["n_hit"] for r in d.decontaminate(make_docs([(1, thue + tail)]), bench).collect()] == [0]


def test_proximity_query_against_brute_force(spark, tmp_path):
    from snapweave.llm.queries import QUERIES

    r = random.Random(4)
    vocabulary = [f"v{k}" for k in range(60)]
    items = [(k, " ".join(r.choices(vocabulary, k=r.choice([2, 4, 10, 14])))) for k in range(15)]
    docs = []
    for k in range(60):
        w = items[k % 15][1].split()
        for _ in range(k % 4):
            at = r.randrange(len(w))
            w[at : at + r.randint(0, 1)] = [f"new{k}"]
        docs.append((k, " ".join(r.choices(vocabulary, k=20) + w + r.choices(vocabulary, k=20))))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = {x["doc_id"]: x for x in QUERIES["op2_decontamination"](spark, str(tmp_path)).collect()}
    want = brute_near(docs, items)
    assert {i: x["near_items"] for i, x in rows.items()} == want
    assert all(x["n_near_items"] == len(want[i].split(",")) * bool(want[i]) for i, x in rows.items())
    only = [i for i, x in rows.items() if want[i] and not x["contaminated"]]
    assert len(only) > 5
    import corpus_pipeline

    kept = {x["doc_id"] for x in corpus_pipeline.benchmark_decontamination(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()}
    assert kept == {i for i, x in rows.items() if not x["contaminated"] and not want[i]}
