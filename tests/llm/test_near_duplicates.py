import random
import re

import pytest

from snapweave.llm import near_duplicates as nd


def shingles(text):
    w = [x for x in re.split(r"[ \t\n\v\f\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    names = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        if i is not None:
            names[r] = min(names.get(r, i), i)
    return sorted(((i, len(sets[k]), names.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def corpus(seed, n=150):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(n):
        base = r.choice(rows)[1].split() if rows and r.random() < 0.7 else r.choices(vocabulary, k=r.choice([3, 8, 30, 60, 120]))
        words = list(base)
        for _ in range(r.choice([0, 0, 1, 2, 3])):
            if words:
                words[r.randrange(len(words))] = r.choice(vocabulary)
        if r.random() < 0.2:
            words += r.choices(vocabulary, k=r.randint(1, 10))
        rows.append((k, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(make_docs, edge_rows, seed):
    rows = corpus(seed)
    rows += [(1000 + i if i is not None else None, t) for i, t in edge_rows] if seed == 1 else []
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nd.join(make_docs(rows)).collect()), key=repr)
    assert got == brute(rows)


def family(seed, n=60):
    """Near copies of one text at all distances, among other texts that share a line with it."""
    r = random.Random(seed)
    origin = [f"o{k}" for k in range(80)]
    rows = []
    for k in range(n):
        words = list(origin)
        for _ in range(r.choice([0, 1, 2, 3, 4, 6, 8])):
            words[r.randrange(80)] = f"x{k}y{r.randrange(9)}"
        rows.append((k, " ".join(words)))
    return rows + [(n + k, " ".join(origin[:15] + [f"z{k}a{j}" for j in range(r.choice([6, 20]))])) for k in range(20)]


def test_families_in_many_tiles_and_rounds(make_docs, monkeypatch):
    for name, value in {"SMALL": 2, "CHUNK": 4, "OUTLIERS": 3, "STREAMED": 7, "ALLOWED": (1, 2, 1 << 62)}.items():
        monkeypatch.setattr(nd, name, value)
    rows = family(6)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nd.join(make_docs(rows)).collect()), key=repr)
    assert got == brute(rows) and 5 < len({c for *_, c in got}) < 70


def test_twin_words_are_different_shingles():
    for bits in (10, 12):
        word = "".join("ab"[bin(k).count("1") % 2] for k in range(1 << bits))
        one, two = nd.sets_of([word.encode(), word.translate(str.maketrans("ab", "ba")).encode()])
        assert one[0] != two[0]


def test_keep_one(make_docs):
    rows = corpus(3, 60)
    kept = nd.keep_one(make_docs(rows + rows[:5]))
    want = {c for i, _, c in brute(rows)}
    clashing = nd.keep_one(make_docs(rows).withColumnsRenamed({"kept": "Kept_", "label": "_kept", "tie": "kept"}))
    assert {"Kept_", "_kept", "kept"} < set(clashing.columns) and clashing.count() == len(want)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want) and kept.columns == make_docs(rows).columns


def test_empty_table(make_docs):
    assert nd.join(make_docs([(1, "x")]).where("doc_id = 2")).count() == 0


def test_bitmap_bound_is_never_below_the_overlap():
    import numpy as np

    r = np.random.default_rng(1)
    for _ in range(200):
        pool = r.integers(0, 2**63, 400).astype(np.uint64)
        a, b = (np.unique(r.choice(pool, r.integers(1, 300))) for _ in range(2))
        width = min(nd.width_of(len(a)), nd.width_of(len(b)))
        x, y = (nd.folded(np.frombuffer(nd.signature(v), np.uint8), width) for v in (a, b))
        bound = min(len(a) - np.bitwise_count(x & ~y).sum(), len(b) - np.bitwise_count(y & ~x).sum())
        assert bound >= len(np.intersect1d(a, b))
