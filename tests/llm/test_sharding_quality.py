import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from snapweave.llm import quality, sharding


def test_hilbert_curve_is_a_walk(spark):
    for bits, n in ((2, 2), (3, 3), (4, 3)):
        side = 1 << bits
        cells = spark.range(side**n).select(*(F.pmod(F.floor(F.col("id") / side**k), F.lit(side)).cast("int").alias(f"c{k}") for k in range(n)))
        walk = [r[:n] for r in sorted(map(tuple, cells.select("*", sharding.hilbert_index([F.col(f"c{k}") for k in range(n)], bits).alias("h")).collect()), key=lambda r: r[-1])]
        assert len(set(walk)) == side**n
        assert all(sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1 for a, b in zip(walk, walk[1:], strict=False))


def test_shards(make_docs, edge_rows):
    rows = edge_rows + [(k + 100, f"text {k % 5}") for k in range(300)]
    got = sharding.shard(make_docs(rows), split=17).collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == len(rows) and set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None) == want
    assert sharding.shard(make_docs(rows).where("doc_id = -1")).count() == 0
    few = sharding.shard(make_docs([(1, "a"), (2, "b")])).collect()
    assert sorted(r["slot"] for r in few) == [0, 0]


def test_ranks_follow_the_curve_and_prune(spark):
    import random

    r = random.Random(5)
    rows = [(k if k % 9 else None, f"text {k}", r.choice(["de", "en", None, "fr"]), "site-" + r.choice("abcdefgh"), r.choice([None, 3, 50, 900, 7000])) for k in range(800)] + [(5, "same", "en", "site-a", 4)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sharding.shard(docs, split=10).collect()
    order = sorted(got, key=lambda x: (x["shard"], x["slot"]))
    curve = [x["curve"] for x in order]
    assert curve == sorted(curve) and len(set(curve)) > 40  # the order of the shards and slots is that of the curve
    for n in range(16):  # run n holds the ranks from n * 840 / 16 on
        assert [x["slot"] for x in order if x["shard"] == n] == list(range(-(-(n + 1) * 840 // 16) - -(-n * 840 // 16)))
    where = {x["doc_id"]: x["shard"] for x in got if x["doc_id"] is not None}
    held = {}
    for i, _, _, source, _ in rows:
        if i is not None and i != 5:
            held.setdefault(source, set()).add(where[i])
    assert max(map(len, held.values())) <= 8  # a reader of one source skips half of the shards at least


def brute_coverage(text, rules):
    """Shares of word characters in repeated lines and n-grams, and the verdict, word by word."""
    spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    words = [text[s:e] for s, e in spans]
    total = max(1, sum(map(len, words)))
    grams = lambda n: Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    inside = lambda n: {k + j for c in [grams(n)] for k in range(len(words) - n + 1) if c[tuple(words[k : k + n])] > 1 for j in range(n)}
    dup = {n: sum(len(words[k]) for k in inside(n)) / total for n in rules.dup}
    top = {n: min(1.0, max((c * sum(map(len, g)) for g, c in grams(n).items() if c > 1), default=0) / total) for n in rules.top}
    seen, chars, n_dup, n_lines = set(), 0, 0, 0
    for line in text.split("\n"):
        w = re.findall(r"[^\x20\x09-\x0D]+", line)
        n_lines += bool(w)
        if w and line in seen:
            chars, n_dup = chars + sum(map(len, w)), n_dup + 1
        seen.add(line)
    lines = chars / total
    over = lambda share, limit: (share - limit) * total > rules.slack_chars
    bad = over(lines, rules.max_dup_line_chars) or n_dup > rules.max_dup_lines * n_lines + rules.slack_lines or any(over(dup[n], x) for n, x in rules.dup.items()) or any(over(top[n], x) for n, x in rules.top.items()) or len(re.findall(r"[#*$%&|<>]", text)) > rules.max_symbols_per_word * len(words)
    failed = len(words) < rules.min_words or 100 * len(inside(3)) > rules.max_repeat_percent * len(words)
    return lines, max(top.values()), max(dup.values()), not (failed or bad)


def test_coverage_and_verdict_equal_brute_force(make_docs):
    import random

    r = random.Random(7)
    texts = []
    for k in range(150):
        lines = [" ".join(r.choices([f"w{j}" for j in range(r.choice([8, 60, 900]))], k=r.randint(1, 40))) for _ in range(r.randint(1, 25))]
        lines += r.choices(lines, k=r.choice([0, 0, 1, 5]))
        lines += ["# $ %"] * r.choice([0, 0, 0, 9])
        r.shuffle(lines)
        texts.append("\n".join(lines))
    for bits in (10, 12):
        word = "".join("ab"[bin(k).count("1") % 2] for k in range(1 << bits))
        texts.append(word + "\n" + word.translate(str.maketrans("ab", "ba")))
    got = {x["doc_id"]: x for x in quality.measure(make_docs(list(enumerate(texts)))).collect()}
    kept = 0
    for k, t in enumerate(texts):
        lines, top, dup, keep = brute_coverage(t, quality.Rules())
        x = got[k]
        assert abs(x["dup_line_chars"] - lines) < 1e-12 and abs(x["top_ngram_chars"] - top) < 1e-12 and abs(x["dup_ngram_chars"] - dup) < 1e-12 and x["kept"] == keep, k
        kept += keep
    assert 10 < kept < 140 and got[150]["n_dup_lines"] == got[151]["n_dup_lines"] == 0


def test_quality(make_docs, edge_rows):
    prose = " ".join(f"word{k}" for k in range(80))
    rows = edge_rows + [(100, prose), (101, (prose + "\n") * 4), (102, " ".join("# $" for _ in range(60)) + prose), (103, prose + "\nline of words here\n" + prose.replace("word", "other") + "\nline of words here")]
    got = {}
    for r in quality.measure(make_docs(rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i, t in rows:
        if i is None:
            continue
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        repeated = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        r = got[i][0]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(repeated)), i
        assert r["base_failed"] == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
    assert [got[k][0]["kept"] for k in (100, 101, 102, 103)] == [True, False, False, True]
    kept = quality.filter_documents(make_docs(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [100, 103] and kept.columns == make_docs(rows).columns
    assert quality.measure(make_docs(rows).where("doc_id = -1")).count() == 0
