import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from snapweave.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab1.@-+ ()0%_9é", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert pii.base_spans(text) == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4539578763621486", "4539-5787 6362 1486", "a@b.c", "a@b", "@x.y", "1.2.3.4", "300.1.2.3", "1.2.3.4.5.6.7.8.9", "+1 (487) 555-7209", "+12", " ", "x", "_", "-", "."]), max_size=12).map("".join))
def test_base_spans_of_joined_pieces(text):
    assert pii.base_spans(text) == brute(text)


def test_luhn():
    assert pii.luhn("4539578763621486") == (sum(int(c) for i in range(16) for c in str(int("4539578763621486"[::-1][i]) * (1 + i % 2))) % 10 == 0)


@pytest.mark.parametrize("text", ["1" * 200000, "a" * 200000 + "@", "+1" + "(" * 100000, "1." * 100000, "a@" * 50000])
def test_long_runs_stay_linear(text):
    pii.base_spans(text)


def test_find_and_sanitise(spark, make_docs, edge_rows):
    secret = "ann@corp.example"
    fill = [f"{w}{k}" for k in range(40) for w in ("lorem", "ipsum")]
    rows = [(1000 + k, f"{fill[k]} {fill[k + 1]} zaphod {secret} {fill[k + 7]} {fill[k + 9]} call") for k in range(6)] + [(2000 + k, f"plain text number {k} call without any of it") for k in range(30)]
    docs = make_docs(rows + edge_rows)
    found = {r["doc_id"]: r for r in pii.digests(pii.find(docs)).collect() if r["doc_id"] is not None}
    assert pii.digests(pii.find(docs)).count() == docs.count()
    assert all("zaphod" in rows[k][1][int(s.split(":")[1]) : int(s.split(":")[2])] for k in range(6) for s in found[1000 + k]["spans"].split(",")[1:]), found[1000]
    assert len(found[1000]["spans"].split(",")) == 2 and found[2000]["spans"] == "" and found[0]["n_email"] == 0
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect() if r["doc_id"] is not None}
    assert secret not in clean[1000] and "zaphod" not in clean[1000] and "[EMAIL]" in clean[1000] and clean[2003] == rows[9][1] and clean[0] is None
    assert pii.sanitise(docs).columns == docs.columns


def test_copies_are_no_evidence(make_docs):
    docs = make_docs([(k, "some words revealing bob@corp.example and more words here") for k in range(20)] + [(100 + k, f"other {k}") for k in range(20)])
    assert {r["spans"] for r in pii.digests(pii.find(docs)).collect()} == {"", "email:21:37"}


def test_three_contexts_are_enough_for_every_pair(make_docs):
    docs = make_docs([(3 * e + k, f"l{e}x{k} term{e} u{e}@corp.example r{e}x{k}") for e in range(2000) for k in range(3)])
    pairs = pii.disclosing_pairs(docs, pii.scan(docs)).collect()
    assert sorted(x["term"] for x in pairs) == sorted(f"term{e}" for e in range(2000))


def test_empty_table(make_docs):
    docs = make_docs([(1, "x")]).where("doc_id = 2")
    assert pii.digests(pii.find(docs)).count() == 0 and pii.sanitise(docs).count() == 0


def brute_added(texts, rules=None):
    """Spans of disclosing terms of each text, by plain counting."""
    from math import log2

    rules = rules or pii.Disclosure()
    different = sorted({t or "" for t in texts} - {""}) + ([""] if any(t == "" for t in texts) else []) + ([None] if None in texts else [])
    terms, entities, near = {}, {}, {}
    for t in different:
        spans = brute(t or "")
        free = lambda s, e, spans=spans: all(e <= b or s >= c for _, b, c in spans)
        words = [m.span() for m in re.finditer(r"[^\x09-\x0D ]+", t or "")]
        for s, e in words:
            bare = t[s:e].strip(".,;:!?\"'()[]{}<>")
            if bare:
                at = s + t[s:e].index(bare)
                terms.setdefault(bare.lower(), {}).setdefault(t, []).append((at, at + len(bare), free(at, at + len(bare))))
        for kind, b, c in spans:
            entity = pii.entity_of(kind, t[b:c])
            entities.setdefault(entity, set()).add(t)
            left, right = [w for w in words if w[1] <= b][-rules.reach :], [w for w in words if w[0] >= c][: rules.reach]
            for s, e in left + right:
                bare = t[s:e].strip(".,;:!?\"'()[]{}<>").lower()
                if len(bare) >= rules.min_chars and free(s, e):
                    near.setdefault((entity, bare), set()).add(t)
    sketch = {t: tuple(int(x[0]) for x in pii.sketches([(t or "").encode()])) for t in different}
    evidence = lambda held: min(len({sketch[t][k] for t in held}) for k in (0, 1))
    kinds = {}
    for (entity, term), held in near.items():
        if evidence(held) >= rules.contexts and evidence(entities[entity]) >= rules.contexts:
            ic = log2(len(different) / len(entities[entity]))
            pmi = log2(min(1, len(held) / max(len(terms[term]), len(held)))) + ic
            if ic > 0 and pmi >= rules.generalise * ic:
                kinds[term] = max(kinds.get(term, ""), "remove" if pmi >= rules.remove * ic else "generalise")
    return {t: sorted((kinds[term], s, e) for term, where in terms.items() if term in kinds for s, e, ok in where.get(t, ()) if ok) for t in different}


def test_added_spans_equal_plain_counts(make_docs, edge_rows):
    import random

    r = random.Random(8)
    common = [f"w{k}" for k in range(30)]
    people = [(f"p{k}@corp.example", f"Name{k}", f"team{k // 2}") for k in range(6)]
    rows = []
    for k in range(160):
        words = r.choices(common, k=r.randint(5, 90))
        mail, name, team = people[k % 6]
        if k < 100:
            words += [mail] + r.choices(common, k=r.choice([0, 3, 45])) + [name + ","] * (k % 3 > 0) + [team] * (k % 2)
        elif k < 110:
            words += [name, "alone"]
        r.shuffle(words) if k % 4 == 0 else None
        rows.append((k if k % 10 else None, " ".join(words)))
    rows += rows[:60] + edge_rows  # repeated rows change nothing
    want = brute_added([t for _, t in rows])
    got = pii.find(make_docs(rows)).collect()
    assert len(got) == len(rows) and sum(map(bool, want.values())) > 40 and {k for x in want.values() for k, _, _ in x} == {"remove", "generalise"}
    key = lambda i, x: (-1 if i is None else i, x)
    assert sorted(key(x["doc_id"], sorted(tuple(s) for s in x["added"])) for x in got) == sorted(key(i, want[t]) for i, t in rows)
    docs = make_docs(rows).withColumnsRenamed({"shard": "added", "kept": "Added_", "spans": "_added"})
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and sorted(map(str, (x["text"] for x in out.collect()))) == sorted(str(t if t is None else pii.replace(t, [*brute(t), *want[t]])) for _, t in rows)
