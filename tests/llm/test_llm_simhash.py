"""SimHash: fingerprints, the grid join and components against plain versions."""

import random
import re

import pytest
import xxhash
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ALL_IDS, SENTENCE, ids, no_docs, odd_docs

from hazeframe.llm import simhash
from hazeframe.llm.components import components
from hazeframe.llm.queries import op2_simhash


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps):
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                x, y = sorted((find(a), find(ids[j])))
                root[y] = x
    return {d: find(d) for d in ids}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAB É\n\t\x1c .ß", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_query_against_plain_version(spark, duck):
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    want_ids, fps = [r[0] for r in rows], [plain_fingerprint(r[1]) for r in rows]
    roots = plain_components(want_ids, fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op2_simhash(spark, SMALL).collect()}
    assert got == {d: (f"{f:016x}", roots[d]) for d, f in zip(want_ids, fps)}


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_links_are_all_pairs_within_reach(spark, bits):
    rnd = random.Random(5)
    points = {0, (1 << 64) - 1}
    for _ in range(60):
        base = rnd.getrandbits(64)
        points.add(base)
        for _ in range(6):
            other = base
            for b in rnd.sample(range(64), rnd.randint(1, 5)):
                other ^= 1 << b
            points.add(other)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    got = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), bits).collect()}
    mask = (1 << 64) - 1
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i]
            if bin((a ^ b) & mask).count("1") <= bits}
    assert got == want


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(40), rnd.randrange(40)) for _ in range(25)]
    edges += [(500, 500 + i) for i in range(1, 50)] + [(3, 3)]
    root = {}
    for a, b in edges:
        if a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    got = simhash.near_duplicates(odd_docs(spark))
    assert got.columns == ["doc_id", "fp", "component_id"] and ids(got) == ALL_IDS
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert by_id[1] == by_id[2] == by_id[3] == {(0, 1)}
    assert by_id[4] == by_id[6] == by_id[11] and {c for _, c in by_id[4]} == {4}
    assert (by_id[4] | {(0, 1)}) == by_id[None]
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = odd_docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert ids(kept) == [None, None, 1, 4, 5, 7, 8, 9, 10]
    assert simhash.keep_one(no_docs(spark)).count() == 0
    twice = odd_docs(spark, [(1, SENTENCE, "en"), (1, SENTENCE, "en")])
    assert simhash.keep_one(twice).count() == 1
