"""Mixing: targets, spans of whole blocks, plain schedule, odd rows."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from conftest import SMALL, rows_of, rows_of_sql
from llm_cases import ALL_IDS, no_docs, odd_docs
from pyspark.sql import functions as F

from hazeframe.llm import mixing
from hazeframe.llm.oracles import MIXING
from hazeframe.llm.queries import op11_mixing

SCHEMA = "doc_id long, source string, text string"


def plain_targets(sizes):
    """Share by weight, cap, reshare: as the contract words it. sizes: source -> words."""
    named = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(named)}
    target = {s: Fraction(0) for s in named}
    left, below = Fraction(3, 2) * sum(sizes.values()), set(named)
    while left and below:
        share = left / sum(weight[s] for s in below)
        left = Fraction(0)
        for s in list(below):
            target[s] += share * weight[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = Fraction(2 * sizes[s])
                below.discard(s)
    return target


def mixed(spark, rows, **more):
    return mixing.Mix(spark.createDataFrame(rows, SCHEMA), **more)


def some_docs(n=400):
    out = [(i, ("a", "b", "é", None, "Z", "")[i * i % 6], " ".join(f"w{i}" for _ in range(i * 31 % 97))) for i in range(n)]
    return out + [(n, "one", "word"), (n + 1, "none", " \n"), (n + 2, "long", "x " * 60_000)]


def test_query_and_sql(spark, duck):
    assert rows_of(op11_mixing(spark, SMALL)) == rows_of_sql(duck, MIXING)


def test_targets_are_met_exactly(spark):
    docs = some_docs()
    rows = mixed(spark, docs, block=100).taken().collect()
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, _, t in docs}
    source = {d: s for d, s, _ in docs}
    sizes = Counter()
    for d, n in size.items():
        sizes[source[d]] += n
    want = plain_targets(sizes)
    taken = Counter()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(float(want[source[r["doc_id"]]]))
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - float(want[s])) < 1 for s in sizes)


def test_spans_fill_their_slots(spark):
    docs = some_docs()
    mix = mixed(spark, docs, block=100)
    spans, slots = mix.spans().collect(), mix.slots.collect()
    assert sorted(r["slot"] for r in slots) == list(range(len(slots)))
    source = {d: s for d, s, _ in docs}
    by_slot = defaultdict(list)
    for r in spans:
        assert r["source"] == source[r["doc_id"]] and 0 <= r["start"] and r["start"] + r["length"] <= r["size"]
        by_slot[r["slot"]].append((r["offset"], r["length"], r["source"]))
    sizes = defaultdict(set)
    for parts in by_slot.values():
        at = 0
        for offset, length, _ in sorted(parts, key=lambda p: p[0]):
            assert offset == at  # gapless
            at += length
        assert len({s for *_, s in parts}) == 1
        sizes[parts[0][2]].add(at)
    assert all(max(s) - min(s) <= 1 for s in sizes.values())  # blocks of a source are equal to a word


def test_schedule_is_the_plain_one_and_even(spark):
    tokens = [(1, 30_000), (2, 10_000), (3, 57_000), (4, 3), (5, 1)]
    got = mixing.schedule(spark.createDataFrame(tokens, "idx long, tokens long"), 10).collect()
    total = sum(t for _, t in tokens)
    n, ranks, want = -(-total // 10), Counter(), []
    ends = [sum(t for _, t in tokens[:k + 1]) for k in range(len(tokens))]
    for slot in range(n):
        u = slot * mixing.STEP % (1 << mixing.POINT_BITS)
        idx = next(k for k, e in enumerate(ends) if u < int(e * (float(1 << 40) / total)) or k == len(ends) - 1) + 1
        want.append((slot, idx, ranks[idx]))
        ranks[idx] += 1
    for idx, _ in tokens:
        if not ranks[idx]:
            want.append((len(want), idx, 0))
    assert sorted((r["slot"], r["idx"], r["k"]) for r in got) == want
    # any stretch of slots has the sources' shares to within a few slots
    order = [idx for _, idx, _ in want]
    for lo in range(0, n - 1000, 700):
        part = Counter(order[lo:lo + 1000])
        assert all(abs(part[i] - 1000 * t / total) < 5 for i, t in tokens)


def test_rows_that_repeat_are_rows(spark):
    rows = [(None, "s", "a b c")] * 25_000 + [(1, "s", "d " * 75_000), (2, "t", "x y")]
    found = mixed(spark, rows).taken().collect()
    assert len(found) == len(rows)
    by = Counter()
    for r in found:
        assert r["taken"] <= 2 * r["size"]
        by[r["source_size"]] += r["taken"]
    want = plain_targets({"s": 150_000, "t": 2})
    assert by[150_000] == int(want["s"]) and by[2] == int(want["t"])


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.createDataFrame(some_docs(), SCHEMA)
    once = rows_of(mixing.Mix(docs).taken())
    assert rows_of(mixing.Mix(docs.repartition(7, F.rand())).taken()) == once


def test_odd_rows(spark):
    rows = mixing.Mix(odd_docs(spark)).taken().collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda d: (d is not None, d)) == ALL_IDS
    assert mixing.Mix(no_docs(spark)).taken().count() == 0
    assert mixed(spark, [(1, "s", None), (2, None, "")]).taken().agg(F.sum("taken")).first()[0] == 0


def test_a_share_above_the_cap_is_an_error(spark):
    with pytest.raises(ValueError):
        mixed(spark, some_docs(3), share=Fraction(5, 2))
