"""Sharding: the law of even sizes, groups together, native plans."""

import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SMALL
from llm_cases import ALL_IDS, no_docs, odd_docs

from hazeframe.llm import sharding
from hazeframe.llm.common import running_total
from hazeframe.llm.queries import op10_sharding


def check(rows, docs, spread):
    """docs: (doc_id, text). ``spread`` bounds the difference of shard sizes in bytes."""
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert set(slots) <= set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes[k] for k in range(8)) <= spread


def test_query(spark, duck):
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    rows = op10_sharding(spark, SMALL).collect()
    check(rows, docs, max(len(t.encode()) for _, t in docs))
    text = dict(docs)
    where = defaultdict(set)
    for r in rows:
        where[text[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


def test_sizes_are_even_and_groups_whole(spark):
    docs = [(i, f"text {i} " + "y" * (i * 37 % 900)) for i in range(3000)]
    docs += [(10_000 + i, f"copy {i % 60} " + "z" * (i % 60)) for i in range(600)]
    docs += [(20_000 + i, "hot " * 60) for i in range(3000)]
    rows = sharding.shard_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check(rows, docs, 300)
    text, where = dict(docs), defaultdict(Counter)
    for r in rows:
        where[text[r["doc_id"]]][r["shard"]] += 1
    assert sum(len(s) > 1 for s in where.values()) <= 2


def hashed_cut(groups):
    """Cut pairs if every document went to a shard by its hash."""
    cut = 0
    for own in groups.values():
        parts = Counter(zlib.crc32(str(d).encode()) % 8 for d in own)
        cut += len(own) * (len(own) - 1) // 2 - sum(n * (n - 1) // 2 for n in parts.values())
    return cut


@pytest.mark.parametrize("copies, single", [(4, 0), (10, 200), (2, 3000), (700, 300)])
def test_linked_tables_keep_their_groups(spark, copies, single):
    """Where nearly all documents are linked, groups stay whole but for the last few."""
    linked = 4000 // copies * copies
    docs = [(i, f"group {i // copies} " + "word " * (i // copies * 7 % 40)) for i in range(linked)]
    docs += [(10_000 + i, f"single {i} " + "x" * (i * 31 % 200)) for i in range(single)]
    found = sharding.shard_documents(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = found.collect()
    check(rows, docs, max(len(t) for _, t in docs) + 1)
    text, where, groups = dict(docs), defaultdict(set), defaultdict(list)
    for r in rows:
        where[text[r["doc_id"]]].add(r["shard"])
        groups[r["group"]].append(r["doc_id"])
    assert sum(len(s) > 1 for s in where.values()) <= 8
    pairs, cut = sharding.cut_pairs(found).first()
    assert pairs == linked // copies * (copies * (copies - 1) // 2)
    assert cut <= hashed_cut(groups) / (20 if copies < 100 else 1.5)


def test_a_group_above_the_quota_fills_shard_after_shard(spark):
    docs = [(i, "hot text") for i in range(3000)] + [(5000 + i, f"other {i % 50} words") for i in range(1000)] + [(9000 + i, f"s {i}") for i in range(500)]
    rows = sharding.shard_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check(rows, docs, 40)
    text, where = dict(docs), defaultdict(set)
    for r in rows:
        where[text[r["doc_id"]]].add(r["shard"])
    size = sum(len(t) + 1 for _, t in docs)
    assert len(where["hot text"]) <= 3000 * 9 / (size / 8) + 2
    assert sum(len(s) > 1 for s in where.values()) <= 8


def test_one_text_only_is_split_evenly(spark):
    docs = [(i, "same text") for i in range(4001)]
    check(sharding.shard_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs, 200)


def test_odd_rows(spark):
    rows = sharding.shard_documents(odd_docs(spark)).collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda d: (d is not None, d)) == ALL_IDS
    assert sharding.shard_documents(no_docs(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = op10_sharding(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("per_bucket", [3, 1000])
def test_running_total(spark, per_bucket):
    rows = [(k % 3 if k % 7 else None, k, k % 5) for k in range(200)]
    df = spark.createDataFrame(rows, "g int, k long, w long")
    got = running_total(df, ["g"], ["k"], "w", "at", len(rows), per_bucket).collect()
    for g in (0, 1, 2, None):
        own = sorted((r["at"], r["w"]) for r in got if r["g"] == g)
        total = 0
        positive = [x for x in own if x[1]]
        for at, w in positive:
            assert at == total
            total += w
        assert total == sum(w for a, _, w in rows if a == g)
