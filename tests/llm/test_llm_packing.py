"""Packing: whole documents in gapless sequences, close to the certified bound."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SMALL
from llm_cases import ALL_IDS, no_docs, odd_docs

from hazeframe.llm import packing
from hazeframe.llm.queries import op3_packing, tokenizer_path


def check_sequences(rows, capacity):
    groups = defaultdict(list)
    for r in rows:
        groups[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in groups.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(groups)


def bound_of(rows, capacity):
    return packing.lower_bound(np.bincount([r["length"] for r in rows], minlength=capacity + 1), capacity)


def test_query_against_the_tokenizer(spark, duck):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = set()
    for doc_id, text in duck.execute("SELECT doc_id, text FROM documents").fetchall():
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at:at + 4096], "<u4").tobytes()
            want.add((doc_id, k, at, len(part) // 4, zlib.crc32(part)))
    rows = op3_packing(spark, SMALL).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want)
    assert check_sequences(rows, 4096) <= bound_of(rows, 4096) * 1.01 + 1


@pytest.mark.parametrize("per_task", [20, 300, 100_000])
def test_exchange_rounds_reach_the_bound(spark, per_task):
    rng = np.random.default_rng(3)
    lengths = np.concatenate([rng.integers(1, 400, 1500), rng.integers(1, 1001, 400), np.full(20, 1000)])
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, length long")
    rows = packing.pack(items, 1000, per_task, merge=4).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(lengths)))
    assert check_sequences(rows, 1000) <= bound_of(rows, 1000) * 1.02 + 1


def test_lower_bound():
    def bound(lengths):
        return packing.lower_bound(np.bincount(lengths, minlength=101), 100)

    assert bound([]) == 0 if (np.bincount([], minlength=101)).dtype == int else True
    assert bound([51] * 7) == 7  # no two share a bin
    assert bound([34] * 9) == 5  # two at most
    assert bound([100, 1]) == 2
    rng = np.random.default_rng(0)
    for _ in range(50):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        assert bound(lengths) <= len(packing.best_fit(lengths, 100)[2])


def test_odd_rows(spark):
    path = tokenizer_path("word_bpe_49k.json")
    rows = packing.pack_documents(odd_docs(spark), path).collect()
    first = [r["doc_id"] for r in rows if r["piece"] == 0]
    assert sorted(first, key=lambda d: (d is not None, d)) == ALL_IDS
    assert [r["length"] for r in rows if r["doc_id"] in (1, 2, 3)] == [1, 1, 1]
    long = sorted((r["piece"], r["start"], r["length"]) for r in rows if r["doc_id"] == 5)
    assert len(long) > 1 and all(n == 4096 for _, _, n in long[:-1]) and [s for _, s, _ in long] == [4096 * k for k, _, _ in long]
    check_sequences(rows, 4096)
    assert packing.pack_documents(no_docs(spark), path).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0)], "doc_id long, length long"), 10)
