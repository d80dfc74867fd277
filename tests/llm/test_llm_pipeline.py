"""The pipeline: stage by stage against its operators' plain results, and a planted corpus."""

import os
import sys

import pytest
from conftest import SMALL, rows_of, rows_of_sql
from llm_cases import ALL_IDS, SENTENCE, ids, no_docs, odd_docs

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from test_llm_text import plain_leaks  # noqa: E402
from hazeframe.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    assert rows_of(QUERIES[name](spark, SMALL)) == rows_of_sql(duck, ORACLES[name])


def test_run_is_the_chain_of_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = docs.columns
    before = docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SMALL)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names, name
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        now = docs.count()
        assert 0 < now
        if k < 4:
            assert now <= before
            before = now
    assert docs.select("doc_id").distinct().count() == before
    run = corpus_pipeline.run(spark, SMALL)
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(own).collect())) == sorted(map(tuple, docs.select(own).collect()))


def test_plain_version_of_the_first_four_stages(spark, duck):
    """Decisions by the operators' own queries, applied one after another in Python."""
    from hazeframe.llm import decontam, langid, quality, simhash

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = langid.learn(docs)
    stay = {d for d, t in rows.items() if known.predict(t)[0] != "und"}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    some = docs.where(docs["doc_id"].isin(sorted(stay)))
    stay = {r["doc_id"] for r in quality.verdicts(some, labels).collect() if r["kept"]}
    groups: list[tuple[int, int]] = []
    for d in sorted(stay):
        groups.append((d, simhash.fingerprint(rows[d])))
    root = {d: d for d in stay}
    for i, (a, x) in enumerate(groups):
        for b, y in groups[:i]:
            if bin(x ^ y).count("1") <= 3:
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    stay = set(root.values())
    items = [(i, decontam.words_of(t)) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()]
    stay = {d for d in stay if not plain_leaks(rows[d], items)}
    assert stay == {r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect()}


def test_decisions_take_effect(spark, tmp_path):
    real = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    item = bench.first()["text"]
    host = real.orderBy("doc_id").where("n_chars between 1500 and 3000 and lang = 'en'").first()
    planted = [(900_001, host["text"] + "\n" + item, "en"), (900_002, "1234 5678", "en"), (900_003, None, None),
               (900_004, ("### $$$ %%% &&& | " + SENTENCE + " ") * 1, "en"), (900_005, SENTENCE * 40, "en")]
    extra = spark.createDataFrame([(d, t, lang, "src0", len(t or "")) for d, t, lang in planted], real.schema)
    real.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not left & {d for d, _, _ in planted}
    assert host["doc_id"] in left or left


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_and_empty_tables(spark, name, stage):
    """Nulls in every column, empty and long texts, repeated rows, clashing columns, no rows."""
    docs = odd_docs(spark)
    out = stage(spark, docs, SMALL)
    assert set(ids(out)) <= set(ALL_IDS)
    if name == "pack":
        assert set(ids(out)) == set(ALL_IDS)
    else:
        assert out.columns == docs.columns
    if name == "decontaminate":
        assert ids(out) == ALL_IDS
    assert stage(spark, no_docs(spark), SMALL).count() == 0


def test_pipeline_without_documents_labels_or_benchmark(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(QUERIES) < names and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
