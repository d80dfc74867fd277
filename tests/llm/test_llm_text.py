"""Language, quality, licences, toxicity and decontamination against plain versions."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ALL_IDS, LONG, SENTENCE, ids, no_docs, odd_docs

from hazeframe.llm import decontam, langid, licenses, quality, toxicity
from hazeframe.llm.queries import op1_decontamination, op5_toxicity, op6_licenses, op7_language, op9_quality

MIDDLE = "/root/testdata/sf0.01"


def texts(duck, where="true"):
    return duck.execute(f"SELECT doc_id, text, lang FROM documents WHERE {where}").fetchall()


def fold(doc_id, by):
    return zlib.crc32(str(doc_id).encode()) % by


# language

def plain_top(text, most):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    grams = Counter()
    line = "_" + "".join(w + "_" for w in words)
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            g = line[i:i + n]
            if g != "_" and not (n == 3 and g[1] == "_"):
                grams[g] += 1

    def number(g):
        out = 0
        for c in g:
            out = out << 21 | ord(c)
        return out

    return [number(g) for g, _ in sorted(grams.items(), key=lambda x: (-x[1], number(x[0])))[:most]] if words else []


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="abcé .1\n_日Σ", max_size=80), st.integers(1, 30))
def test_ranked_ngrams(text, most):
    assert langid.top_grams(text, most).tolist() == plain_top(text, most)


def test_out_of_place_distance():
    profiles = langid.Profiles({"a": [1, 2, 3], "b": [3, 9]}, 3)
    assert profiles.distances(np.array([1, 3, 7])).tolist() == [0 + 1 + 3, 3 + 1 + 3]


def test_languages_held_out(spark, duck):
    want = {d: lang for d, _, lang in duck.execute(f"SELECT doc_id, text, lang FROM '{MIDDLE}/documents.parquet'").fetchall()}
    rows = op7_language(spark, MIDDLE).collect()
    assert len(rows) == len(want) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) for r in rows)
    held = [r["lang_pred"] == want[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(held) > 0.95 * len(held)


def test_language_odd_rows(spark):
    rows = langid.predictions(odd_docs(spark)).collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda d: (d is not None, d)) == ALL_IDS
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 7)} == {"und"}
    assert langid.predictions(no_docs(spark)).count() == 0
    kept = langid.in_known_language(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and not {1, 2, 3, 7} & set(ids(kept))
    nothing = odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert set(ids(langid.in_known_language(nothing))) == {None, 4, 5, 6, 8, 9, 10, 11}


# quality

def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [s for s in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w, c in Counter(windows).items() if c > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", " ", "\n", "\t", "\x1c", "#", "|", "<x>", " "]), max_size=60).map("".join))
def test_base_statistics(text):
    assert quality.statistics(text)[:5] == plain_counts(text)


def test_forest_isolates_what_is_rare():
    rng = np.random.default_rng(2)
    rows = np.concatenate([rng.normal(0, 1, (2000, 3)), rng.normal(9, 0.1, (10, 3))])
    scores = quality.Forest(rows, 50, 256).score(rows)
    assert scores[2000:].min() > np.quantile(scores[:2000], 0.99)
    assert quality.Forest(rows[:0]).score(rows).tolist() == [0.0] * len(rows)
    assert quality.Forest.average_path(2) == 1 and quality.Forest.average_path(1) == 0


def test_path_lengths_follow_the_trees():
    rng = np.random.default_rng(4)
    rows = rng.random((300, 2))
    forest = quality.Forest(rows, 5, 64)
    want = []
    for row in rows[:20]:
        total = 0.0
        for feature, split, child, path in forest.trees:
            node = 0
            while child[node]:
                node = child[node] + int(row[feature[node]] > split[node])
            total += path[node]
        want.append(2 ** (-total / 5 / forest.average_path(64)))
    assert np.allclose(forest.score(rows[:20]), want)


def test_quality_query(spark, duck):
    labels = dict(duck.execute(f"SELECT doc_id, quality FROM '{MIDDLE}/labels.parquet'").fetchall())
    docs = dict(duck.execute(f"SELECT doc_id, text FROM '{MIDDLE}/documents.parquet'").fetchall())
    rows = op9_quality(spark, MIDDLE).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain_counts(docs[r["doc_id"]])
        assert tuple(r[c] for c in quality.COUNTS) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])
    judged = [(labels[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in labels and not r["base_failed"]]
    good, bad = [k for q, k in judged if q], [k for q, k in judged if not q]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_quality_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(5, 1), (None, 1), (4, None), (4, 0), (4, 1)], "doc_id long, quality int")
    rows = quality.verdicts(docs, labels).collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda d: (d is not None, d)) == ALL_IDS
    assert {r["doc_id"] for r in rows if not r["base_failed"]} == {5} or {r["doc_id"] for r in rows if r["base_failed"]}
    for some in (labels, labels.limit(0)):
        kept = quality.good_documents(docs, some)
        assert kept.columns == docs.columns
        assert ids(kept) == sorted(r["doc_id"] for r in quality.verdicts(docs, some).collect() if r["kept"])
    assert quality.verdicts(no_docs(spark), labels).count() == 0


# licences

def plain_licenses(text, named, least):
    """Every run of words against every template."""
    words = [(w, i) for i, s in enumerate((text or "").lower().split("\n")) for w in re.findall(r"\w+", s)]
    flat = [w for w, _ in words]
    best = {}
    for name, variants in named.items():
        for v in variants:
            own = re.findall(r"\w+", v.lower())
            t = Counter(zip(own, own[1:]))
            n = sum(t.values())
            if not n or sum((Counter(zip(flat, flat[1:])) & t).values()) < least * n / (2 - least) - 1e-9:
                continue
            for lo in range(len(flat)):
                for hi in range(lo + 2, min(len(flat), lo + int(2 * n / least) + 2) + 1):
                    run = Counter(zip(flat[lo:hi], flat[lo + 1:hi]))
                    value = 2 * sum((run & t).values()) / (hi - lo - 1 + n)
                    key = (value, -(hi - lo - 1), -lo)
                    if value >= least and (name not in best or key > best[name][0]):
                        best[name] = key, (words[lo][1], words[hi - 1][1] - words[lo][1] + 1)
    return [(name, *where, key[0]) for name, (key, where) in sorted(best.items())]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.sampled_from(["Released under", "the MIT License.", "All rights", "reserved.", "\n", "zzz", "Licensed", "under",
                                 "CC BY-NC 4.0.", "\n\n", "the Apache License, Version 2.0."]), max_size=14).map(" ".join),
       st.sampled_from([0.5, 0.8, 1.0]))
def test_anchored_runs_lose_no_licence(text, least):
    short = {n: [t for t in texts if len(t) < 200] for n, texts in licenses.TEMPLATES.items()}
    assert licenses.Templates(short, least).scan(text) == plain_licenses(text, short, least)


@pytest.mark.parametrize("text, name", [
    ("2020 Foo Inc. All rights reserved.", "all-rights-reserved"), ("Copyright 2020. All rights reserved.", "all-rights-reserved"),
    ("The tool, by the way, is Licensed under the MIT License. You will find more of it below.", "MIT")])
def test_notices_inside_a_line(text, name):
    assert licenses.Templates(licenses.TEMPLATES).scan("one\n" + text + " And so on\nlast") == [(name, 1, 1, 1.0)]


def test_whole_licences_are_found():
    whole = licenses.TEMPLATES["MIT"][3].split()
    changed = " ".join(w for i, w in enumerate(whole) if i % 17)
    for text in (" ".join(whole), changed, "\n".join(whole), "word " * 50 + changed + " word" * 500):
        (name, line, lines, value), = [x for x in licenses.Templates(licenses.TEMPLATES).scan(text)]
        assert name == "MIT" and value >= 0.85


def test_templates_from_a_folder(tmp_path):
    (tmp_path / "Own-1.0.txt").write_text("you may use this as you like but tell us")
    named = licenses.read_templates(str(tmp_path))
    assert licenses.Templates(named).scan("well: you may use this, as you like, but tell us!") == [("Own-1.0", 0, 1, 1.0)]


def test_long_licence_runs_are_found():
    words = licenses.TEMPLATES["MIT"][2].split()
    narrow = "\n".join(" ".join(words[i:i + 3]) for i in range(0, len(words), 3))
    for text, lines in ((narrow, -(-len(words) // 3)), (narrow.replace("\n", "\n\n"), 2 * -(-len(words) // 3) - 1)):
        assert licenses.Templates(licenses.TEMPLATES).scan(f"zzz\n\n{text}\nzzz") == [("MIT", 2, lines, 1.0)]
    # a whole licence of 120 lines as template
    whole = "\n".join(" ".join(f"w{i}x{j}" for j in range(9)) + "\n" * (i % 5 == 0) for i in range(120))
    got = licenses.Templates({"own": [whole]}).scan("before\n" + whole + "\nafter")
    assert got == [("own", 1, len(whole.rstrip().split("\n")), 1.0)]


def test_licence_query(spark, duck):
    want = [(d, *m) for d, t, _ in texts(duck) for m in plain_licenses(t, licenses.TEMPLATES, 0.8)]
    got = [tuple(r) for r in op6_licenses(spark, SMALL).collect()]
    assert sorted(got) == sorted(want) and want
    assert licenses.licenses(odd_docs(spark)).count() == 0 and licenses.licenses(no_docs(spark)).count() == 0
    assert licenses.licenses(odd_docs(spark), {}).count() == 0


# toxicity

@pytest.mark.parametrize("many", [0.0, 0.1, 2.0])
def test_block_max_search_is_exact(many):
    rng = random.Random(8)
    n_terms, rows = 30, []
    for _ in range(400):
        own = sorted(rng.sample(range(n_terms), rng.randint(0, 6)))
        rows.append((np.array(own, int), np.array([rng.randint(1, 4) for _ in own], int)))
    rows += rows[:90]  # equal vectors tie
    value = np.array([1 + rng.random() for _ in range(n_terms)])
    toxic = np.array([rng.randint(0, 1) for _ in rows])
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    index = toxicity.Index(ids, rows, toxic, value, neighbours=7, block=16, many=many)
    dense = np.zeros((len(rows), n_terms))
    for i, row in enumerate(rows):
        t, w = index.weigh(*row)
        dense[i, t] = w

    def plain(row, skip=None):
        t, w = index.weigh(*row)
        cosine = dense[:, t] @ w
        best = sorted((-round(c, 9), ids[i]) for i, c in enumerate(cosine) if c > 0 and i != skip)[:7]
        return [(i, pytest.approx(-c)) for c, i in best]

    got = index.nearest([index.weigh(*r) for r in rows], 7)
    assert [[(index.ids[i], c) for c, i in g] for g in got] == [plain(r) for r in rows]
    alone = index.nearest([index.weigh(*r) for r in rows], 7, [index.place.get(i, -1) for i in range(len(rows))])
    assert [[(index.ids[i], c) for c, i in g] for g in alone] == [plain(r, i) for i, r in enumerate(rows)]
    votes = [(v, toxic[i]) for i, v in enumerate(index.left_out(list(range(len(rows))), rows)) if len(rows[i][0])]
    xs, ys = toxicity.calibrated(np.array([v for v, _ in votes]), np.array([float(y) for _, y in votes]), index.prior)
    assert (np.diff(ys) >= 0).all() and 0 <= ys.min() <= ys.max() <= 1 and (xs[0], xs[-1]) == (0, 1)


def test_blocks_of_most_frequent_terms_keep_all_of_them():
    """Blocks that hold most rows of the matrix are multiplied whole, others by their own rows;
    neighbours are those of all cosines."""
    rng = np.random.default_rng(4)
    common, kinds = np.arange(40), [np.arange(40, 60), np.arange(60, 80)]
    for own in ([], kinds):  # one language, and two that share no term
        rows = []
        for i in range(320):
            terms = np.sort(rng.choice(own[i % 2] if len(own) else common, 12, replace=False))
            rows.append((terms, rng.integers(1, 4, len(terms))))
        index = toxicity.Index(list(range(320)), rows, np.arange(320) % 3 == 0, np.ones(80), neighbours=5, block=16)
        if own:
            assert any(held is not None and len(held) == len(part) == 20 for held, part in index.parts)
        else:
            assert all(held is None and len(part) == 40 for held, part in index.parts)
        dense = np.zeros((320, 80))
        for i, (t, w) in enumerate(index.weigh(*r) for r in rows):
            dense[i, t] = w
        got = index.nearest([index.weigh(*r) for r in rows], 5)
        for i, near in enumerate(got):
            want = sorted((-round(c, 9), k) for k, c in enumerate(dense @ dense[i]) if c > 0)[:5]
            assert [(int(index.ids[k]), pytest.approx(c)) for c, k in near] == [(k, -c) for c, k in want]


def test_reading_looks_at_stems_of_few_words(monkeypatch):
    import pyarrow as pa
    reader = toxicity.Reader(["plain", "stemm*", "stemm*2"])
    asked = []
    stems_of = toxicity.stems_of
    monkeypatch.setattr(toxicity, "stems_of", lambda w: asked.append(w) or stems_of(w))
    words = ["other" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(600)]
    got = reader.read(pa.array([" ".join([*words, "stemmed stemming stemless plain stem"])]))
    assert got[0][0].tolist() == [0, 1, 2] and got[0][1].tolist() == [1, 2, 1]
    assert sorted(asked) == ["stem", "stemless", "stemmed", "stemming"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["stem", "stemmed", "stemming", "stems", "stemless", "x", "É", "other others", ".", "no1two"]), max_size=12)
                .map(" ".join) | st.none(), max_size=4))
def test_numbered_terms_are_read_as_they_are_counted(some):
    terms = sorted(toxicity.terms_of("stem stemmed stemming stems stemless others"))[::2] + ["x", "stemmed"]
    import pyarrow as pa
    got = toxicity.Reader(terms).read(pa.array(some, pa.string()))
    assert len(got) == len(some)
    number = {w: i for i, w in enumerate(terms)}
    for i, text in enumerate(some):
        want = toxicity.terms_of(text)
        t, n, rest = got[i]
        assert list(zip(t.tolist(), n.tolist())) == sorted((number[w], k) for w, k in want.items() if w in number)
        assert rest == pytest.approx(sum((1 + np.log(k)) ** 2 for w, k in want.items() if w not in number and "*" not in w))


def test_words_are_runs_of_letters():
    assert dict(toxicity.terms_of("One one, ÉTÉ-2x under_score 日本 no.One")) == {
        "one": 3, "été": 1, "x": 1, "under": 1, "score": 1, "日本": 1, "no": 1, "unde*": 1, "scor*": 1}


def plain_toxicity(docs, labels, weak):
    """(neighbours, vote) of every document by cosines to all examples. docs: id -> text."""
    by_text = {}
    for d in sorted(labels):
        if d in docs and fold(d, 5):
            by_text.setdefault(docs[d] or "", []).append(d)
    examples = [(own[0], t, sum(labels[d] for d in own) / len(own)) for t, own in by_text.items()]
    seen = [Counter(), Counter()]
    for _, t, y in examples:
        seen[y >= 0.5].update(set(toxicity.terms_of(t)))
    of = [sum(y < 0.5 for *_, y in examples), sum(y >= 0.5 for *_, y in examples)]
    every = [w for w in seen[0] | seen[1]]
    kinds = sum(seen[0][w] + seen[1][w] >= 3 for w in every)

    def ratio(w):
        total, n = 0.0, seen[0][w] + seen[1][w]
        for side in (0, 1):
            for k, share in ((seen[side][w], n), (of[side] - seen[side][w], sum(of) - n)):
                if k:
                    total += 2 * k * np.log(k / (share * of[side] / sum(of)))
        return total

    tells = {w for w in every if seen[0][w] + seen[1][w] >= 3 and ratio(w) >= 2 * np.log(kinds / 0.05)}
    used = {w for w in every if w in tells or "*" not in w}
    bags = {d: toxicity.terms_of(t) for d, t in docs.items()}
    holds = Counter(w for b in bags.values() for w in b)
    place = {w: i for i, w in enumerate(sorted(used))}

    def vector(bag):
        out, rest = np.zeros(len(place)), 0.0
        for w, n in bag.items():
            if w in place:
                out[place[w]] = (1 + np.log(n)) * (np.log((len(docs) + 1) / (holds[w] + 1)) + 1) * (1 if w in tells else weak)
            elif "*" not in w:
                rest += ((1 + np.log(n)) * weak * (np.log((len(docs) + 1) / 2) + 1)) ** 2
        length = np.sqrt(out @ out + rest)
        return out / length if length else out

    matrix = np.stack([vector(bags[d]) for d, *_ in examples])
    share = np.mean([y for *_, y in examples])
    out = {}
    for d, bag in bags.items():
        cosine = np.round(matrix @ vector(bag), 9)
        best = sorted((-c, examples[i][0], examples[i][2]) for i, c in enumerate(cosine) if c > 0)[:toxicity.NEIGHBOURS]
        weights = [-c for c, *_ in best]
        vote = (sum(w * y for w, (*_, y) in zip(weights, best)) + 0.5 * share) / (sum(weights) + 0.5)
        out[d] = ([i for _, i, _ in best], vote if best else None)
    return out


def test_toxicity_query_against_all_cosines(spark, duck):
    docs = dict(duck.execute(f"SELECT doc_id, text FROM '{MIDDLE}/documents.parquet'").fetchall())
    labels = dict(duck.execute(f"SELECT doc_id, toxic FROM '{MIDDLE}/labels.parquet'").fetchall())
    want = plain_toxicity(docs, labels, toxicity.WEAK)
    rows = {r["doc_id"]: r for r in toxicity.scores(*[spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels")]).collect()}
    assert {d: r["neighbours"] for d, r in rows.items()} == {d: near for d, (near, _) in want.items()}
    assert sum(bool(near) for near, _ in want.values()) > 0.99 * len(docs)
    by_vote = sorted((vote, rows[d]["score"]) for d, (near, vote) in want.items() if near)
    assert all(b[1] >= a[1] - 1e-9 for a, b in zip(by_vote, by_vote[1:]))


def test_toxicity_held_out(spark, duck):
    labels = dict(duck.execute("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").fetchall())
    rows = op5_toxicity(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    hits = sum(p for y, p, _ in held if y)
    assert hits >= 0.9 * sum(y for y, _, _ in held)
    assert sum(p for y, p, _ in held if not y) <= 0.01 * len(held)


def test_all_telling_terms_of_both_sides_count(spark):
    words = ["".join(w) for w in itertools.product("abcdefghijk", repeat=3)]
    toxic, clean = words[:1100], words[1100:1200]
    train = [d for d in range(200) if fold(d, 5)][:80]
    # a word of its own makes each text an example of its own
    texts = [(d, " ".join([*(toxic if d % 2 else clean), "own" + chr(97 + d % 26) * (d // 26 + 1)]), d % 2) for d in train]
    examples = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    found = toxicity.example_terms(examples)
    assert {w for w, tells in found if tells} == {*toxic, *clean} and len(found) == 1200 + len(train)
    # one chance term among many of the other side does not stand for the whole text
    new = [d for d in range(200) if not fold(d, 5)][:2]
    more = spark.createDataFrame(list(zip(new, [" ".join([toxic[0], *clean]), " ".join([clean[0], *toxic])])), "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.scores(examples.select("doc_id", "text").union(more),
                                                               examples.select("doc_id", "toxic")).collect()}
    assert [got[d] for d in new] == [0, 1]


def test_copies_are_one_example(spark):
    rows = [(d, "same words here", 1) for d in range(50)] + [(60, "other words", 0), (61, "same words here", 0), (62, None, 0), (63, "", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    train = frame.select("doc_id", "toxic")
    got = {r["text"]: (r["doc_id"], r["toxic"]) for r in toxicity.distinct_examples(frame.select("doc_id", "text"), train).collect()}
    assert got == {"same words here": (0, pytest.approx(50 / 51)), "other words": (60, 0.0), "": (62, 0.5)}


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (4, 0), (6, None), (None, 1)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        rows = toxicity.scores(odd_docs(spark), some).collect()
        assert sorted((r["doc_id"] for r in rows), key=lambda d: (d is not None, d)) == ALL_IDS
        assert all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.scores(no_docs(spark), labels).count() == 0


# decontamination

def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12), st.integers(0, 6))
def test_banded_distance(a, b, most):
    want = plain_distance(a, b)
    assert decontam.edit_distance(a, b, most) == (want if want <= most else None)


def plain_leaks(text, items):
    words, out = decontam.words_of(text), {}
    for item, own in items:
        n, most, bag = len(own), int(0.2 * len(own)), set(own)
        hits = np.concatenate([[0], np.cumsum([w in bag for w in words])])
        for p in range(len(words)):
            # words that no edit touches are words of the item
            if hits[min(p + n, len(words))] - hits[p] < n - most:
                continue
            window = words[p:p + n]
            # words that no edit touches are common to both
            if len(window) >= n - most and sum((Counter(own) & Counter(window)).values()) >= n - most:
                d = plain_distance(own, window)
                if d <= most and (item not in out or d < out[item]):
                    out[item] = d
    return out


def test_search_reaches_the_target_recall():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, [rnd.choice(vocabulary) for _ in range(rnd.randint(6, 40))]) for i in range(40)]
    docs = []
    for k in range(120):
        words = [rnd.choice(vocabulary) for _ in range(60)]
        item, own = rnd.choice(items)
        changed = list(own)
        for _ in range(rnd.randint(0, int(0.2 * len(own)))):
            at = rnd.randrange(len(changed))
            changed[at:at + 1] = rnd.choice([[], ["new"], [changed[at], "more"]])
            changed = changed or ["x"]
        at = rnd.randint(0, 60)
        docs.append(" ".join(words[:at] + changed + words[at:]) if k % 4 else " ".join(words))
    block = decontam.Items(items)
    assert min(block.recall.values()) >= 0.99
    found = missed = 0
    for text, got in zip(docs, block.leaks(docs)):
        want = plain_leaks(text, items)
        have = {i: d for i, _, _, d in got}
        assert set(have) <= set(want) and all(have[i] >= want[i] for i in have)
        found += len(have)
        missed += len(set(want) - set(have))
    assert found > 60 and missed <= 0.02 * (found + missed)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=10), st.lists(st.integers(0, 3), max_size=14), st.integers(0, 5))
def test_closest_span(a, b, most):
    want = min((plain_distance(a, b[:j]), abs(j - len(a)), j) for j in range(len(b) + 1))
    assert decontam.closest_span(a, b, most) == ((want[0], want[2]) if want[0] <= most else None)


def test_passages_with_inserted_words_are_leaks(spark):
    """Against a brute force over all spans of n - k to n + k words."""
    rnd = random.Random(5)
    items = [(i, [f"w{i}x{j}" for j in range(15)]) for i in range(30)]
    docs, want = [], {}
    for d, (item, own) in enumerate(items):
        changed, cuts = list(own), rnd.sample(range(5, 10), 1 + d % 3)
        for at in sorted(cuts, reverse=True):
            changed.insert(at, f"new{at}")
        words = [rnd.choice("abcdef") for _ in range(9)]
        words = words[:4] + changed + words[4:]
        docs.append((d, " ".join(words)))
        spans = [(plain_distance(own, words[p:p + n]), p, n) for p in range(len(words)) for n in range(12, 19) if p + n <= len(words)]
        want[d, item] = min(spans)
    assert {w[0] for w in want.values()} == {1, 2, 3}
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["distance"], r["start"], r["span"]) for r in decontam.leaks(table, bench).collect()}
    assert got == want
    assert decontam.without_leaks(table, bench).count() == 0


def test_decontamination_query(spark, duck):
    items = [(i, decontam.words_of(t)) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()]
    want = {(d, i): n for d, t, _ in texts(duck) for i, n in plain_leaks(t, items).items()}
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in op1_decontamination(spark, SMALL).collect()}
    assert got == want and want


def test_decontamination_odd_rows(spark):
    items = [(1, SENTENCE.replace("quick", "slow")), (2, None), (None, SENTENCE), (3, ""), (4, "fox"), (5, LONG[200:600])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = odd_docs(spark)
    marked = decontam.with_leaks(docs, bench)
    assert set(marked.columns) == set(docs.columns)
    hits = {(r["doc_id"], x["item_id"]) for r in marked.collect() for x in r["leaks"] or []}
    assert hits == {(None, 1), (4, 1), (6, 1), (11, 1), (5, 5)}
    clean = decontam.without_leaks(docs.drop("leaks"), bench)
    assert clean.columns == docs.drop("leaks").columns and ids(clean) == [None, 1, 2, 3, 7, 8, 9, 10]
    assert decontam.leaks(docs, bench.limit(0)).count() == 0 and decontam.leaks(no_docs(spark), bench).count() == 0


def test_items_in_several_blocks(spark):
    bench = spark.createDataFrame([(i, f"{SENTENCE} number {i}") for i in range(6)], "item_id long, text string")
    whole = list(decontam.item_blocks(bench))
    parts = list(decontam.item_blocks(bench, block_words=30))
    assert len(whole) == 1 and len(parts) == 3
    joined = sorted(x for b in parts for x in b.leaks([SENTENCE + " number 3"])[0])
    assert [x[0] for x in joined] == [x[0] for x in whole[0].leaks([SENTENCE + " number 3"])[0]]


def edited(rng, words, edits):
    """``words`` after so many random edits."""
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at:at + 1] = rng.choice([["new"], [out[at], "more"]] + [[]] * (len(out) > 1))
    return out


@pytest.mark.parametrize("walks", [decontam.MAX_WALKS, 1])
def test_recall_of_every_item_size(monkeypatch, walks):
    """A few long items among many short ones; with one walk the exact way has to find them."""
    monkeypatch.setattr(decontam, "MAX_WALKS", walks)
    rng = random.Random(12)
    counts = {15: 60, 59: 20, 100: 8, 300: 4}
    items = [(1000 * n + k, [f"i{n}x{k}w{j}" for j in range(n)]) for n, many in counts.items() for k in range(many)]
    block = decontam.Items(items)
    assert walks > 1 or 0 in block.walks.values()
    for n in counts:
        own = [x for x in items if len(x[1]) == n]
        picks = [rng.choice(own) for _ in range({15: 300, 59: 100, 100: 100, 300: 8 if walks > 1 else 2}[n])]
        docs = [" ".join(["before"] * 7 + edited(rng, w, n // 5) + ["after"] * 9) for _, w in picks]
        found = sum(item in {x[0] for x in got} for (item, _), got in zip(picks, block.spans(docs)))
        # edits may cancel out, but never add up to more than the bound
        assert found >= 0.99 * len(picks), (n, found)


def test_short_items_are_found_word_for_word():
    block = decontam.Items([(1, ["two", "words"]), (2, ["a", "b", "c"]), (3, ["p", "q", "r", "s"]), (4, ["b", "c"])])
    got = block.spans(["x two words y", "two, Words", "two x words", "a b c", "A b C p q r s", "p q r", "b", None])
    assert [[x[0] for x in g] for g in got] == [[1], [1], [], [2, 4], [2, 3, 4], [], [], []]


def test_blocks_are_stored_one_by_one(spark):
    bench = spark.createDataFrame([(i, f"{SENTENCE} number {i}") for i in range(6)] + [(9, "fox jumps")], "item_id long, text string")
    docs = odd_docs(spark).withColumn("_row", F.lit("x"))
    one, many = decontam.with_leaks(docs, bench), decontam.with_leaks(docs, bench, block_words=30)
    assert one.columns == many.columns and sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    assert sorted(map(str, decontam.leaks(docs, bench).collect())) == sorted(map(str, decontam.leaks(docs, bench, block_words=30).collect()))
    assert decontam.with_leaks(no_docs(spark), bench, block_words=30).count() == 0


@pytest.mark.parametrize("text", [None, "", "fox"])
def test_texts_too_short_to_leak(text):
    assert decontam.Items([(1, SENTENCE.split())]).leaks([text]) == [[]]
