"""Conversation repair: brute force over edits, pieces against whole conversations, SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from conftest import SMALL, rows_of, rows_of_sql

from hazeframe.llm import repair
from hazeframe.llm.oracles import repair_sql
from hazeframe.llm.queries import op12_repair

SCHEMA = "conv_id long, turn long, role string, text string"
NAME = {"u": "user", "a": "assistant"}


def plain(rows):
    """(counts, cost, audit, hash) of one conversation's rows (turn, role, text) in order,
    by trying every edit; the wanted pattern is checked as a pattern."""
    blank = duplicate = truncated = 0
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.strip(" \t\n\v\f\r")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        blank, duplicate, truncated = blank + (fault == "blank"), duplicate + (fault == "duplicate"), truncated + (fault == "truncated")
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0

    def possible(initials):  # a start of the pattern
        return bool(re.fullmatch(r"s?(ua)*u?", initials))

    @lru_cache(None)
    def best(i, tail, inserted):
        """Cheapest (cost, audit, lines) from row i on; tail: the last two initials so far."""
        out = []
        if i == len(rows):
            if re.fullmatch(r"(.*ua)?", tail):
                out.append((0, "", ()))
        else:
            _, role, text = rows[i]
            c, a, lines = best(i + 1, tail, 0)
            out.append((c + 2, "D" + a, lines))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                for edit, cost, new in [("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")]:
                    grown = tail + new[:1]
                    if new and possible(grown):
                        c, a, lines = best(i + 1, grown[-2:] if grown[-2:] != "au" else "u", 0)
                        out.append((c + cost + extra, edit + a, (f"{new}:{text}", *lines)))
        if inserted < 3:
            for new in "ua":
                grown = tail + new
                if possible(grown):
                    c, a, lines = best(i, grown[-2:] if grown[-2:] != "au" else "u", inserted + 1)
                    out.append((c + 5, "I" + a, (f"{NAME[new]}:", *lines)))
        return min(out, key=lambda x: x[:2]) if out else (10**9, "", ())

    cost, audit, lines = best(0, "", 0)
    return (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def by_conversation(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        out[conv].append((turn, role, text))
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    return out


def found(results):
    return {r["conv_id"]: tuple(r)[1:] for r in results.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def random_rows(seed, convs, length):
    rng = random.Random(seed)
    out = []
    for c in range(convs):
        for t in range(rng.randrange(1, length)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "unknown", "", None])
            text = rng.choice(["Hi.", "Yes!", "So, no", f"Line {t}.", f"Line {t}?", f"open {t}", "", " \n", None, "ends ! \n"])
            out.append((c, rng.choice([t, t, t + 3, None]), role, text))
    return out


def test_query_and_sql(spark, duck):
    assert rows_of(op12_repair(spark, SMALL)) == rows_of_sql(duck, repair_sql())


@pytest.mark.parametrize("range_rows", [100_000, 9])
def test_same_as_trying_all_edits(spark, range_rows):
    rows = random_rows(5, 80, 9)
    got = found(repair.repair(spark.createDataFrame(rows, SCHEMA), range_rows)[0])
    assert got == {c: plain(own) for c, own in by_conversation(rows).items()}


def test_pieces_of_a_long_conversation(spark):
    rows = random_rows(6, 3, 700) + [(9, t, "user", f"again {t % 50}.") for t in range(900)] + [(10, 0, "system", "s.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole, edits = repair.repair(frame, 10_000, with_rows=True)
    cut, cut_edits = repair.repair(frame, 40, with_rows=True)
    assert found(whole) == found(cut) and len(found(cut)) == 5
    for result, made in ((whole, edits), (cut, cut_edits)):
        lines = defaultdict(list)
        for e in sorted(made.collect(), key=lambda e: (e["conv_id"], e["chunk"], e["seq"])):
            lines[e["conv_id"]].append(e)
        for conv, (*_, audit, digest) in found(result).items():
            assert "".join(e["edit"] for e in lines[conv]) == audit
            kept = [e for e in lines[conv] if e["edit"] != "D"]
            assert re.fullmatch("(s?(ua)+)?", "".join(e["role"][0] for e in kept))
            assert hashlib.sha256("\n".join(f"{e['role']}:{e['text']}" for e in kept).encode()).hexdigest() == digest


def test_powers_equal_steps():
    for symbol in ("s", "u", "a", "o", "s!", "u!", "a!", "o!", repair.GONE):
        v = repair.ACCEPT
        for n in range(1, 40):
            v = repair._apply(repair.power(symbol, 0), v)
            assert repair.costs_to_go([(symbol, n)], repair.ACCEPT)[0] == v
    runs = [("s", 1), ("u", 37), ("a!", 5), (repair.GONE, 1000), ("u", 2)]
    assert repair._apply(repair.matrix(runs), repair.ACCEPT) == repair.costs_to_go(runs, repair.ACCEPT)[0]


def test_copies_of_a_row(spark):
    rows = [(1, 0, "user", "Hi.")] * 3000 + [(1, 0, "assistant", "")] * 500 + [(1, 1, "assistant", "So.")]
    got = found(repair.repair(spark.createDataFrame(rows, SCHEMA))[0])
    assert got[1][:6] == (0, 500, 2999, 0, 499 + 2999, 2 * 3499)
    assert got[1][6] == "D" * 500 + "K" + "D" * 2999 + "K"


def test_damage(spark):
    rows = [(c, t, r, x) for c in range(40) for t, r, x in ((0, "system", "a.b!"), (1, None, None), (None, "assistant", "q?"))] + [(None, 3, "user", "x")]
    got = sorted(map(tuple, repair.damage(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = []
    for c, t, r, x in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", " " if x is None else x
        if h:
            want.append((c, t, "user" if h == 4 else r, "" if h == 1 else re.sub("[.!?]", "", x) if h == 2 else x, 2 if h == 3 else 1))
    assert got == sorted(want, key=str)


def test_conversations_without_rows_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, 0, "user", "Hi."), (None, None, None, None), (2, 5, "u", "x " * 50_000)], SCHEMA)
    done, _ = repair.repair(frame.where("conv_id = 1").selectExpr("*", "'x' as kind", "1 as chunk", "2 as seq"))
    got = found(repair.all_conversations(frame, done))
    assert got[None] == (0, 0, 0, 0, 0, 0, "", repair.EMPTY) == got[2] and got[1][6] == "D"
    assert found(repair.repair(frame)[0])[None] == plain([(None, " ", " ")])
    none = frame.limit(0)
    assert repair.all_conversations(none, repair.repair(none)[0]).count() == 0
