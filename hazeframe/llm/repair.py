"""Conversation repair by run-length dynamic programming (operator 12).

A row is a symbol: the initial of its role (s, u, a or other) and whether it ends in
mid-sentence, or that it has to go. What an edit of a row costs between the states of the
wanted pattern ``(s?(ua)+)?`` is a 4 x 4 matrix of the min-plus semiring. Equal symbols in
a row form a run, which is passed in one step per binary digit of its length, through
cached powers of the symbol's matrix. The costs to go choose the edits, front to back.

Conversations are ranges of a sorted table. One that crosses a range border is solved by
pieces: matrices of pieces are multiplied to costs to go at the borders, pieces map states
to states, and so each piece can be unrolled by a task of its own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby, islice

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.llm.common import in_tasks, stored
from hazeframe.session import ship

SPACE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: States: nothing yet, after a system row, after a user row, after an assistant row.
STATES = range(4)
NEXT = (2, 2, 3, 2)  # the state that the one fitting user or assistant row leads to
ROLE = ("user", "user", "assistant", "user")
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPT = (0, 10, 5, 0)  # costs to end: inserts that complete a pair
FAR = 1 << 60
GONE = "-"  # the symbol of a row that has to be deleted
LEGAL = {"su", "ua", "au"}

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def _apply(m: Matrix, v: Vector) -> Vector:
    return tuple(min(m[i][k] + v[k] for k in STATES) for i in STATES)


UNIT: Matrix = tuple(tuple(0 if i == j else FAR for j in STATES) for i in STATES)
_ONE_INSERT: Matrix = tuple(tuple(0 if i == j else INSERT if j == NEXT[i] else FAR for j in STATES) for i in STATES)
INSERTS = _times(_ONE_INSERT, _ONE_INSERT)  # three in a row would repeat a state


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """Costs of 2**k equal rows, with any inserts before each."""
    if k:
        half = power(symbol, k - 1)
        return _times(half, half)
    extra = TRUNCATED if symbol.endswith("!") else 0
    edits = [[FAR] * 4 for _ in STATES]
    for s in STATES:
        edits[s][s] = DELETE
        if symbol != GONE:
            edits[s][NEXT[s]] = min(edits[s][NEXT[s]], REROLE + extra)
            kept = KEEP.get((s, symbol[0]))
            if kept is not None:
                edits[s][kept] = min(edits[s][kept], extra)
    return _times(INSERTS, tuple(map(tuple, edits)))


def _over(symbol: str, n: int, v: Vector) -> Vector:
    """Costs to go before ``n`` equal rows, from those behind them."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            v = _apply(power(symbol, k), v)
    return v


def matrix(runs: Iterable[tuple[str, int]]) -> Matrix:
    """Costs of a whole piece between its states."""
    out = UNIT
    for symbol, n in runs:
        for k in range(n.bit_length()):
            if n >> k & 1:
                out = _times(out, power(symbol, k))
    return out


@lru_cache(maxsize=100_000)
def _step(symbol: str, behind: Vector) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    """(costs to go before a row less their minimum, (edits, next state) of each state)."""
    before = _apply(power(symbol, 0), behind)
    extra = TRUNCATED if symbol.endswith("!") else 0
    choices = []
    for start in STATES:
        s, edits = start, ""
        while True:
            kept = KEEP.get((s, symbol[0])) if symbol != GONE else None
            if DELETE + behind[s] == before[s]:  # in ASCII order: D, I, K, R
                edits += "D"
            elif INSERT + before[NEXT[s]] == before[s]:
                edits, s = edits + "I", NEXT[s]
                continue
            elif kept is not None and extra + behind[kept] == before[s]:
                edits, s = edits + "K", kept
            else:
                edits, s = edits + "R", NEXT[s]
            choices.append((edits, s))
            break
    low = min(before)
    return tuple(x - low for x in before), tuple(choices)


def costs_to_go(runs: list[tuple[str, int]], end: Vector) -> list[Vector]:
    """Costs to go before each run, and ``end`` behind the last."""
    out = [end]
    for symbol, n in reversed(runs):
        out.append(_over(symbol, n, out[-1]))
    return out[::-1]


def unroll(runs: list[tuple[str, int]], end: Vector, state: int) -> Iterator[tuple[str, int]]:
    """(edits, state before them) of each row; the least string among the cheapest."""
    to_go = costs_to_go(runs, end)
    for (symbol, n), behind in zip(runs, to_go[1:]):
        low = min(behind)
        tail = [tuple(x - low for x in behind)]  # costs to go behind the run's rows, from the last row on
        while len(tail) < n:
            before = _step(symbol, tail[-1])[0]
            if before == tail[-1]:
                break
            tail.append(before)
        for left in range(n - 1, -1, -1):
            edits, after = _step(symbol, tail[min(left, len(tail) - 1)])[1][state]
            yield edits, state
            state = after


def closing(state: int) -> int:
    """Inserts that end a conversation in ``state``."""
    return ACCEPT[state] // INSERT


class Rows:
    """Rows of one conversation, or of a piece of one, in order; equal rows of a turn are one item."""

    def __init__(self) -> None:
        self.items: list[tuple[str, str, int]] = []  # role, text, copies
        self.runs: list[list] = []
        self.seen: set[tuple[str, bytes]] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.first_turn, self.last_turn = 0, None, None
        self.first, self.last = None, None

    def _symbol(self, symbol: str, n: int) -> None:
        if n and self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += n
        elif n:
            self.runs.append([symbol, n])

    def add(self, turn: int | None, role: str, text: str, copies: int, seen: bool = False) -> None:
        """``seen``: an earlier piece holds the same role and text."""
        self.items.append((role, text, copies))
        core, initial = text.strip(SPACE), role[:1]
        if not core:
            self.blank += copies
            self._symbol(GONE, copies)
        else:
            mark = (role, hashlib.sha256(text.encode()).digest())
            again = seen or mark in self.seen
            self.seen.add(mark)
            self.duplicate += copies if again else copies - 1
            if again:
                self._symbol(GONE, copies)
            else:
                open_end = core[-1] not in ".!?"
                self.truncated += open_end
                self._symbol((initial if initial and initial in "sua" else "o") + ("!" if open_end else ""), 1)
                self._symbol(GONE, copies - 1)
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += copies - 1  # a role never follows itself
        self.last = initial
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def edited(self, end: Vector, state: int) -> Iterator[tuple[str, str | None, str | None]]:
        """(edit, role, text) of every edit, in order; role and text are None for a deletion."""
        steps = unroll([tuple(r) for r in self.runs], end, state)
        for role, text, copies in self.items:
            for edits, s in islice(steps, copies):
                for edit in edits:
                    if edit == "D":
                        yield "D", None, None
                    elif edit == "K":
                        yield "K", role, text
                    else:
                        yield edit, ROLE[s], text if edit == "R" else ""
                    s = NEXT[s]


def _closing_rows(state: int) -> list[tuple[str, str, str]]:
    out = []
    for _ in range(closing(state)):
        out.append(("I", ROLE[state], ""))
        state = NEXT[state]
    return out


def _end_state(rows: Rows, end: Vector, state: int) -> int:
    runs = [tuple(r) for r in rows.runs]
    if not runs:
        return state
    last = None
    for last in unroll(runs, end, state):
        pass
    edits, s = last
    for edit in edits:
        if edit == "K":
            return KEEP[s, runs[-1][0][0]]
        s = s if edit == "D" else NEXT[s]
    return s


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_PASS = f"kind int, chunk int, seq long, turn long, role string, text string, copies long, edit string, {RESULT}"
_NAMES = [f.split()[0] for f in _PASS.split(", ")]


def _whole(rows: Rows) -> tuple[dict, list]:
    runs = [tuple(r) for r in rows.runs]
    edits = list(rows.edited(ACCEPT, 0))
    edits += _closing_rows(_end_state(rows, ACCEPT, 0))
    lines = "\n".join(f"{role}:{text}" for edit, role, text in edits if edit != "D")
    gaps = rows.last_turn - rows.first_turn + 1 - rows.turns if rows.turns else 0
    return dict(gaps=gaps, blank=rows.blank, duplicate=rows.duplicate, truncated=rows.truncated, illegal=rows.illegal,
                cost=costs_to_go(runs, ACCEPT)[0][0], audit="".join(e for e, _, _ in edits),
                repaired_sha256=hashlib.sha256(lines.encode()).hexdigest()), edits


def _solve_range(with_rows: bool):
    """Solve the conversations inside a sorted range. Its first and its last one may go on
    in another range: their rows are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId()
        types = pa.schema([pa.field(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[f.split()[1]])
                           for n, f in zip(_NAMES, _PASS.split(", "))])
        out: list[dict] = []

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(out, schema=types)
            out.clear()
            return made

        def parts() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*[b.column(i).to_pylist() for i in range(5)])

        def on_edge(conv, rows) -> Iterator[None]:
            for seq, (_, turn, role, text, copies) in enumerate(rows):
                out.append(dict(kind=1, conv_id=conv, chunk=chunk, seq=seq, turn=turn, role=role, text=text, copies=copies))
                yield

        held, first = None, True  # the latest conversation: it may be the last of the range
        for conv, group in groupby(parts(), key=lambda r: r[0]):
            if held is not None:
                rows = Rows()
                for _, *row in held[1]:
                    rows.add(*row)
                result, edits = _whole(rows)
                out.append(dict(kind=0, conv_id=held[0], **result))
                if with_rows:
                    for k, (edit, role, text) in enumerate(edits):
                        out.append(dict(kind=2, conv_id=held[0], chunk=chunk, seq=k, edit=edit, role=role, text=text))
            if first:
                for _ in on_edge(conv, group):
                    if len(out) >= 5_000:
                        yield batch()
                first, held = False, None
            else:
                held = (conv, list(group))
            if len(out) >= 5_000:
                yield batch()
        if held is not None:
            for _ in on_edge(*held):
                if len(out) >= 5_000:
                    yield batch()
        if out:
            yield batch()

    return run


def _text(turn: int | None) -> str | None:
    """Turns go through pandas as text: a null would turn their column into floats."""
    return None if turn is None else str(turn)


def _piece(pdf: pd.DataFrame) -> Rows:
    rows = Rows()
    for r in pdf.sort_values("seq").itertuples(index=False):
        rows.add(None if r.turn is None else int(r.turn), r.role, r.text, int(r.copies), bool(r.seen))
    return rows


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = _piece(pdf)
    flat = [x for row in matrix(tuple(r) for r in rows.runs) for x in row]
    conv = pdf["conv_id"].iloc[0]
    return pd.DataFrame([dict(conv_id=conv, chunk=pdf["chunk"].iloc[0], costs=flat, blank=rows.blank, duplicate=rows.duplicate,
                              truncated=rows.truncated, illegal=rows.illegal, turns=rows.turns, first_turn=_text(rows.first_turn),
                              last_turn=_text(rows.last_turn), first=rows.first, last=rows.last)]).astype({"conv_id": "Int64"})


_SUMMED = ("conv_id long, chunk int, costs array<long>, blank long, duplicate long, truncated long, illegal long, turns long, "
           "first_turn string, last_turn string, first string, last string")
_JOINED = "conv_id long, chunk int, behind array<long>, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    """Costs to go behind every piece of a conversation, and its counts; a row per piece."""
    pieces = pdf.sort_values("chunk").to_dict("records")
    behind, v = [], ACCEPT
    for p in reversed(pieces):
        behind.append(v)
        flat = [int(x) for x in p["costs"]]
        v = _apply(tuple(tuple(flat[4 * i:4 * i + 4]) for i in STATES), v)
    illegal = sum(int(p["illegal"]) for p in pieces) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(pieces, pieces[1:]))
    dated = [p for p in pieces if p["turns"]]
    turns = sum(int(p["turns"]) for p in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
    gaps = int(dated[-1]["last_turn"]) - int(dated[0]["first_turn"]) + 1 - turns if dated else 0
    total = {c: sum(int(p[c]) for p in pieces) for c in ("blank", "duplicate", "truncated")}
    return pd.DataFrame([dict(conv_id=p["conv_id"], chunk=p["chunk"], behind=list(b), gaps=gaps, illegal=illegal, cost=v[0], **total)
                         for p, b in zip(pieces, behind[::-1])]).astype({"conv_id": "Int64"})


def _mapped(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state behind a piece, for each state before it."""
    rows, end = _piece(pdf), tuple(int(x) for x in pdf["behind"].iloc[0])
    return pd.DataFrame([dict(conv_id=pdf["conv_id"].iloc[0], chunk=pdf["chunk"].iloc[0],
                              ends=[_end_state(rows, end, s) for s in STATES])]).astype({"conv_id": "Int64"})


def _chained(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state before every piece, and whether it is the last one."""
    state, out = 0, []
    pieces = pdf.sort_values("chunk").to_dict("records")
    for k, p in enumerate(pieces):
        out.append(dict(conv_id=p["conv_id"], chunk=p["chunk"], state=state, final=k == len(pieces) - 1))
        state = int(p["ends"][state])
    return pd.DataFrame(out).astype({"conv_id": "Int64"})


_EDITS = "conv_id long, chunk int, seq long, edit string, role string, text string"


def _unrolled(pdf: pd.DataFrame) -> pd.DataFrame:
    rows, end, state = _piece(pdf), tuple(int(x) for x in pdf["behind"].iloc[0]), int(pdf["state"].iloc[0])
    edits = list(rows.edited(end, state))
    if pdf["final"].iloc[0]:
        edits += _closing_rows(_end_state(rows, end, state))
    out = pd.DataFrame(edits, columns=["edit", "role", "text"])
    out.insert(0, "seq", range(len(out)))
    out.insert(0, "chunk", pdf["chunk"].iloc[0])
    out.insert(0, "conv_id", pd.array([pdf["conv_id"].iloc[0]] * len(out), dtype="Int64"))
    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, one after another: rows come sorted, and no
    more than a batch is held."""
    now, digest, empty = (), None, True
    for b in batches:
        done = []
        for conv, role, text in zip(*[b.column(i).to_pylist() for i in range(3)]):
            if now != (conv,):
                if now:
                    done.append((now[0], digest.hexdigest()))
                now, digest, empty = (conv,), hashlib.sha256(), True
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())],
                                         names=["conv_id", "repaired_sha256"])
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([digest.hexdigest()], pa.string())],
                                         names=["conv_id", "repaired_sha256"])


def _matched(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join that keeps one copy of the key columns."""
    renamed = right.select(*[F.col(c).alias(f"_k_{c}") if c in cols else F.col(c) for c in right.columns])
    match = F.lit(True)
    for c in cols:
        match = match & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return left.join(renamed, match, how).drop(*[f"_k_{c}" for c in cols])


def _across(edge: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results, edits) of conversations that may lie in several ranges, piece by piece."""
    marked = edge.withColumn("mark", F.sha2(F.concat("role", F.lit("\n"), "text"), 256))
    earliest = Window.partitionBy("conv_id", "mark")
    # a row per conversation, text and piece; so no group is larger than the number of pieces
    marks = marked.select("conv_id", "mark", "chunk").distinct().select(
        "conv_id", "mark", "chunk", (F.min("chunk").over(earliest) < F.col("chunk")).alias("seen"))
    pieces = stored(_matched(marked, marks, ["conv_id", "mark", "chunk"]).drop("mark").withColumn("turn", F.col("turn").cast("string")),
                    "pieces")
    summed = stored(pieces.groupBy("conv_id", "chunk").applyInPandas(_summed, _SUMMED), "piece-costs")
    joined = stored(summed.groupBy("conv_id").applyInPandas(_joined, _JOINED), "piece-ends")
    key = ["conv_id", "chunk"]
    ended = _matched(pieces, joined.select(*key, "behind"), key)
    mapped = stored(ended.groupBy(*key).applyInPandas(_mapped, "conv_id long, chunk int, ends array<int>"), "piece-states")
    chained = stored(mapped.groupBy("conv_id").applyInPandas(_chained, "conv_id long, chunk int, state int, final boolean"), "piece-starts")
    edits = stored(_matched(ended, chained, key).groupBy(*key).applyInPandas(_unrolled, _EDITS), "piece-edits")
    audits = edits.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("seq", "edit"))).alias("e")).select(
        *key, F.concat_ws("", "e.edit").alias("e"))
    audits = audits.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "e"))).alias("e")).select(
        "conv_id", F.concat_ws("", "e.e").alias("audit"))
    lines = edits.where("edit <> 'D'").repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "seq")
    hashes = in_tasks(lines.select("conv_id", "role", "text"), _hashed, "conv_id long, repaired_sha256 string")
    counts = joined.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])
    out = _matched(_matched(counts, audits, ["conv_id"]), hashes, ["conv_id"], "left")
    return out.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(EMPTY))), edits


EMPTY = hashlib.sha256(b"").hexdigest()


def damage(rows: DataFrame) -> DataFrame:
    """Damage rows by the hash of ``conv_id:turn``; nulls in it, in role and in text are one
    space. A row that is repeated comes with copies = 2."""
    blank = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"), (F.crc32(named.cast("binary")) % 20).alias("_h"))
    return rows.where("_h <> 0").select(
        "conv_id", "turn", F.when(F.col("_h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_h") == 3, 2).otherwise(1).cast("long").alias("copies"))


def repair(rows: DataFrame, range_rows: int = 20_000, with_rows: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(results, edits): one row per conversation, and if asked for, one row per edit
    (conv_id, chunk, seq in order; edit, role, text) with the repaired rows.

    ``rows`` has conv_id, turn, role, text and, if it likes, copies (how often the row
    stands there). Null roles and texts are one space; a null conv_id is a conversation.
    Rows go by turn, null turns first, then by role and the MD5 of the text, so rows that
    repeat are adjacent. Other columns are ignored; an empty table gives no rows.

    ``range_rows`` bounds the rows a task holds. The hash of a conversation is one chain by
    its definition: its lines stream through one task, which holds a batch of them.
    """
    ship(rows.sparkSession)
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    items = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), copies.cast("long").alias("n"))
    items = items.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("copies"))
    items = stored(items.withColumn("_md5", F.md5("text")), "turns")
    total = items.count()
    order = ["conv_id", "turn", "role", "_md5"]
    ranges = items.repartitionByRange(max(1, math.ceil(total / range_rows)), *order).sortWithinPartitions(*order)
    done = stored(in_tasks(ranges.select("conv_id", "turn", "role", "text", "copies"), _solve_range(with_rows), _PASS), "repaired")
    names = [f.split()[0] for f in RESULT.split(", ")]
    results, edits = _across(done.where("kind = 1").select("conv_id", "chunk", "seq", "turn", "role", "text", "copies"))
    out = done.where("kind = 0").select(*names).unionByName(results.select(*names))
    if not with_rows:
        return out, None
    key = [f.split()[0] for f in _EDITS.split(", ")]
    return out, done.where("kind = 2").select(*key).unionByName(edits)


def all_conversations(rows: DataFrame, results: DataFrame) -> DataFrame:
    """Results with a row for each conversation of ``rows``; one without rows left has zeros."""
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = _matched(every, results, ["conv_id"], "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                         F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"))
