"""Repair of conversation structure by a run-length min-plus DP (operator 13).

A conversation is a sequence of symbols, one per row: the role's initial and
the row's fault.  A sound one reads ``(s?(ua)+)?``; four states of that
automaton are enough: nothing yet, after the system row, after a user row,
after an assistant row.  Each symbol is a 4 x 4 matrix of least costs (insert
rows, then keep, re-role or delete this one).  Equal consecutive symbols are
one run, and a run of any length is applied by binary powers of its matrix,
kept per worker.  From the costs to the end the choices are unrolled forwards,
at each point the first by letter among the cheapest, which gives the
ASCII-least audit; the roles of the repaired rows follow from the audit.

Each conversation is one stream of rows, sorted by Spark on disk: first its
symbols, which become runs, then its texts, which pass through the hash.  No
text is held, only the runs and the audit, which the result holds in one cell
anyway; the hash of one conversation is one sequence by its nature.  Whether a
row repeats an earlier one is settled before, by an aggregate over digests.

Defined cases: null roles and texts are one space, a null id or turn is one
space in the damage rule, and the null id is a conversation like any other; a
null turn comes first; rows of one turn stand in order of role, then of the
SHA-256 of the text; a repeated row of the table is a duplicate like any other;
a role of another initial must be re-roled or deleted; empty and very long texts
need nothing special; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import materialize

# White space of the contract, closing marks, costs, the damage modulus.
BLANKS = "\x20\x09\x0A\x0B\x0C\x0D"
CLOSING = "[.!?]"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
DAMAGE_MODULUS = 20

NO_COST = float("inf")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTING = (START, ASSISTANT)
# state -> state after a row of this initial
STEP = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
OK, CUT, GONE = "ok", "truncated", "gone"
Symbol = tuple[str, str]


def symbol_of(role: str, fault: str | None) -> Symbol:
    if fault in ("blank", "duplicate"):
        return "", GONE
    return role[:1] if role[:1] in STEP else "", CUT if fault == "truncated" else OK


# --- min-plus matrices ----------------------------------------------------------

Matrix = tuple[tuple[float, ...], ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def apply(a: Matrix, to_end: tuple[float, ...]) -> tuple[float, ...]:
    """Costs to the end before a stretch of rows, from those behind it."""
    return tuple(min(a[i][k] + to_end[k] for k in STATES) for i in STATES)


def _inserted(state: int) -> int:
    """The state after an inserted row: a user one, or after a user an assistant one."""
    return ASSISTANT if state == USER else USER


@lru_cache(maxsize=1)
def inserts() -> Matrix:
    """Any number of inserted rows."""
    unit = tuple(tuple(0 if i == j else NO_COST for j in STATES) for i in STATES)
    one = tuple(tuple(0 if i == j else INSERT if _inserted(i) == j else NO_COST for j in STATES) for i in STATES)
    out = unit
    for _ in STATES:
        out = times(out, one)
    return out


def edits(symbol: Symbol, state: int) -> Iterator[tuple[str, float, int]]:
    """(letter, cost, next state) of what can be done with a row, by letter."""
    initial, fault = symbol
    yield "D", DELETE, state
    if fault == GONE:
        return
    extra = TRUNCATED if fault == CUT else 0
    if initial and STEP[initial][state] is not None:
        yield "K", KEEP + extra, STEP[initial][state]
    yield "R", REROLE + extra, _inserted(state)


@lru_cache(maxsize=4096)
def power(symbol: Symbol, exponent: int) -> Matrix:
    """The matrix of ``2 ** exponent`` equal rows."""
    if exponent:
        half = power(symbol, exponent - 1)
        return times(half, half)
    rows = []
    for state in STATES:
        row = [NO_COST] * 4
        for _, cost, to in edits(symbol, state):
            row[to] = min(row[to], cost)
        rows.append(tuple(row))
    return times(inserts(), tuple(rows))


def before_run(symbol: Symbol, length: int, to_end: tuple[float, ...]) -> tuple[float, ...]:
    exponent = 0
    while length >> exponent:
        if length >> exponent & 1:
            to_end = apply(power(symbol, exponent), to_end)
        exponent += 1
    return to_end


def _unroll(state: int, runs: list[list], ends: list[tuple[float, ...]]) -> Iterator[str]:
    """The audit's letters.  ``ends[i]`` are the costs to the end behind run i."""
    def inserting(to_end: tuple[float, ...]) -> Iterator[str]:
        nonlocal state
        while to_end[state] == INSERT + to_end[_inserted(state)]:
            yield "I"
            state = _inserted(state)

    for (symbol, length), to_end in zip(runs, ends, strict=True):
        after = [to_end]
        for _ in range(length - 1):
            after.append(apply(power(symbol, 0), after[-1]))
        for rest in reversed(after):
            here = apply(power(symbol, 0), rest)
            while True:
                options = [(letter, to) for letter, cost, to in edits(symbol, state) if cost + rest[to] == here[state]]
                if options and options[0][0] == "D":
                    yield "D"
                elif here[state] == INSERT + here[_inserted(state)]:
                    yield "I"
                    state = _inserted(state)
                    continue
                else:
                    letter, state = options[0]
                    yield letter
                break
    yield from inserting(apply(inserts(), tuple(0 if s in ACCEPTING else NO_COST for s in STATES)))


def solve(runs: list[list]) -> tuple[int, str]:
    """Least cost and ASCII-least audit of runs ``[symbol, length]``."""
    to_end = apply(inserts(), tuple(0 if s in ACCEPTING else NO_COST for s in STATES))
    ends = []
    for symbol, length in reversed(runs):
        ends.append(to_end)
        to_end = before_run(symbol, length, to_end)
    return int(to_end[START]), "".join(_unroll(START, runs, ends[::-1]))


@lru_cache(maxsize=20_000)
def _solved(runs: tuple[tuple[Symbol, int], ...]) -> tuple[int, str]:
    return solve(list(runs))


# --- one conversation at a time ----------------------------------------------------

_RESULT = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                     ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
                     ("repaired_sha256", pa.string())])
_RESULT_DDL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
LEGAL = ("su", "ua", "au")


class _Conversation:
    """What is known of one conversation while its rows pass."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.last_initial = 0, None
        self.turns, self.low, self.high = 0, None, None
        self.runs: list[list] = []
        self.cost, self.audit = 0, None
        self.hash, self.lines, self.at, self.state = hashlib.sha256(), 0, 0, START

    def row(self, turn: int | None, role: str, fault: str | None) -> None:
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.last_initial is not None and self.last_initial + initial not in LEGAL:
            self.illegal += 1
        self.last_initial = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        symbol = symbol_of(role, fault)
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += 1
        else:
            self.runs.append([symbol, 1])

    def settle(self) -> None:
        if self.audit is None:
            if len(self.runs) <= 32 and all(n <= 32 for _, n in self.runs):
                self.cost, self.audit = _solved(tuple((s, n) for s, n in self.runs))
            else:
                self.cost, self.audit = solve(self.runs)

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _new_role(self) -> str:
        self.state = _inserted(self.state)
        return "assistant" if self.state == ASSISTANT else "user"

    def _insert(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._line(self._new_role(), "")
            self.at += 1

    def text(self, role: str, text: str) -> None:
        self.settle()
        self._insert()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = STEP[role[:1]][self.state]
            self._line(role, text)
        elif letter == "R":
            self._line(self._new_role(), text)

    def result(self) -> tuple:
        self.settle()
        self._insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.counts.values(), self.illegal, self.cost, self.audit, self.hash.hexdigest())


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, kind, turn, role, text, fault) by conversation and kind:
    0 the conversation, 1 a symbol, 2 a text."""
    conv: _Conversation | None = None
    for b in batches:
        done = []
        columns = [b.column(i).to_pylist() for i in (0, 1, 2, 3, 5)]
        for i, (conv_id, kind, turn, role, fault) in enumerate(zip(*columns, strict=True)):
            if conv is None or kind == 0 and conv.conv_id != conv_id:
                if conv is not None:
                    done.append(conv.result())
                conv = _Conversation(conv_id)
            if kind == 1:
                conv.row(turn, role, fault)
            elif kind == 2:
                conv.text(role, b.column(4)[i].as_py())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], f.type) for i, f in enumerate(_RESULT)], schema=_RESULT)
    if conv is not None:
        last = conv.result()
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(last, _RESULT, strict=True)], schema=_RESULT)


# --- the table ---------------------------------------------------------------------

def damaged(rows: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` after the damage rule."""
    flat = rows.select(F.col(key).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    h = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % DAMAGE_MODULUS
    hit = flat.withColumn("_h", h).where("_h <> 0").withColumn("_n", F.explode(F.when(F.col("_h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return hit.select(
        "conv_id", "turn", F.when(F.col("_h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.regexp_replace("text", CLOSING, "")).otherwise(F.col("text")).alias("text"))


def repair(rows: DataFrame, original: DataFrame, *, key: str = "conv_id") -> DataFrame:
    """One row per id of ``original``: counts of gaps and faults in ``rows``
    (``conv_id``, ``turn``, ``role``, ``text``), and the cheapest repair."""
    said = F.rtrim(F.col("text"), F.lit(BLANKS))
    # The id tells equal rows apart; which of them is which does not matter.
    marked = materialize(rows.select(
        "conv_id", "turn", "role", "text", F.sha2("text", 256).alias("digest"),
        F.when(said == "", "blank").when(~F.substring(said, -1, 1).rlike(CLOSING), "truncated").alias("fault"),
        F.monotonically_increasing_id().alias("row")), "conversation-rows")
    same = ["conv_id", "role", "digest"]
    first = marked.groupBy(*same).agg(F.min(F.struct("turn", "row")).alias("first")).select(
        F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), F.col("first.row").alias("_first"))
    narrow = marked.drop("text").join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d")))
    repeats = (F.col("row") != F.col("_first")) & ~F.col("fault").eqNullSafe("blank")
    symbols = narrow.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.lit(None).cast("string").alias("text"),
                            F.when(repeats, "duplicate").otherwise(F.col("fault")).alias("fault"), "digest", "row")
    texts = marked.select("conv_id", F.lit(2).alias("kind"), "turn", "role", "text", F.lit(None).cast("string").alias("fault"), "digest", "row")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("fault", "string"), ("digest", "string"), ("row", "long"))]
    convs = original.select(F.col(key).cast("long").alias("conv_id")).distinct().select("conv_id", F.lit(0).alias("kind"), *nothing)
    stream = (convs.unionByName(symbols).unionByName(texts).repartition("conv_id")
              .sortWithinPartitions("conv_id", "kind", "turn", "role", "digest", "row"))
    return stream.select("conv_id", "kind", "turn", "role", "text", "fault").mapInArrow(_repair, _RESULT_DDL)
