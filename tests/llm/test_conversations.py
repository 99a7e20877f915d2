"""The run-length DP against a shortest path over single rows, whole tables against a plain loop."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

from cardsentry.llm import conversations as cv

_SHAPE = re.compile("(s?(ua)+)?")


def _cheapest(symbols):
    """Least (cost, audit), one row at a time, with no use of the operator's tables."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, last = heapq.heappop(heap)
        if at == len(symbols) and last in ("", "a"):
            return cost, audit
        if (at, last) in seen:
            continue
        seen.add((at, last))
        new = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", at, new))
        if at < len(symbols):
            initial, fault = symbols[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + more, audit + "R", at + 1, new))
                if initial == new or initial == "s" and last == "":
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, initial))
    return None


def _plain(rows):
    """conv_id -> result, from (conv_id, turn, role, text) rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            h = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            kept += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in kept:
            said = text.strip(" \t\n\v\f\r")
            faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None)
            seen.add((role, text))
        cost, audit = _cheapest([(r[1][:1], f) for r, f in zip(kept, faults, strict=True)])
        lines, last, at = [], "", 0
        for letter in audit:
            role, text = ("", "") if letter == "I" else kept[at][1:]
            at += letter != "I"
            if letter != "D":
                role = role if letter == "K" else "assistant" if last == "u" else "user"
                lines.append(f"{role}:{'' if letter == 'I' else text}")
                last = role[:1]
        assert _SHAPE.fullmatch("".join(x[:1] for x in lines))
        turns = {r[0] for r in kept} - {None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(kept)),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def _got(df):
    rows = cv.repair(cv.damaged(df), df).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_runs_as_single_rows():
    rng = random.Random(2)
    kinds = [(i, f) for i in ("s", "u", "a", "") for f in (None, "truncated")] + [("u", "blank")]
    for _ in range(1500):
        rows = [x for x in rng.choices(kinds, k=rng.randint(0, 7)) for _ in range(rng.randint(1, 4))]
        symbols = [cv.symbol_of(i, f) for i, f in rows]
        runs = [[s, len(list(g))] for s, g in itertools.groupby(symbols)]
        assert cv.solve(runs) == _cheapest(rows)


def test_runs_of_any_length():
    user, answer = ("u", cv.OK), ("a", cv.CUT)
    assert cv.solve([[user, 200_001]]) == (200_002, "KIK" + "RK" * 99_999 + "R")
    cost, audit = cv.solve([[user, 3], [answer, 50_000], [("", cv.GONE), 70_000]])
    assert cost == _cheapest([("u", None)] * 3 + [("a", "truncated")] * 50 + [("", "blank")] * 70)[0] + (50_000 - 50) * 2 + (70_000 - 70) * 3
    assert len(audit.replace("I", "")) == 120_003
    power = cv.before_run(user, 1000, (0.0, 1.0, 2.0, 3.0))
    single = (0.0, 1.0, 2.0, 3.0)
    for _ in range(1000):
        single = cv.apply(cv.power(user, 0), single)
    assert power == single


def test_random_tables_with_nulls_ties_and_clashes(spark):
    rng = random.Random(9)
    says = ["Yes.", "No!", "well", "", "  \t\n", "Why? ", None, " ", "a.b", "Ende. \x0b", "日本。"]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(8)]), rng.choice(["system", "user", "assistant", "tool", "", None, "User"]), rng.choice(says))
            for _ in range(500)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clashing = df.selectExpr("*", "1 as kind", "'x' as digest", "'x' as fault", "2 as row", "'y' as _c", "'z' as first", "3 as h")
    assert _got(clashing.repartition(5)) == _plain(rows)


def test_one_conversation_with_most_rows_and_long_texts(spark):
    rows = [(7, i, "user" if i % 3 else "assistant", "x" * 200_000 if i < 3 else "same." if i % 5 else f"turn {i}.") for i in range(4000)]
    rows += [(i, 0, "user", "Hello?") for i in range(100, 140)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert _got(df.repartition(6)) == _plain(rows)


def test_no_rows_and_nothing_left(spark):
    ddl = "conv_id long, turn long, role string, text string"
    assert _got(spark.createDataFrame([], ddl)) == {}
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert _got(spark.createDataFrame([(lost, 0, "user", "Hi.")], ddl)) == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
