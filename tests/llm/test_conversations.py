"""Repair of conversations against all ways to edit them, in one block and in many."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from weirline.llm import conversations as cv

SPACE = " \t\n\x0b\x0c\r"
ROWS = "conv_id long, turn long, role string, text string, gone boolean"


def faults(rows):
    """The first fault of each (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, inserts=2):
    """(cost, edits, lines) by trying all edits; ``inserts`` before each row and at the end, at most."""
    kinds, best = faults(rows), [(10**9, "", [])]

    def go(k, cost, edits, initials, lines, gap):
        if cost > best[0][0]:
            return
        if k == len(rows):
            if re.fullmatch("(s?(ua)+)?", initials) and (cost, edits) < best[0][:2]:
                best[0] = cost, edits, lines
        else:
            _, role, text = rows[k]
            go(k + 1, cost + 2, edits + "D", initials, lines, 0)
            if kinds[k] not in ("blank", "duplicate"):
                more = 5 if kinds[k] else 0
                for r, c, e in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                    if re.fullmatch("(s?(ua)*u?)?", initials + r[:1]) and r:
                        go(k + 1, cost + c + more, edits + e, initials + r[:1], [*lines, f"{r}:{text}"], 0)
        if gap < inserts:
            for r in ("user", "assistant"):
                if re.fullmatch("(s?(ua)*u?)?", initials + r[0]):
                    go(k, cost + 5, edits + "I", initials + r[0], [*lines, f"{r}:"], gap + 1)

    go(0, 0, "", "", [], 0)
    return best[0]


def expected(conv, rows):
    """``rows`` in order, without those that are gone."""
    kinds, turns = faults(rows), [t for t, *_ in rows if t is not None]
    cost, edits, lines = cheapest(rows) if rows else (0, "", [])
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def order(row):
    turn, role, text = row
    return turn is not None, turn or 0, role.encode(), text.encode()


def some(seed, n, roles=("user", "assistant", "system", "tool", "")):
    rng = random.Random(seed)
    texts = ["ok.", "cut", "", " \t", "why?", "fin!  ", "ok."]
    return sorted(((rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts) + rng.choice(["", "", str(k) + "."])) for k in range(n)), key=order)


@pytest.fixture(scope="module")
def cases():
    out = {k: some(k, k % 6) for k in range(60)}
    out[None] = some(99, 4)
    return out


@pytest.mark.parametrize("block_rows,passes", [(4096, 3), (3, 3), (2, 0), (1, 1)])
def test_cheapest_edits(spark, cases, block_rows, passes):
    table = [(c, *r, False) for c, rows in cases.items() for r in rows] + [(c, 1, "user", "gone.", True) for c in cases]
    random.Random(1).shuffle(table)
    df = spark.createDataFrame(table, ROWS).withColumns({"block": F.lit(1), "kind": F.lit("x"), "tie": F.lit(0)})
    got = {tuple(r) for r in cv.repair(df, passes=passes, block_rows=block_rows).collect()}
    assert got == {expected(c, rows) for c, rows in cases.items()}


def one_pass(rows):
    """Costs and edits of a long conversation by a plain backward search."""
    kinds = faults(rows)
    follow = [lambda r: {"s": 1, "u": 2}.get(r), lambda r: {"u": 2}.get(r), lambda r: {"a": 3}.get(r), lambda r: {"u": 2}.get(r)]
    ahead, tables = [0, 10, 5, 0], []
    for (_, role, _), kind in zip(rows[::-1], kinds[::-1]):
        ways = []
        for q in range(4):
            mine = [(2 + ahead[q], "D", q)]
            if kind not in ("blank", "duplicate"):
                stay, to, nxt = 5 if kind else 0, follow[q](role[:1]), 3 if q == 2 else 2
                mine += [(stay + ahead[to], "K", to)] if to else []
                mine.append((1 + stay + ahead[nxt], "R", nxt))
            ways.append(mine)
        now = [min(w)[0] for w in ways]
        now = [min(now[0], 5 + now[2], 10 + now[3]), min(now[1], 5 + now[2], 10 + now[3]), min(now[2], 5 + now[3]), min(now[3], 5 + now[2])]
        tables.append((now, ways))
        ahead = now
    q, edits = 0, ""
    for now, ways in tables[::-1]:
        while True:
            options = [(e, to, False) for c, e, to in ways[q] if c == now[q]]
            nxt = 3 if q == 2 else 2
            options += [("I", nxt, True)] if 5 + now[nxt] == now[q] else []
            e, q, again = min(options)
            edits += e
            if not again:
                break
    return tables[-1][0][0], edits + {0: "", 1: "II", 2: "I", 3: ""}[q]


@pytest.mark.parametrize("kind,passes", [("mixed", 3), ("mixed", 0), ("cut", 1), ("same", 3)])
def test_a_conversation_of_many_blocks(spark, kind, passes):
    rng = random.Random(5)
    texts = {"mixed": lambda k: f"{k}" + rng.choice([".", "!", ""]), "cut": lambda k: f"{k}" + ("." if k > 2900 else ""), "same": lambda k: "same."}[kind]
    rows = [(k, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]), texts(k)) for k in range(3000)]
    small = [(c, 0, "user", "hello.", False) for c in range(1000)]
    df = spark.createDataFrame([(500, *r, False) for r in rows] + [(c, t, r, x, g) for c, t, r, x, g in small if c != 500], ROWS).repartition(5)
    got = {r.conv_id: r for r in cv.repair(df, passes=passes, block_rows=50).collect()}
    assert len(got) == 1000
    r = got[500]
    kinds = faults(rows)
    assert (r.cost, r.audit) == one_pass(rows)
    assert (r.blank, r.duplicate, r.truncated, r.gaps) == (0, kinds.count("duplicate"), kinds.count("truncated"), 0)
    lines = [x for p in sorted(cv.repaired(df, passes=passes, block_rows=50).filter("conv_id = 500").collect(), key=lambda p: p.block) for x in [p.repaired]]
    assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == r.repaired_sha256
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in "\n".join(lines).split("\n") if x))


def test_one_row_repeated_very_often(spark):
    df = spark.range(20000).select(F.lit(7).alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), F.lit("hi.").alias("text"), F.lit(False).alias("gone"))
    r = cv.repair(df, block_rows=500).first()
    assert (r.duplicate, r.cost, r.gaps, len(r.audit)) == (19999, 2 * 19999 + 2, 0, 20000) and set(r.audit) == {"D"}


def test_damage_and_nulls(spark):
    rows = [(c, t, "assistant", "one. two! three?") for c in range(20) for t in range(10)] + [(None, None, None, None), (3, None, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("copy", F.lit(5))
    got = sorted(map(repr, map(tuple, cv.damage(df).collect())))
    want = []
    for c, t, role, text in rows:
        case = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        want += [(c, t, "user" if case == 4 else role, text, case == 0)] * (2 if case == 3 else 1)
    assert got == sorted(map(repr, want))
    found = {r.conv_id: r for r in cv.repair(cv.damage(df)).collect()}
    assert set(found) == {None, *range(20)} and cv.repair(cv.damage(df.limit(0))).count() == 0


def test_two_runs_meet_and_steps_are_shared():
    rng = random.Random(2)
    s = bytes(rng.choice([0, 1, 2, 1, 2, 3, 5, 8, 9]) for _ in range(400))
    for start in itertools.product((0, 3), (0, 10), (0, 5), (0, 4)):
        a, b = cv.Vector.of(start), cv.Vector.of((0, 0, 0, 0))
        head, _ = cv.backward(s, a)
        assert cv.backward(s, a, b) is None and head is cv.backward(s, b)[0]
        moves = cv.transfer(s)
        assert cv.Vector.of([min(moves[4 * q + t] + a.costs[t] for t in range(4)) for q in range(4)]) is head
    assert len(cv.Vector.known) < 3000
