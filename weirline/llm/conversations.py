"""Repair of the turns of conversations by least edits, with a Viterbi search that is parallel within a conversation.

Rows are sorted by conversation and turn over all tasks and cut into blocks. What a block's rows cost is a vector, one
number for each state of the grammar `(s?(ua)+)?`; the search runs backward over it. A conversation that
lies in one block is searched there. Where one runs over several, every block but its last starts from a speculative
vector. In fix-up passes a block whose successor has found another vector than it started from runs again, until the two runs
differ only by a constant, from where on nothing changes. Blocks over which that never happens (where all
rows go, the way in stays the way out) are settled by their costs from each state to each, folded along the conversation. From
the stitched backward costs the edits are traced forward, the least edit first where several are cheapest.

A conversation's blocks are small rows of bytes in all of this. Only its edits and the digest of its repaired text, which by
definition run from its begin to its end, pass through one task, and they do so as a stream.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, saved

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5  # what edits cost, and a truncated row that stays
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # states: what the repaired conversation ends in
#: The state after an inserted or reroled row, and the state after one that is kept, by the row's class.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: A row's byte: its role's initial (s, u, a, other), and bits for what it is.
CLASS, TRUNCATED, BLANK, GONE, DUPLICATE = 3, 4, 8, 16, 32
FORCED, ABSENT = 8, 9  # symbols beside class + TRUNCATED
NEVER = 1 << 40
END = (0, 2 * INSERT, INSERT, 0)
BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 20
#: Fix-up passes; blocks that still change then are settled by folding.
PASSES = 3
SPACE = " \t\n\x0b\x0c\r"
TIE_CHARS = 64


class Action:
    """What becomes of a row that is met in some state, with the insertions before it."""

    __slots__ = ("edits", "inserted", "role", "keeps", "state", "cost")

    def __init__(self, state: int):
        self.edits, self.inserted, self.role, self.keeps, self.state, self.cost = "", [], None, False, state, 0

    def insert(self):
        self.state = NEXT[self.state]
        self.edits += "I"
        self.inserted.append(f"{ROLE[self.state]}:")
        self.cost += INSERT
        return self


class Vector:
    """Costs to the end from each state, less their least; ``step`` gives what a row before makes of them."""

    known: dict[tuple, Vector] = {}

    def __init__(self, costs: tuple):
        self.costs, self.steps = costs, [None] * 10

    @classmethod
    def of(cls, costs) -> Vector:
        """The vector of these costs; vectors that differ only by a constant are one. There are few."""
        low = min(costs)
        costs = tuple(min(c - low, NEVER) if c < NEVER // 2 else NEVER for c in costs)
        if costs not in cls.known:
            cls.known[costs] = cls(costs)
        return cls.known[costs]

    def step(self, symbol: int) -> tuple:
        """(vector, what its least cost has grown by, the action from each state)."""
        out = self.steps[symbol]
        if out is None:
            out = self.steps[symbol] = self._step(symbol)
        return out

    def _step(self, symbol: int) -> tuple:
        if symbol == ABSENT:
            return self, 0, [Action(q) for q in range(4)]
        ways = []
        for q in range(4):
            mine = {"D": (DELETE + self.costs[q], q)}
            if symbol != FORCED:
                stays = CUT_OFF if symbol & TRUNCATED else 0
                to = KEPT[q].get(symbol & CLASS)
                if to is not None:
                    mine["K"] = KEEP + stays + self.costs[to], to
                mine["R"] = REROLE + stays + self.costs[NEXT[q]], NEXT[q]
            ways.append(mine)
        costs = [min(c for c, _ in w.values()) for w in ways]
        for _ in range(2):
            costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
        actions = []
        for q in range(4):
            act = Action(q)
            while True:
                at, best = act.state, costs[act.state]
                if ways[at]["D"][0] == best:
                    how = "D"
                elif INSERT + costs[NEXT[at]] == best:
                    act.insert()
                    continue
                else:
                    how = "K" if ways[at].get("K", (NEVER * 2,))[0] == best else "R"
                break
            to = ways[at][how][1]
            act.edits, act.state, act.keeps = act.edits + how, to, how == "K"
            act.role = ROLE[to] if how == "R" else None
            act.cost += {"D": DELETE, "K": KEEP, "R": REROLE}[how] + (CUT_OFF if how != "D" and symbol & TRUNCATED and symbol < FORCED else 0)
            actions.append(act)
        return Vector.of(costs), min(costs), actions


def at_end(state: int) -> Action:
    act = Action(state)
    while END[act.state]:
        act.insert()
    return act


def symbols(rows: bytes) -> bytes:
    """The rows' symbols from their bytes."""
    return rows.translate(SYMBOLS)


SYMBOLS = bytes(ABSENT if b & GONE else FORCED if b & (BLANK | DUPLICATE) else b & (CLASS | TRUNCATED) for b in range(256))


def backward(symbols: bytes, start: Vector, other: Vector | None = None) -> tuple[Vector, list] | None:
    """(the vector before the rows, each row's step from the last on), or None as soon as a run from ``other`` is the same."""
    steps, v = [], start
    for s in reversed(symbols):
        step = v.step(s)
        steps.append(step)
        v = step[0]
        if other is not None:
            other = other.step(s)[0]
            if other is v:
                return None
    return v, steps


def exits(symbols: bytes, start: Vector) -> list[int]:
    """The state after the rows for each state before them."""
    _, steps = backward(symbols, start)
    out = []
    for q in range(4):
        for step in reversed(steps):
            q = step[2][q].state
        out.append(q)
    return out


def transfer(symbols: bytes) -> list[int]:
    """Costs from each state before the rows to each after them, state by state."""
    columns = []
    for to in range(4):
        v, total = Vector.of([0 if q == to else NEVER for q in range(4)]), 0
        for s in reversed(symbols):
            v, more, _ = v.step(s)
            total += more
        columns.append([c + total if c < NEVER else NEVER for c in v.costs])
    return [columns[to][q] for q in range(4) for to in range(4)]


class Part:
    """What a conversation's rows in one block say, and their repair: edits, and lines of the repaired text."""

    def __init__(self, rows: bytes, turns: list, roles: list, texts: list, state: int, start: Vector, last: bool):
        here = [k for k, b in enumerate(rows) if not b & GONE]
        known = [turns[k] for k in here if turns[k] is not None]
        self.low, self.high, self.turns = (known[0], known[-1], len(set(known))) if known else (None, None, 0)
        kinds = [rows[k] for k in here]
        self.blank = sum(b & BLANK > 0 for b in kinds)
        self.duplicate = sum(b & (BLANK | DUPLICATE) == DUPLICATE for b in kinds)
        self.truncated = sum(b & (BLANK | DUPLICATE | TRUNCATED) == TRUNCATED for b in kinds)
        self.first, self.last = (kinds[0] & CLASS, kinds[-1] & CLASS) if kinds else (None, None)
        self.illegal = sum((a & CLASS, b & CLASS) not in LEGAL for a, b in zip(kinds, kinds[1:]))
        self.cost, self.lines, edits = 0, [], []
        _, steps = backward(symbols(rows), start)
        for k, step in enumerate(reversed(steps)):
            act = step[2][state]
            state = act.state
            self.cost += act.cost
            edits.append(act.edits)
            self.lines += act.inserted
            if act.keeps or act.role:
                self.lines.append(f"{act.role or roles[k]}:{texts[k]}")
        if last:
            act = at_end(state)
            self.cost += act.cost
            edits.append(act.edits)
            self.lines += act.inserted
        self.edits = "".join(edits)


def damage(conversations: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows damaged by the CRC-32 of `conv_id:turn`, of twenty cases the first five.

    0 drops the row (it stays, marked ``gone``), 1 empties its text, 2 takes `.`, `!` and `?` from it, 3 repeats the row and 4
    makes its role user. Nulls count as one space, in the key too; a null turn stays null as a turn.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(space(conv_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    text = F.when(case == 1, F.lit("")).when(case == 2, F.translate(space(text_col), ".!?", "")).otherwise(space(text_col))
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(case == 4, F.lit("user")).otherwise(space(role_col)).alias("role"),
        text.alias("text"),
        (case == 0).alias("gone"),
        F.when(case == 3, F.expr("array(1, 2)")).otherwise(F.expr("array(1)")).alias("copy"),
    )
    return rows.withColumn("copy", F.explode("copy")).drop("copy")


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """A row for each block: its conversations (``conv``, with ``size`` rows each), the rows' turns, roles, texts and bytes, and
    digests of the rows of the first and the last conversation by which other blocks tell repeats."""
    ends = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    kind = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for x in ("s", 0, "u", 1, "a", 2))), F.left("role", F.lit(1))), F.lit(3))
    state = F.when(F.col("gone"), GONE).when(ends == "", BLANK).when(~ends.isin(".", "!", "?"), TRUNCATED).otherwise(0)
    order = ["conv_id", "turn", "role", "tie", "hash", "source"]
    keyed = rows.withColumns(
        {
            "kind": (kind + state).cast("byte"),
            "text": F.when(F.col("gone"), F.lit("")).otherwise(F.col("text")),
            "tie": F.left("text", F.lit(TIE_CHARS)),
            "hash": F.xxhash64("text", "gone"),
            "source": F.spark_partition_id(),  # so that a row that is repeated very often is not one range
        }
    )
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "kind")

    def run(batches):
        number, n, size = TaskContext.get().partitionId() << 32, 0, 0
        conv, sizes, turns, roles, texts, kinds = [], [], [], [], [], bytearray()
        seen: dict = {}
        edge: list = []

        def row():
            last = [(conv[-1], k, key) for key, k in seen.items()]
            digests = [(c, k, hashlib.blake2b(f"{len(r)}:{r}{t}".encode("utf-8", "surrogatepass"), digest_size=16).digest()) for c, k, (r, t) in (edge + last)]
            c, k, d = zip(*digests) if digests else ((), (), ())
            columns = [[number + n], [conv], [sizes], [turns], [roles], [texts], [bytes(kinds)], [list(c)], [list(k)], [list(d)]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, BLOCK_TYPES)], names=BLOCK_NAMES)

        for b in batches:
            for c, turn, role, text, kind in zip(*(b.column(k).to_pylist() for k in range(5))):
                if not sizes or c != conv[-1]:
                    if len(conv) == 1:  # the block's first conversation ends
                        edge = [(conv[0], k, key) for key, k in seen.items()]
                    conv.append(c)
                    sizes.append(0)
                    seen = {}
                if not kind & (GONE | BLANK) and seen.setdefault((role, text), len(kinds)) != len(kinds):
                    kind |= DUPLICATE
                sizes[-1] += 1
                turns.append(turn)
                roles.append(role)
                texts.append(text)
                kinds.append(kind)
                size += len(text) + len(role)
                if len(kinds) >= block_rows or size >= BLOCK_BYTES:
                    yield row()
                    n, size, seen, edge = n + 1, 0, {}, []
                    conv, sizes, turns, roles, texts, kinds = [], [], [], [], [], bytearray()
        if kinds:
            yield row()

    return ordered.mapInArrow(run, ", ".join(f"{a} {b}" for a, b in zip(BLOCK_NAMES, BLOCK_SQL)))


BLOCK_NAMES = ["block", "conv", "size", "turns", "roles", "texts", "kinds", "edge_conv", "edge_row", "edge_digest"]
BLOCK_SQL = [
    "long", "array<long>", "array<int>", "array<long>", "array<string>", "array<string>", "binary", "array<long>", "array<int>", "array<binary>",
]
BLOCK_TYPES = [
    pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary(),
    pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.binary()),
]


def _repeats(blocks: DataFrame) -> DataFrame:
    """(block, repeats): rows that repeat one of an earlier block. A block gives each text of its conversation once, so that
    no group of equal texts has more rows than its conversation has blocks."""
    edges = blocks.select("block", F.explode(F.arrays_zip("edge_conv", "edge_row", "edge_digest")).alias("e")).select("block", "e.*")
    first = F.min("block").over(W.partitionBy("edge_conv", "edge_digest"))
    later = edges.withColumn("first", first).filter("block > first")
    return later.groupBy("block").agg(F.collect_list("edge_row").alias("repeats"))


def _marked(kinds: bytes, repeats) -> bytes:
    if not repeats:
        return kinds
    out = bytearray(kinds)
    for k in repeats:
        out[k] |= DUPLICATE
    return bytes(out)


def _chains(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, seg, symbols, last): the pieces of conversations that lie in several blocks; ``seg`` numbers a
    block's conversations."""

    def run(batches):
        for b in batches:
            for r in b.select(["block", "conv", "size", "kinds", "repeats"]).to_pylist():
                each, size = symbols(_marked(r["kinds"], r["repeats"])), r["size"]
                rows = [(r["conv"][0], r["block"], 0, each[: size[0]])]
                if len(size) > 1:
                    rows.append((r["conv"][-1], r["block"], len(size) - 1, each[-size[-1] :]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                    names=["conv_id", "block", "seg", "symbols"],
                )

    ends = blocks.mapInArrow(run, "conv_id long, block long, seg int, symbols binary")
    whole = W.partitionBy("conv_id")
    counted = ends.withColumns({"n": F.count("*").over(whole), "final": F.max("block").over(whole)})
    return counted.filter("n > 1").select("conv_id", "block", "seg", "symbols", (F.col("block") == F.col("final")).alias("last"))


def _map_rows(df: DataFrame, of, schema: str, kinds: list) -> DataFrame:
    """``of`` applied to each small row."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for b in batches:
            rows = [of(r) for r in b.to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return df.mapInArrow(run, schema)


CHAIN = "conv_id long, block long, seg int, symbols binary, last boolean"
CHAIN_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]
COSTS = pa.list_(pa.int64())
_own = lambda r: (r["conv_id"], r["block"], r["seg"], r["symbols"], r["last"])


def _settled(chains: DataFrame, passes: int) -> DataFrame:
    """The chains with ``start``, the true vector after each piece."""
    schema, kinds = f"{CHAIN}, start array<long>, head array<long>", [*CHAIN_KINDS, COSTS, COSTS]

    def speculate(r):
        start = Vector.of(END if r["last"] else (0, 0, 0, 0))
        return *_own(r), start.costs, backward(r["symbols"], start)[0].costs

    def fix(r):
        start, head = r["start"], r["head"]
        if r["found"] is not None and r["found"] != start:
            again = backward(r["symbols"], Vector.of(r["found"]), Vector.of(start))
            start = r["found"]
            head = again[0].costs if again else head
        return *_own(r), start, head

    along = W.partitionBy("conv_id").orderBy("block")
    state = saved(_map_rows(chains, speculate, schema, kinds), "speculated")
    for _ in range(passes):
        found = state.withColumn("found", F.lead("head").over(along))
        if found.filter("found is not null and found != start").isEmpty():
            return state.drop("head")
        state = saved(_map_rows(found, fix, schema, kinds), "fixed")
    found = state.withColumn("found", F.lead("head").over(along))
    if found.filter("found is not null and found != start").isEmpty():
        return state.drop("head")
    return _folded(state)


def _folded(state: DataFrame) -> DataFrame:
    """The same where passes alone would go on block by block: each piece's costs from state to state, folded from the end."""
    small = "conv_id long, block long, transfer array<long>"
    moves = _map_rows(state, lambda r: (r["conv_id"], r["block"], transfer(r["symbols"])), small, [pa.int64(), pa.int64(), COSTS])

    def fold(key, pieces):  # a row of 16 numbers for each block of one conversation
        import pandas as pd

        v, out = Vector.of(END).costs, []
        pieces = pieces.sort_values("block", ascending=False)
        for block, t in zip(pieces["block"], pieces["transfer"]):
            out.append((pieces["conv_id"].iloc[0], block, list(v)))
            v = Vector.of([min(int(t[4 * q + to]) + v[to] for to in range(4)) for q in range(4)]).costs
        return pd.DataFrame(out, columns=["conv_id", "block", "start"])

    starts = moves.groupBy("conv_id").applyInPandas(fold, "conv_id long, block long, start array<long>")
    start = starts.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "start")
    own = state.drop("start", "head")
    return own.join(start, own["conv_id"].eqNullSafe(F.col("_conv")) & (own["block"] == F.col("_block"))).drop("_conv", "_block")


def _entries(chains: DataFrame) -> DataFrame:
    """(block, entries): for each piece of a long conversation its number in the block, the state it is met in, the vector after
    it and whether it is the last."""
    small = "conv_id long, block long, seg int, last boolean, start array<long>, exits array<int>"
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), COSTS, pa.list_(pa.int32())]
    of = lambda r: (r["conv_id"], r["block"], r["seg"], r["last"], r["start"], exits(r["symbols"], Vector.of(r["start"])))

    def follow(key, pieces):  # a small row for each block of one conversation
        pieces = pieces.sort_values("block")
        states = [NOTHING]
        for e in pieces["exits"]:
            states.append(int(e[states[-1]]))
        return pieces.assign(enter=states[:-1])[["block", "seg", "enter", "start", "last"]]

    met = _map_rows(chains, of, small, kinds).groupBy("conv_id")
    found = met.applyInPandas(follow, "block long, seg int, enter int, start array<long>, last boolean")
    return found.groupBy("block").agg(F.collect_list(F.struct("seg", "enter", "start", "last")).alias("entries"))


PART = (
    "conv_id long, block long, whole boolean, final boolean, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "first int, last int, cost long, audit string, lines long, repaired string"
)
PART_TYPES = [
    pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.int64()] * 7, pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(),
]
PART_NAMES = [c.split()[0] for c in PART.split(", ")]


def _parts(blocks: DataFrame) -> DataFrame:
    """A row for each conversation of each block: PART."""

    def run(batches):
        for b in batches:
            for at in range(len(b)):
                r = b.slice(at, 1).to_pylist()[0]
                kinds, begin, rows = _marked(r["kinds"], r["repeats"]), 0, []
                entries = {e["seg"]: e for e in r["entries"] or ()}
                for seg, (conv, size) in enumerate(zip(r["conv"], r["size"])):
                    end = begin + size
                    e = entries.get(seg)
                    state, start, last = (e["enter"], e["start"], e["last"]) if e else (NOTHING, END, True)
                    p = Part(kinds[begin:end], r["turns"][begin:end], r["roles"][begin:end], r["texts"][begin:end], state, Vector.of(start), last)
                    rows.append(
                        (conv, r["block"], e is None, last, p.low, p.high, p.turns, p.blank, p.duplicate, p.truncated, p.illegal, p.first, p.last,
                         p.cost, p.edits, len(p.lines), "\n".join(p.lines))
                    )
                    begin = end
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PART_TYPES)], names=PART_NAMES)

    return blocks.select("block", "conv", "size", "turns", "roles", "texts", "kinds", "repeats", "entries").mapInArrow(run, PART)


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _joined(parts: DataFrame) -> DataFrame:
    """The results of conversations in several parts, which stream through a task in order."""
    kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
    names = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches):
        sums, before, low, turns, audit, lines, sha = [0] * 5, None, None, 0, [], 0, hashlib.sha256()
        high = last = None
        for b in batches:
            for at in range(len(b)):
                r = b.slice(at, 1).to_pylist()[0]
                for k, c in enumerate(("blank", "duplicate", "truncated", "illegal", "cost")):
                    sums[k] += r[c]
                if r["first"] is not None:
                    sums[3] += last is not None and (last, r["first"]) not in LEGAL
                    last = r["last"]
                if r["low"] is not None:
                    low = r["low"] if low is None else low
                    turns += r["turns"] - (high == r["low"])
                    high = r["high"]
                audit.append(r["audit"])
                if r["lines"]:
                    sha.update((b"\n" if lines else b"") + r["repaired"].encode("utf-8", "surrogatepass"))
                    lines += r["lines"]
                if r["final"]:
                    gaps = 0 if low is None else high - low + 1 - turns
                    row = [r["conv_id"], gaps, *sums, "".join(audit), sha.hexdigest()]
                    yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, kinds)], names=names)
                    sums, low, high, turns, audit, lines, sha, last = [0] * 5, None, None, 0, [], 0, hashlib.sha256(), None

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run, RESULT)


def _repaired_parts(rows: DataFrame, passes: int, block_rows: int) -> DataFrame:
    blocks = saved(_blocks(rows, block_rows), "blocks")
    repeats = saved(_repeats(blocks.select("block", "edge_conv", "edge_row", "edge_digest")), "repeats")
    sized = lambda df, per_row: F.broadcast(df) if per_row * df.count() <= BROADCAST_BYTES else df
    # a repeat is a row of its block, so a block's have at most 4 * block_rows bytes
    own = blocks.drop("edge_conv", "edge_row", "edge_digest").join(sized(repeats, 4 * block_rows), "block", "left")
    chains = saved(_chains(own.select("block", "conv", "size", "kinds", "repeats")), "chains")
    if chains.isEmpty():
        return _parts(own.withColumn("entries", F.expr("cast(null as array<struct<seg: int, enter: int, start: array<long>, last: boolean>>)")))
    entries = saved(_entries(_settled(chains, passes)), "entries")
    return _parts(own.join(sized(entries, 256), "block", "left"))


def repair(rows: DataFrame, passes: int = PASSES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each conversation's faults and cheapest repair, from (conv_id, turn, role, text, gone) as damage() gives them.

    Rows are taken by turn, nulls first; those of one turn by role, then by their first 64 characters, then by a hash of the text.
    A row's first fault counts: blank, a repeat of an earlier row's role and text, or truncated (its last character other
    than white space is none of `.!?`). ``audit`` are the cheapest edits' initials (Keep, Rerole, Delete, Insert), the least in ASCII
    of several. A null id is a conversation of its own. One all of whose rows are gone has zeros, no edits and the
    empty text's hash. An empty table gives no rows. Other columns are not read.
    """
    made = saved(_repaired_parts(rows.select("conv_id", "turn", "role", "text", "gone"), passes, block_rows), "parts")
    whole = made.filter("whole").select(
        "conv_id",
        F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long")).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2("repaired", 256).alias("repaired_sha256"),
    )
    return whole.unionByName(_joined(made.filter("not whole")))


def repaired(rows: DataFrame, passes: int = PASSES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv_id, block, audit, repaired): the repaired conversations' `role:text` lines themselves, block by block in order."""
    return _repaired_parts(rows.select("conv_id", "turn", "role", "text", "gone"), passes, block_rows).filter("lines > 0").select("conv_id", "block", "audit", "repaired")
