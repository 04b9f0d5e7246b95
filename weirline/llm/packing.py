"""Best-fit packing of token pieces into fixed-length sequences by a configuration linear program.

A configuration says how many pieces of each length share a sequence. The program covers the histogram of lengths
with as few configurations as it can: lengths have prices that fall by a factor as they are covered (multiplicative
weights), and a knapsack over the capacity finds the configurations dearest at these prices. What it says is rounded
down; the lengths that rest go, longest first, to the tightest room left, in the configurations too. The program knows
lengths alone, at most ``capacity`` of them, so its size is that of no corpus.

Pieces never meet in one place: a piece is the n-th of its length, counted by task and then over tasks, and the
program's answer says where the n-th piece of a length goes.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, saved
from .token_files import _gathered, tokenizer

#: Rounds of pricing, and the share of a length's pieces that a configuration covers in one.
ROUNDS, STEP = 300, 0.1
#: How fast a covered length's price falls, and how near to the dearest a configuration must come.
FALL, NEAR = 0.5, 0.995
#: Bytes of a row of counts in a broadcast.
COUNT_BYTES = 48


class Run(NamedTuple):
    """``times`` sequences alike: ``items`` are (length, how many) and ``free`` is their room."""

    times: int
    free: int
    items: tuple


def _knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The dearest contents of every capacity, and the index of a length in it (-1: none but those of one less)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fits[c]:
            value = prices[: fits[c]] + best[c - lengths[: fits[c]]]
            k = int(value.argmax())
            if value[k] > best[c]:
                best[c], last[c] = value[k], k
    return best, last


def _contents(last: np.ndarray, lengths: np.ndarray, c: int, first: int) -> dict[int, int]:
    """The configuration that holds length ``first`` and the dearest that still fits."""
    out = defaultdict(int, {first: 1})
    c -= int(lengths[first])
    while c > 0:
        k = int(last[c])
        if k < 0:
            c -= 1
        else:
            out[k] += 1
            c -= int(lengths[k])
    return dict(out)


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[dict[tuple, float], float]:
    """(how often each configuration is used, a lower bound on the number of sequences).

    A configuration is a tuple of (index of a length, how many). Each round prices once and takes, among the configurations
    that come near the dearest, those that share no length, so that no price is stale. The uses of the first rounds, in
    which prices find their level, are forgotten; the others are scaled to cover everything once in the mean. The
    bound is the dual one: all pieces' prices over the dearest configuration's, the best of all rounds.
    """
    used: dict[tuple, float] = defaultdict(float)
    covered, bound, before = np.zeros(len(lengths)), 0.0, 0.0
    for r in range(ROUNDS):
        if r == ROUNDS // 3:
            used.clear()
            before = float(covered @ (counts * lengths))
        prices = lengths * np.exp(-FALL * (covered - covered.mean()))
        best, last = _knapsack(prices, lengths, capacity)
        bound = max(bound, float(counts @ prices) / best[capacity])
        value = prices + best[capacity - lengths]
        touched = np.zeros(len(lengths), bool)
        for k in np.argsort(-value, kind="stable").tolist():
            if value[k] < NEAR * best[capacity]:
                break
            if touched[k]:
                continue
            held = _contents(last, lengths, capacity, k)
            if touched[list(held)].any():
                continue
            step = STEP * min(counts[i] / n for i, n in held.items())
            used[tuple(sorted(held.items()))] += step
            for i, n in held.items():
                covered[i] += step * n / counts[i]
                touched[i] = True
    times = (float(covered @ (counts * lengths)) - before) / float(counts @ lengths)
    return {held: x / times for held, x in used.items()}, bound


def best_fit(counts: dict[int, int], capacity: int, room: list[Run] = ()) -> list[Run]:
    """Best fit decreasing, runs of like sequences at a time: each piece goes to the tightest room, ``room``'s or a new sequence's."""
    by_free: dict[int, list[Run]] = defaultdict(list)
    frees: list[int] = []

    def put(run: Run):
        if run.times:
            if not by_free[run.free]:
                bisect.insort(frees, run.free)
            by_free[run.free].append(run)

    for run in room:
        put(run)
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(frees, length)
            if at == len(frees):
                each = capacity // length
                put(Run(-(-n // each), capacity, ()))
                continue
            free = frees[at]
            run = by_free[free].pop()
            if not by_free[free]:
                frees.pop(at)
            each = free // length
            full = min(run.times, n // each)
            if full:
                put(Run(full, free - each * length, (*run.items, (length, each))))
                n -= full * each
            rest = run.times - full
            if rest and n:  # fewer than ``each`` are left
                put(Run(1, free - n * length, (*run.items, (length, n))))
                rest, n = rest - 1, 0
            put(Run(rest, free, run.items))
    return [r for f in frees for r in by_free[f]]


def solve(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """(runs of sequences that hold all pieces, a lower bound on their number).

    Lengths of ``capacity`` are sequences of their own. Where rounding leaves more sequences than best fit decreasing alone
    takes, that is the answer.
    """
    counts = {k: n for k, n in counts.items() if n}
    whole = counts.pop(capacity, 0)
    alone = [Run(whole, 0, ((capacity, 1),))] if whole else []
    if not counts:
        return alone, whole
    lengths = np.array(sorted(counts))
    n = np.array([counts[k] for k in lengths.tolist()], np.float64)
    used, bound = fractional(lengths, n, capacity)
    rest, runs = dict(counts), []
    for held, times in sorted(used.items(), key=lambda u: (-u[1], u[0])):
        items = tuple((int(lengths[i]), k) for i, k in held)
        times = min(int(times), *(rest[length] // k for length, k in items))
        if times:
            for length, k in items:
                rest[length] -= times * k
            runs.append(Run(times, capacity - sum(length * k for length, k in items), items))
    rounded = best_fit({k: c for k, c in rest.items() if c}, capacity, runs)
    plain = best_fit(counts, capacity)
    out = min(rounded, plain, key=lambda r: sum(x.times for x in r))
    size = -(-sum(k * c for k, c in counts.items()) // capacity)
    return alone + out, whole + max(size, int(np.ceil(bound - 1e-6)))


class Places:
    """Where the n-th piece of a length goes."""

    def __init__(self, runs: list[Run]):
        rows, first, sequence = [], defaultdict(int), 0
        for run in runs:
            offset = 0
            for length, k in run.items:
                rows.append((length, first[length], run.times, sequence, offset))
                first[length] += run.times * k
                offset += length * k
            sequence += run.times
        self.length, self.first, self.times, self.sequence, self.offset = np.array(sorted(rows), np.int64).reshape(-1, 5).T.copy()
        self.sequences = sequence
        self.key = (self.length << 48) + self.first

    def of(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each; ``nth`` counts from 0 and is below 2**48."""
        at = np.searchsorted(self.key, (length << 48) + nth, "right") - 1
        copy, which = np.divmod(nth - self.first[at], self.times[at])
        return self.sequence[at] + which, self.offset[at] + copy * length


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col="doc_id", text_col="text", keep_ids=False) -> DataFrame:
    """The pieces of every document: its ids and ``end_id``, cut only where there are more than ``capacity``.

    ``part`` is the task that made a piece and ``nth`` its number among that task's pieces of its length; the table must
    be written before it is used twice. With ``keep_ids`` a column ``ids`` follows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def run(batches):
        known, part, seen = tokenizer(tokenizer_path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for table in _gathered(batches):
            raw = known.encode(table.column(1).to_pylist(), end_id)
            n_ids = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
            n = -(-n_ids // capacity)
            own = np.repeat(np.arange(len(raw)), n)
            piece = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, n_ids[own] - start)
            cut = [raw[d][4 * a : 4 * (a + k)] for d, a, k in zip(own.tolist(), start.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            sizes = np.bincount(length, minlength=capacity + 1)
            nth = np.empty(len(own), np.int64)
            nth[order] = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(seen, sizes)
            seen += sizes
            ids = table.column(0).combine_chunks().take(pa.array(own))
            columns = [ids, piece, start, length, [zlib.crc32(c) for c in cut], np.full(len(own), part), nth]
            columns = [c.cast(k) if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)]
            names = [c.split()[0] for c in PIECE.split(", ")]
            if keep_ids:
                columns.append(pa.array([np.frombuffer(c, "<u4") for c in cut], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, PIECE + (", ids array<int>" if keep_ids else ""))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col="doc_id", text_col="text", keep_ids=False) -> DataFrame:
    """Each piece's place: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids with ``keep_ids``).

    Pieces fill a sequence from 0 on without gaps and never pass ``capacity``. A null or empty text is its end id alone.
    Rows that repeat an id or a text are packed one by one; null ids too. Which of several pieces of one length
    goes where is settled by the table that they are written to. An empty table gives no rows. Columns beside those
    named are not read.
    """
    made = saved(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    each = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")
    counts = saved(each.withColumn("before", before), "piece_counts")
    # bounded: at most ``capacity`` lengths
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(solve(histogram, capacity)[0])
    if COUNT_BYTES * counts.count() <= BROADCAST_BYTES:
        counts = F.broadcast(counts)
    held = made.sparkSession.sparkContext.broadcast(places)
    out = ["doc_id", "piece", "start", "length", "ids_crc32"]
    more = ["ids"] if keep_ids else []

    def run(batches):
        for b in batches:
            length, nth = b.column("length").to_numpy(), b.column("at").to_numpy()
            sequence, offset = held.value.of(length, nth)
            columns = [b.column(c) for c in out] + [pa.array(sequence), pa.array(offset)] + [b.column(c) for c in more]
            yield pa.RecordBatch.from_arrays(columns, names=[*out, "sequence_id", "offset", *more])

    at = made.join(counts.select("part", "length", "before"), ["part", "length"]).select(*out, (F.col("before") + F.col("nth")).alias("at"), *more)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return at.mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of a packing made with ``keep_ids``; a sequence holds at most ``capacity`` ids."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(held, lambda p: p["ids"])).alias("ids"))
