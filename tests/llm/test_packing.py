"""Packing: every piece placed once, no gap, no sequence too long, and few sequences."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirline.llm import packing
from weirline.llm.queries import vocabulary

WORDS = vocabulary("word_bpe_49k.json")


def fewest(items, capacity):
    """The least number of sequences, by trying all ways."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for i in {r: i for i, r in enumerate(rooms)}.values():
            if rooms[i] >= items[k]:
                place(k + 1, rooms[:i] + [rooms[i] - items[k]] + rooms[i + 1 :])
        place(k + 1, [*rooms, capacity - items[k]])

    place(0, [])
    return best[0]


def histogram(items):
    values, counts = np.unique(items, return_counts=True)
    return dict(zip(values.tolist(), counts.tolist()))


def check(runs, counts, capacity):
    held = {}
    for run in runs:
        assert run.free == capacity - sum(length * k for length, k in run.items) >= 0 and run.items
        for length, k in run.items:
            held[length] = held.get(length, 0) + run.times * k
    assert held == {k: n for k, n in counts.items() if n}


@pytest.mark.parametrize("seed", range(6))
def test_small_histograms_meet_the_fewest(seed, monkeypatch):
    monkeypatch.setattr(packing, "ROUNDS", 60)
    rng = np.random.default_rng(seed)
    items = rng.integers(1, 64, 11) if seed % 2 else rng.integers(12, 40, 9)
    counts = histogram(items)
    runs, bound = packing.solve(dict(counts), 64)
    check(runs, counts, 64)
    want = fewest(items.tolist(), 64)
    assert bound <= want <= sum(r.times for r in runs) <= want + 1


def one_by_one(items, capacity):
    rooms = []
    for item in sorted(items, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= item]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= item
        else:
            rooms.append(capacity - item)
    return len(rooms)


def test_runs_are_best_fit_piece_by_piece():
    rng = np.random.default_rng(1)
    for n, low, high in itertools.product((1, 50, 400), (1, 20), (30, 100)):
        items = rng.integers(low, high, n)
        runs = packing.best_fit(histogram(items), 100)
        check(runs, histogram(items), 100)
        assert sum(r.times for r in runs) == one_by_one(items, 100)


def test_the_program_beats_best_fit_where_nothing_small_fills_up():
    counts = histogram(np.random.default_rng(0).integers(400, 700, 20000))
    runs, bound = packing.solve(dict(counts), 2048)
    check(runs, counts, 2048)
    n = sum(r.times for r in runs)
    assert n <= 1.03 * bound and n < 0.97 * sum(r.times for r in packing.best_fit(counts, 2048))


def test_whole_pieces_and_nothing():
    assert packing.solve({}, 8) == ([], 0)
    runs, bound = packing.solve({8: 5, 3: 0}, 8)
    assert (sum(r.times for r in runs), bound) == (5, 5)


TEXTS = ["a b c", "", None, "word " * 700, "ünïcode 日本 text", "a b c", "x" * 500, "the end. " * 90]


def library(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids, 0]


def test_pieces_are_placed_once_and_without_gaps(spark):
    rows = [(k % 9, t, 1, 2, 3) for k, t in enumerate(TEXTS * 4)] + [(None, "no id", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int, nth int, at int").repartition(3)
    packed = packing.pack(docs, WORDS, capacity=256, keep_ids=True).cache()
    got = packed.collect()
    want = []
    for i, t, *_ in rows:
        ids = library(t)
        want += [(i, a // 256, a, tuple(ids[a : a + 256])) for a in range(0, len(ids), 256)]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in got), key=key) == sorted(want, key=key)
    assert all(r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in spans.values():
        s.sort()
        assert [a for a, _ in s] == list(itertools.accumulate([0] + [n for _, n in s]))[:-1] and sum(n for _, n in s) <= 256
    assert len(spans) <= sum(r.length for r in got) // 256 + 2
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert all(whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids for r in got)
    packed.unpersist()


def test_hot_length_and_empty_table(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same text for all").alias("text")).repartition(7)
    got = packing.pack(docs, WORDS, capacity=64)
    assert got.select("sequence_id", "offset").distinct().count() == 5000
    per = got.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert per.count() == -(-5000 // (64 // 5)) and per.agg(F.max("n")).first()[0] <= 64
    assert packing.pack(docs.limit(0), WORDS).count() == 0
