"""Phrases against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirline.llm import phrases as ph


def counted(rows):
    """Per language: how often each word and phrase of up to five words occurs, and all words."""
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(w)
            mine = counts.setdefault(lang, Counter())
            for k in range(1, 6):
                mine.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return counts, sizes


def expected(rows, least, top):
    counts, sizes = counted(rows)
    out = []
    for lang, mine in counts.items():
        found, n = {p: a for p, a in mine.items() if a >= least and len(p) > 1}, sizes[lang]
        inner = {(p[i:j], a) for p, a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p)}
        best = []
        for p, a in found.items():
            if (p, a) not in inner:
                score, k = min((1000 * a * n // (mine[p[:k]] * mine[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "of", "Über", "x-y", "(a)", "日本", "net", "work", "a", "a", "the"] + [f"w{k}" for k in range(40)]
    rows = []
    for k in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(rng.randrange(80)))
        if k % 3 == 0:
            text += " once upon a time there was the END; hot pair " + rng.choice(words) + " hot pair hot pair"
        rows.append((rng.choice(["en", "de", None]), text))
    return [*rows, ("en", None), (None, ""), ("fr", " \t "), ("en", "a " * 300), *[("de", "the very same text again and again")] * 40]


@pytest.mark.parametrize("least,limits", [
    (8, {}), (8, {"hot_least": 5}), (5, {"most_words": 0, "hot_least": 20}), (12, {"broadcast_bytes": 0}), (30, {"most_words": 0, "broadcast_bytes": 0}),
])
def test_phrases_are_counted_and_scored(spark, least, limits):
    rows = corpus(least)
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({n: F.lit(3) for n in ("word", "h", "hs", "n", "c", "bucket")}).repartition(5)
    got = sorted(tuple(r) for r in ph.collocations(df, least=least, top=20, **limits).collect())
    assert got == expected(rows, least, 20)
    assert len(got) >= 5


def test_empty_tables_and_no_phrases(spark):
    df = spark.createDataFrame(corpus(1, 10), "lang string, text string")
    assert ph.collocations(df.limit(0)).count() == 0
    assert ph.collocations(df, least=10**6).count() == 0


def test_quicksort_abandons_and_counts():
    rng = np.random.default_rng(3)
    ids = np.append(rng.integers(0, 6, 4000), 0)
    rows = ph.suffixes(ids, len(ids))
    each, counts = np.unique(rows, axis=0, return_counts=True)
    for least in (1, 20, 100):
        row, depth, total = ph.quicksort(each, counts, least)
        got = {tuple(each[r][:d].tolist()): int(t) for r, d, t in zip(row, depth, total)}
        assert len(got) == len(row)
        want = Counter(tuple(r[:d].tolist()) for r in rows for d in range(2, 6) if r[d - 1] != 0)
        assert got == {p: c for p, c in want.items() if c >= least}
    assert all(len(x) == 0 for x in ph.quicksort(np.zeros((0, 5), np.int64), np.zeros(0, np.int64), 1))


def test_suffixes_in_steps_and_blocks():
    ids = np.array([1, 2, 3, 0, 4, 5, 6, 7, 8, 9, 0, 1, 0])
    whole = ph.suffixes(ids, len(ids))
    steps = [ph.suffixes(ids[at : at + 3 + ph.LONGEST - 1], 3) for at in range(0, len(ids), 3)]
    assert (np.concatenate(steps) == whole).all()
    back, counts = ph._unpacked(ph._packed(whole, np.arange(len(whole))))
    assert (back == whole).all() and (counts == np.arange(len(whole))).all()


def test_scores_beyond_64_bits(spark):
    """The arithmetic alone, on counts no fixture could have."""
    expr = "(cast(1000 as decimal(19, 0)) * cast(c as decimal(19, 0))) * cast(n as decimal(19, 0)) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    a, n, left, right = 10**12 + 7, 9 * 10**12 + 1, 10**12 + 9, 2 * 10**12 + 3
    df = spark.createDataFrame([(a, n, left, right)], "c long, n long, l long, r long")
    assert df.select(F.expr(expr)).first()[0] == 1000 * a * n // (left * right)
