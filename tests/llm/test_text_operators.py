"""Decontamination, line dedup, SimHash and sharding against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from weirline.llm import decontam, line_dedup, sharding, simhash
from weirline.llm.common import attach

LONG = "This line is long enough to be counted as a common one, surely. "
NASTY = [None, "", " \n\t ", "a", "A b", LONG, "é" * 50, "\x00 x \x1f y", "one two three four five six seven eight nine ten eleven"]


def documents(spark, texts, extra=True):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    return df.withColumns({n: F.lit(1) for n in ("item_id", "h1", "h2", "fp", "n", "key", "_bm_id", "unit", "shard")}) if extra else df


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contaminated(texts, items, n=10):
    out = {}
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[k : k + size])].add(item)
    for doc, text in enumerate(texts):
        w, hit, found = words(text), set(), set()
        for window, ids in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
                    found |= ids
        ids = sorted(str(i) for i in found if i is not None)
        out[doc] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit))
    return out


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_decontamination(spark, limit):
    texts = [*NASTY, f"x {ITEM.upper()}; y", "alpha beta gamma delta epsilon zeta eta theta iota", "Tiny item here, tiny item.", "beta " * 30]
    items = [(1, ITEM), (22, ITEM), (3, "tiny item"), (4, ""), (5, None), (None, "one two three four five six seven eight nine ten"), (3, "tiny item")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = decontam.scan(documents(spark, texts), bench, broadcast_bytes=limit).collect()
    want = contaminated(texts, items)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == want
    assert all(sum(s.end - s.start for s in r.spans) == r.n_hit for r in got)
    kept = decontam.remove(documents(spark, texts), decontam.scan(documents(spark, texts), bench, broadcast_bytes=limit))
    assert {r.doc_id for r in kept.collect()} == {d for d, w in want.items() if not w[4]}


def test_decontamination_of_hot_texts_by_join(spark):
    """Thousands of rows of one text, and as many without words: each row is a key of its own."""
    texts = [f"so {ITEM} it is", "", "nothing of the kind here"] * 700
    bench = spark.createDataFrame([(1, ITEM), (2, f"{ITEM} omicron")], "item_id long, text string")
    got = decontam.scan(documents(spark, texts, False), bench, broadcast_bytes=0).groupBy("n_words", "n_hit", "n_items").count().collect()
    assert sorted(map(tuple, got)) == [(0, 0, 0, 700), (5, 0, 0, 700), (17, 14, 2, 700)]


def test_a_benchmark_of_megabytes_is_held_flat(spark):
    """The set of 300,000 words, pickled as it is broadcast: under 40 bytes a window."""
    import pickle
    import random

    rng = random.Random(1)
    items = [(k, " ".join(str(rng.randrange(10**6)) for _ in range(300))) for k in range(1000)]
    windows = decontam.Windows(items, 10)
    assert len(pickle.dumps(windows)) < 40 * 300_000
    some = items[77][1].split()
    hit, found = windows.hits(decontam.Words(["x y " + " ".join(some[20:40]) + " z"]))
    assert hit.sum() == 20 and {windows.ids[i] for _, i in found} == {"77"}


def test_decontamination_of_empty_tables(spark):
    none, bench = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontam.scan(none, bench).count() == 0
    assert decontam.scan(documents(spark, ["a b"]), bench).first().n_hit == 0


def deduped(rows, min_chars=40, min_docs=5):
    holders = defaultdict(set)

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    common = {k: max((d for d in v if d is not None), default=None) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in common or common[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup(spark):
    shared = [f"{LONG}{k}" for k in range(3)]
    texts = [*NASTY]
    for k in range(12):
        body = [f"own line {k} that nobody shares with any other text", *shared[: k % 4], f"\t{shared[0].upper()}\r", "", "short"]
        texts.append("\n".join(body * (1 + k % 2)))
    rows = [*enumerate(texts), (3, texts[-1]), (3, texts[-1]), (None, texts[-2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in ("line", "pos", "dropped", "h1")})
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.dedup_lines(df).collect()), key=str)
    assert got == deduped(rows) and any(g[2] > 2 for g in got)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_of_lines_with_an_outer_f(spark):
    lines = ["for what it is worth this line is long enough to count", "fluff at both ends of a line of forty ff"]
    forms = [lines[0], lines[0].title(), f"\f{lines[0]}\f", f"\x0b{lines[0].upper()}\f", f" \f {lines[0]}"]
    rows = [(k, f"{form}\n{lines[1]}") for k, form in enumerate(forms)]
    rows += [(10 + k, f"{f}our lines whose keys differ in their outer letters only") for k, f in enumerate(["f", "", "ff", "f", "F"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.dedup_lines(df).collect()), key=str)
    assert got == deduped(rows) and [g[2] for g in got if g[0] < 5] == [2, 2, 2, 2, 0]


def test_bitmaps_pack_and_unpack(spark):
    runs = [[(0, 1), (7, 300), (70000, 2)], [(5, 1)], []]
    df = spark.createDataFrame([(r,) for r in runs], "runs array<struct<start: int, length: int>>")
    got = df.select("runs", line_dedup.packed("runs").alias("b")).select("runs", F.octet_length("b").alias("n"), line_dedup.unpacked(F.col("b")).alias("back"))
    assert all(r.runs == r.back and r.n == 8 * len(r.runs) for r in got.collect())


def test_first_occurrences_are_streamed_from_sorted_ranges(spark):
    """One range exchange, one sort, and a window on what they give."""
    lines = spark.range(1000).selectExpr("id % 7 as h1", "id % 3 as h2", "id % 50 as doc_id", "cast(id as int) as pos")
    firsts = line_dedup.first_occurrences(lines)
    plan = firsts._jdf.queryExecution().sparkPlan().toString() + firsts._jdf.queryExecution().executedPlan().toString()
    executed = plan[plan.index("AdaptiveSparkPlan") :]
    assert executed.count("Exchange") == executed.count("Exchange rangepartitioning") == 1 and "Sort [h1" in executed and "Window" in executed
    want = {}
    for r in lines.collect():
        want[r.h1, r.h2, r.doc_id] = min(want.get((r.h1, r.h2, r.doc_id), 1 << 30), r.pos)
    assert {(r.h1, r.h2, r.doc_id): r.pos for r in firsts.collect()} == want


def test_line_dedup_of_a_hot_line(spark, monkeypatch):
    """A line in thousands of documents takes the broadcast way of the join, marks too many to broadcast the shuffled one."""
    rows = [(k, f"own line number {k} of document {k}, which no other one has\n{LONG}\n{LONG if k % 3 else 'tail'}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = deduped(rows)
    for limit in (1 << 25, 0):
        monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", limit)
        out = line_dedup.dedup_lines(df)
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()), key=str) == want


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    for text in [*NASTY, "To be or not to be, that is the question " * 40]:
        assert simhash.fingerprint(text) % 2**64 == brute_fingerprint(text)


def grouped(fps, distance=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(len(fps))]


def test_components_in_crowded_buckets(spark):
    import random

    rng = random.Random(5)
    base, fps = [rng.getrandbits(64) for _ in range(4)], set()
    for b in base:  # a ball around each: many share every pair of blocks
        fps.add(b)
        fps |= {b ^ (1 << rng.randrange(16)) ^ (1 << rng.randrange(16)) for _ in range(90)}
        fps |= {b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(20)}
    fps = sorted(x - 2**64 if x >> 63 else x for x in fps | {rng.getrandbits(64) for _ in range(60)})
    reps = spark.createDataFrame([(x,) for x in fps], "fp long")
    roots = {r.fp: r.root for r in simhash.components(simhash.links(reps)).collect()}
    want = grouped([x % 2**64 for x in fps])
    assert [roots.get(x, x) for x in fps] == [fps[k] for k in want]


def test_near_duplicates(spark):
    text = " ".join(f"word{k}" for k in range(400))
    texts = [*NASTY, text, text, text.replace("word7 ", "word8 "), text + " more"]
    got = {r.doc_id: r for r in simhash.near_duplicates(documents(spark, texts)).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    assert [got[k].fp % 2**64 for k in got] == [fps[k] for k in got]
    assert {k: got[k].component_id for k in got} == dict(enumerate(grouped(fps)))
    assert simhash.near_duplicates(documents(spark, texts).limit(0)).count() == 0


def test_near_copies(spark):
    import random

    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(500)]
    originals = [rng.choices(vocabulary, k=300) for _ in range(40)]
    texts, origin = [], []
    for k, o in enumerate(originals):
        texts.append(" ".join(o))
        origin.append(k)
        for _ in range(60 if k == 0 else k % 3):  # copies with two words of 300 changed: similarity over 0.9
            c = list(o)
            for _ in range(2):
                c[rng.randrange(300)] = "changed"
            texts.append(" ".join(c))
            origin.append(k)
    groups = {r.doc_id: r.component_id for r in simhash.near_copies(documents(spark, texts)).collect()}
    first = {o: origin.index(o) for o in origin}
    found = [groups[k] == first[o] for k, o in enumerate(origin)]
    assert sum(found) >= 0.97 * len(found)
    assert all(origin[groups[k]] == origin[k] for k in groups)  # no clean text is drawn in
    nasty = simhash.near_copies(documents(spark, NASTY)).collect()
    assert sorted((r.doc_id, r.component_id) for r in nasty) == [(k, 0 if k < 3 else k) for k in range(len(NASTY))]


def near_copy_groups(texts, limit=0.8, n=5):
    """Components of all pairs whose sets of shingles are similar enough, by brute force; the first text names its group."""
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        sets.append({" ".join(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b, y in enumerate(sets):
        for a, x in enumerate(sets[:b]):
            if 5 * len(x & y) >= 4 * len(x | y):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(k) for k in range(len(texts))]


def edited(rng, words, edits):
    out = list(words)
    for at in rng.sample(range(len(out)), edits):
        out[at] = f"edit{rng.randrange(10**9)}"
    return " ".join(out)


def test_near_copies_are_exact_around_the_limit(spark):
    import random

    rng = random.Random(3)
    texts = []
    for k in range(60):  # similarities of 0.7 to 0.9, most on either side of 0.8
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        texts += [" ".join(words), *(edited(rng, words, e) for e in range(3, 8))]
    want = near_copy_groups(texts)
    got = {r.doc_id: r.component_id for r in simhash.near_copies(documents(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == want and len(set(want)) > 60


def test_near_copies_of_one_text_keep_every_link(spark, monkeypatch):
    import random

    monkeypatch.setattr(simhash, "TOGETHER", 40)
    rng = random.Random(4)
    texts = []
    for _ in range(2):  # edits of one text, similar to it and seldom to one another
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        texts += [edited(rng, words, 3 + k % 3) for k in range(150)] + [" ".join(words)]
    want = near_copy_groups(texts)
    got = {r.doc_id: r.component_id for r in simhash.near_copies(documents(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == want


def test_pages_of_one_template_do_not_meet(spark, monkeypatch):
    """Pages that share five sixths of their shingles, of many lengths, some of them near copies: links as by brute force, and
    few of the pages are compared."""
    import random

    monkeypatch.setattr(simhash, "TOGETHER", 20)
    monkeypatch.setattr(simhash, "SAMPLED", 2)
    rng, seen, meetings = random.Random(7), [], simhash._meetings

    def spy(members, similarity):
        seen.append((members.count(), meetings(members, similarity)))
        return seen[-1][1]

    monkeypatch.setattr(simhash, "_meetings", spy)
    template = [f"t{k}" for k in range(400)]
    texts = []
    for k in range(150):
        shared = 240 + k % 160 if k % 3 else 300
        own = [f"own{rng.randrange(10**9)}" for _ in range(shared // 6 + k % 5)]
        texts.append(" ".join(own + template[:shared]))
        if k % 10 == 0:
            texts.append(" ".join(own[: -k // 10 or None] + template[: shared - k // 4]))
    want = near_copy_groups(texts)
    got = {r.doc_id: r.component_id for r in simhash.near_copies(documents(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == want and 100 < len(set(want)) < len(texts)
    crowded = simhash.near_copies(documents(spark, [" ".join([f"u{k}x{j}" for j in range(60)] + template[:300]) for k in range(150)]))
    assert crowded.select("component_id").distinct().count() == 150
    members, met = seen[-1]
    assert members >= 150 and met.count() == 0


def test_sharding(spark):
    import random

    rng = random.Random(2)
    texts = [*NASTY, *["copy " * 10] * 50, *("x" * rng.randrange(1, 900) + str(k) for k in range(600))]
    rows = sharding.assign(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    by_text, sizes, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        by_text[raw].add(r.shard)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in by_text.values()) and set(sizes) == set(range(16))
    assert max(sizes.values()) - min(sizes.values()) <= 0.02 * max(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign(documents(spark, texts).limit(0)).count() == 0


def test_shards_do_not_depend_on_the_cluster(spark):
    """Nor does the broadcast way of joining hot groups change anything."""
    rows = [(k, f"text number {k % 1500}" if k % 2 else "a hot text that half of the rows have") for k in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    old, seen = spark.conf.get("spark.sql.shuffle.partitions"), set()
    try:
        for n in ("2", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.add(tuple(sorted(map(tuple, sharding.assign(df.repartition(int(n))).select("doc_id", "shard", "slot").collect()))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(seen) == 1 and len({s for d, s, _ in seen.pop() if d % 2 == 0}) == 1


def test_hot_keys_are_joined_by_broadcast(spark):
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, -1, id % 900) as k", "id as v")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    out = attach(rows, groups, ["k"])
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 20_000 and out.filter("k = -1").agg(F.countDistinct("top")).first()[0] == 1


def test_near_duplicates_with_a_hot_fingerprint(spark):
    texts = ["one and the same text in very many rows"] * 2500 + ["", None] * 700 + [f"another text of its own, number {k}" for k in range(50)]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(spark, texts, False)).collect()}
    assert all(got[k] == 0 for k in range(2500)) and all(got[k] == 2500 for k in range(2500, 3900))


def test_near_copies_of_repeated_rows_and_null_ids(spark):
    """One row's marks for a group, told by id and text; null ids come last."""
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(None, text), (None, text), (7, text + " end"), (7, text + " end"), (9, "apart from the others"), (None, "no id and no copy"), (None, None)]
    got = simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r.component_id == 7 for r in got) == 4
    kept = sorted(((r.doc_id, r.kept) for r in got), key=str)
    assert kept == sorted([(None, False), (None, False), (7, True), (7, True), (9, True), (None, True), (None, True)], key=str)


def test_a_group_above_its_share_stands_alone(spark):
    texts = ["big" * 1000] * 10 + [f"t{k}" * 20 for k in range(200)]
    sizes = defaultdict(set)
    for r in sharding.assign(documents(spark, texts)).collect():
        sizes[r.shard].add(texts[r.doc_id][:3] == "big")
    assert sorted(map(sorted, sizes.values())) == [[False]] * 15 + [[True]]


def test_best_fit_takes_the_tightest_bin():
    import random

    rng = random.Random(3)
    sizes = sorted((rng.randrange(1, 60) for _ in range(400)), reverse=True)
    got, bins = list(sharding.best_fit(sizes, 100)), []
    for size, bin_ in zip(sizes, got):
        fits = [(r, k) for k, r in enumerate(bins) if r >= size]
        want = min(fits)[1] if fits else len(bins)
        assert bin_ == want
        bins.append(100) if not fits else None
        bins[want] -= size


def test_a_window_of_very_many_items(spark):
    """Boilerplate that 100,000 items share, quoted by many documents: items are listed once for a set of windows."""
    import time

    shared = "please answer the following question with a single word only now"
    bench = spark.range(100_000).select(F.col("id").alias("item_id"), F.concat(F.lit(f"{shared} q"), F.col("id").cast("string")).alias("text"))
    texts = [f"say {shared} twice {shared}", "nothing of it here at all", *[f"{shared} {k}" for k in range(60)]]
    want = hashlib.sha256(",".join(sorted(map(str, range(100_000)))).encode()).hexdigest()
    windows = decontam.Windows([(k, f"{shared} q{k}") for k in range(100_000)], 10)
    start = time.time()
    told = [t for _, _, t, _ in decontam._block(windows, texts)]
    assert time.time() - start < 5 and told[0] == (100_000, want) == told[5] and told[1] == (0, decontam.EMPTY)
    for limit in (1 << 30, 0):
        got = {r.doc_id: r for r in decontam.scan(documents(spark, texts, False), bench, broadcast_bytes=limit).collect()}
        assert (got[0].n_hit, got[0].n_items, got[0].items_sha256) == (22, 100_000, want) and not got[1].contaminated
        assert got[7].n_items == 100_000 and got[7].n_hit == 11
