"""Phrases that belong together, mined by a multikey quicksort of word suffixes.

Every place in a text is a suffix, of which up to five words count. Words that are rarer in their language than a phrase
must be end a suffix, as does punctuation. Suffixes are routed by their two leading words, so that all occurrences of a
phrase meet; a task sorts pointers to its suffixes by three-way partitions, word by word. The part that equals the
pivot is a phrase, and its size the phrase's count; parts that hold fewer suffixes than a phrase must are
abandoned at once. All parts of a task are partitioned together, a step at a time.

Pairs of words so frequent that one task should not have all their suffixes are routed by whole suffixes
instead; their counts from several tasks are added.

Suffixes travel sorted, repeated ones counted, in compressed blocks. A word is a 64-bit hash of language and word;
should a frequent word share its hash with any other, all is hashed anew with another seed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, ascii_lower, attach, saved

LONGEST = 5
#: Suffixes of a task that sorts, and of a block that travels before it is cut by destination.
TASK_SUFFIXES, FLUSH = 1 << 21, 1 << 20
#: A pair is hot with more than this share of all suffixes, unless that is fewer than HOT_LEAST.
HOT_SHARE, HOT_LEAST = 256, 1 << 16
#: Words whose hashes are broadcast as they are; beyond, a bitmap of FILTER_BITS bits lets through all of them and a few more.
MOST_WORDS, FILTER_BITS = 1 << 21, 27
PHRASE_BYTES, SALTS = 120, 64
BREAK = "\n"
MIX, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


def words_of(lang: Column, text: Column) -> Column:
    """The words of a text in order, with BREAK between its pieces."""
    broken = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"[.,;:!?\x0A-\x0D]+", f" {BREAK} ")
    return F.filter(F.split(broken, r"[\x20\x09]+"), lambda w: w != "")


def _hash(seed: int, lang, word):
    return F.xxhash64(F.lit(seed), lang, word)


class Words:
    """The frequent words' hashes: numbered from 1 while they are few, else a bitmap that lets their hashes through."""

    def __init__(self, hashes: np.ndarray | None, bits: np.ndarray | None):
        self.hashes, self.bits = hashes, bits

    def ids(self, h: np.ndarray) -> np.ndarray:
        """A number for each hash, 0 for one that is not frequent."""
        if self.hashes is not None:
            at = np.minimum(np.searchsorted(self.hashes, h), max(0, len(self.hashes) - 1))
            return np.where(self.hashes[at] == h, at + 1, 0) if len(self.hashes) else np.zeros(len(h), np.int64)
        bit = (h.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        return np.where(self.bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1, h, 0)

    def back(self, ids: np.ndarray) -> np.ndarray:
        return ids if self.hashes is None else np.where(ids > 0, self.hashes[np.maximum(ids, 1) - 1], 0)

    @property
    def width(self) -> int:
        """Bits of a number."""
        return 64 if self.hashes is None else max(1, len(self.hashes).bit_length())


def _frequent(words: DataFrame, most: int) -> Words:
    if words.count() <= most:  # bounded: 8 bytes each
        return Words(np.sort(words.select("h").toPandas()["h"].to_numpy(np.int64)), None)
    bit = F.shiftrightunsigned("h", 64 - FILTER_BITS) + 1  # Spark numbers a bitmap's bits from 1
    parts = words.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for bucket, bits in parts.toLocalIterator():  # at most as many of 4096 bytes as the array holds
        out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bytes(bits), np.uint8)
    return Words(None, out)


def suffixes(ids: np.ndarray, starts: int) -> np.ndarray:
    """The suffixes of two words or more that start in the first ``starts`` places, five words a row, 0 behind a suffix's end."""
    n = min(starts, len(ids))
    padded = np.concatenate([ids, np.zeros(LONGEST, ids.dtype)])
    columns = [ids[:n]]
    for k in range(1, LONGEST):
        columns.append(np.where(columns[-1] != 0, padded[k : k + n], 0))
    return np.stack([c[columns[1] != 0] for c in columns], axis=1)


def _mixed(columns) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = (out ^ c.view(np.uint64)) * MIX
        out ^= out >> TURN
    return out


def _sorted(rows: np.ndarray, width: int, bucket: np.ndarray) -> np.ndarray:
    """The order of rows by bucket and words, as many words in a key as it holds."""
    keys, per = [], max(1, 63 // width)
    for k in range(0, LONGEST, per):
        key = rows[:, k]
        for c in range(k + 1, min(LONGEST, k + per)):
            key = key << width | rows[:, c]
        keys.append(key)
    return np.lexsort([*keys[::-1], bucket])


def _packed(rows: np.ndarray, counts: np.ndarray) -> bytes:
    """Rows and their counts column by column, the bytes of a number apart, compressed."""
    flat = np.ascontiguousarray(np.concatenate([rows, counts[:, None]], axis=1).T).view(np.uint8)
    planes = np.ascontiguousarray(flat.reshape(LONGEST + 1, len(rows), 8).transpose(0, 2, 1)).tobytes()
    return len(rows).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8:], decompressed_size=n * 8 * (LONGEST + 1), codec="zstd"), np.uint8)
    flat = np.ascontiguousarray(planes.reshape(LONGEST + 1, 8, n).transpose(0, 2, 1)).view(np.int64).reshape(LONGEST + 1, n)
    return flat[:LONGEST].T, flat[LONGEST]


def quicksort(rows: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a row, its first words that are a phrase, how often the phrase occurs) of every phrase of two words or more that occurs
    ``least`` times or more, by multikey three-way partitions of pointers to the rows."""
    rng, n = np.random.default_rng(0), len(rows)
    words = np.ascontiguousarray(rows.T).reshape(-1)  # a word's column after another's
    pointers, sizes, depths = np.arange(n), np.array([n] if n else [], np.int64), np.zeros(min(n, 1), np.int64)
    out: list[tuple] = []
    while len(sizes):
        starts = np.cumsum(sizes) - sizes
        pivots = words[depths * n + pointers[starts + (rng.random(len(sizes)) * sizes).astype(np.int64)]]
        word = words[np.repeat(depths * n, sizes) + pointers]
        against = np.repeat(pivots, sizes)
        parts = []
        for where in (word < against, word == against, word > against):
            size = np.add.reduceat(where.astype(np.int64), starts)
            picked = pointers[where]
            parts.append((picked, size, np.add.reduceat(np.where(where, counts[pointers], 0), starts)))
        equal, size, total = parts[1]
        phrase = (total >= least) & (pivots != 0) & (depths >= 1)
        first = np.cumsum(size) - size
        out.append((equal[first[phrase]], depths[phrase] + 1, total[phrase]))
        pointers, kept_sizes, kept_depths = [], [], []
        for k, (picked, size, total) in enumerate(parts):
            goes_on = total >= least
            if k == 1:
                goes_on &= (pivots != 0) & (depths + 1 < LONGEST)
            pointers.append(picked[np.repeat(goes_on, size)])
            kept_sizes.append(size[goes_on])
            kept_depths.append(depths[goes_on] + (k == 1))
        pointers, sizes, depths = np.concatenate(pointers), np.concatenate(kept_sizes), np.concatenate(kept_depths)
        some = sizes > 0
        sizes, depths = sizes[some], depths[some]
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*out))


def _scanned(docs: DataFrame, lang_col: str, text_col: str, seed: int) -> DataFrame:
    """(h): each text's hashes in order, 0 between pieces and at the end."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    zero = F.lit(0).cast("long")
    each = F.transform(F.col("w"), lambda w: F.when(w == BREAK, zero).otherwise(_hash(seed, F.col("lang"), w)))
    named = docs.select(lang.alias("lang"), words_of(lang, F.col(text_col)).alias("w"))
    return named.select(F.concat(each, F.array(zero)).alias("h"))


def _flat(batch) -> np.ndarray:
    return batch.column(0).flatten().to_numpy()


def _hot_pairs(scanned: DataFrame, hot: Words, limit: int) -> np.ndarray:
    """Mixed hashes of the pairs that occur more often than ``limit``: fewer than suffixes / limit. Both words of such a pair
    do, so only pairs of those are counted."""
    held = scanned.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        for b in batches:
            ids = held.value.back(held.value.ids(_flat(b)))
            both = (ids[:-1] != 0) & (ids[1:] != 0)
            pairs, n = np.unique(_mixed([ids[:-1][both], ids[1:][both]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(n, pa.int64())], names=["pair", "n"])

    counted = scanned.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter(F.col("n") > limit)
    return np.sort(counted.select("pair").toPandas()["pair"].to_numpy(np.int64).view(np.uint64))


def _mined(scanned: DataFrame, words: Words, hot: np.ndarray, buckets: int, least: int) -> DataFrame:
    """(hs, c, partial): phrases of two words or more; those of hot pairs, whose counts are still to be added, are partial."""
    held = scanned.sparkSession.sparkContext.broadcast((words, hot))

    def send(batches):
        known, hot = held.value
        rows, n = [], 0

        def blocks():
            each = np.concatenate(rows)
            pair = _mixed([known.back(each[:, 0]), known.back(each[:, 1])])
            at = np.minimum(np.searchsorted(hot, pair), max(0, len(hot) - 1))
            is_hot = hot[at] == pair if len(hot) else np.zeros(len(each), bool)
            route = pair.copy()
            route[is_hot] = _mixed(list(np.ascontiguousarray(each[is_hot].T)))
            bucket = (route % np.uint64(buckets)).astype(np.int64) * 2 + is_hot
            order = _sorted(each, known.width, bucket)
            each, bucket = each[order], bucket[order]
            new = np.concatenate(([True], (each[1:] != each[:-1]).any(axis=1) | (bucket[1:] != bucket[:-1])))
            at = np.flatnonzero(new)
            counts = np.diff(np.concatenate((at, [len(each)])))
            each, bucket = each[at], bucket[at]
            edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
            raw = [_packed(each[a:b], counts[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            key = bucket[edges[:-1]]
            columns = [pa.array(key >> 1, pa.int32()), pa.array(key & 1 == 1), pa.array(raw, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "hot", "block"])

        for b in batches:
            ids = known.ids(_flat(b))
            for at in range(0, len(ids), FLUSH):  # a very long text in steps
                here = suffixes(ids[at : at + FLUSH + LONGEST - 1], FLUSH)
                if len(here):
                    rows.append(here)
                    n += len(here)
                if n >= FLUSH:
                    yield blocks()
                    rows, n = [], 0
        if rows:
            yield blocks()

    def sort(batches):
        known = held.value[0]
        now, rows, counts = None, [], []

        def phrases():
            each, n = np.concatenate(rows), np.concatenate(counts)
            row, depth, total = quicksort(each, n, 1 if now[1] else least)
            found = known.back(each[row])
            flat = found[np.arange(LONGEST) < depth[:, None]]
            hs = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(depth))), pa.int32()), pa.array(flat))
            return pa.RecordBatch.from_arrays([hs, pa.array(total, pa.int64()), pa.array(np.full(len(row), now[1]))], names=["hs", "c", "partial"])

        for b in batches:
            for key, raw in zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), b.column(2)):
                if rows and key != now:
                    yield phrases()
                    rows, counts = [], []
                now = key
                each, n = _unpacked(raw.as_buffer().to_pybytes())
                rows.append(each)
                counts.append(n)
        if rows:
            yield phrases()

    sent = scanned.mapInArrow(send, "bucket int, hot boolean, block binary")
    routed = sent.repartition(buckets, "bucket", "hot").sortWithinPartitions("bucket", "hot")
    return routed.mapInArrow(sort, "hs array<long>, c long, partial boolean")


def _looked_up(rows: DataFrame, key: str, table: DataFrame, broadcast_bytes: int, per_row: int) -> DataFrame:
    """``rows`` with what ``table`` has for ``key``, a column of both; no key of ``rows`` is too hot for a task."""
    if per_row * table.count() <= broadcast_bytes:
        return rows.join(F.broadcast(table), key)
    rows = saved(rows, "rows")
    uses = rows.groupBy(key).agg(F.count("*").alias("_uses"))
    return attach(rows, saved(table.join(uses, key), "looked_up"), [key], "_uses")


def collocations(
    docs: DataFrame,
    least: int = 100,
    top: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
    hot_least: int = HOT_LEAST,
    most_words: int = MOST_WORDS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to 5 words occurs ``a`` times, ``least`` at least, within pieces between marks `.,;:!?` and line ends; words end at
    spaces and tabs, A-Z count as a-z. ``n`` are the language's words, ``l`` and ``r`` the counts of the two parts of the cut
    with the lowest score (the first of several), which is floor(1000 * a * n / (l * r)). A phrase all of whose
    occurrences lie in a longer one is left out. Order: score and ``a`` descending, then the phrase's bytes.

    A null language is `und`, a null text empty; repeated rows count each time. Empty tables give no rows. Columns beside
    those named are not read.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    each = docs.select(lang.alias("lang"), F.explode(words_of(lang, F.col(text_col))).alias("word")).filter(F.col("word") != BREAK)
    counted = saved(each.groupBy("lang", "word").agg(F.count("*").alias("c")), "words")
    sizes = saved(counted.groupBy("lang").agg(F.sum("c").alias("n")), "languages")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    seed = 0
    while True:
        hashed = counted.withColumn("h", _hash(seed, F.col("lang"), F.col("word")))
        per_hash = hashed.groupBy("h").agg(F.count("*").alias("words"), F.max("c").alias("most"))
        if per_hash.filter((F.col("most") >= least) & ((F.col("words") > 1) | (F.col("h") == 0))).isEmpty():
            break
        seed += 1
    frequent = saved(hashed.filter(F.col("c") >= least).join(F.broadcast(sizes), "lang"), "frequent_words")

    scanned = _scanned(docs, lang_col, text_col, seed)
    limit = min(TASK_SUFFIXES, max(hot_least, total // HOT_SHARE))
    hot_words = frequent.filter(F.col("c") > limit)
    hot = np.zeros(0, np.uint64) if hot_words.isEmpty() else _hot_pairs(scanned, _frequent(hot_words, most_words), limit)
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_SUFFIXES))
    mined = saved(_mined(scanned, _frequent(frequent, most_words), hot, buckets, least), "mined")
    added = mined.filter("partial").groupBy("hs").agg(F.sum("c").alias("c")).filter(F.col("c") >= least)
    phrases = saved(mined.filter("not partial").select("hs", "c").unionByName(added), "phrases")

    # a phrase lies in one a word longer with the same count, if it does in any
    longer = phrases.filter("size(hs) > 2")
    inner = F.explode(F.expr("array(slice(hs, 1, size(hs) - 1), slice(hs, 2, size(hs) - 1))"))
    covers = longer.select("c", inner.alias("hs")).groupBy("hs").agg(F.max("c").alias("cover"))
    kept = phrases.join(covers, "hs", "left").filter("cover is null or cover < c").drop("cover")

    one = frequent.select("h", "word", "lang", "n")
    parts = phrases.select("hs", "c").unionByName(frequent.select(F.array("h").alias("hs"), "c"))
    led = kept.withColumn("h", F.get("hs", F.lit(0)))
    led = _looked_up(led, "h", one.drop("word"), broadcast_bytes, PHRASE_BYTES).drop("h")
    cuts = led.withColumn("k", F.explode(F.expr("sequence(1, size(hs) - 1)")))
    cuts = cuts.withColumns({"lhs": F.expr("slice(hs, 1, k)"), "rhs": F.expr("slice(hs, k + 1, size(hs) - k)")})
    cuts = _looked_up(cuts, "lhs", parts.select(F.col("hs").alias("lhs"), F.col("c").alias("l")), broadcast_bytes, PHRASE_BYTES)
    cuts = _looked_up(cuts, "rhs", parts.select(F.col("hs").alias("rhs"), F.col("c").alias("r")), broadcast_bytes, PHRASE_BYTES)
    whole = lambda c: f"cast({c} as decimal(19, 0))"
    score = F.expr(f"({whole('1000')} * {whole('c')}) * {whole('n')} div ({whole('l')} * {whole('r')})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("hs", F.col("c").alias("a"), "lang", "n").agg(lowest).select("hs", "a", "lang", "n", "cut.*")

    # words only for phrases that can still be among the first: in every salt's share as many as are asked for, and their ties
    order = [F.col("score").desc(), F.col("a").desc()]
    share = W.partitionBy("lang", F.pmod(F.xxhash64("hs"), F.lit(SALTS))).orderBy(*order)
    first = saved(scored.withColumn("place", F.rank().over(share)).filter(F.col("place") <= top), "first_phrases")
    named = first.select(F.posexplode("hs").alias("at", "h"), "hs")
    named = _looked_up(named, "h", one.select("h", "word"), broadcast_bytes, PHRASE_BYTES)
    words = F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"])
    named = named.groupBy("hs").agg(F.array_join(words, " ").alias("phrase"))
    rows = first.join(named, "hs").withColumn("salt", F.pmod(F.xxhash64("hs"), F.lit(SALTS)))
    order.append(F.col("phrase"))
    best = rows.withColumn("place", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
