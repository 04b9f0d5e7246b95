"""Benchmark decontamination: a broadcast set of benchmark word windows against every document window.

A word is a 64-bit hash of its bytes and a window a polynomial over the hashes of its words, computed for a whole
batch at once in numpy. A document's window whose hash is in the set is verified by its words. The set is flat:
a hash, a place in the benchmark's words and an item for each window. A benchmark too large for that is met
by a shuffled join, to which documents send only the windows that a bitmap of hashes lets through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, attach, saved

#: Bytes that stay in words: digits, letters in lower case and all that is not ASCII.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
BASE, BYTE_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
BLOCK_ROWS, BLOCK_BYTES = 1000, 1 << 20
#: Bytes that a window takes in the broadcast set, its share of the words included.
WINDOW_BYTES = 32
#: Bits of the bitmap that filters windows before a shuffled join: 32 MB, whatever the benchmark's size.
FILTER_BITS = 28


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased, as UTF-8; none for null."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


class Words:
    """The words of several texts, one after another: their bytes' ``start`` and ``end`` in ``raw``, their ``hash``, and
    ``at``, where each text's begin (and the last one's end)."""

    def __init__(self, texts: list):
        each = [t.encode("utf-8", "surrogatepass").translate(WORD_BYTES) if t else b"" for t in texts]
        self.raw = b" ".join(each) + b" "
        flat = np.frombuffer(self.raw, np.uint8)
        inside = np.zeros(len(flat) + 1, np.int8)
        inside[1:] = flat != 32
        turns = np.diff(inside)
        self.start, self.end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        lengths = np.array([len(e) + 1 for e in each], np.int64)
        self.at = np.searchsorted(self.start, np.concatenate(([0], np.cumsum(lengths))))
        self.hash = self._hashes(flat)

    def _hashes(self, flat: np.ndarray) -> np.ndarray:
        """A polynomial over each word's bytes, mixed."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        n = self.end - self.start
        first = np.concatenate(([0], np.cumsum(n)[:-1]))
        within = np.arange(int(n.sum())) - np.repeat(first, n)
        powers = np.ones(int(n.max()), np.uint64)
        powers[1:] = BYTE_BASE
        powers = np.cumprod(powers)
        out = np.add.reduceat((flat[np.repeat(self.start, n) + within].astype(np.uint64) + np.uint64(1)) * powers[within], first)
        out = (out ^ out >> np.uint64(31)) * BASE
        return out ^ out >> np.uint64(29)

    def window(self, k: int, size: int) -> bytes:
        """The words of a window, space-joined."""
        return b" ".join(self.raw[self.start[k] : self.end[k + size - 1]].split())

    def rolled(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of all windows of ``size`` words within one text, and their hashes."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        out = np.zeros(n, np.uint64)
        for k in range(size):
            out = (out + self.hash[k : k + n]) * BASE
        text = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        whole = np.flatnonzero(text[:n] == text[size - 1 :])
        return whole, out[whole]


class Windows:
    """The benchmark's windows in flat arrays: for each length the sorted hashes, with each a place in the words and an item."""

    def __init__(self, items, n: int):
        """items: (item_id, text). An item without words has no window; a null id hits but is not listed."""
        items = list(items)
        self.ids = [None if i is None else str(i) for i, _ in items]
        self.words = Words([t for _, t in items])
        own, sizes = np.repeat(np.arange(len(items)), np.diff(self.words.at)), np.minimum(np.diff(self.words.at), n)
        self.by_length = {}
        self.words.start, self.words.end = self.words.start.astype(np.int32), self.words.end.astype(np.int32)
        lists, known = [], 0  # windows' items one after another, and how many windows there are
        for size in np.unique(sizes[sizes > 0]).tolist():
            at, hashes = self.words.rolled(size)
            mine = sizes[own[at]] == size
            at, hashes, items_ = at[mine], hashes[mine], own[at[mine]].astype(np.int32)
            order = np.lexsort((items_, hashes))
            at, hashes, items_ = at[order], hashes[order], items_[order]
            window = np.cumsum(np.concatenate(([0], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, np.int64)
            window = self._told_apart(at, window, size)
            order = np.lexsort((items_, window))
            at, hashes, items_, window = at[order], hashes[order], items_[order], window[order]
            new = np.concatenate(([True], window[1:] != window[:-1])) if len(window) else np.zeros(0, bool)
            once = new | np.concatenate(([True], items_[1:] != items_[:-1])) if len(window) else new
            by_hash = np.argsort(hashes[new], kind="stable")
            rank = np.empty(len(by_hash), np.int64)
            rank[by_hash] = np.arange(len(by_hash))
            lists.append((rank[np.cumsum(new)[once] - 1] + known, items_[once]))
            self.by_length[size] = hashes[new][by_hash], at[new][by_hash].astype(np.int32), known
            known += int(new.sum())
        windows = np.concatenate([w for w, _ in lists]) if lists else np.zeros(0, np.int64)
        owners = np.concatenate([o for _, o in lists]) if lists else np.zeros(0, np.int32)
        self.owners = owners[np.argsort(windows, kind="stable")]
        self.owners_at = np.concatenate(([0], np.cumsum(np.bincount(windows, minlength=known)))).astype(np.int64)
        self.digests: dict = {}
        del self.words.hash  # the windows' hashes are made

    def _told_apart(self, at: np.ndarray, window: np.ndarray, size: int) -> np.ndarray:
        """``window`` numbers runs of one hash; windows of other words than a run's first get numbers of their own."""
        first = at[np.flatnonzero(np.concatenate(([True], window[1:] != window[:-1])))] if len(at) else at
        odd = [k for k in np.flatnonzero(at != first[window]).tolist() if self.words.window(at[k], size) != self.words.window(first[window[k]], size)]
        if not odd:
            return window
        out, numbers = window.copy(), {}
        for k in odd:
            out[k] = numbers.setdefault((int(window[k]), self.words.window(at[k], size)), len(first) + len(numbers))
        return out

    def hits(self, docs: Words) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """The words that lie in a window, and (place, item) of each item of each occurrence."""
        hit, found = self.met(docs)
        return hit, [(k, int(o)) for k, w in found for o in self.owners[self.owners_at[w] : self.owners_at[w + 1]]]

    def met(self, docs: Words) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """The words that lie in a window, and (place, window) of each occurrence."""
        hit, found = np.zeros(len(docs.hash), bool), []
        for size, (hashes, places, before) in self.by_length.items():
            at, rolled = docs.rolled(size)
            low, high = np.searchsorted(hashes, rolled), np.searchsorted(hashes, rolled, "right")
            some = np.flatnonzero(high > low)
            for k, a, b in zip(at[some].tolist(), low[some].tolist(), high[some].tolist()):
                window = docs.window(k, size)
                for e in range(a, b):  # more than one only where windows share a hash
                    if self.words.window(places[e], size) == window:
                        hit[k : k + size] = True
                        found.append((k, before + e))
                        break
        return hit, found

    def told(self, windows: set) -> tuple[int, str]:
        """How many items have any of the windows, and the digest of their ids. Kept, as documents share what they quote."""
        key = tuple(sorted(windows))
        if key not in self.digests:
            if len(self.digests) >= KEPT_DIGESTS:
                self.digests.clear()
            owners = np.unique(np.concatenate([self.owners[self.owners_at[w] : self.owners_at[w + 1]] for w in key]))
            self.digests[key] = _digest({self.ids[o] for o in owners.tolist()})
        return self.digests[key]


#: Sets of windows of which a task keeps the items' digest.
KEPT_DIGESTS = 10_000


def _digest(items: set) -> tuple[int, str]:
    ids = sorted({i for i in items if i is not None})
    return len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()


EMPTY = hashlib.sha256(b"").hexdigest()


def _blocks(batches, text: int):
    for b in batches:
        step = max(1, min(BLOCK_ROWS, int(len(b) * BLOCK_BYTES / max(1, b.column(text).nbytes))))
        for at in range(0, len(b), step):
            yield b.slice(at, step)


def _block(windows: Windows, texts: list):
    """For each text: words, hit words, items and their digest, and which words windows cover."""
    words = Words(texts)
    hit, found = windows.met(words)
    items: list[set] = [set() for _ in texts]
    for k, window in found:
        items[int(np.searchsorted(words.at, k, "right")) - 1].add(window)
    for k, (a, b) in enumerate(zip(words.at.tolist(), words.at[1:].tolist())):
        mine = hit[a:b]
        yield b - a, int(mine.sum()), windows.told(items[k]) if items[k] else (0, EMPTY), mine


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Each document's contamination: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    A window is ``n`` consecutive words of an item (all of a shorter one). ``spans`` are the runs
    (start, end) of hit words, counted in words. One row for each row of ``docs``, repeated ids
    included. Null or empty texts have no words and no hits. Items without words match nothing;
    items with a null id hit words but are not listed; repeated ids count once. Either table may be
    empty. Columns beside those named are not read.
    """
    bench = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    n_words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))  # at least as many as there are windows
    size = bench.agg(F.sum(WINDOW_BYTES * n_words.cast("long") + F.octet_length("text"))).first()[0] or 0
    if size > broadcast_bytes:
        return _scan_by_join(docs, bench, n, id_col, text_col)
    # bounded: windows of at most broadcast_bytes come here
    held = docs.sparkSession.sparkContext.broadcast(Windows([(r[0], r[1]) for r in bench.toLocalIterator()], n))

    def run(batches):
        windows = held.value
        for part in _blocks(batches, 1):
            rows = [
                (words, hits, *told, _runs(mine) if hits else [])
                for words, hits, told, mine in _block(windows, part.column(1).to_pylist())
            ]
            w, h, k, sha, spans = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(w, pa.int64()),
                    pa.array(h, pa.int64()),
                    pa.array(k, pa.int64()),
                    pa.array(sha, pa.string()),
                    pa.array(np.array(h) > 0),
                    pa.array(spans, SPANS_ARROW),
                ],
                names=NAMES,
            )

    return saved(docs.select(F.col(id_col).cast("long"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA), "scanned")


SPANS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
NAMES = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]
SCHEMA = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "spans array<struct<start: long, end: long>>"
)


def _runs(mine: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mine.astype(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]


def _item_windows(bench: DataFrame, n: int) -> DataFrame:
    """(item, size, h, words) of each item's windows."""

    def run(batches):
        for part in _blocks(batches, 1):
            words, ids = Words(part.column(1).to_pylist()), part.column(0).to_pylist()
            sizes, own = np.minimum(np.diff(words.at), n), np.repeat(np.arange(len(ids)), np.diff(words.at))
            for size in np.unique(sizes[sizes > 0]).tolist():
                at, hashes = words.rolled(size)
                mine = sizes[own[at]] == size
                at, hashes = at[mine], hashes[mine]
                columns = [[ids[k] for k in own[at]], [size] * len(at), hashes.view(np.int64), [words.window(k, size) for k in at.tolist()]]
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["item", "size", "h", "words"])

    items = bench.select(F.col("item_id").cast("string").alias("item"), "text")
    return items.mapInArrow(run, "item string, size int, h long, words binary")


def _bit(hashes):
    return hashes >> np.uint64(64 - FILTER_BITS)


def _bitmap(windows: DataFrame) -> np.ndarray:
    """A byte array with a bit for the first FILTER_BITS bits of each window's hash: of one size for any benchmark."""
    bit = F.shiftrightunsigned("h", 64 - FILTER_BITS) + 1  # Spark numbers a bitmap's bits from 1
    parts = windows.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for bucket, bits in parts.toLocalIterator():  # at most as many buckets of 4096 bytes as the array holds
        out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bytes(bits), np.uint8)
    return out


def _scan_by_join(docs: DataFrame, bench: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """The same without a broadcast of windows: those that a bitmap lets through meet the benchmark's by hash and words. A row
    is told by a number of its own, so copies and empty texts share no key. An occurrence gets its window's number; items are
    put together once for each set of windows that documents have."""
    each = saved(_item_windows(bench, n), "item_windows")
    windows = saved(each.select("size", "h", "words").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    lengths = [r[0] for r in windows.select("size").distinct().orderBy("size").collect()]  # at most n values
    held = docs.sparkSession.sparkContext.broadcast(_bitmap(windows))

    def run(batches):
        bits, row, task = held.value, 0, TaskContext.get().partitionId() << 33
        names = ["row", "doc_id", "n_words", "pos", "size", "h", "words"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

        def out(*columns):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        for part in _blocks(batches, 1):
            words = Words(part.column(1).to_pylist())
            rows = np.arange(row, row + len(part)) + task
            row += len(part)
            none = [None] * len(part)
            yield out(rows, part.column(0), np.diff(words.at), none, none, none, none)
            for size in lengths:
                at, hashes = words.rolled(size)
                bit = _bit(hashes).astype(np.int64)
                passed = bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1
                at, hashes = at[passed], hashes[passed]
                text = np.searchsorted(words.at, at, "right") - 1
                none = [None] * len(at)
                yield out(
                    rows[text], none, none, at - words.at[text], [size] * len(at), hashes.view(np.int64), [words.window(k, size) for k in at.tolist()]
                )

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = saved(plain.mapInArrow(run, "row long, doc_id long, n_words long, pos long, size int, h long, words binary"), "windows_met")
    met = table.filter("pos is not null").select("row", "pos", "size", "h", "words")
    uses = met.groupBy("size", "h", "words").agg(F.count("*").alias("n"))
    found = attach(met, saved(windows.join(uses, ["size", "h", "words"]), "windows_used"), ["size", "h", "words"])
    per_row = saved(
        found.groupBy("row").agg(
            F.array_distinct(F.flatten(F.collect_list(F.sequence("pos", F.col("pos") + F.col("size") - 1)))).alias("at"),
            F.array_sort(F.collect_set("window")).alias("windows"),
        ),
        "rows_met",
    )
    sets = per_row.select("windows").distinct().withColumn("window", F.explode("windows"))
    used = windows.join(each, ["size", "h", "words"]).select("window", "item").distinct()
    items = F.collect_set("item")
    told = sets.join(used, "window").groupBy("windows").agg(F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"))
    per_row = per_row.join(told, "windows", "left")
    runs = per_row.withColumn("p", F.array_sort("at")).select(
        "row",
        F.size("p").cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.lit(EMPTY)).alias("items_sha256"),
        F.filter("p", lambda x, i: (i == 0) | (F.get("p", i - 1) != x - 1)).alias("a"),
        F.filter("p", lambda x, i: F.coalesce(F.get("p", i + 1) != x + 1, F.lit(True))).alias("b"),
    )
    return table.filter("pos is null").select("row", "doc_id", "n_words").join(runs, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.lit(EMPTY)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce(
            F.zip_with("a", "b", lambda x, y: F.struct(x.alias("start"), (y + 1).alias("end"))),
            F.expr("cast(array() as array<struct<start: long, end: long>>)"),
        ).alias("spans"),
    )


def remove(docs: DataFrame, scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that ``scanned`` calls contaminated. A null id is never removed."""
    bad = scanned.filter("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs[id_col] == bad["_bad"], "left_anti")
