"""SentencePiece BPE with seeded merge-dropout, over whole batches of words at once.

Every word (a run of spaces and what follows up to the next one) starts as single characters and an
agenda of candidate merges, best score first, leftmost first among equals. Each candidate that comes
up is skipped with a given probability by a hash keyed with seed, document, word, place and merge;
a skipped one is off the agenda until a neighbour changes. Words of like length go through the agenda
together as numpy matrices. The same key gives the same pieces anywhere, and pieces decode to the text.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

SPACE = "▁"
LONGEST = 48  # characters of a word that goes through the matrices; longer ones go through a heap one by one
WORDS = 1 << 15
NONE = np.iinfo(np.int32).max
A_INT, B_INT, C_INT, MASK = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, (1 << 64) - 1
A, B, C = (np.uint64(x) for x in (A_INT, B_INT, C_INT))
PLACE_BITS = 13  # symbols of a long word are counted by stretches of 2**13
BLOCK_ROWS, BLOCK_BYTES = 300, 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) of each number."""
    x = (x ^ (x >> np.uint64(30))) * B
    x = (x ^ (x >> np.uint64(27))) * C
    return x ^ (x >> np.uint64(31))


class Pieces:
    """A BPE model's pieces, and its merges in a table by open addressing."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        normal = [not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i)) for i in range(n)]
        self.id = {p: i for i, p in enumerate(names) if normal[i]}
        self.byte = np.array([self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        # symbols that are no pieces (single characters outside the vocabulary) come after the pieces
        self.size, self.extra, self.extra_names = n, {}, []
        rank = {i: r for r, i in enumerate(sorted(self.id.values(), key=lambda i: (-self.model.get_score(i), i)))}
        keys, values = [], []
        for p, i in self.id.items():
            for k in range(1, len(p)):
                left, right = self.id.get(p[:k]), self.id.get(p[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append((rank[i], i))
        self.pairs = dict(zip(keys, values))
        self.bits = 20
        while len(keys) * 4 > 1 << self.bits:
            self.bits += 1
        self.slots = np.zeros(1 << self.bits, np.uint64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        self.probes = 0
        left = np.array(keys, np.uint64)
        value = np.array([r for r, _ in values], np.int32)
        at = self._home(left)
        while len(left):  # each round places one key in each free slot; the others go one slot on
            free = self.slots[at] == 0
            _, one = np.unique(at, return_index=True)
            won = np.zeros(len(left), bool)
            won[one] = True
            won &= free
            self.slots[at[won]], self.ranks[at[won]] = left[won] + np.uint64(1), value[won]
            left, value, at = left[~won], value[~won], (at[~won] + 1) & ((1 << self.bits) - 1)
            self.probes += 1
        self.merged = np.zeros(len(rank) + 1, np.int64)
        for i, r in rank.items():
            self.merged[r] = i
        points = np.full(0x110000, -1, np.int32)
        for p, i in self.id.items():
            if len(p) == 1:
                points[ord(p)] = i
        self.points = points

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * A) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NONE where there is none."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at, out = self._home(keys), np.full(keys.shape, NONE, np.int32)
        keys = keys + np.uint64(1)
        slot = self.slots[at]
        hit = slot == keys
        out[hit] = self.ranks[at[hit]]
        open_ = np.flatnonzero(~hit & (slot != 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            slot = self.slots[at[open_]]
            hit = slot == keys[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (slot != 0)]
        return out

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """A symbol for each code point; those that are no piece get numbers beyond the pieces: size + code point."""
        found = self.points[points]
        return np.where(found >= 0, found, self.size + points.astype(np.int64))


def skipped(key: np.ndarray, place, merged, limit: np.uint64) -> np.ndarray:
    """Whether a candidate is skipped: the keyed hash of its place in the word and the piece it would make is below the limit."""
    with np.errstate(over="ignore"):
        x = key + (np.asarray(merged).astype(np.uint64) << np.uint64(20)) * A + np.asarray(place).astype(np.uint64) * C
        return mixed(x) < limit


def plain_skipped(key: int, place: int, merged: int, limit: int) -> bool:
    """skipped() for one candidate, in Python's integers."""
    x = (key + (merged << 20) * A_INT + place * C_INT) & MASK
    x = (x ^ x >> 30) * B_INT & MASK
    x = (x ^ x >> 27) * C_INT & MASK
    return x ^ x >> 31 < limit


def _matrix_words(pieces: Pieces, s: np.ndarray, key: np.ndarray, limit: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Agendas of words of one length (rows of ``s``): their symbols at the end, and how many each has."""
    words, width = s.shape
    final, lengths = s.copy(), np.full(words, width)
    if width == 1:
        return final, lengths
    live = np.arange(words)
    rank = pieces.rank_of(s[:, :-1].ravel(), s[:, 1:].ravel()).reshape(words, width - 1)
    s, n = s.copy(), np.full(words, width)
    columns = np.arange(width)
    while True:
        j = rank.argmin(axis=1)
        best = rank[np.arange(len(live)), j]
        over = best == NONE
        if over.any():
            final[live[over]], lengths[live[over]] = s[over], n[over]
            keep = ~over
            live, s, n, rank, j, best, key = live[keep], s[keep], n[keep], rank[keep], j[keep], best[keep], key[keep]
            if not len(live):
                return final, lengths
        new = pieces.merged[best]
        rank[np.arange(len(live)), j] = NONE
        go = np.flatnonzero(~skipped(key, j, new, limit))
        if not len(go):
            continue
        jj = j[go]
        # close up behind the merge, then look up its two new neighbours
        shift = np.minimum(columns[None] + (columns[None] > jj[:, None]), width - 1)
        part = np.take_along_axis(s[go], shift, 1)
        part[np.arange(len(go)), jj] = new[go]
        s[go] = part
        n[go] -= 1
        moved = np.minimum(columns[None, :-1] + (columns[None, :-1] >= jj[:, None]), width - 2)
        ranks = np.take_along_axis(rank[go], moved, 1)
        ranks[np.arange(len(go)), n[go] - 1] = NONE
        left, right = np.flatnonzero(jj > 0), np.flatnonzero(jj < n[go] - 1)
        ranks[left, jj[left] - 1] = pieces.rank_of(part[left, jj[left] - 1], part[left, jj[left]])
        ranks[right, jj[right]] = pieces.rank_of(part[right, jj[right]], part[right, jj[right] + 1])
        rank[go] = ranks


def heap_word(pieces: Pieces, symbols: list[int], key: int, limit: int) -> list[int]:
    """The same agenda for one word of any length, by a heap; places are counted in symbols as they then stand."""
    n = len(symbols)
    pairs, push, pop = pieces.pairs, heapq.heappush, heapq.heappop
    s, after, before = list(symbols), [*range(1, n), -1], list(range(-1, n - 1))
    alive = bytearray(b"\1") * n
    gone = [0] * ((n >> PLACE_BITS) + 1)  # dead symbols of each stretch, for a symbol's place among the living

    def dead_before(i):
        stretch = i >> PLACE_BITS
        return sum(gone[:stretch]) + alive.count(0, stretch << PLACE_BITS, i)

    agenda, stamp = [], [0] * n

    def add(i):
        if i >= 0 and after[i] >= 0:
            found = pairs.get(s[i] << 32 | s[after[i]])
            if found:
                push(agenda, (found[0], i, stamp[i], stamp[after[i]], found[1]))

    for i in range(n - 1):
        add(i)
    while agenda:
        _, i, a, b, new = pop(agenda)
        if not alive[i] or stamp[i] != a or after[i] < 0 or stamp[after[i]] != b:
            continue
        if limit and plain_skipped(key, i - dead_before(i), new, limit):
            continue
        j = after[i]
        s[i], alive[j], after[i] = new, 0, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        stamp[i] += 1
        stamp[j] += 1
        gone[j >> PLACE_BITS] += 1
        add(before[i])
        add(i)
    return [s[i] for i in range(n) if alive[i]]


def encode_batch(pieces: Pieces, texts: list, keys: list[int], dropout: float) -> list[np.ndarray]:
    """Ids of each text; keys: a 64-bit number for each (seed and document). None and empty texts have no ids."""
    limit = np.uint64(min(int(dropout * 2.0**64), 2**64 - 1))
    mark = ord(SPACE)
    each = []
    for t in texts:
        points = np.frombuffer((" " + t).encode("utf-32-le", "surrogatepass"), np.uint32) if t else np.zeros(0, np.uint32)
        each.append(points)
    sizes = np.array([len(p) for p in each])
    flat = np.concatenate(each) if each else np.zeros(0, np.uint32)
    if not len(flat):
        return [np.zeros(0, np.int32) for _ in texts]
    doc_start = np.zeros(len(flat), bool)
    doc_start[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    space = flat == 32
    # a literal U+2581 would decode to a space, so it is spelled in bytes like a character outside the vocabulary
    s = np.where(flat == mark, pieces.size + mark, pieces.symbols(np.where(space, mark, flat)))
    starts = np.flatnonzero(doc_start | (space & ~np.concatenate(([False], space[:-1]))))
    ends = np.concatenate((starts[1:], [len(flat)]))
    owner = np.repeat(np.arange(len(texts)), sizes)[starts]
    first = np.searchsorted(owner, owner, "left")
    with np.errstate(over="ignore"):
        key = mixed(np.array(keys, np.uint64)[owner] + (np.arange(len(starts)) - first).astype(np.uint64) * A)
    width = ends - starts
    out = np.full(len(flat), -1, np.int64)
    order = np.argsort(width, kind="stable")
    cuts = np.flatnonzero(np.diff(width[order])) + 1
    for group in np.split(order, cuts):
        w = int(width[group[0]])
        if w > LONGEST:
            for g in group:
                done = heap_word(pieces, s[starts[g] : ends[g]].tolist(), int(key[g]), int(limit))
                out[starts[g] : starts[g] + len(done)] = done
            continue
        for at in range(0, len(group), WORDS):
            part = group[at : at + WORDS]
            cells = starts[part][:, None] + np.arange(w)[None]
            final, n = _matrix_words(pieces, s[cells], key[part], limit)
            out[cells] = np.where(np.arange(w)[None] < n[:, None], final, -1)
    used = np.flatnonzero(out >= 0)
    ids, of = out[used], np.repeat(np.arange(len(texts)), sizes)[used]
    strange = np.flatnonzero(ids >= pieces.size)
    if len(strange):  # bytes of characters outside the vocabulary
        points = ids[strange] - pieces.size
        length = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        counts = np.ones(len(ids), np.int64)
        counts[strange] = length
        first = (np.cumsum(counts) - counts)[strange]
        ids, of = np.repeat(ids, counts), np.repeat(of, counts)
        lead = np.array([0, 0x00, 0xC0, 0xE0, 0xF0])
        for k in range(4):  # UTF-8's k-th byte: a lead byte with the top bits, then six bits each
            there = length > k
            value = points[there] >> (6 * (length[there] - 1 - k))
            ids[first[there] + k] = pieces.byte[lead[length[there]] | value if k == 0 else 0x80 | value & 0x3F]
    at = np.searchsorted(of, np.arange(len(texts) + 1))
    return [ids[a:b].astype(np.int32) for a, b in zip(at, at[1:])]


_LOADED: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def document_key(seed: int, doc_id: int | None) -> int:
    return xxhash.xxh64_intdigest(b"" if doc_id is None else int(doc_id).to_bytes(8, "little", signed=True), seed & (2**64 - 1))


def _blocks(batches):
    for b in batches:
        step = max(1, min(BLOCK_ROWS, int(len(b) * BLOCK_BYTES / max(1, b.column(1).nbytes))))
        for at in range(0, len(b), step):
            yield b.slice(at, step)


def encode(
    docs: DataFrame, model_path: str, dropout: float = 0.1, seed: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs``'s (doc_id, ids): piece ids of every whole text, as array<int>.

    Null and empty texts have no ids. The same seed, id and text give the same ids; rows that repeat
    both are equal. Other columns are not read. An empty table gives no rows.
    """

    def run(batches):
        pieces = loaded(model_path)
        for b in _blocks(batches):
            keys = [document_key(seed, i) for i in b.column(0).to_pylist()]
            ids = encode_batch(pieces, b.column(1).to_pylist(), keys, dropout)
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from ids; null or no ids give an empty text."""

    def run(batches):
        model = loaded(model_path).model
        for b in batches:
            texts = model.decode([x or [] for x in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, text string"
    )


def round_trip(
    docs: DataFrame, model_path: str, dropout: float = 0.1, seed: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, lossless): each text encoded, decoded again and compared with itself.

    ids_crc32 is over the ids as little-endian 32-bit integers. Null counts as empty.
    """

    def run(batches):
        pieces = loaded(model_path)
        for b in _blocks(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids = encode_batch(pieces, texts, [document_key(seed, i) for i in b.column(0).to_pylist()], dropout)
            back = pieces.model.decode([x.tolist() for x in ids])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<i4").tobytes()) for x in ids], pa.int64()),
                    pa.array([x == t for x, t in zip(back, texts)]),
                ],
                names=["doc_id", "n_tokens", "ids_crc32", "lossless"],
            )

    done = docs.select(F.col(id_col).cast("long"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, lossless boolean"
    )
    return saved(done, "round_trip")
