"""Token ids in files: blocks coded by an adaptive context-mixing range coder, each reset and checksummed.

Order 2 and order 1 each name the id that they expect next, with a trust that grows while they are
right; order 0 counts all ids. What each of the three says of order 2's id is mixed in the logistic
domain, with weights that follow the error, and corrected by what became of like cases. The range coder
then codes whether it is that id, order 1's or another, and another by order 0's counts.

A block's ids are cut into stretches that are coded side by side, a step of all of them at a time, and
share one model, so that numpy works on whole steps and the model learns from the whole block. The
model starts afresh with each block. Its arithmetic is on integers, so files read the same anywhere.

A file is a Parquet table with a row for each chunk: its place, the document ids and token counts, and
the coded blocks as bytes: HEAD, the bitmap of the ids that occur (deflated), the stretches' numbers of
16-bit words (deflated), and the words.
"""

from __future__ import annotations

import math
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, small_batches

BLOCK = 1 << 22  # ids in a block
STRETCHES, LEAST_STEPS = 8192, 512  # stretches of a block, and ids that each has at least in a large one
CHUNK_IDS = 1 << 23  # ids after which a chunk ends with its document
SLOTS = 20  # bits of order 2's table
RENEW = 32  # steps between renewals of the probabilities, fewer in the first of them
GAIN, TOTAL = 24, 1 << 21  # what an id adds to order 0's counts, and the total at which they are halved
#: An id of order 0 falls into a class by how many of these powers of 1/2 its share exceeds.
SHARES = (15, 13, 11, 9, 8, 7, 6)
HIT, SECOND, OTHER = range(3)  # the id is order 2's, order 1's or another
STATES = 16 * 16 * 2 * 8  # trust in order 2, in order 1, whether they agree, order 0's class
LEAST, MOST = 24, 65_000  # bounds of a probability out of 2**16
U = np.uint64
TOP, WORD, LOW32 = U(1 << 32), U(16), U(0xFFFFFFFF)
HEAD = np.dtype([("n", "<u4"), ("crc", "<u4"), ("stretches", "<u4"), ("ids", "<u4"), ("sizes", "<u4"), ("words", "<u4")])

#: A logistic in fixed point, out of 2**16, for -2048 to 2047 in units of 1/256.
SQUASH = np.array([min(MOST, max(LEAST, round(65536 / (1 + math.exp(-d / 256))))) for d in range(-2048, 2048)], np.int64)
MOST_TRUST = 15
#: Bits of the table of where order 0's slots lie, and ids that are tried from there one after another.
PLACES, TRIED = 16, 4


def _stretch(p):
    return np.minimum(np.searchsorted(SQUASH, np.clip(p, LEAST, MOST)), 4095) - 2048


class Model:
    """The adaptive state of a block over its ids numbered from 0; encoder and decoder drive it alike.

    A table's entry is an id and the trust in it. Where several stretches write one entry in a step
    the last of them counts.
    """

    def __init__(self, ids: int, stretches: int):
        self.t = 0
        self.counts = np.ones(ids, np.int64)
        self.tables = np.zeros(ids, np.int32), np.zeros(1 << SLOTS, np.int32)
        self.one, self.two = np.zeros(stretches, np.int32), np.zeros(stretches, np.int32)
        self.seen = np.zeros((3, STATES), np.int64)
        self.weights = [160, 130, 60, 0]
        self.cases = np.zeros((RENEW, stretches), np.intp)
        self.others: list[np.ndarray] = []
        self._renew()

    def _learn(self, steps: int):
        """Takes in what the last ``steps`` steps brought."""
        last = (self.t - 1) % RENEW + 1
        new = np.bincount(self.cases[last - steps : last].ravel(), minlength=3 * STATES).reshape(3, STATES)
        n = new.sum(axis=0)
        error = (new[HIT] << 16) - n * self.mixed
        for k, x in enumerate(self.inputs):
            self.weights[k] += int((error * x).sum()) // int(n.sum()) >> 11
        self.seen += new
        if self.others:
            self.counts += GAIN * np.bincount(np.concatenate(self.others), minlength=len(self.counts))
            self.others = []
        while self.counts.sum() > max(TOTAL, 4 * len(self.counts)):
            self.counts = (self.counts + 1) >> 1

    def _renew(self):
        """Order 0's sums, and for each state the mixed probabilities as the coder takes them."""
        self.sums = np.concatenate(([0], np.cumsum(self.counts)))
        self.total, self.places = int(self.sums[-1]), None
        self.share = sum((self.counts > self.total >> s).astype(np.int32) for s in SHARES)
        hit, second, other = (x.reshape(16, 16, 2, 8) for x in self.seen)
        n = hit + second + other

        def said(*axes):
            rate = (hit.sum(axes, keepdims=True) * 65536 + 6554) // (n.sum(axes, keepdims=True) + 1)
            return np.broadcast_to(_stretch(rate), n.shape).reshape(-1)

        self.inputs = said(1, 2, 3), said(0, 3), said(0, 1, 2), np.full(STATES, 256)
        dot = sum(w * x for w, x in zip(self.weights, self.inputs)) >> 8
        self.mixed = SQUASH[np.clip(dot, -2048, 2047) + 2048]
        first = np.clip((self.seen[HIT] * 65536 + 24 * self.mixed) // (self.seen.sum(axis=0) + 24), LEAST, MOST)
        usual = (second.sum((0, 3), keepdims=True) * 65536 + 3000) // ((second + other).sum((0, 3), keepdims=True) + 1)
        then = np.clip((second * 65536 + 12 * usual) // (second + other + 12), LEAST, MOST).reshape(-1)
        then = np.maximum(1, (65536 - first) * then >> 16)
        then[(np.arange(STATES) >> 3) & 1 == 1] = 0  # where they agree there is no second id
        both = first + then
        self.first, self.both = first.astype(np.int32), both.astype(np.int32)
        self.start = np.concatenate([np.zeros(STATES, np.int64), first, both]).astype(U)
        self.freq = np.concatenate([first, then, 65536 - both]).astype(U)

    def predict(self):
        """Sets the expected ids ``a`` and ``b`` of orders 2 and 1 and the state of each stretch."""
        mixed = self.one * np.int32(0x2F0B4C47) + self.two * np.int32(0x1D8AF067)
        # numpy takes and puts by its own index type much faster
        self.at, self.own = ((mixed >> 7) & np.int32((1 << SLOTS) - 1)).astype(np.intp), self.one.astype(np.intp)
        x, y = self.tables[1].take(self.at), self.tables[0].take(self.own)
        self.entries, self.a, self.b, self.trust = (x, y), x >> 4, y >> 4, (x & 15, y & 15)
        agree = self.a == self.b
        self.state = ((((self.trust[0] << 4) | self.trust[1]) << 1 | agree) << 3 | self.share.take(self.a)).astype(np.intp)

    def ids_at(self, slots: np.ndarray) -> np.ndarray:
        """Order 0's ids at some of its slots: a table names an id near below, from where few steps lead to most."""
        if self.places is None:
            self.shift = max(0, self.total.bit_length() - PLACES)
            self.places = np.searchsorted(self.sums, np.arange(0, self.total, 1 << self.shift), "right") - 1
        ids = self.places.take(slots >> self.shift)
        below = np.flatnonzero(self.sums.take(ids + 1) <= slots)
        for _ in range(TRIED):
            if not len(below):
                return ids
            ids[below] = now = ids[below] + 1
            below = below[self.sums.take(now + 1) <= slots[below]]
        ids[below] = np.searchsorted(self.sums, slots[below], "right") - 1
        return ids

    def update(self, ids: np.ndarray, cases: np.ndarray, others: np.ndarray):
        self.cases[self.t % RENEW] = cases
        if len(others):
            self.others.append(others)
        new = ids << 4 | 1
        for table, at, entry, guess, trust in (
            (self.tables[0], self.own, self.entries[1], self.b, self.trust[1]),
            (self.tables[1], self.at, self.entries[0], self.a, self.trust[0]),
        ):
            # an entry's last bits are its trust: one more where it was right, else one less, or the id that came in its place
            table[at] = np.where(guess == ids, entry + (trust < MOST_TRUST), np.where(trust < 2, new, entry - 1))
        self.two, self.one = self.one, ids
        self.t += 1
        early = self.t < RENEW and self.t & (self.t - 1) == 0
        if early or self.t % RENEW == 0:
            self._learn(max(1, self.t // 2) if self.t <= RENEW else RENEW)
            self._renew()


class Encoder:
    """A range coder of 48 bits for each stretch, 16-bit words out; carries are added in at the end."""

    def __init__(self, stretches: int):
        self.low, self.range = np.zeros(stretches, U), np.full(stretches, (1 << 48) - 1, U)
        self.owners, self.words = [], []

    def put_all(self, start, freq):
        """A symbol out of 2**16 in every stretch."""
        r = self.range >> WORD
        self.low += start * r
        self.range = freq * r
        self._emit(np.flatnonzero(self.range < TOP))

    def put(self, some, start, freq, total: int):
        r = self.range[some] // U(total)
        self.low[some] += start.astype(U) * r
        self.range[some] = r = freq.astype(U) * r
        self._emit(some[r < TOP])

    def _emit(self, some):
        while len(some):
            low = self.low[some]
            self.owners.append(some.astype(np.uint16))
            self.words.append((low >> U(32)).astype(np.uint32))  # 17 bits: the top one is a carry
            self.low[some] = (low & LOW32) << WORD
            self.range[some] = r = self.range[some] << WORD
            some = some[r < TOP]

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """The words of all stretches, one after another, and how many each has."""
        every = np.arange(len(self.low))
        for _ in range(3):
            self.range[:] = 1 << 20
            self.owners.append(every.astype(np.uint16))
            self.words.append((self.low >> U(32)).astype(np.uint32))
            self.low = (self.low & LOW32) << WORD
        owners, words = np.concatenate(self.owners), np.concatenate(self.words)
        words = words[np.argsort(owners, kind="stable")]
        while (carry := words >> 16).any():  # a carry runs on only through words that are full
            words &= 0xFFFF
            words[:-1] += carry[1:]
        return words.astype("<u2"), np.bincount(owners, minlength=len(every)).astype("<u4")


class Decoder:
    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.words = np.concatenate([words, np.zeros(4, words.dtype)]).astype(U)
        self.at = np.cumsum(sizes, dtype=np.int64) - sizes
        self.code = self.words[self.at] << U(32) | self.words[self.at + 1] << U(16) | self.words[self.at + 2]
        self.at += 3
        self.range = np.full(len(sizes), (1 << 48) - 1, U)

    @staticmethod
    def _slots(code, r, total):
        # exact in doubles: both lie below 2**48, and a quotient is never nearer to the next integer than they resolve
        return np.minimum((code.astype(np.float64) / r.astype(np.float64)).astype(np.int64), total - 1)

    def slots_all(self):
        self.r = self.range >> WORD
        return self._slots(self.code, self.r, 1 << 16)

    def take_all(self, start, freq):
        self.code -= start * self.r
        self.range = freq * self.r
        self._fill(np.flatnonzero(self.range < TOP))

    def slots(self, some, total: int):
        self.r = self.range[some] // U(total)
        return self._slots(self.code[some], self.r, total)

    def take(self, some, start, freq):
        self.code[some] -= start.astype(U) * self.r
        self.range[some] = r = freq.astype(U) * self.r
        self._fill(some[r < TOP])

    def _fill(self, some):
        while len(some):
            at = self.at[some]
            self.code[some] = self.code[some] << WORD | self.words.take(at, mode="clip")
            self.at[some] = at + 1
            self.range[some] = r = self.range[some] << WORD
            some = some[r < TOP]


def _encode_block(ids: np.ndarray) -> bytes:
    n = len(ids)
    occurs = np.zeros(int(ids.max()) + 1, bool)
    occurs[ids] = True
    stretches = max(1, min(STRETCHES, n // LEAST_STEPS))
    rows = np.zeros(stretches * -(-n // stretches), np.int32)
    rows[:n] = (np.cumsum(occurs, dtype=np.int32) - 1).take(ids)
    model, coder = Model(int(occurs.sum()), stretches), Encoder(stretches)
    for now in np.ascontiguousarray(rows.reshape(stretches, -1).T):
        model.predict()
        hit, second = model.a == now, model.b == now
        cases = model.state + np.where(hit, 0, np.where(second, STATES, 2 * STATES))
        coder.put_all(model.start.take(cases), model.freq.take(cases))
        others = np.flatnonzero(~(hit | second))
        values = now[others].astype(np.intp)
        if len(others):
            coder.put(others, model.sums.take(values), model.counts.take(values), model.total)
        model.update(now, cases, values)
    words, sizes = coder.finish()
    known, sizes = zlib.compress(np.packbits(occurs).tobytes()), zlib.compress(sizes.tobytes())
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    head = np.array([(n, crc, stretches, len(known), len(sizes), len(words))], HEAD)
    return b"".join([head.tobytes(), known, sizes, words.tobytes()])


def _decode_block(head, known: bytes, sizes: bytes, words: np.ndarray) -> np.ndarray:
    ids = np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(known), np.uint8)))
    n, stretches = int(head["n"]), int(head["stretches"])
    model, coder = Model(len(ids), stretches), Decoder(words, np.frombuffer(zlib.decompress(sizes), "<u4"))
    out = np.empty((-(-n // stretches), stretches), np.int32)
    for t in range(len(out)):
        model.predict()
        slots = coder.slots_all()
        miss, other = slots >= model.first.take(model.state), slots >= model.both.take(model.state)
        cases = model.state + (miss.astype(np.intp) + other) * STATES
        coder.take_all(model.start.take(cases), model.freq.take(cases))
        now = np.where(miss, model.b, model.a)
        values = others = np.flatnonzero(other)
        if len(others):
            values = model.ids_at(coder.slots(others, model.total))
            coder.take(others, model.sums.take(values), model.counts.take(values))
            now[others] = values
        out[t] = now
        model.update(now, cases, values)
    ids = ids.take(out.T.reshape(-1)[:n])
    if zlib.crc32(ids.astype("<u4").tobytes()) != int(head["crc"]):
        raise ValueError("a block's checksum does not match its ids")
    return ids


def encode_ids(ids: np.ndarray, id_bits: int = 16) -> bytes:
    """The coded blocks of ``ids``, which lie below 2**id_bits (at most 24)."""
    ids = np.asarray(ids, np.int64)
    if not 8 <= id_bits <= 24 or len(ids) and (ids.min() < 0 or ids.max() >> id_bits):
        raise ValueError(f"ids must lie in 0 to 2**{id_bits} - 1")
    return b"".join(_encode_block(ids[k : k + BLOCK]) for k in range(0, len(ids), BLOCK))


def decode_ids(raw: bytes) -> np.ndarray:
    """The ids of coded blocks. A block whose ids don't have its checksum is an error."""
    out, at = [], 0
    while at < len(raw):
        head = np.frombuffer(raw, HEAD, 1, at)[0]
        ends = at + HEAD.itemsize + np.cumsum([0, int(head["ids"]), int(head["sizes"]), 2 * int(head["words"])])
        a, b, c, at = ends.tolist()
        try:
            out.append(_decode_block(head, raw[a:b], raw[b:c], np.frombuffer(raw, "<u2", int(head["words"]), c)))
        except (zlib.error, IndexError) as damage:
            raise ValueError("a block is damaged") from damage
    return np.concatenate(out) if out else np.zeros(0, np.int64)


#: Pieces of words of which a task keeps the ids; as many again from before.
HELD = 600_000
#: Text that this module cuts itself has none of these, only white space, printable ASCII and the letters of Latin-1, and no special token.
ODD = re.compile("[^\t-\r -~\xc0-\xd6\xd8-\xf6\xf8-\xff]")
#: How the vocabulary's own pattern cuts such text once it is in lower case.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\\sa-z0-9\xdf-\xf6\xf8-\xff]+")
#: Bytes of texts that are put to the tokenizer at a time.
GATHERED_BYTES = 12 << 20
#: Different words after which pieces that are held are counted.
WORDS = 10_000
_LOADED: dict = {}


def _is_plain(text: str) -> bool:
    return "<|" not in text and not ODD.search(text)


class Recent(dict):
    """Values by key, made where missing; the less recent half goes when there are too many."""

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, key):
        value = self.before.get(key)
        self[key] = value = self.make(key) if value is None else value
        return value

    def trim(self):
        if len(self) > HELD:
            self.before = dict(self)
            self.clear()


class Tokenizer:
    """A tokenizer of the tokenizers library with the ids of pieces seen before.

    Plain text is cut as the library cuts it, and new pieces are put to its model. In other text the words that aren't
    plain go to the library, and a text with control characters that Python and the library take differently
    for white space goes to it whole. ``plain`` says whether the vocabulary cuts text as PIECES
    does; that is tested when it is loaded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Library.from_file(path)
        by_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        # letters beyond ASCII as the model takes them, byte by byte
        self.bytes = {c: by_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.model = self.library.model
        self.pieces, self.plain = Recent(self._piece), True
        sample = "It's we'll 'tis A1B22 x.y,z!? \xc9t\xe9\xdf \xd6L  don'ta\n--''-- \xfcber[3]{4}_5"
        self.plain = self._plain(sample) == self._ids(sample)

    def _ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.translate(self.bytes)
        ids = [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, PIECES.findall(text.lower())))

    def _other(self, text: str) -> bytes:
        """A text that isn't plain as a whole."""
        if not self.plain or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._ids(text)
        return b"".join([self._plain(w) if _is_plain(w) else self._ids(w) for w in text.split()])

    def _plain_texts(self, texts: list) -> list[bytes]:
        """Ids of plain texts: Arrow lower-cases them, cuts them at white space and numbers their words, so each different word is
        cut once, and one of letters alone not at all."""
        cut = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
        words = cut.flatten().dictionary_encode()
        get, pieces, each, distinct = self.pieces.__getitem__, PIECES.findall, [], words.dictionary
        for at in range(0, len(distinct), WORDS):
            some = distinct.slice(at, WORDS).to_numpy(zero_copy_only=False).tolist()
            each += [get(w) if w.isalpha() else b"".join(map(get, pieces(w))) for w in some]
            self.pieces.trim()
        flat = np.frombuffer(b"".join(each), "<u4")
        sizes = np.fromiter(map(len, each), np.int64, len(each)) >> 2
        code = words.indices.to_numpy().astype(np.intp)
        n = sizes.take(code)
        ends = np.concatenate(([0], np.cumsum(n)))
        # every word's ids, one after another; so many texts have fewer than 2**31
        shift = ((np.cumsum(sizes) - sizes).take(code) - ends[:-1]).astype(np.int32)
        ids = flat[np.repeat(shift, n) + np.arange(ends[-1], dtype=np.int32)]
        at = ends.take(cut.offsets.to_numpy()).tolist()
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:])]

    def encode(self, texts: list, end: int) -> list[bytes]:
        """Ids of each text and the end id, as little-endian 32-bit integers."""
        tail, plain = struct.pack("<I", end), [bool(t) and self.plain and _is_plain(t) for t in texts]
        whole = iter(self._plain_texts([t for t, p in zip(texts, plain) if p]))
        return [(next(whole) if p else self._other(t) if t else b"") + tail for t, p in zip(texts, plain)]


def tokenizer(path: str) -> Tokenizer:
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def _gathered(batches):
    """Batches together up to some bytes: the more text, the more often a word has been met in it."""
    held, size = [], 0
    for b in batches:
        if len(b):
            held.append(b)
            size += b.nbytes
        if size >= GATHERED_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


FILE = "part int, chunk int, n_ids long, doc_ids array<long>, counts array<long>, blocks binary"


def write(
    docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 2, id_bits: int = 16, id_col="doc_id", text_col="text"
) -> None:
    """Encodes every whole text, appends ``end_id`` and writes all ids in ascending doc_id order (nulls first) to ``path``.

    Null texts count as empty and give the end id alone; rows that repeat an id follow one another.
    An empty table gives a file without chunks.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    # the text's hash only breaks ties between rows of one id
    spread = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
    ordered = spread.sortWithinPartitions("doc_id", "tie").select("doc_id", "text", F.spark_partition_id().alias("part"))

    def run(batches):
        known, chunk, part = tokenizer(tokenizer_path), 0, 0
        ids, raw, held = [], [], 0

        def row():
            flat = np.frombuffer(b"".join(raw), "<u4")
            columns = [[part], [chunk], [len(flat)], [ids], [[len(x) // 4 for x in raw]], [encode_ids(flat, id_bits)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["part", "chunk", "n_ids", "doc_ids", "counts", "blocks"],
            )

        for table in _gathered(batches):
            part = table.column(2)[0].as_py()
            for i, x in zip(table.column(0).to_pylist(), known.encode(table.column(1).to_pylist(), end_id)):
                ids.append(i)
                raw.append(x)
                held += len(x) // 4
                if held >= CHUNK_IDS:
                    yield row()
                    ids, raw, held, chunk = [], [], 0, chunk + 1
        if raw:
            yield row()

    with small_batches(docs.sparkSession):
        ordered.mapInArrow(run, FILE).write.parquet(path)


def read(files: DataFrame) -> DataFrame:
    """(part, chunk, at, doc_id, n_tokens, ids) of each document in the files; ``at`` counts the chunk's ids before it."""
    return _read(files, lambda ids: ids, pa.list_(pa.int64()), "ids array<long>")


def digests(files: DataFrame) -> DataFrame:
    """As read(), with the CRC-32 of a document's ids as little-endian 32-bit integers in place of them."""
    return _read(files, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64(), "ids_crc32 long")


def _read(files: DataFrame, of, kind, column: str) -> DataFrame:
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = decode_ids(r["blocks"])
                ends = np.cumsum(r["counts"])
                starts = ends - r["counts"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["part"]] * len(ends), pa.int32()),
                        pa.array([r["chunk"]] * len(ends), pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(r["doc_ids"], pa.int64()),
                        pa.array(r["counts"], pa.int64()),
                        pa.array([of(ids[a:z]) for a, z in zip(starts, ends)], kind),
                    ],
                    names=["part", "chunk", "at", "doc_id", "n_tokens", column.split()[0]],
                )

    names = files.select("part", "chunk", "doc_ids", "counts", "blocks")
    return names.mapInArrow(run, f"part int, chunk int, at long, doc_id long, n_tokens long, {column}")


def starts(files: DataFrame) -> DataFrame:
    """(part, chunk, before): ids in all chunks before each. Sums within a part, then over the parts' totals, of which there
    are as many as tasks that wrote."""
    chunks = files.select("part", "chunk", "n_ids")
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("total"))
    offset = parts.select("part", (F.sum("total").over(W.orderBy("part")) - F.col("total")).alias("offset"))
    own = F.sum("n_ids").over(W.partitionBy("part").orderBy("chunk")) - F.col("n_ids")
    return chunks.withColumn("own", own).join(offset, "part").select(
        "part", "chunk", (F.col("own") + F.col("offset")).cast("long").alias("before")
    )


def placed(files: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` of read() or digests() with ``start``, the ids of all documents before each. Chunks are many only where ids
    are; their starts are broadcast while they are few."""
    before = starts(files)
    if 32 * files.count() <= BROADCAST_BYTES:
        before = F.broadcast(before)
    return rows.join(before, ["part", "chunk"]).withColumn("start", F.col("before") + F.col("at")).drop("before")
