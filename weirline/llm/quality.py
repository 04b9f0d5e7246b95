"""Quality by perplexity under an interpolated modified Kneser-Ney model of character n-grams.

The model is counted on trusted text: raw counts for the longest order, counts of distinct left
neighbours below it. Counts, their contexts and the grams that documents ask for are tables of grams, and
joins of those shards give the log probability of every gram asked for. A document's
perplexity follows from its grams'; it is accepted up to a quantile of the perplexities that trusted
documents of its language have which the model was not counted on.

A gram is up to five code points, packed without loss into two longs: ``lo`` holds the last three of them and
``hi`` those before.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, saved

ORDER = 5
BITS, IN_LO = 21, 3  # bits of a code point, and code points in lo
BLOCK_BYTES, BLOCK_ROWS, HELD_GRAMS = 1 << 19, 500, 800_000
#: One trusted document of so many is kept from the model for the thresholds.
HELD_OUT = 5
#: Bytes of a gram's hash and score in the broadcast table.
SCORE_BYTES = 12
#: Rows up to which the table of languages is broadcast.
LANGUAGES = 100_000
MIX, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def symbols(text: str | None) -> np.ndarray:
    """A text's code points."""
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """hi and lo of the grams that end at each code point of the texts, one text after another, and how many each text has."""
    each = [symbols(t) for t in texts]
    pad = np.zeros(ORDER - 1, np.uint32)
    flat = np.concatenate([x for s in each for x in (pad, s)] or [pad]).astype(np.uint64)
    n = np.array([len(s) for s in each], np.int64)
    size = len(flat) - ORDER + 1
    hi, lo = np.zeros(max(0, size), np.uint64), np.zeros(max(0, size), np.uint64)
    for k in range(ORDER):
        into = hi if k < ORDER - IN_LO else lo
        into <<= np.uint64(BITS)
        into |= flat[k : size + k]
    # a gram counts where its last symbol is one of the text's, not of the padding before it
    real = np.repeat(np.tile([False, True], len(n)), np.column_stack([np.full(len(n), ORDER - 1), n]).ravel())
    return hi[real[ORDER - 1 :]], lo[real[ORDER - 1 :]], n


def _hashed(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    out = (hi * MIX + lo) * MIX2
    return out ^ out >> np.uint64(29)


def _cut(batches):
    for b in batches:
        step = max(1, min(BLOCK_ROWS, int(len(b) * BLOCK_BYTES / max(1, b.column(0).nbytes))))
        for at in range(0, len(b), step):
            yield b.slice(at, step)


def _distinct(hi, lo, n):
    """Each gram once with the sum of its n."""
    _, at, back = np.unique(_hashed(hi, lo), return_index=True, return_inverse=True)
    return hi[at], lo[at], np.bincount(back, n, len(at)).astype(np.int64)


def _gram_rows(*columns):
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["hi", "lo", "n"])


def _count(batches):
    """Grams of all texts with their number in counted ones, summed within the task while they are few enough to hold."""

    held: list = []
    for part in _cut(batches):
        hi, lo, n = _grams(part.column(0).to_pylist())
        held.append(_distinct(hi, lo, np.repeat(np.array(part.column(1).to_pylist(), np.int64), n)))
        if sum(len(x[0]) for x in held) > HELD_GRAMS:
            held = [_distinct(*(np.concatenate(x) for x in zip(*held)))]
            if len(held[0][0]) > HELD_GRAMS // 2:
                yield _gram_rows(*held.pop())
    if held:
        yield _gram_rows(*_distinct(*(np.concatenate(x) for x in zip(*held))))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """D1, D2 and D3+ from how many grams occur once to four times."""
    row = counts.agg(*(F.count(F.when(F.col("n") == k, 1)) for k in (1, 2, 3, 4))).first()
    n1, n2, n3, n4 = (float(x) for x in row)
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a else k * 0.5
        out.append(min(max(d, 0.1), k - 0.01))
    return tuple(out)


def _context(hi, lo):
    """A gram without its last code point."""
    high = F.shiftleft(hi.bitwiseAND(F.lit((1 << BITS) - 1)), BITS * (IN_LO - 1))
    return F.shiftright(hi, BITS), F.shiftright(lo, BITS).bitwiseOR(high)


def _suffix(hi, lo, k: int):
    """The last k code points of a gram."""
    return hi.bitwiseAND(F.lit((1 << BITS * max(0, k - IN_LO)) - 1)), lo.bitwiseAND(F.lit((1 << BITS * min(k, IN_LO)) - 1))


def gram_scores(grams: DataFrame) -> DataFrame:
    """(hi, lo, logp) for every gram of ``grams`` (hi, lo, n), of which those with n > 0 make the model.

    Interpolated modified Kneser-Ney: p_k(w|h) = (c - D(c)) / c(h) + lambda(h) * p_{k-1}(w|h'), down to
    the uniform distribution over the symbols counted and one more; an unseen context leaves all to the next
    order. Every step is a join or an aggregate hashed by gram or context.
    """
    hi, lo = F.col("hi"), F.col("lo")
    counts = grams.filter("n > 0")
    tables = []  # from the longest order down: (probabilities' parts, contexts)
    for k in range(ORDER, 0, -1):
        d1, d2, d3 = _discounts(counts)
        d = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        ch, cl = _context(hi, lo)
        parts = counts.select("hi", "lo", ch.alias("ch"), cl.alias("cl"), "n", d.alias("d"))
        contexts = parts.groupBy("ch", "cl").agg(F.sum("n").alias("total"), F.sum("d").alias("held"))
        contexts = contexts.select("ch", "cl", "total", (F.col("held") / F.col("total")).alias("rest"))
        tables.append((k, parts, contexts))
        if k > 1:
            sh, sl = _suffix(hi, lo, k - 1)
            counts = saved(counts.groupBy(sh.alias("hi"), sl.alias("lo")).agg(F.count("*").alias("n")), "counts")
    uniform = 1.0 / (counts.count() + 1)
    lower = None
    for k, parts, contexts in reversed(tables):
        own = parts.join(contexts, ["ch", "cl"]).withColumn("own", (F.col("n") - F.col("d")) / F.col("total"))
        if lower is None:
            p = own.select("hi", "lo", (F.col("own") + F.col("rest") * uniform).alias("p"))
        else:
            sh, sl = _suffix(hi, lo, k - 1)
            below = lower[0].select(F.col("hi").alias("sh"), F.col("lo").alias("sl"), F.col("p").alias("below"))
            p = own.withColumns({"sh": sh, "sl": sl}).join(below, ["sh", "sl"])
            p = p.select("hi", "lo", (F.col("own") + F.col("rest") * F.col("below")).alias("p"))
        lower = (saved(p, f"order{k}"), contexts, lower)
    asked = grams.select("hi", "lo")
    chain, weight, value = lower, F.lit(1.0), F.lit(None).cast("double")
    for k in range(ORDER, 0, -1):
        table, contexts, chain = chain
        gh, gl = _suffix(hi, lo, k)
        ch, cl = _context(gh, gl)
        asked = (
            asked.withColumns({"gh": gh, "gl": gl, "ch": ch, "cl": cl})
            .join(table.toDF("gh", "gl", f"p{k}"), ["gh", "gl"], "left")
            .join(contexts.select("ch", "cl", F.col("rest").alias(f"rest{k}")), ["ch", "cl"], "left")
            .drop("gh", "gl", "ch", "cl")
        )
        value = F.coalesce(value, weight * F.col(f"p{k}"))
        weight = weight * F.coalesce(F.col(f"rest{k}"), F.lit(1.0))
    return asked.select("hi", "lo", F.log(F.coalesce(value, weight * uniform)).alias("logp"))


def _sums(texts: list, keys: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and summed squared log probability of each text; summed text by text, so blocks don't matter."""
    hi, lo, n = _grams(texts)
    found = logp[np.searchsorted(keys, _hashed(hi, lo))] if len(hi) else np.zeros(0)
    found = found * found
    at = np.concatenate(([0], np.cumsum(n))).tolist()
    return n, np.array([found[a:b].sum() for a, b in zip(at, at[1:])], np.float64)


RESULT = "doc_id long, lang string, text_hash long, part int, n_symbols long, squares double"
#: What a document is to the model: unknown, counted, or trusted but kept from it.
UNKNOWN, COUNTED, KEPT = 0, 1, 2


def _rows(batch, n, squares):
    """The batch is of (text, counted, doc_id, lang, text_hash, part)."""
    return pa.RecordBatch.from_arrays(
        [*batch.columns[2:], pa.array(n, pa.int64()), pa.array(squares, pa.float64())],
        names=["doc_id", "lang", "text_hash", "part", "n_symbols", "squares"],
    )


def _score_by_broadcast(rows: DataFrame, scores: DataFrame) -> DataFrame:
    table = scores.select("hi", "lo", F.col("logp").cast("float")).toArrow()  # bounded: its size has been checked
    hi, lo, logp = (table.column(c).to_numpy() for c in table.column_names)
    keys = _hashed(hi.astype(np.uint64), lo.astype(np.uint64))
    order = np.argsort(keys)
    held = rows.sparkSession.sparkContext.broadcast((keys[order], logp[order]))

    def run(batches):
        for part in _cut(batches):
            yield _rows(part, *_sums(part.column(0).to_pylist(), *held.value))

    return rows.mapInArrow(run, RESULT)


def _uncounted(batches):
    """Without a model: the symbols of each text, of which none costs anything."""
    for part in _cut(batches):
        _, _, n = _grams(part.column(0).to_pylist())
        yield _rows(part, n, np.zeros(len(n)))


def _frequent(rows: DataFrame, scores: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` grams that most blocks of texts hold, as sorted hashes, and their scores: what blocks need not ask for."""

    def held(batches):
        each: list = []
        for part in _cut(batches):
            hi, lo, _ = _grams(part.column(0).to_pylist())
            each.append(_distinct(hi, lo, np.ones(len(hi), np.int64))[:2])
            each[-1] = (*each[-1], np.ones(len(each[-1][0]), np.int64))
            if sum(len(x[0]) for x in each) > HELD_GRAMS:
                each = [_distinct(*(np.concatenate(x) for x in zip(*each)))]
                if len(each[0][0]) > HELD_GRAMS // 2:
                    yield _gram_rows(*each.pop())
        if each:
            yield _gram_rows(*_distinct(*(np.concatenate(x) for x in zip(*each))))

    often = rows.select("text").mapInArrow(held, "hi long, lo long, n long").groupBy("hi", "lo").agg(F.sum("n").alias("n"))
    top = often.filter("n > 1").orderBy(F.desc("n"), "hi", "lo").limit(most)
    table = saved(top.join(scores, ["hi", "lo"]).select("hi", "lo", F.col("logp").cast("float")), "frequent_grams").toArrow()  # bounded
    hi, lo, logp = (table.column(c).to_numpy() for c in table.column_names)
    keys = _hashed(hi.astype(np.uint64), lo.astype(np.uint64))
    order = np.argsort(keys)
    return keys[order], logp[order]


def _score_by_block(rows: DataFrame, scores: DataFrame, most: int) -> DataFrame:
    """Beyond what is broadcast: each block of texts asks for its own distinct grams and is met by them. The ``most`` most frequent
    grams are broadcast all the same, so that no gram is asked for by very many blocks, and a block asks for few."""
    hot = rows.sparkSession.sparkContext.broadcast(_frequent(rows, scores, most))
    fields = [("text", pa.string()), ("counted", pa.bool_()), ("doc_id", pa.int64()), ("lang", pa.string()), ("text_hash", pa.int64()), ("part", pa.int32())]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct(fields))]
    names = ["block", "hi", "lo", "rows"]

    def pack(batches):
        task = TaskContext.get().partitionId()
        for k, part in enumerate(_cut(batches)):
            block = (task << 32) + k
            hi, lo, _ = _grams(part.column(0).to_pylist())
            hi, lo, _ = _distinct(hi, lo, np.zeros(len(hi), np.int64))
            keys = hot.value[0]
            if len(keys):
                hashes = _hashed(hi, lo)
                rare = keys[np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)] != hashes
                hi, lo = hi[rare], lo[rare]
            whole = [[block], [None], [None], [part.to_pylist()]]
            for columns in (whole, [[block] * len(hi), hi.astype(np.int64), lo.astype(np.int64), [None] * len(hi)]):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    row = "text string, counted boolean, doc_id long, lang string, text_hash long, part int"
    table = saved(rows.mapInArrow(pack, f"block long, hi long, lo long, rows array<struct<{row}>>"), "blocks")
    wanted = table.filter("hi is not null").select(F.col("block").alias("of"), "hi", "lo").join(scores, ["hi", "lo"])
    texts = table.filter("hi is null").select("block", "rows")

    def score(left, right):
        keys = _hashed(right.column("hi").to_numpy().astype(np.uint64), right.column("lo").to_numpy().astype(np.uint64))
        keys = np.concatenate([keys, hot.value[0]])
        logp = np.concatenate([right.column("logp").to_numpy().astype(np.float32), hot.value[1].astype(np.float32)])
        order = np.argsort(keys)
        keys, logp = keys[order], logp[order]
        out = []
        for r in left.column("rows").to_pylist():
            part = pa.RecordBatch.from_pylist(r, schema=pa.schema(fields))
            out.append(_rows(part, *_sums(part.column(0).to_pylist(), keys, logp)))
        return pa.Table.from_batches(out)

    return texts.groupBy("block").cogroup(wanted.groupBy("of")).applyInArrow(score, RESULT)


def perplexities(
    docs: DataFrame, trusted_ids: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", broadcast_bytes=BROADCAST_BYTES
) -> DataFrame:
    """(doc_id, lang, text_hash, part, n_symbols, squares) for each row of ``docs``: whether it is one of the documents that the model
    is counted on, and the sum of its symbols' squared log probabilities."""
    marks = trusted_ids.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_t")).distinct()
    if 8 * marks.count() <= broadcast_bytes:
        marks = F.broadcast(marks)
    plain = docs.select(
        F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
    )
    # by the text, so that copies of a document are on one side
    kept = F.pmod(F.xxhash64("text_hash"), F.lit(HELD_OUT)) == 0
    part = F.when(F.col("_t").isNull(), UNKNOWN).when(kept, KEPT).otherwise(COUNTED)
    rows = plain.join(marks, F.col("doc_id") == F.col("_t"), "left").select(
        "text", (part == COUNTED).alias("counted"), "doc_id", "lang", "text_hash", part.cast("int").alias("part")
    )
    counted = rows.select("text", "counted").mapInArrow(_count, "hi long, lo long, n long")
    grams = saved(counted.groupBy("hi", "lo").agg(F.sum("n").alias("n")), "grams")
    if grams.filter("n > 0").isEmpty():  # no model: every symbol is as likely as any other, which is certain
        return rows.mapInArrow(_uncounted, RESULT)
    scores = saved(gram_scores(grams), "scores")
    if SCORE_BYTES * scores.count() <= broadcast_bytes:
        return _score_by_broadcast(rows, scores)
    return _score_by_block(rows, scores, broadcast_bytes // SCORE_BYTES)


def assess(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = 0.99,
    few: float = 4.0,
    prior: float = 40.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    **options,
) -> DataFrame:
    """(doc_id, lang, text_hash, n_symbols, perplexity, threshold, accepted) for each row of ``docs``.

    Trusted text: documents that ``labels`` (doc_id, quality, toxic) call good and not toxic; one in HELD_OUT of them is
    kept from the model. Perplexity is the exponential of the root mean square of the symbols' log
    probabilities, in which a few very unlikely words weigh more than in their mean. A document is accepted up to the
    ``quantile`` of the kept documents' perplexities in its language, or in all languages together where its own has
    none; m of them are allowed ``few`` / m more. The perplexity of a short text is drawn to the language's
    usual one by ``prior`` symbols. Null or empty texts have no perplexity and are accepted, as are all where
    nothing is trusted; with no document kept, those counted on give the threshold. Null languages form one
    language. Rows that repeat an id are assessed one by one. Empty tables give no rows.
    """
    trusted = labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    rows = saved(perplexities(docs, trusted, id_col, text_col, lang_col, **options), "perplexities")
    known = rows.filter(f"part = {KEPT} and n_symbols > 0")
    if known.isEmpty():
        known = rows.filter(f"part = {COUNTED} and n_symbols > 0")
    usual = F.sum("squares") / F.sum("n_symbols")

    def leveled(frame):
        drawn = F.sqrt((F.col("squares") + prior * F.col("usual")) / (F.col("n_symbols") + prior))
        return frame.withColumn("level", F.when(F.col("n_symbols") > 0, drawn))

    cut = F.percentile_approx("level", quantile, 100_000) + F.log1p(few / F.count("level"))
    levels = leveled(_by_language(rows, known, usual, "usual"))
    return (
        _by_language(levels, leveled(_by_language(known, known, usual, "usual")), cut, "cut")
        .select("doc_id", "lang", "text_hash", "n_symbols", F.exp("level").alias("perplexity"), F.exp("cut").alias("threshold"))
        .withColumn("accepted", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
    )


def _by_language(rows: DataFrame, known: DataFrame, value, name: str) -> DataFrame:
    """``rows`` with ``value`` over the known rows of their language as ``name``, or over all known rows."""
    each = saved(known.groupBy(F.col("lang").alias("_lang")).agg(value.alias("_own")), "languages")
    whole = known.agg(value.alias("_all"))
    if each.count() <= LANGUAGES:
        each = F.broadcast(each)
    joined = rows.join(each, F.col("lang").eqNullSafe(F.col("_lang")), "left").join(F.broadcast(whole), F.lit(True), "left")
    return joined.withColumn(name, F.coalesce("_own", "_all")).drop("_lang", "_own", "_all")
