"""Dropping lines that many documents share, with DataFrame functions only.

Line hashes are range-partitioned together with the document and sorted by hash, document and position, so
that a partition streams each document's first occurrence of a line in order, and even one very common line
spreads over several partitions; what is counted there is merged afterwards. What comes back for a
document is its keep bitmap, packed as the runs of lines that go, not text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, ascii_lower, attach, saved, unused

BLANK = " \t\n\x0b\x0c\r"
#: Bytes of a bitmap's row besides its runs, doubled for their unpacked form.
ROW_BYTES = 64


def _lines(c):
    return F.split(F.coalesce(c, F.lit("")), "\n")


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A document is told by its id (null is an id of its own) and its text's hash, so that rows that repeat an id keep
    bitmaps of their own."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def first_occurrences(lines: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, pos) of each line's first place in each document that holds it. A partition is a range of
    (h1, h2, doc_id), sorted once, and a window that stops after a group's first row passes over it."""
    spread = lines.select("h1", "h2", "doc_id", "pos").repartitionByRange("h1", "h2", "doc_id")
    place = F.row_number().over(W.partitionBy("h1", "h2", "doc_id").orderBy("pos"))
    return spread.withColumn("place", place).filter("place = 1").drop("place")


def common_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, n_docs, keep_doc) of each line hash found in at least ``min_docs`` distinct documents: what each partition
    saw of a line, then their sum."""
    return (
        first_occurrences(lines)
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keep_doc"))
        .filter(F.col("n_docs") >= min_docs)
    )


def packed(runs):
    """An array of runs (start, length) as bytes, four for each number, the highest first."""
    number = lambda c: F.lpad(F.hex(c), 8, "0")
    return F.unhex(F.array_join(F.transform(runs, lambda r: F.concat(number(r["start"]), number(r["length"]))), ""))


def unpacked(bitmap):
    """The runs of packed()."""
    number = lambda at: F.conv(F.hex(F.substring(bitmap, at, F.lit(4))), 16, 10).cast("int")
    n = (F.octet_length(bitmap) / 8).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda k: F.struct(number(8 * k + 1).alias("start"), number(8 * k + 5).alias("length")))


def keep_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
) -> DataFrame:
    """(doc_id, text_hash, dropped, bitmap) for each document that loses lines.

    A line's key is the line without ASCII white space at both ends and with A-Z lower-cased. Keys of
    at least ``min_chars`` code points in at least ``min_docs`` documents lose every line except in
    the largest doc_id that holds one. ``dropped`` counts the lost lines; ``bitmap`` is the
    keep bitmap, run-length packed to bytes: the runs of lines that go, all others stay. Null and
    empty texts are one empty line and lose nothing. Rows with the same id count as one document; a null id counts as one document too and
    is never the largest.
    """
    whole = _identified(docs, id_col, text_col)
    split = whole.select("doc_id", "text_hash", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    trimmed = F.btrim(F.col("line"), F.lit(BLANK))
    long = split.select("doc_id", "text_hash", "pos", trimmed.alias("line")).filter(F.char_length("line") >= min_chars)
    key = ascii_lower(F.col("line"))
    hashed = long.select(
        "doc_id", "text_hash", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")
    )
    lines = saved(hashed, "lines")
    common = saved(common_lines(lines, min_docs), "common")
    lost = attach(lines, common, ["h1", "h2"], "n_docs").filter(~F.col("doc_id").eqNullSafe(F.col("keep_doc")))
    per_doc = lost.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    edges = per_doc.withColumns(
        {
            "first": F.filter("gone", lambda p, i: (i == 0) | (F.get("gone", i - 1) != p - 1)),
            "last": F.filter("gone", lambda p, i: F.coalesce(F.get("gone", i + 1) != p + 1, F.lit(True))),
        }
    )
    run = F.zip_with("first", "last", lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("length")))
    return edges.select("doc_id", "text_hash", F.size("gone").cast("long").alias("dropped"), packed(run).alias("bitmap"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped`` added; the other columns stay as they are. Bitmaps are
    broadcast while they are few, so that texts stay where they are; beyond that both are joined by a shuffle."""
    id_, hash_, gaps, dropped, lines = (unused(docs, n) for n in ("bm_id", "bm_hash", "bm_gaps", "bm_dropped", "bm_lines"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    marks = bitmaps.select(
        F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("dropped").alias(dropped), unpacked(F.col("bitmap")).alias(gaps)
    )
    size = bitmaps.agg(F.sum(F.octet_length("bitmap") + ROW_BYTES)).first()[0] or 0
    marks = F.broadcast(marks) if size <= BROADCAST_BYTES else marks
    joined = docs.join(
        marks, F.col(id_col).eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(hash_)), "left"
    ).withColumn(lines, _lines(F.col(text_col)))
    # the stretch of lines before each gap, and after the last one
    stretches = F.expr(
        f"""
        flatten(transform(sequence(0, size({gaps})), k -> slice({lines},
          coalesce(get({gaps}, k - 1).start + get({gaps}, k - 1).length, 0) + 1,
          coalesce(get({gaps}, k).start, size({lines}))
            - coalesce(get({gaps}, k - 1).start + get({gaps}, k - 1).length, 0))))
        """
    )
    return (
        joined.withColumn("kept_text", F.when(F.col(gaps).isNull(), text).otherwise(F.array_join(stretches, "\n")))
        .withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("n_dropped", F.coalesce(dropped, F.lit(0).cast("long")))
        .drop(id_, hash_, gaps, dropped, lines)
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` without the lines that keep_bitmaps() marks, as apply_bitmaps() gives it; ``limits`` are those of keep_bitmaps()."""
    return apply_bitmaps(docs, saved(keep_bitmaps(docs, id_col, text_col, **limits), "bitmaps"), id_col, text_col)
