"""A corpus pipeline of five stages over ``documents``; each stage's result is written and read by the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirline.llm import decontam, line_dedup, quality, sentence_pieces, simhash
from weirline.llm.common import BROADCAST_BYTES, saved
from weirline.llm.queries import vocabulary

#: Bytes that a key takes in a broadcast table, at most.
KEY_BYTES = 128


def _without(docs: DataFrame, keys: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``docs`` without the rows whose ``values`` are a row of ``keys``; nulls match nulls. Keys are broadcast while they are
    few enough, so that texts stay where they are."""
    gone = saved(keys.select(*(F.col(c).alias(f"_gone_{c}") for c in values)).distinct(), "gone")
    if KEY_BYTES * gone.count() <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    return docs.join(gone, [v.eqNullSafe(F.col(f"_gone_{c}")) for c, v in values.items()], "left_anti")


def _text_hash(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model of trusted text accepts. Null and empty texts stay; a null id is judged like any other."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rejected = quality.assess(docs, labels).filter("not accepted")
    return _without(docs, rejected, {"doc_id": docs["doc_id"], "lang": docs["lang"], "text_hash": _text_hash(docs)})


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least five of them share; a document of which nothing stays goes."""
    kept = line_dedup.dedup_lines(docs).filter("n_dropped = 0 or trim(kept_text) != ''")
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_dropped") > 0, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumns({"text": text, "n_chars": n_chars}).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; of rows that repeat an id and a text one stays.

    SimHash comes first: documents whose fingerprints differ in at most two bits. At a similarity of 0.8 fingerprints differ in more
    bits than blocks of them can tell, so pairs whose sets of five-word shingles are as similar as that follow from a join of those
    sets. What either finds goes; the smallest of all that are linked, by whichever, stands in both."""
    alike = saved(simhash.near_duplicate_rows(docs), "near_duplicates")
    groups = saved(simhash.near_copies(docs), "near_copies")
    keys = {"doc_id": docs["doc_id"], "text_hash": _text_hash(docs)}
    repeated = groups.filter("kept").groupBy("doc_id", "text_hash").count().filter("count > 1")
    rest = _without(docs, alike.filter("not kept").unionByName(groups.filter("not kept")), keys)
    if repeated.isEmpty():
        return rest
    marked = repeated.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    on = docs["doc_id"].eqNullSafe(F.col("_id")) & (_text_hash(docs) == F.col("_hash"))
    one = rest.join(marked, on).drop("_id", "_hash").dropDuplicates(["doc_id", "text"])
    return _without(rest, repeated, keys).unionByName(one)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs; a null id is judged like any other."""
    keyed = docs.select("text", F.xxhash64("text").alias("doc_id"))
    found = decontam.scan(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("contaminated")
    return _without(docs, found, {"doc_id": F.xxhash64(docs["text"])})


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces: count, checksum and whether they decode to the text."""
    return sentence_pieces.round_trip(docs, vocabulary("piece_bpe_32k.model"), dropout=0.1, seed=1)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_common_lines),
    ("SimHash near-dedup, then by shingles", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding", encode),
]

#: SQL can't express the language model, the fingerprints or the pieces; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each result but the last written and read again. The last is of one
    row for each document left: its pieces' count and checksum and whether they decode to the text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        docs = saved(out, f"stage{k}")
    return docs
