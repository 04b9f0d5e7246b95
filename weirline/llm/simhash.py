"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components.

A pair within ``distance`` differing bits leaves at least two of ``distance + 2`` blocks untouched, so
each fingerprint is sent once for every pair of blocks and met only by those that agree there. A
bucket that holds many fingerprints is not paired up: its members go to their one-bit neighbours
instead, where any two that meet are within two bits, and each is linked to the smallest there. No
link is lost and no bucket gives more than a bounded number of rows for each member.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, attach, deleted, saved, shared_path, small_batches

CHUNK = 1 << 16
#: Members of a bucket up to which its pairs are verified one by one.
PAIRED = 48
#: Passes for the components of a graph, at most.
MOST_PASSES = 200


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit majority of the XXH64 (seed 42) of all word shingles, as a signed integer.

    Words are runs of non-white-space (ASCII) after lower-casing A-Z. Fewer words than a shingle: the
    whole sequence is the one shingle. None, empty or blank: 0.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    digest, total, ones = xxhash.xxh64_digest, 0, np.zeros(64, np.int64)
    for at in range(0, max(1, len(words) - shingle + 1), CHUNK):
        part = words[at : at + CHUNK + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle))) if len(part) >= shingle else [part]
        raw = b"".join([digest(b" ".join(g), 42) for g in grams])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
        total += len(bits)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp) for every row of ``docs``; other columns are not read. Null text: fingerprint 0."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], pa.int64())],
                names=["doc_id", "fp"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, fp long"
    )


def _keys(fp, distance: int):
    """One key for each pair of blocks: the two blocks' bits and the number of the pair."""
    n = distance + 2
    edges = [round(64 * k / n) for k in range(n + 1)]
    block = [
        F.shiftrightunsigned(fp, edges[k]).bitwiseAND(F.lit((1 << (edges[k + 1] - edges[k])) - 1)) for k in range(n)
    ]
    return F.array(*(F.xxhash64(F.lit(k), block[i], block[j]) for k, (i, j) in enumerate(combinations(range(n), 2))))


def links(reps: DataFrame, distance: int = 2) -> DataFrame:
    """Links (a, b), a < b or a > b, that join every two of the distinct ``fp`` within ``distance`` bits, directly or
    over a third one that is itself within ``distance`` of both.

    Buckets of more than PAIRED members take the exact neighbour way for distance 2 (one flipped bit
    each) and pair up otherwise.
    """
    if distance < 1 or distance > 6:
        raise ValueError("distance must be 1 to 6")
    rows = reps.select("fp", F.explode(_keys(F.col("fp"), distance)).alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = rows.join(sizes, "key")
    small = shared.filter(F.col("n") <= PAIRED) if distance == 2 else shared
    a, b = small.select("key", F.col("fp").alias("a")), small.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = a.join(b, "key").filter((F.col("a") < F.col("b")) & near).select("a", "b")
    if distance != 2:
        return pairs.distinct()
    crowded = shared.filter(F.col("n") > PAIRED).select("fp").distinct()
    flips = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.expr(f"shiftleft(1L, {k})")) for k in range(64)))
    spread = crowded.select("fp", F.explode(flips).alias("near"))
    # at most 65 distinct fingerprints lie within one bit of a value, so these groups are bounded
    met = spread.groupBy("near").agg(F.collect_set("fp").alias("all")).filter(F.size("all") > 1)
    stars = met.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).filter("a != b")
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): the smallest value reachable over the undirected ``edges`` (a, b), for each value that has one.

    Smallest-label passes with pointer jumping, which halve the way to the root each time; each is written
    to the shared folder and the one before it deleted. The driver sees only the number of changed rows. MOST_PASSES are more
    than any graph that can be stored needs; beyond them is an error.
    """
    spark = edges.sparkSession
    both = saved(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges"
    )
    path = shared_path(spark, "roots")
    first = both.groupBy("a").agg(F.min("b").alias("m"))
    state = saved(first.select(F.col("a").alias("fp"), F.least("a", "m").alias("root")), "roots", path)
    if state.isEmpty():
        return state
    for _ in range(MOST_PASSES):
        lower = (
            both.join(state.withColumnRenamed("fp", "b"), "b").groupBy("a").agg(F.min("root").alias("via"))
        ).withColumnRenamed("a", "fp")
        moved = state.join(lower, "fp").select("fp", F.col("root").alias("old"), F.least("root", "via").alias("root"))
        jump = state.select(F.col("fp").alias("root"), F.col("root").alias("top"))
        last, path = path, shared_path(spark, "roots")
        new = saved(
            moved.join(jump, "root", "left").select("fp", F.least("root", F.coalesce("top", "root")).alias("root"), "old"),
            "roots",
            path,
        )
        changed = new.filter("root != old").count()
        deleted(spark, last)
        state = new.select("fp", "root")
        if not changed:
            return state
    raise RuntimeError(f"components aren't found in {MOST_PASSES} passes")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most ``distance`` differing bits,
    the row's own included. Repeated rows share a component; null doc_ids are carried along and never
    the smallest, and a component of nothing but them has a null id. Null, empty and blank texts have
    fingerprint 0 and link like any other. An empty table gives an empty result.
    """
    fps = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    reps = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "reps")
    found = _with_components(fps, reps, links(reps, distance), {"component_id": "first_id"})
    return found.select("doc_id", "fp", "component_id")


def near_duplicate_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """(doc_id, text_hash, component_id, kept) for every row of ``docs``: the components of near_duplicates(), and the rows that stand
    for them, as near_copies() marks them."""

    def run(batches):
        for b in batches:
            fps = pa.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps], names=["doc_id", "text_hash", "fp"])

    hashed = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), hashed.alias("text_hash"), F.col(text_col).alias("text"))
    fps = saved(source.mapInArrow(run, "doc_id long, text_hash long, fp long"), "fingerprints")
    own = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_hash")
    reps = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.min(own).alias("first"), F.count("*").alias("n")), "reps")
    found = _with_components(fps, reps, links(reps, distance), {"component_id": "first_id", "stands": "first"})
    kept = F.col("doc_id").eqNullSafe(F.col("stands.doc_id")) & (F.col("text_hash") == F.col("stands.text_hash"))
    return found.select("doc_id", "text_hash", "component_id", kept.alias("kept"))


def _with_components(fps: DataFrame, reps: DataFrame, edges: DataFrame, least: dict[str, str]) -> DataFrame:
    """``fps`` with new columns, each the smallest value of a column of all representatives that ``edges`` connect."""
    joined = components(edges).join(reps, "fp")
    named = joined.select("fp", "root").join(joined.groupBy("root").agg(*(F.min(c).alias(n) for n, c in least.items())), "root")
    groups = saved(
        reps.join(named.drop("root"), "fp", "left").select("fp", "n", *(F.coalesce(n, c).alias(n) for n, c in least.items())),
        "groups",
    )
    return attach(fps, groups, ["fp"])


#: Members of a token's bucket up to which all pairs are compared one by one; larger buckets go to tasks, so many members of a part.
PAIRED_SETS, TOGETHER = 48, 400
#: Shingles that a part of a bucket holds at most on average, and columns of its matrix of shingles at a time.
PART_GRAMS, COLUMNS = 1 << 20, 2048
#: Bytes that a row's number takes in a broadcast table.
ROW_BYTES = 32
#: One text of so many is sampled for frequent shingles; of these so many, at most, go last in every prefix.
SAMPLED, FREQUENT, MOST_FREQUENT = 32, 3, 1_000_000
#: Texts of which a task holds the sets at a time.
ROWS = 250
SLACK = 1e-6
#: Members of a bucket, in parts, from which it is cut by sizes and reaches; cells to a size's growth by 5 / 4 and to a reach of once the size.
CELLED, SIZE_CELLS, REACH_CELLS = 4, 2, 8


def gram_set(text: str | None, shingle: int = 5) -> np.ndarray:
    """The distinct word shingles of a text as sorted 64-bit hashes; words as in fingerprint(), none without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    digest, parts = xxhash.xxh64_digest, []
    for at in range(0, max(1, len(words) - shingle + 1) if words else 0, CHUNK):
        part = words[at : at + CHUNK + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle))) if len(part) >= shingle else [part]
        parts.append(np.frombuffer(b"".join([digest(b" ".join(g)) for g in grams]), np.int64))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def _prefix(grams: np.ndarray, frequent: np.ndarray, rank: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a set in one order for all sets: two sets that are similar enough share one of them. Those that are
    ``frequent`` (sorted) go last, by ``rank``, the others by hash."""
    length = len(grams) - math.ceil(similarity * len(grams) - SLACK) + 1 if len(grams) else 0
    if not len(frequent) or not length:
        return grams[:length]
    at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
    last = frequent[at] == grams
    return np.concatenate([grams[~last], grams[last][np.argsort(rank[at[last]])]])[:length]


def _forest(similarity: float):
    """Links (a, b) that connect what all similar pairs of the sets of a frame connect, one fewer than members each."""

    def run(frame):
        ids = frame["fp"].to_numpy(np.int64)
        sets = frame["grams"].tolist()
        n = np.array([len(s) for s in sets], np.int64)
        vocabulary, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        kept = counts[column] > 1
        owner, column = np.repeat(np.arange(len(ids)), n)[kept], (np.cumsum(counts > 1) - 1)[column[kept]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        both = np.zeros((len(ids), len(ids)), np.float32)
        for base in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            lo, hi = np.searchsorted(column, (base, base + COLUMNS))
            dense = np.zeros((len(ids), COLUMNS), np.float32)
            dense[owner[lo:hi], column[lo:hi] - base] = 1
            both += dense @ dense.T
        near = both >= similarity / (1 + similarity) * (n[:, None] + n[None, :]) - SLACK
        new, a, b = np.ones(len(ids), bool), [], []
        for start in range(len(ids)):
            todo = [start] if new[start] else []
            new[start] = False
            while todo:
                at = todo.pop()
                found = np.flatnonzero(near[at] & new)
                new[found] = False
                todo += found.tolist()
                a += [ids[at]] * len(found)
                b += ids[found].tolist()
        return pd.DataFrame({"a": a, "b": b}).astype("int64")

    return run


def _slices(batch):
    """Some hundred texts at a time, so that a task holds few sets."""
    for at in range(0, len(batch), ROWS):
        yield batch.slice(at, ROWS)


def near_copies(
    docs: DataFrame, similarity: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_hash, component_id, kept) for every row of ``docs``: components of the pairs whose sets of word shingles have
    a Jaccard similarity of at least ``similarity``. Exact, but for collisions of 64-bit hashes.

    In any one order of all shingles, two such sets share one of their first ``n - ceil(similarity * n)
    + 1`` (prefix filter). The order is by hash, shingles that a sample shows as frequent last, the most frequent at the end. Sets
    that share a prefix shingle are compared whole: pair by pair in small buckets. A large bucket is cut into parts
    and parts meet in a task, which returns a spanning forest of its similar pairs. First,
    its parts alone link what they can; buckets that are of one component by then are done.

    A pair need only be found by the first shingle that it shares in that order. What lies before that shingle in either set
    is not shared, so the shingle's place in a set bounds how large its partners may be there, its reach. Pairs
    out of reach, in size or by place, are not compared, and parts of a large bucket that are out of each other's reach do not meet.

    text_hash is the XXH64 of the text (null counts as empty). ``kept`` marks the rows with the id and text that
    stand for their component: the smallest id, null ids last, and its smallest text_hash. Rows that repeat both
    are marked alike. component_id is as in near_duplicates(), as are nulls and empty tables.
    """
    spark = docs.sparkSession
    hashed = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), hashed.alias("text_hash"), F.col(text_col).alias("text"))

    def sample(batches):
        for b in (x for batch in batches for x in _slices(batch)):
            sets = [gram_set(t, shingle) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*sets, np.zeros(0, np.int64)]))], names=["token"])

    sampled = source.filter(F.pmod("text_hash", F.lit(SAMPLED)) == 0).select("text").mapInArrow(sample, "token long")
    often = sampled.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= FREQUENT)
    with small_batches(spark):
        top = often.orderBy(F.desc("n"), "token").limit(MOST_FREQUENT).select("token").toPandas()  # bounded
    tokens = top["token"].to_numpy(np.int64)
    order = np.argsort(tokens)
    frequent = spark.sparkContext.broadcast((tokens[order], (len(tokens) - order).astype(np.int32)))

    def run(batches):
        task, row = TaskContext.get().partitionId() << 33, 0
        for b in (x for batch in batches for x in _slices(batch)):
            sets = [gram_set(t, shingle) for t in b.column(2).to_pylist()]
            columns = [
                pa.array(np.arange(row, row + len(b)) + task),
                pa.array([xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) for s in sets], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_prefix(s, *frequent.value, similarity) for s in sets], pa.list_(pa.int64())),
            ]
            row += len(b)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *columns], names=["doc_id", "text_hash", "row", "fp", "size", "prefix"]
            )

    kinds = "doc_id long, text_hash long, row long, fp long, size long, prefix array<long>"
    fps = saved(source.mapInArrow(run, kinds), "prefixes")
    own = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_hash")
    firsts = fps.groupBy("fp").agg(
        F.min("doc_id").alias("first_id"), F.min(own).alias("first"), F.count("*").alias("n"), F.min("row").alias("row")
    )
    reps = saved(firsts, "reps")
    chosen = reps.select("row")
    chosen = F.broadcast(chosen) if ROW_BYTES * reps.count() <= BROADCAST_BYTES else chosen
    some = fps.select("row", "fp", "size", "prefix").join(chosen, "row", "left_semi")
    rows = some.select("fp", "size", F.posexplode("prefix").alias("at", "token"))
    buckets = rows.groupBy("token").agg(F.count("*").alias("m"), F.sum("size").alias("total")).filter("m > 1")
    shared = saved(rows.join(saved(buckets, "buckets"), "token"), "shared")

    small = shared.filter(F.col("m") <= PAIRED_SETS)
    a, b = (small.select("token", F.col("fp").alias(x), F.col("size").alias(f"n{x}"), F.col("at").alias(f"at{x}")) for x in "ab")
    enough = similarity / (1 + similarity) * (F.col("na") + F.col("nb")) - SLACK
    fits = F.least("na", "nb") >= similarity * F.greatest("na", "nb") - SLACK
    met = a.join(b, "token").filter((F.col("a") < F.col("b")) & fits)
    # what two sets share is at most the rest of one from the first shingle that they share
    left = F.max(F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb")))
    counted = met.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("common"), left.alias("left")).filter(F.col("left") >= enough)
    crowded = shared.filter(F.col("m") > PAIRED_SETS)
    is_crowded = not crowded.isEmpty()
    # nor more than the small and crowded buckets that both are in and what lies beyond a prefix
    rest = F.ceil(similarity * F.greatest("na", "nb") - SLACK) - 1
    if is_crowded:
        times = saved(crowded.groupBy("fp").agg(F.count("*").alias("times")), "times")
        counted = counted.join(times.toDF("a", "ta"), "a", "left").join(times.toDF("b", "tb"), "b", "left")
        rest = rest + F.least(F.coalesce("ta", F.lit(0)), F.coalesce("tb", F.lit(0)))
    pairs = saved(counted.filter(F.col("common") + rest >= enough).select("a", "b", "na", "nb"), "pairs")

    needed = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).union(crowded.select("fp")).distinct()
    held = _sets(source, saved(needed.join(reps, "fp").select("fp", "first"), "needed"), shingle)

    both = pairs.join(held.toDF("a", "ga"), "a").join(held.toDF("b", "gb"), "b")
    edges = saved(both.filter(F.size(F.array_intersect("ga", "gb")) >= enough).select("a", "b"), "near")
    if is_crowded:
        edges = edges.unionByName(_crowded_links(crowded, held, edges, similarity)).distinct()
    found = _with_components(
        fps.select("doc_id", "text_hash", "fp"), reps.select("fp", "first_id", "first", "n"), edges,
        {"component_id": "first_id", "stands": "first"},
    )
    kept = F.col("doc_id").eqNullSafe(F.col("stands.doc_id")) & (F.col("text_hash") == F.col("stands.text_hash"))
    return found.select("doc_id", "text_hash", "component_id", kept.alias("kept"))


def _sets(source: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """(fp, grams) of each needed (fp, first), from the texts once more rather than from sets that all texts have written."""

    def run(batches):
        for b in (x for batch in batches for x in _slices(batch)):
            sets = [gram_set(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["fp", "grams"])

    wanted = needed.select("fp", F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    n = wanted.count()
    wanted = F.broadcast(wanted) if 2 * ROW_BYTES * n <= BROADCAST_BYTES else wanted
    texts = source.join(wanted, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    held = saved(texts.select("fp", "text").mapInArrow(run, "fp long, grams array<long>"), "held")
    # rows that repeat an id and a text are one
    return held if held.count() == n else saved(held.dropDuplicates(["fp"]), "held")


def _crowded_links(crowded: DataFrame, held: DataFrame, edges: DataFrame, similarity: float) -> DataFrame:
    """Links that connect, together with ``edges``, what all similar pairs within the large buckets connect."""
    parts = F.ceil(F.greatest(F.col("m") / TOGETHER, F.col("total") / PART_GRAMS))
    placed = crowded.select("token", "fp", "m", "total", "size", "at", parts.alias("parts")).withColumn(
        "part", F.pmod(F.xxhash64("fp", "token"), F.col("parts"))
    )
    own = placed.groupBy("fp").agg(F.slice(F.array_sort(F.collect_list(F.struct("token", "part"))), 1, 2).alias("own"))
    once = own.select("fp", F.explode("own").alias("x")).select("fp", "x.token", "x.part").join(held, "fp")
    forest = _forest(similarity)
    first = saved(once.groupBy("token", "part").applyInPandas(forest, "a long, b long"), "forest")
    roots = components(edges.unionByName(first))
    rooted = placed.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    alike = rooted.groupBy("token").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.first("m").alias("m"), F.bit_xor("fp").alias("members"), F.sum("at").alias("at")
    )
    # buckets of several components; of those with the same members the one whose shingle is first
    left = alike.filter("low < high").groupBy("m", "members").agg(F.min_by("token", F.struct("at", "token")).alias("token"))
    again = placed.drop("parts", "part").join(saved(left.select("token"), "left"), "token")
    second = _meetings(again, similarity).join(held, "fp").groupBy("token", "i", "j").applyInPandas(forest, "a long, b long")
    return first.unionByName(saved(second, "forest"))


def _meetings(members: DataFrame, similarity: float) -> DataFrame:
    """(fp, token, i, j): where the members (token, fp, m, total, size, at) of large buckets meet, so that any two within reach do.

    A member's partners in a bucket are at most ``reach`` in size. Large buckets are cut into cells of like size and like reach, and cells
    into parts by hash; the parts of two cells meet if the smallest of each is within the largest reach of the other. Cells of a
    bucket are few, whatever its members.
    """
    members = members.withColumn("reach", F.floor((1 + similarity) / similarity * (F.col("size") - F.col("at")) + SLACK) - F.col("size"))
    celled = (F.col("m") > CELLED * TOGETHER) | (F.col("total") > CELLED * PART_GRAMS)
    by_size = F.floor(F.log(F.col("size").cast("double")) * (SIZE_CELLS / math.log(1.25)))
    by_reach = F.floor(F.col("reach") * REACH_CELLS / F.col("size"))
    placed = saved(members.withColumn("cell", F.when(celled, by_size * 4 * REACH_CELLS + by_reach).otherwise(0)), "members")
    cells = placed.groupBy("token", "cell").agg(
        F.min("size").alias("low"), F.max("reach").alias("high"), F.count("*").alias("n"), F.sum("size").alias("grams")
    )
    cells = cells.withColumn("parts", F.ceil(F.greatest(F.col("n") / TOGETHER, F.col("grams") / PART_GRAMS)))
    cells = saved(cells, "cells")
    one = cells.select("token", "cell", *(F.col(c).alias(f"own_{c}") for c in ("low", "high", "n", "parts")))
    other = cells.select("token", F.col("cell").alias("other"), "low", "high", "parts")
    near = one.join(other, "token").filter((F.col("own_low") <= F.col("high")) & (F.col("low") <= F.col("own_high")))
    near = saved(near.filter("cell != other or own_n > 1").select("token", "cell", "own_parts", "other", "parts"), "near_cells")
    near = F.broadcast(near) if 2 * ROW_BYTES * near.count() <= BROADCAST_BYTES else near
    own = F.pmod(F.xxhash64("fp", "token"), F.col("own_parts"))
    met = placed.select("token", "cell", "fp").join(near, ["token", "cell"]).withColumn("part", own)
    met = met.select("fp", "token", "cell", "other", "part", "parts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("with"))
    met = met.filter((F.col("cell") != F.col("other")) | (F.col("part") != F.col("with")) | (F.col("parts") == 1))
    here, there = (F.shiftleft(F.col(c).cast("long"), 32) + F.col(p) for c, p in (("cell", "part"), ("other", "with")))
    return met.select("fp", "token", F.least(here, there).alias("i"), F.greatest(here, there).alias("j"))


def hex16(c):
    return F.lower(F.lpad(F.hex(c), 16, "0"))
