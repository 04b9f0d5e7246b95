"""Exact top-k by inner product, pruned by length and by rotated partial sums.

Vectors are cut into blocks by descending length, of one dimension each. The longest blocks give every query
a first threshold: the k-th best score it already has. A task goes through its blocks from the longest
vectors on and raises its queries' thresholds as it goes; once a block's longest vector can reach no
threshold by Cauchy-Schwarz, neither can any later one. Within a block, coordinates rotated onto the principal
axes (SVD) give partial sums in several steps, each with a bound on the rest by Cauchy-Schwarz; queries are
taken few at a time, of like direction, and only vectors that pass for one of them are scored in
full, exactly, on the integers. Each task returns at most k for each query, and the best k of those are the answer.

Queries within a byte limit are broadcast, and blocks stay where they are. Otherwise groups of queries and
parts of the table meet in the cells of a grid, to which each is sent once for a row or column, not for each pair.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, saved

ROWS, QUERIES = 4096, 512
#: Queries of like direction that are bounded together.
TOGETHER = 32
#: Shares of the rotated axes after which what can't reach a threshold is dropped.
STEPS = (1 / 16, 1 / 8, 1 / 4, 1 / 2)
#: Bytes of vectors on either side of a cell of the grid.
CELL_BYTES = 64 << 20


def quantised(table: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(vec_id, v, length, dim): v is floor(scale * x) of every component. Rows with a null id, a null vector, or null or
    non-finite components are left out."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("double"))
    rows = table.filter(x.isNotNull() & F.col(id_col).isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col(id_col).cast("long").alias("vec_id"), v.alias("v")
    )
    return rows.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))).withColumn(
        "dim", F.size("v")
    )


def _bytes_of(v: np.ndarray) -> bytes:
    """Integers of 32 bits where they fit, else doubles."""
    return v.astype(np.int32).tobytes() if np.abs(v).max(initial=0) < 1 << 31 else v.tobytes()


def _matrix(raw: bytes, rows: int, dim: int) -> np.ndarray:
    kind = np.int32 if len(raw) == 4 * rows * dim else np.float64
    return np.frombuffer(raw, kind).reshape(rows, dim).astype(np.float64)


def _packed(rows: DataFrame, of: str) -> DataFrame:
    """One row for each block: ids and vectors as bytes, longest first; block sizes are bounded by their numbering."""

    def run(frame):
        frame = frame.sort_values(["length", "vec_id"], ascending=[False, True])
        v = np.array(frame["v"].tolist(), np.float64).reshape(len(frame), -1)
        return pd.DataFrame(
            {
                of: [frame[of].iloc[0]],
                "dim": [v.shape[1]],
                "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()],
                "m": [_bytes_of(v)],
                "longest": [float(frame["length"].iloc[0])],
            }
        )

    return rows.groupBy(of).applyInPandas(run, f"{of} long, dim int, ids binary, m binary, longest double")


def _blocks(rows: DataFrame, of: str, size: int) -> DataFrame:
    """Numbers ``rows`` into blocks of about ``size`` by descending length, each of one dimension. Ranges come from a
    range partitioning and, within a partition, from the position, so no task sees more than its own range."""
    spread = saved(
        rows.repartitionByRange("dim", F.desc("length"), "vec_id")
        .sortWithinPartitions("dim", F.desc("length"), "vec_id")
        .withColumn("at", F.monotonically_increasing_id()),
        "ranges",
    )
    # a block is a stretch of `size` within a partition; hashed with the dimension so that blocks hold one only
    block = F.xxhash64(F.floor(F.col("at") / size), "dim")
    return _packed(spread.withColumn(of, block), of)


#: Tasks that add up the sums of all others before one adds up theirs.
SUMMING = 64


def _gram(rows: DataFrame, dim: int) -> np.ndarray:
    """Sum of outer products: dim * dim numbers, whatever the rows. Sums travel as bytes and are added up in a tree, as a stream."""

    def products(frames):
        total = np.zeros((dim, dim))
        for f in frames:
            if len(f):
                v = np.array(f["v"].tolist(), np.float64)
                total += v.T @ v
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "g": [total.tobytes()]})

    def sums(frames):
        total, part = np.zeros(dim * dim), 0
        for f in frames:
            for part, g in zip(f["part"], f["g"]):
                total += np.frombuffer(g)
        yield pd.DataFrame({"part": [part], "g": [total.tobytes()]})

    schema = "part long, g binary"
    parts = rows.filter(F.col("dim") == dim).select("v").mapInPandas(products, schema)
    few = parts.repartition(SUMMING, "part").mapInPandas(sums, schema)
    whole = few.coalesce(1).mapInPandas(sums, schema).collect()
    return np.frombuffer(bytes(whole[0]["g"])).reshape(dim, dim) if whole else np.zeros((dim, dim))


class Queries:
    """A block of queries of one dimension, in groups of like direction, with what each has found so far."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, least: np.ndarray, axes: np.ndarray, k: int):
        self.k, self.dim = k, v.shape[1]
        turned = v @ axes if len(axes) == self.dim else v
        order = np.lexsort(turned[:, :3].T[::-1]) if self.dim else np.arange(len(ids))
        self.ids, self.v, self.turned = ids[order], v[order], turned[order]
        self.least, self.length = least[order].copy(), np.sqrt((self.v * self.v).sum(axis=1))
        self.cuts = [max(1, int(self.dim * s)) for s in STEPS if self.dim >= 8]
        self.scores, self.found = np.full((len(ids), k), -np.inf), np.full((len(ids), k), -1, np.int64)
        self.full = self.all = 0  # pairs scored in full, and all

    def meet(self, cid: np.ndarray, c: np.ndarray, turned: np.ndarray) -> None:
        """Scores a block of vectors, longest first, against the queries."""
        lengths = np.sqrt((c * c).sum(axis=1))
        rests = [np.sqrt((turned[:, cut:] ** 2).sum(axis=1)) for cut in self.cuts]
        for a in range(0, len(self.ids), TOGETHER):
            g = slice(a, a + TOGETHER)
            self.all += len(self.ids[g]) * len(cid)
            least, ql = self.least[g], self.length[g]
            slack = 1e-9 * (1 + ql.max(initial=0) * lengths[:1].max(initial=0))
            # by descending length: beyond the last vector that can reach any threshold, none can
            reach = (ql[:, None] * lengths[None, :] + slack >= least[:, None]).any(axis=0)
            n = int(np.flatnonzero(reach)[-1]) + 1 if reach.any() else 0
            alive, partial, done = np.arange(n), np.zeros((len(ql), n)), 0
            for cut, rest in zip(self.cuts, rests):
                if not len(alive):
                    break
                partial = partial + self.turned[g, done:cut] @ turned[alive, done:cut].T
                done = cut
                own = np.sqrt((self.turned[g, cut:] ** 2).sum(axis=1))
                passed = (partial + own[:, None] * rest[alive][None, :] + slack >= least[:, None]).any(axis=0)
                if passed.mean() < 0.9:
                    alive, partial = alive[passed], partial[:, passed]
            if len(alive):
                self.full += len(ql) * len(alive)
                self._take(g, cid[alive], self.v[g] @ c[alive].T)

    def _take(self, g: slice, cid: np.ndarray, scores: np.ndarray) -> None:
        """Keeps the best k of each query of the group, ties to the smaller id, and raises its threshold."""
        scores = np.where((self.ids[g][:, None] == cid[None, :]) | (scores < self.least[g][:, None]), -np.inf, scores)
        some = np.flatnonzero((scores > -np.inf).any(axis=1))
        if not len(some):
            return
        row, k = g.start + some, self.k
        every = np.concatenate([self.scores[row], scores[some]], axis=1)
        ids = np.concatenate([self.found[row], np.broadcast_to(cid, (len(some), len(cid)))], axis=1)
        last = -np.partition(-every, k - 1, axis=1)[:, k - 1]  # the k-th best
        r, c = np.nonzero((every >= last[:, None]) & (every > -np.inf))
        order = np.lexsort((ids[r, c], -every[r, c], r))
        r, c = r[order], c[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        best = place < k
        kept_scores, kept_ids = np.full((len(some), k), -np.inf), np.full((len(some), k), -1, np.int64)
        kept_scores[r[best], place[best]], kept_ids[r[best], place[best]] = every[r[best], c[best]], ids[r[best], c[best]]
        self.scores[row], self.found[row] = kept_scores, kept_ids
        self.least[row] = np.maximum(self.least[row], last)

    def rows(self) -> pd.DataFrame:
        at, place = np.nonzero(self.scores > -np.inf)
        return pd.DataFrame({"query_id": self.ids[at], "vec_id": self.found[at, place], "score": self.scores[at, place].astype(np.int64)})


def _searched(blocks, queries: list[Queries], axes: np.ndarray):
    """Puts blocks (dim, ids, m, longest) to queries; the longest should come first."""
    for dim, ids, m, longest in blocks:
        cid = np.frombuffer(ids, np.int64)
        wanted = [q for q in queries if q.dim == dim and bool((q.length * longest * (1 + 1e-9) + 1e-9 >= q.least).any())]
        if wanted:
            c = _matrix(m, len(cid), dim)
            turned = c @ axes if len(axes) == dim else c
            for q in wanted:
                q.meet(cid, c, turned)


def _query_blocks(rows, axes: np.ndarray, k: int) -> list[Queries]:
    """From (dim, q_ids, q_m, least)."""
    out = []
    for dim, ids, m, least in rows:
        ids = np.frombuffer(ids, np.int64)
        out.append(Queries(ids, _matrix(m, len(ids), dim), np.frombuffer(least, np.float64), axes, k))
    return out


def top_k(
    table: DataFrame,
    queries: DataFrame,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k best rows of ``table`` but its own id.

    Score: inner product of floor(scale * x), exact while it stays below 2**53. Ties go to the smaller
    vec_id; fewer than k candidates: all. Null ids, null vectors and vectors with null or
    non-finite components take no part; a query meets vectors of its own dimension only. Repeated
    rows are candidates each, and repeated query ids are one query by their first vector. Other
    columns are not read. Empty tables give no rows.
    """
    rows = saved(quantised(table, id_col, vector_col, scale), "vectors")
    asked = quantised(queries, id_col, vector_col, scale)
    asked = asked.groupBy("vec_id").agg(F.min(F.struct("v", "length", "dim")).alias("x")).select("vec_id", "x.*")
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    dim = common[0] if common else 0
    axes = np.linalg.eigh(_gram(rows, dim))[1][:, ::-1].copy() if dim else np.zeros((0, 0))
    blocks = saved(_blocks(rows, "block", ROWS), "blocks")
    q_blocks = saved(_blocks(asked, "q_block", QUERIES).withColumnsRenamed({"ids": "q_ids", "m": "q_m"}), "queries")
    # a first threshold from the longest block of each dimension: one block for all queries of the dimension
    first = blocks.groupBy("dim").agg(F.max_by("block", F.struct("longest", "block")).alias("block"))
    seeds = saved(blocks.join(first, ["dim", "block"], "left_semi").select("dim", "ids", "m"), "seeds")
    seed_bytes = seeds.agg(F.sum(F.octet_length("m") + F.octet_length("ids"))).first()[0] or 0
    asked_first = q_blocks.drop("longest").join(F.broadcast(seeds) if seed_bytes <= broadcast_bytes else seeds, "dim")
    least = "q_block long, dim int, q_ids binary, q_m binary, least binary, reach double"
    ready = saved(asked_first.mapInPandas(_thresholds(k), least), "thresholds")
    q_bytes = ready.agg(F.sum(F.octet_length("q_m") + 2 * F.octet_length("q_ids"))).first()[0] or 0
    found = "query_id long, vec_id long, score long"
    if q_bytes <= broadcast_bytes:
        held = table.sparkSession.sparkContext.broadcast(
            [tuple(map(lambda x: bytes(x) if isinstance(x, bytearray) else x, r)) for r in ready.select("dim", "q_ids", "q_m", "least").collect()]
        )  # bounded: its bytes have been counted

        def search(frames):
            own = _query_blocks(held.value, axes, k)
            for f in frames:
                f = f.sort_values("longest", ascending=False)
                _searched(f.itertuples(index=False, name=None), own, axes)
            for q in own:
                yield q.rows()

        # as many tasks as run at once: each gives up to k rows for every query, and carries its thresholds from block to block
        tasks = max(1, table.sparkSession.sparkContext.defaultParallelism)
        scored = blocks.select("dim", "ids", "m", "longest").coalesce(tasks).mapInPandas(search, found)
    else:
        scored = _by_grid(blocks, ready, q_bytes, axes, k, found)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        scored.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def _by_grid(blocks: DataFrame, ready: DataFrame, q_bytes: int, axes: np.ndarray, k: int, found: str) -> DataFrame:
    """Queries in groups and vectors in parts of CELL_BYTES each; a group is sent to every part once and a part to every
    group that its blocks can still matter to by length alone."""
    t_bytes = blocks.agg(F.sum(F.octet_length("m") + F.octet_length("ids"))).first()[0] or 0
    groups, parts = (max(1, -(-int(n) // CELL_BYTES)) for n in (q_bytes, t_bytes))
    cells = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p")
    left = ready.withColumn("g", F.pmod(F.xxhash64("q_block"), F.lit(groups)))
    nearest = left.groupBy("dim", "g").agg(F.min("reach").alias("reach"))
    wanted = blocks.select("block", "dim", "longest").join(nearest, "dim").filter(F.col("longest") >= F.col("reach"))
    wanted = wanted.select("block", F.col("g").alias("of_g"))
    right = blocks.withColumn("of_p", F.pmod(F.xxhash64("block"), F.lit(parts))).join(wanted, "block")

    def cell(q, b):
        own = _query_blocks(q[["dim", "q_ids", "q_m", "least"]].itertuples(index=False, name=None), axes, k)
        b = b.sort_values("longest", ascending=False)
        _searched(b[["dim", "ids", "m", "longest"]].itertuples(index=False, name=None), own, axes)
        return pd.concat([x.rows() for x in own]) if own else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    left = left.select("g", cells, "dim", "q_ids", "q_m", "least")
    return left.groupBy("g", "p").cogroup(right.groupBy("of_g", "of_p")).applyInPandas(cell, found)


def _thresholds(k: int):
    """For each query block the k-th score against the longest vectors, and the least length that can beat any of them."""

    def run(frames):
        for f in frames:
            for r in f.itertuples(index=False):
                qid, cid = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.ids, np.int64)
                q, c = _matrix(r.q_m, len(qid), r.dim), _matrix(r.m, len(cid), r.dim)
                scores, ql = q @ c.T, np.sqrt((q * q).sum(axis=1))
                scores = np.where(qid[:, None] == cid[None, :], -np.inf, scores)
                if len(cid) >= k:
                    least = np.partition(scores, len(cid) - k, axis=1)[:, len(cid) - k]
                else:
                    least = np.full(len(qid), -np.inf)
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(least <= 0, -np.inf, least / np.maximum(ql, 1e-300))
                reach = float(need.min()) if len(need) else 0.0
                reach = reach - 1e-6 * abs(reach) if np.isfinite(reach) else -1.0
                yield pd.DataFrame({"q_block": [r.q_block], "dim": [r.dim], "q_ids": [r.q_ids], "q_m": [r.q_m], "least": [least.tobytes()], "reach": [reach]})

    return run
