"""Best-fit-decreasing sharding of indivisible groups.

Groups larger than a unit (a small share of a shard) number a few thousand at most, whatever the
corpus: their sizes add up to it. They are packed on the driver. All smaller groups are first packed
into units, by best fit decreasing within each of PACKS parts of their hashes, and the units then join the
large groups. Neither depends on the cluster, so its size moves no document. Bins lie in a balanced
tree by remaining capacity, so the tightest that fits is found in logarithmic time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import attach, saved

#: Units in a shard, and parts in which small groups are packed; the driver packs at most about twice UNITS for each shard and
#: one unit for each part.
UNITS, PACKS = 256, 1024


class Bins:
    """Open bins in a treap keyed by (remaining capacity, bin)."""

    def __init__(self):
        self.root, self.seed = None, 12345

    def _split(self, node, key):
        """Nodes below key, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            a, b = self._split(node[3], key)
            return [node[0], node[1], node[2], a], b
        a, b = self._split(node[2], key)
        return a, [node[0], node[1], b, node[3]]

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return [a[0], a[1], a[2], self._merge(a[3], b)]
        return [b[0], b[1], self._merge(a, b[2]), b[3]]

    def put(self, remaining: int, number: int) -> None:
        self.seed = (self.seed * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        a, b = self._split(self.root, (remaining, number))
        self.root = self._merge(self._merge(a, [(remaining, number), self.seed, None, None]), b)

    def take(self, size: int) -> tuple[int, int] | None:
        """The bin with the least remaining capacity of at least ``size``, taken out; None if there is none."""
        at, best = self.root, None
        while at is not None:
            if at[0] >= (size, -1):
                best, at = at[0], at[2]
            else:
                at = at[3]
        if best is not None:
            a, b = self._split(self.root, best)
            self.root = self._merge(a, self._split(b, (best[0], best[1] + 1))[1])
        return best


def best_fit(sizes, capacity: int) -> Iterator[int]:
    """The bin of each size, which come in decreasing order; one beyond the capacity gets a bin of its own."""
    bins, opened = Bins(), 0
    for size in sizes:
        found = bins.take(size)
        if found is None:
            found, opened = (max(capacity, size), opened), opened + 1
        bins.put(found[0] - size, found[1])
        yield found[1]


def pack(units: list[tuple[int, object]], shards: int) -> dict:
    """Shard of each (size, name) for ``shards`` shards of the least equal capacity that holds all by best fit decreasing.

    A unit above an equal share of what is left takes a shard of its own.
    """
    left = sorted(units, key=lambda u: (-u[0], str(u[1])))
    placed, first, total = {}, 0, sum(u[0] for u in left)
    while left and shards - first > 1 and left[0][0] * (shards - first) > total:
        placed[left[0][1]], total, first, left = first, total - left[0][0], first + 1, left[1:]
    if not left:
        return placed
    room = shards - first
    low, high = max(-(-total // room), left[0][0]), 2 * (total // room + left[0][0])
    chosen = None
    while low < high:
        mid = (low + high) // 2
        bins = list(best_fit((u[0] for u in left), mid))
        if max(bins) < room:
            high, chosen = mid, bins
        else:
            low = mid + 1
    if chosen is None:
        chosen = list(best_fit((u[0] for u in left), high))
    return placed | {u[1]: first + b for u, b in zip(left, chosen)}


def _unit_packer(capacity: int):
    """Packs each part's small groups into units. Groups come by part and decreasing size."""

    def run(batches):
        bins, opened, own = Bins(), 0, None
        for b in batches:
            out = []
            for size, part in zip(b.column(2).to_pylist(), b.column(4).to_pylist()):
                if part != own:
                    bins, opened, own = Bins(), 0, part
                found = bins.take(size)
                if found is None:
                    found, opened = (capacity, opened), opened + 1
                if found[0] > size:
                    bins.put(found[0] - size, found[1])
                out.append(f"{part}-{found[1]}")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), b.column(3), pa.array(out, pa.string())],
                names=["h1", "h2", "bytes", "n", "unit"],
            )

    return run


def assign(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every row in one of ``shards`` shards of nearly equal bytes.

    size is the text's UTF-8 bytes plus 1. Rows with equal texts stay together; null counts as empty.
    One group with more than a shard's share has a shard to itself. slot numbers the rows of a shard
    from 0 by doc_id (nulls first). Repeated rows each get a place. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = saved(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h1"),
            F.xxhash64(F.lit("second"), text).alias("h2"),
        ),
        "rows",
    )
    groups = saved(rows.groupBy("h1", "h2").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    capacity = max(1, total // (shards * UNITS))
    large = groups.filter(F.col("bytes") > capacity).withColumn("unit", F.concat_ws("_", "h1", "h2"))
    small = (
        groups.filter(F.col("bytes") <= capacity)
        .withColumn("part", F.pmod("h1", F.lit(PACKS)))
        .repartition("part")
        .sortWithinPartitions("part", F.desc("bytes"), "h1", "h2")
        .mapInArrow(_unit_packer(capacity), "h1 long, h2 long, bytes long, n long, unit string")
    )
    packed = saved(large.unionByName(small), "units")
    # at most shards * UNITS * 2 units over half full, and one more for each part
    units = [(r[1], r[0]) for r in packed.groupBy("unit").agg(F.sum("bytes")).collect()]
    place = docs.sparkSession.createDataFrame(list(pack(units, shards).items()), "unit string, shard int")
    placed = saved(packed.join(F.broadcast(place), "unit").select("h1", "h2", "n", "shard"), "placed")
    dealt = attach(rows, placed, ["h1", "h2"]).select("doc_id", "size", "text_crc32", "shard")
    return number(dealt)


def number(dealt: DataFrame) -> DataFrame:
    """Adds slot: a gapless number within each shard, by doc_id. No task holds a whole shard: rows are range-partitioned
    by shard and doc_id, counted by partition, and the counts before a partition are added to its own numbers."""
    keys = ["shard", "doc_id", "text_crc32", "size"]
    spread = saved(
        dealt.repartitionByRange("shard", "doc_id", "text_crc32")
        .sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "slots",
    )
    # one row for each shard and partition
    counts = spread.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("part")) - F.col("n")
    offsets = counts.select("shard", "part", "first", before.alias("before"))
    return (
        spread.join(F.broadcast(offsets), ["shard", "part"])
        .withColumn("slot", (F.col("before") + F.col("at") - F.col("first")).cast("long"))
        .select("doc_id", "size", "text_crc32", "shard", "slot")
    )
