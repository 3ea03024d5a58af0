"""Sharding by best-fit-decreasing bin packing.

Indivisible groups, sorted by size, enter the bin whose remaining capacity is
the tightest that holds them, else a new one.  Groups of one size are alike, so
the packer takes runs (size, number of groups): a run fills the tightest bin
with as many as it holds, then the next.  That is best-fit-decreasing on every
single group, while the driver holds one entry for each size that occurs, at
most sqrt(2 x total bytes) of them.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import drop_written, hinted, join_counted, materialise

#: Ranks within a size and slots within a shard are counted in so many parts each, so none is ranked in one task.
PARTS = 1024


class Bins:
    """Remaining capacities in a balanced search tree of two levels: leaves of bounded length under a sorted root."""

    LEAF = 64

    def __init__(self) -> None:
        self.leaves: list[list[tuple[int, int]]] = []
        self.tops: list[tuple[int, int]] = []

    def add(self, entry: tuple[int, int]) -> None:
        if not self.leaves:
            self.leaves, self.tops = [[entry]], [entry]
            return
        i = min(bisect_left(self.tops, entry), len(self.leaves) - 1)
        leaf = self.leaves[i]
        insort(leaf, entry)
        self.tops[i] = leaf[-1]
        if len(leaf) > self.LEAF:
            half = len(leaf) // 2
            self.leaves[i : i + 1] = [leaf[:half], leaf[half:]]
            self.tops[i : i + 1] = [leaf[half - 1], leaf[-1]]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the entry of least remaining capacity that is not below ``size``."""
        i = bisect_left(self.tops, (size, -1))
        if i == len(self.leaves):
            return None
        leaf = self.leaves[i]
        entry = leaf.pop(bisect_left(leaf, (size, -1)))
        if leaf:
            self.tops[i] = leaf[-1]
        else:
            del self.leaves[i], self.tops[i]
        return entry


def best_fit_decreasing(runs: list[tuple[int, int]], capacity: int, most_bins: int | None = None) -> tuple[list[tuple[int, int, int]], int] | None:
    """Entries (size, groups, bin) and the number of bins, ``runs`` of (size, groups) being in decreasing order of size.

    None if more than ``most_bins`` are needed.  A group larger than ``capacity`` has a bin to itself.
    """
    tree, opened, placed = Bins(), 0, []
    for size, n in runs:
        while n:
            entry = tree.take_tightest(size)
            if entry is None:
                if opened == most_bins:
                    return None
                entry, opened = (max(capacity, size), opened), opened + 1
            k = min(n, entry[0] // size)
            placed.append((size, k, entry[1]))
            n -= k
            tree.add((entry[0] - k * size if entry[0] <= capacity else 0, entry[1]))
    return placed, opened


def pack_equal(runs: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int]]:
    """Best-fit-decreasing into ``bins`` bins at the least capacity, found by bisection, at which they hold all.

    Groups of an equal share or more each have a bin to themselves; the rest is packed equally in the others.
    """
    alone, left, total = [], [list(r) for r in runs], sum(s * n for s, n in runs)
    while left and bins - len(alone) > 1 and left[0][0] * (bins - len(alone)) >= total:
        size = left[0][0]
        alone.append((size, 1, len(alone)))
        total -= size
        left[0][1] -= 1
        if not left[0][1]:
            del left[0]
    if not left:
        return alone
    bins -= len(alone)
    low = max(-(-total // bins), left[0][0])
    high, best = low, None
    while best is None:
        best = best_fit_decreasing(left, high, bins)
        high = high if best is not None else high + max(1, (high - low) * 2, low // 4096)
    while low < high:
        middle = (low + high) // 2
        placed = best_fit_decreasing(left, middle, bins)
        if placed is None:
            low = middle + 1
        else:
            high, best = middle, placed
    return alone + [(size, n, b + len(alone)) for size, n, b in best[0]]


def _ranked(rows: DataFrame, key: str, spread: list[str], order: list[str], alias: str) -> DataFrame:
    """``rows`` with their rank from 0 within ``key``: counted within PARTS parts by the hash of ``spread``, and the parts' counts summed."""
    rows = rows.withColumn("__part", F.pmod(F.xxhash64(*spread), F.lit(PARTS)).cast("int"))
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(key, "__part").agg(F.count("*").alias("__n")).select(
        F.col(key).alias("__key"), F.col("__part").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    rank = F.row_number().over(Window.partitionBy(key, "__part").orderBy(*order))
    ranked = rows.withColumn("__rank", rank)
    return ranked.join(offsets, (F.col(key) == F.col("__key")) & (F.col("__part") == F.col("__of"))).withColumn(alias, F.col("__offset") + F.col("__rank") - 1).drop("__part", "__key", "__of", "__n", "__offset", "__rank")


def shard(docs: DataFrame, shards: int = 24, capacity: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, over_share) of each row, under the law ``bytes``.

    A row's size is its text's UTF-8 bytes plus 8.  Rows of equal text form a
    group, which is never divided: it is in one shard whole.  Slots count from 0
    in each shard without gaps.  With ``capacity`` the shards are as many as
    best-fit-decreasing needs at that size, in place of ``shards`` near-equal ones.

    A group larger than an equal share (or the capacity) has a shard to itself;
    ``over_share`` marks its rows, since no whole placement makes that shard
    equal to the others.  Null texts are empty (size 8); repeated rows each have
    a place; null ids are carried; texts of any length count by all their bytes;
    an empty table gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialise(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "shard-rows",
    )
    groups = materialise(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-groups")
    # One row for each size: of k sizes that differ, the total is k * k / 2 at least.
    sizes = groups.groupBy("bytes").agg(F.count("*").alias("groups"), F.sum("n").alias("n")).toPandas().sort_values("bytes", ascending=False)
    runs = [(int(b), int(g)) for b, g in zip(sizes["bytes"], sizes["groups"], strict=True)]
    total = sum(b * g for b, g in runs)
    placed = best_fit_decreasing(runs, capacity)[0] if capacity else pack_equal(runs, shards)
    limit = capacity or total / shards

    segments, next_rank = [], {}
    for size, n, b in placed:
        first = next_rank.get(size, 0)
        next_rank[size] = first + n
        segments.append((size, first, first + n, b))
    columns = list(zip(*segments, strict=True)) or [[]] * 4
    places = spark.createDataFrame(
        pa.table({"of_bytes": pa.array(columns[0], pa.int64()), "first": pa.array(columns[1], pa.int64()), "end": pa.array(columns[2], pa.int64()), "shard": pa.array(columns[3], pa.int32())})
    )
    ranked = _ranked(groups, "bytes", ["digest"], ["digest"], "rank")
    of_groups = ranked.join(hinted(places, len(segments) * 28), (F.col("bytes") == F.col("of_bytes")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    of_groups = materialise(of_groups.select("digest", "n", "shard", (F.col("bytes") > limit).alias("over_share")), "shard-places")
    united = materialise(join_counted(rows, of_groups, "digest", "n", int(sizes["n"].sum())), "shard-united")
    for table in (rows, groups, of_groups):
        drop_written(table)
    return _ranked(united, "shard", ["doc_id", "at"], ["doc_id", "at"], "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "over_share",
    )
