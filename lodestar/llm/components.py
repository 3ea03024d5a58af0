"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import drop_written, join_counted, materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an edge, component being the least node reachable.

    Alternates large-star and small-star steps until the edges are stars, which
    takes a number of rounds that grows with the logarithm of a component's
    size.  Each round is a minimum per node and a join with the minima in which
    hubs are joined by a broadcast, so no task gathers a hub's edges; its result
    is written to the shared folder.  Loops and repeated edges do no harm; edges
    with a null end are left out.
    """

    def with_minima(df: DataFrame) -> DataFrame:
        least = df.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        return join_counted(df, least, "u", "n", rows)

    pairs = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    current, before = materialise(pairs, "edges"), None
    rows = 2 * current.count()
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_minima(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "edges")
        small = with_minima(large)
        small = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(small.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = materialise(small, "edges")
        drop_written(current)
        drop_written(large)
        current = after
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
