"""Joins, set operations, limits and orders over key tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unseen(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(existing, keys, "left_anti")


def seen(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(existing, keys, "left_semi")


def with_seeds(found: DataFrame, seeds: DataFrame, key: str, least: int) -> DataFrame:
    """``found``, and the seeds that it lacks if it has less than ``least`` rows."""
    few = found.agg((F.count("*") < least).alias("few"))  # one row
    lacking = seeds.join(found.select(key), key, "left_anti").join(F.broadcast(few)).where("few").drop("few")
    return found.unionByName(lacking, allowMissingColumns=True)


def insert_ignore(bridge: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``bridge`` with the rows whose keys it lacks, each once."""
    return bridge.unionByName(rows.dropDuplicates(keys).join(bridge.select(*keys), keys, "left_anti"))


def resume(topics: DataFrame, progress: DataFrame) -> DataFrame:
    """Where each topic goes on: the page after the last, nowhere if it is complete."""
    return topics.join(progress, "topic", "left").select(
        "topic",
        (F.coalesce("last_page_number", F.lit(0)) + 1).alias("start_page"),
        F.coalesce("is_complete", F.lit(False)).alias("exhausted"),
    )


def topic_counts(topics: DataFrame, bridge: DataFrame, key: str) -> DataFrame:
    """Rows of the bridge for each topic, 0 for none, in the order of the topics."""
    counts = bridge.groupBy(key).agg(F.count("*").alias("n_guides"))
    return topics.join(counts, key, "left").withColumn("n_guides", F.coalesce("n_guides", F.lit(0).cast("long"))).orderBy(key)


def top_n(rows: DataFrame, groups: list[str], order: list[str], n: int) -> DataFrame:
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col("__n") <= n).drop("__n")


#: Groups sampled for each range that ``group_ranges`` deals.
SAMPLED = 20


def group_ranges(rows: DataFrame, group: str, parts: int) -> DataFrame:
    """``rows`` with ``__part``, the range of the row's group: about ``parts`` ranges in ascending order, nulls in the last.

    Hashes choose the groups that bound the ranges, so a plan that is computed
    twice finds the same ones; ``repartitionByRange`` draws its bounds anew each time.
    """
    groups = rows.select(F.col(group).alias("__of")).where("__of is not null").distinct()
    chosen = groups.orderBy(F.xxhash64("__of"), "__of").limit(parts * SAMPLED)
    bounds = chosen.agg(F.sort_array(F.collect_list("__of")).alias("__of")).select(F.filter("__of", lambda x, i: (i + 1) % SAMPLED == 0).alias("__bounds"))
    steps = F.sequence(F.lit(1), F.lit(parts.bit_length()))

    def halve(s, _):
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        right = F.get("__bounds", middle) <= F.col(group)
        return (
            F.when(s["low"] >= s["high"], s)
            .when(right, F.struct((middle + 1).alias("low"), s["high"].alias("high")))
            .otherwise(F.struct(s["low"].alias("low"), middle.alias("high")))
        )

    found = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size("__bounds").alias("high")), halve, lambda s: s["low"])
    part = F.when(F.col(group).isNull(), F.size("__bounds") + 1).otherwise(found)
    return rows.join(F.broadcast(bounds)).withColumn("__part", part).drop("__bounds")


def round_robin(rows: DataFrame, group: str, order: str) -> DataFrame:
    """(round, place in the round): each round takes the next row of each group, groups in order, nulls last.

    Groups are counted before rows are: a place in round n is the number of
    groups up to this one that have n rows.  A round is dealt out by ranges of
    groups and the ranges' counts summed, so the first round, which all groups have, is not one task's.
    """
    ranged = group_ranges(rows, group, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    turn = ranged.withColumn("round", F.row_number().over(Window.partitionBy(group).orderBy(F.col(order).asc_nulls_last())))
    within = F.row_number().over(Window.partitionBy("__part", "round").orderBy(group))
    before = Window.partitionBy("__round").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    counts = turn.groupBy(F.col("round").alias("__round"), F.col("__part").alias("__of")).agg(F.count("*").alias("__n"))
    counts = counts.select("__round", "__of", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    placed = turn.withColumn("__within", within).join(counts, (F.col("round") == F.col("__round")) & (F.col("__part") == F.col("__of")))
    return placed.withColumn("place", F.col("__offset") + F.col("__within")).drop("__part", "__round", "__of", "__n", "__offset", "__within")


def ordered_union(tables: list[DataFrame], order: str) -> DataFrame:
    """All rows of the tables, with ``seq`` = (place of the table, ``order`` in it): a fold by it takes the tables one after the other."""
    parts = [t.withColumn("seq", F.struct(F.lit(i).alias("table"), F.col(order).alias("place"))) for i, t in enumerate(tables)]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def seeded_order(rows: DataFrame, key: str, seed: str) -> DataFrame:
    """A shuffle that the seed settles: by the MD5 of key and seed, then by key."""
    return rows.orderBy(F.md5(F.concat(F.col(key), F.lit(seed))), key)
