"""Ordered folds as window functions: precedence merge, versioned upsert, first and last wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_records(records: DataFrame, key: str, seq: str, version: str = "version", updated: str = "is_updated", seen: str = "last_seen") -> DataFrame:
    """One record for each key: higher version, then an updated one, then later ``seen`` if both have one, else the earlier.

    Rows of null or empty key are dropped.  A first record without ``seen`` is never replaced by its equals.
    """
    rank = Window.partitionBy(key).orderBy(F.coalesce(version, F.lit(0)).desc(), F.coalesce(updated, F.lit(False)).desc())
    best = records.where(F.coalesce(F.col(key), F.lit("")) != "").withColumn("__rank", F.dense_rank().over(rank)).where("__rank = 1")
    first = Window.partitionBy(key).orderBy(seq)
    whole = first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    best = best.withColumn("__head", F.first(F.col(seen).isNull()).over(whole))
    pick = Window.partitionBy(key).orderBy(F.when(F.col("__head"), F.lit(None)).otherwise(F.col(seen)).desc_nulls_last(), F.col(seq))
    return best.withColumn("__pick", F.row_number().over(pick)).where("__pick = 1").drop("__rank", "__head", "__pick")


def merge_summary(records: DataFrame, key: str) -> DataFrame:
    """(total, unique_keys): rows read and keys kept."""
    named = F.when(F.coalesce(F.col(key), F.lit("")) != "", F.col(key))
    return records.agg(F.count("*").alias("total"), F.count_distinct(named).alias("unique_keys"))


def versioned(events: DataFrame, key: str, seq: str, content: str = "content_hash", topic: str = "primary_topic") -> DataFrame:
    """``events`` with version, is_new, is_updated and the topic held after each event.

    A new key has version 1; a content hash that is not empty and differs from
    the last raises the version and sets the topic, even to null; otherwise the
    version stays and a topic that is not null replaces the old.
    """
    order = Window.partitionBy(key).orderBy(seq)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    now = F.nullif(F.col(content), F.lit(""))
    out = events.withColumns({"__prev": F.last(now, ignorenulls=True).over(before), "__n": F.row_number().over(order)})
    out = out.withColumn("is_new", F.col("__n") == 1).withColumn(
        "is_updated", (F.col("__n") > 1) & now.isNotNull() & ~now.eqNullSafe(F.col("__prev"))
    )
    out = out.withColumn("version", (F.lit(1) + F.sum(F.col("is_updated").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))).cast("int"))
    within = Window.partitionBy(key, "version").orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("held_topic", F.last(F.col(topic), ignorenulls=True).over(within)).drop("__prev", "__n")


def upsert(state: DataFrame, events: DataFrame, key: str, seq: str, content: str = "content_hash", topic: str = "primary_topic") -> DataFrame:
    """The state (key, content, topic, version) after ``events``, the stored rows being their keys' first events."""
    stored = state.select(key, content, topic, F.col("version").alias("__base"), F.lit(None).cast(events.schema[seq].dataType).alias(seq), F.lit(0).alias("__new"))
    fresh = events.select(key, content, topic, F.lit(None).cast("int").alias("__base"), seq, F.lit(1).alias("__new"))
    every = stored.unionByName(fresh).withColumn("__order", F.struct("__new", seq))
    done = versioned(every, key, "__order", content, topic)
    return done.groupBy(key).agg(
        F.max_by(content, F.when(F.coalesce(F.col(content), F.lit("")) != "", F.col("__order"))).alias(content),
        F.max_by("held_topic", "__order").alias(topic),
        (F.max("version") + F.coalesce(F.max("__base"), F.lit(1)) - 1).cast("int").alias("version"),
    )


def first_by(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(seq))).where("__n = 1").drop("__n")


def last_value(rows: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """The value written last for each key."""
    return rows.groupBy(key).agg(F.max_by(value, seq).alias(value))


def progress(visits: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Topic progress after ``visits`` (topic, seq, pages, guides, page_number, complete): sums, the last page and whether ever complete."""
    now = visits.groupBy("topic").agg(
        F.sum("pages").alias("pages_crawled"), F.sum("guides").alias("guides_crawled"), F.max_by("page_number", "seq").alias("last_page_number"), F.max("complete").alias("is_complete")
    )
    if state is None:
        return now
    old = state.select(*(F.col(c).alias(f"__{c}") for c in now.columns))
    both = now.join(old, F.col("topic") == F.col("__topic"), "full")
    return both.select(
        F.coalesce("topic", "__topic").alias("topic"),
        *((F.coalesce(c, F.lit(0)) + F.coalesce(f"__{c}", F.lit(0))).alias(c) for c in ("pages_crawled", "guides_crawled")),
        F.coalesce("last_page_number", "__last_page_number").alias("last_page_number"),
        F.greatest("is_complete", "__is_complete").alias("is_complete"),
    )
