"""Streaming: versioned upsert by batches and keyed state machines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lodestar.operators.folds import upsert

STATE = "key string, content_hash string, primary_topic string, version int"


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest state table below ``path``; empty if there is none."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    epochs = [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []
    done = [int(e.removeprefix("epoch=")) for e in epochs if e.startswith("epoch=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{e}/_SUCCESS"))]
    if not done:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(f"{path}/epoch={max(done)}")


def upsert_stream(events: DataFrame, path: str, checkpoint: str, seq: str = "seq") -> StreamingQuery:
    """Upsert each micro-batch of (key, seq, content_hash, primary_topic) into the state below ``path``.

    An epoch writes a folder of its own from the one before it, so a batch that is run again gives the same state.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = spark.createDataFrame([], STATE) if epoch == 0 else spark.read.schema(STATE).parquet(f"{path}/epoch={epoch - 1}")
        upsert(before, batch, "key", seq).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def token_bucket_stream(arrivals: DataFrame, capacity: float = 12.0, initial: float = 8.4, per_second: float = 1.2) -> DataFrame:
    """(key, admitted, delayed) so far, each time a key has arrivals: a token bucket kept as keyed state.

    ``arrivals`` has (key long, us long); a micro-batch's arrivals of a key are taken in order of time.
    """

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        at, have, yes, no = state.get if state.exists else (None, initial, 0, 0)
        for us in sorted(int(x) for b in batches for x in b["us"]):
            have = min(capacity, have + per_second * max(0, us - (us if at is None else at)) / 1e6)
            at = us
            if have >= 1:
                have, yes = have - 1, yes + 1
            else:
                no += 1
        state.update((at, have, yes, no))
        yield pd.DataFrame({"key": [key[0]], "admitted": [yes], "delayed": [no]})

    return arrivals.groupBy("key").applyInPandasWithState(
        step, "key long, admitted long, delayed long", "at long, have double, yes long, no long", "update", "NoTimeout"
    )


def windowed_progress(events: DataFrame, ts: str = "ts", late: str = "10 minutes", every: str = "60 seconds") -> DataFrame:
    """Events and errors of each window, closed when the watermark passes it."""
    return (
        events.withWatermark(ts, late)
        .groupBy(F.window(ts, every))
        .agg(F.count("*").alias("n_events"), F.count_if(F.col("event_type") == "error").alias("n_errors"))
        .select("window.start", "n_events", "n_errors")
    )


def error_sessions(events: DataFrame, key: str, ts: str = "ts", gap: str = "120 seconds", late: str = "10 minutes") -> DataFrame:
    """Streaks of hits: sessions that end after a gap."""
    return (
        events.withWatermark(ts, late)
        .groupBy(key, F.session_window(ts, gap).alias("w"))
        .agg(F.count("*").alias("streak"))
        .select(key, "w.start", "w.end", "streak")
    )
