from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators.folds import upsert
from lodestar.operators.logstats import token_bucket
from lodestar.streaming.state import STATE, error_sessions, read_state, token_bucket_stream, upsert_stream, windowed_progress


def test_upsert_stream_equals_batch(spark, tmp_path):
    rows = [(f"k{i % 7}", i, None if i % 5 == 0 else f"h{(i * i) % 3}", None if i % 4 == 0 else f"t{i % 2}") for i in range(60)]
    df = spark.createDataFrame(rows, "key string, seq long, content_hash string, primary_topic string")
    for k in range(3):
        df.where((F.col("seq") >= k * 20) & (F.col("seq") < k * 20 + 20)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    upsert_stream(stream, f"{tmp_path}/state", f"{tmp_path}/check").awaitTermination()
    want = upsert(spark.createDataFrame([], STATE), df, "key", "seq")
    got = read_state(spark, f"{tmp_path}/state")
    assert sorted(map(tuple, got.select("key", "version").collect())) == sorted(map(tuple, want.select("key", "version").collect()))


def test_token_bucket_stream_equals_batch(spark, tmp_path):
    rows = [(i % 3, i * 300_000) for i in range(200)]
    df = spark.createDataFrame(rows, "key long, us long")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    out = token_bucket_stream(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"))
    q = out.writeStream.format("memory").queryName("bucket").outputMode("update").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(map(tuple, spark.table("bucket").collect()))
    assert got == sorted(map(tuple, token_bucket(df.withColumn("n", F.col("us")), "key", "n", "us").collect()))


def test_windows_and_sessions_plan(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    assert windowed_progress(events, every="1 day").agg(F.sum("n_events")).first()[0] == events.count()
    assert error_sessions(events, "user_id").agg(F.sum("streak")).first()[0] == events.count()
