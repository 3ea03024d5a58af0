from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from lodestar.functions.text import parse_timestamp, retry_after, word_count
from lodestar.functions.url import canonical_url, enforce_listing, listing_url, topic_slug, with_params
from lodestar.sources.jsonl import add_missing, append_items, free_path, known_keys, line_report, merge_snapshots, read_jsonl, read_lines, read_seeds

SCHEMA = StructType(
    [StructField("canonical_url", StringType()), StructField("version", IntegerType()), StructField("is_updated", BooleanType()), StructField("last_seen", StringType())]
)


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"canonical_url":"https://x/1/","version":1}\n\n{bad\n{"canonical_url":"https://x/2","last_seen":"2024-01-01T00:00:00Z"}\n')
    (tmp_path / "b.jsonl").write_text('{"canonical_url":"https://x/2","last_seen":"2024-02-01T00:00:00Z"}\n{"canonical_url":"https://x/1/","version":2}\n{"version":3}\n')
    files = [str(tmp_path / "*.jsonl")]
    assert read_jsonl(spark, files, SCHEMA).count() == 5
    assert sorted(r[0] for r in known_keys(spark, files).collect()) == ["https://x/1", "https://x/2"]
    out = merge_snapshots(spark, files, str(tmp_path / "out.jsonl"))
    want = ['{"canonical_url":"https://x/1/","version":2}', '{"canonical_url":"https://x/2","last_seen":"2024-02-01T00:00:00Z"}']
    assert sorted(r["value"] for r in out.collect()) == want
    stamped = free_path(spark, str(tmp_path / "out.jsonl"))
    assert stamped.endswith(".jsonl") and stamped.startswith(str(tmp_path / "out-"))
    assert read_jsonl(spark, [str(tmp_path / "nowhere.jsonl")], SCHEMA).count() == 0
    assert tuple(line_report(read_lines(spark, files), SCHEMA).first()) == (7, 1, 1)
    (tmp_path / "seeds.json").write_text('["https://s/1",\n "https://s/2"]')
    assert [r["url"] for r in read_seeds(spark, str(tmp_path / "seeds.json")).orderBy("pos").collect()] == ["https://s/1", "https://s/2"]


def test_sink(spark, tmp_path):
    df = spark.createDataFrame([("u", "t"), ("", "t"), ("u", None)], "canonical_url string, title string")
    append_items(df, str(tmp_path / "o"))
    append_items(df, str(tmp_path / "o"))
    assert spark.read.json(str(tmp_path / "o")).count() == 2
    assert add_missing(df, {"n": ("int", 0), "title": ("string", "")}).columns == ["canonical_url", "title", "n"]


def test_urls(spark):
    cases = ["HTTP://A.b/c/;p?q#f", "https://a.b//", "https://a.b/x y/", "a/b/", "https://a.b/c;d/e"]
    df = spark.createDataFrame([(c,) for c in cases], "u string")
    assert [r[0] for r in df.select(canonical_url(F.col("u"))).collect()] == ["http://A.b/c", "https://a.b", "https://a.b/x y", "a/b", "https://a.b/c;d/e"]
    one = spark.createDataFrame([("https://a.b/t?x=1&x=2&y=#f",)], "u string")
    assert one.select(with_params(F.col("u"), z="a b", w=None)).first()[0] == "https://a.b/t?x=2&y=&z=a+b#f"
    assert one.select(listing_url(F.col("u"), F.lit(3))).first()[0] == "https://a.b/t?x=2&y=&guide=1&page=3#f"
    assert one.select(enforce_listing(F.lit("https://a.b/?guide=1&p=2"))).first()[0] == "https://a.b/?guide=1&p=2"
    assert one.select(topic_slug(F.lit("https://a.b/")), topic_slug(F.lit("https://a.b/x/y/"))).first() == ("root", "y")


def test_text(spark):
    df = spark.createDataFrame([("a\x1cb c  d",), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(word_count(F.col("s"))).collect()] == [4, 0, 0]
    times = ["2024-01-01T00:00:00Z", "2024-01-01T02:00:00+0200", "2024-01-01T00:00:00.5", "2024-01-01", "x"]
    df = spark.createDataFrame([(x,) for x in times], "s string")
    assert [r[0] is not None for r in df.select(parse_timestamp(F.col("s"))).collect()] == [True, True, True, False, False]


def test_retry_after(spark):
    rows = [("120",), ("Wed, 01 May 2024 00:01:00 GMT",), ("Wed, 01 May 2023 00:01:00 GMT",), ("soon",), (None,)]
    now = F.lit("2024-05-01 00:00:00").cast("timestamp")
    got = spark.createDataFrame(rows, "h string").select(retry_after(F.col("h"), now)).collect()
    assert [r[0] for r in got] == [120.0, 60.0, None, None, None]


def test_merge_command(spark, tmp_path, capsys):
    from lodestar.plans.merge import main

    (tmp_path / "a.jsonl").write_text('{"canonical_url":"https://x/1","version":1}\n{"version":1}\n')
    assert main(["--inputs", str(tmp_path / "*.jsonl"), "--output", str(tmp_path / "m")], spark) == 0
    assert "2 read, 1 kept" in capsys.readouterr().out
    (tmp_path / "z b.jsonl").write_text('{"canonical_url":"https://x/9","version":1,"authors":[{"name":"Z"}],"n":1}\n{"canonical_url":"https://x/8"}\n')
    (tmp_path / "c.jsonl").write_text('{"canonical_url":"https://x/8","version":0}\n{"canonical_url":"https://x/9","version":1,"authors":[{"name":"C"}]}\n{"canonical_url":"https://x/7"}\n')
    assert main(["--inputs", str(tmp_path / "z b.jsonl"), str(tmp_path / "c.jsonl"), str(tmp_path / "[cz]*.jsonl"), "--output", str(tmp_path / "whole")], spark) == 0
    lines = [x for f in sorted((tmp_path / "whole").glob("part-*")) for x in f.read_text().splitlines()]
    # Whole records, the tie to the first file given though its name is later, in the order in which keys were met.
    assert lines == ['{"canonical_url":"https://x/9","version":1,"authors":[{"name":"Z"}],"n":1}', '{"canonical_url":"https://x/8"}', '{"canonical_url":"https://x/7"}']
    assert main(["--inputs", str(tmp_path / "none*.jsonl"), "--output", str(tmp_path / "m")], spark) == 1
