"""JSON-lines sources and sinks, and the snapshot merge over them."""

from __future__ import annotations

import posixpath
import re
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from lodestar.functions.text import parse_timestamp
from lodestar.functions.url import canonical_url
from lodestar.operators.folds import merge_records

CORRUPT = "_corrupt_record"


def expand(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Files that the patterns match, each once, in the order of the patterns and by name within one; none for a path that is not there."""
    found: dict[str, None] = {}
    for pattern in patterns:
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        matched = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
        for name in sorted(s.getPath().toString() for s in matched if s.isFile()):
            found.setdefault(name)
    return list(found)


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value, seq) of the lines of all files that ``paths`` (globs, too) match, none if there is none.

    ``seq`` = (place of the file, block, place in it) is the order of the
    files, not of their names.  Lines are numbered in the blocks in which they are read.
    """
    files = expand(spark, paths)
    if not files:
        return spark.createDataFrame([], "value string, seq struct<file:int,block:bigint,at:bigint>")
    lines = spark.read.text(files).select(
        "value", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")
    )
    # A file's own name and its URI: the scan tells one or the other.
    names = {re.sub("^file:/+", "file:/", n): i for i, f in enumerate(files) for n in (f, spark._jvm.org.apache.hadoop.fs.Path(f).toUri().toString())}
    places = spark.createDataFrame(list(names.items()), "path string, file int")
    return lines.join(F.broadcast(places), "path").select("value", F.struct("file", "block", "at").alias("seq"))


def parse_lines(lines: DataFrame, schema: StructType) -> DataFrame:
    """``lines`` with their record r; blank lines and lines that do not parse are left out."""
    tolerant = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.where(F.trim("value") != "").withColumn("r", F.from_json("value", tolerant, options))
    return parsed.where(F.col(f"r.{CORRUPT}").isNull()).withColumn("r", F.col("r").dropFields(CORRUPT))


def line_report(lines: DataFrame, schema: StructType) -> DataFrame:
    """(n_lines, n_blank, n_bad): lines read, and those of them that hold no record."""
    blank = F.trim("value") == ""
    tolerant = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    bad = F.from_json("value", tolerant, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})[CORRUPT].isNotNull()
    return lines.agg(F.count("*").alias("n_lines"), F.count_if(blank).alias("n_blank"), F.count_if(~blank & bad).alias("n_bad"))


def read_jsonl(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """Rows of all lines that parse; blank lines and lines that don't are left out (``line_report`` counts them).  Paths may be globs; a missing one has no rows."""
    return parse_lines(read_lines(spark, paths), schema).select("r.*")


def known_keys(spark: SparkSession, paths: list[str], field: str = "canonical_url") -> DataFrame:
    """Distinct canonical keys; lines without the field's name are not parsed."""
    return keys_of(read_lines(spark, paths), field)


def keys_of(lines: DataFrame, field: str = "canonical_url") -> DataFrame:
    """``known_keys`` of lines."""
    named = lines.where(F.col("value").contains(f'"{field}"'))
    return named.select(canonical_url(F.get_json_object("value", f"$.{field}")).alias(field)).where(F.col(field) != "").distinct()


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """The strings of a JSON array, with their place."""
    return seeds_of(spark.read.text(path, wholetext=True))


def seeds_of(text: DataFrame) -> DataFrame:
    return text.select(F.posexplode(F.from_json("value", "array<string>")).alias("pos", "url"))


def valid(items: DataFrame, required: tuple[str, ...] = ("canonical_url", "title")) -> DataFrame:
    """Items whose required fields are there and not empty."""
    for c in required:
        items = items.where(F.coalesce(F.col(c), F.lit("")) != "")
    return items


def drop_report(items: DataFrame, required: tuple[str, ...] = ("canonical_url", "title")) -> DataFrame:
    """(n_items, n_dropped): how many of them ``valid`` leaves out."""
    lacking = F.lit(False)
    for c in required:
        lacking = lacking | (F.coalesce(F.col(c), F.lit("")) == "")
    return items.agg(F.count("*").alias("n_items"), F.count_if(lacking).alias("n_dropped"))


def append_items(items: DataFrame, path: str, required: tuple[str, ...] = ("canonical_url", "title")) -> None:
    """Append the valid items as JSON lines with their nulls."""
    valid(items, required).write.mode("append").option("ignoreNullFields", "false").json(path)


def free_path(spark: SparkSession, path: str) -> str:
    """``path``, or with a time stamp and then a number before its extension where it exists."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path

    def there(p: str) -> bool:
        at = jvm(p)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)

    if not there(path):
        return path
    stem, ext = posixpath.splitext(path)
    stem = f"{stem}-{time.strftime('%Y%m%d-%H%M%S')}"
    candidate, n = stem + ext, 1
    while there(candidate):
        candidate, n = f"{stem}-{n}{ext}", n + 1
    return candidate


#: The fields of a snapshot's record that decide a merge.
DECIDING = StructType(
    [StructField("canonical_url", StringType()), StructField("version", IntegerType()), StructField("is_updated", BooleanType()), StructField("last_seen", StringType())]
)


def merge_lines(lines: DataFrame) -> DataFrame:
    """(canonical_url, value, first, seq): the line of each key's record by version, updated flag and last_seen, and where the key is first met.

    ``lines`` are (value, seq).  A line is kept as it stands, with all its fields.
    """
    rows = parse_lines(lines, DECIDING).select("r.*", "value", "seq")
    rows = rows.withColumns({"__seen": parse_timestamp(F.col("last_seen")), "first": F.min("seq").over(Window.partitionBy("canonical_url"))})
    return merge_records(rows, "canonical_url", "seq", seen="__seen").select("canonical_url", "value", "first", "seq")


def merge_snapshots(spark: SparkSession, paths: list[str], out: str | None = None) -> DataFrame:
    """``merge_lines`` over all snapshot files in the order of ``paths``; written to ``out`` as whole records in the order in which their keys were first met."""
    merged = merge_lines(read_lines(spark, paths))
    if out:
        merged.orderBy("first").select("value").write.mode("errorifexists").text(free_path(spark, out))
    return merged


def log_line(**fields: Column) -> Column:
    """A structured log event: JSON with its keys in order."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def add_missing(df: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """Additive schema migration: columns (type, default) that ``df`` lacks."""
    return df.withColumns({c: F.lit(default).cast(kind) for c, (kind, default) in columns.items() if c not in df.columns})
