"""Helpers that the training-data operators share: written tables and id order."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from itertools import count

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, which the cluster names in ``spark.checkpoint.dir``.

    Where that is unset it is a folder in the warehouse, which machines share
    too; on a local master, with all in one process, a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.master.startswith("local"):
        return f"file://{tempfile.gettempdir()}/lodestar-{context.applicationId}"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/lodestar/{tag}-{uuid.uuid4().hex}"


#: After so many written tables the driver gives back what memory it can.
RELEASE_EVERY = 6
_WRITTEN = count(1)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor costs only the tasks after the
    written table, and no later job computes what stands before it again.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    if next(_WRITTEN) % RELEASE_EVERY == 0:
        release(spark)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table made by ``materialise`` that nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def trim_native(spark: SparkSession) -> str | None:
    """Let the driver's JVM give back the free memory of its native heap; what it tells of that, or None where it has no such command."""
    jvm, new_array = spark._jvm, spark.sparkContext._gateway.new_array
    kinds, args = new_array(jvm.Class, 4), new_array(jvm.Object, 4)
    for i, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[i] = jvm.Class.forName(name)
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        # By reflection on the interface: the server's own class is not open to callers.
        invoke = jvm.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds)
        return invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JJavaError:
        return None


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffles and broadcasts of jobs that are over, and the driver's JVM give its free memory back.

    It does so once the driver's JVM has collected what named them, which else
    may be long after; Python's references to them form cycles.  The native
    heap keeps what planning and compiling freed until it is trimmed.
    """
    gc.collect()
    spark._jvm.System.gc()
    trim_native(spark)


#: A table is broadcast up to so many bytes; beyond that it is joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def hinted(df: DataFrame, size: int) -> DataFrame:
    """The small side of a join by its size in bytes: broadcast up to BROADCAST_BYTES, else hashed after a shuffle."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df.hint("shuffle_hash")


#: Bytes that a row of a broadcast table takes beside its values: its key once more, headers and the hash table's slots.
HASHED_ROW = 96


def size_of(df: DataFrame) -> int:
    """Bytes that the rows of a table take in memory: eight for each number, and strings and lists by their lengths."""

    def width(column, kind) -> object:
        if isinstance(kind, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + 16
        if isinstance(kind, StructType):
            return sum((width(column[f.name], f.dataType) for f in kind.fields), F.lit(16).cast("long"))
        if isinstance(kind, ArrayType):
            return F.coalesce(F.aggregate(column, F.lit(16).cast("long"), lambda n, x: n + width(x, kind.elementType)), F.lit(0).cast("long"))
        return F.lit(8).cast("long")

    return df.select(F.sum(sum((width(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(16).cast("long")))).first()[0] or 0


#: Keys that hold HOT_ROWS rows or more are joined apart from the others, HOT_KEYS keys at most, so their table can be broadcast.
HOT_KEYS = 4096
HOT_ROWS = 1000


def join_counted(left: DataFrame, right: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """The inner join of ``left`` with ``right``, which has one row for each key and in column ``n`` the key's rows in ``left``.

    Keys of more than HOT_ROWS and ``total`` / HOT_KEYS rows are joined by a
    broadcast, so no task gets a hot key's rows; only the others are shuffled.
    Column ``n`` is dropped.  Both tables are read twice, so they had better be
    written ones.
    """
    least = max(HOT_ROWS, total // HOT_KEYS)
    hot = F.broadcast(right.where(F.col(n) > least).drop(n))
    cold = right.where(F.col(n) <= least).drop(n)
    return left.join(hot, key).unionByName(left.join(hot, key, "left_anti").join(cold, key))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until it differs from all columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(column: str = "text"):
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def in_id_order(texts: DataFrame) -> DataFrame:
    """(part, doc_id, text) rows dealt into ranges in ascending order and sorted there; part numbers the ranges.

    Nulls come first, equal ids in the order of their texts' hashes; rows equal in both are dealt out, too, so no range has to hold a hot id.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("__key"), F.col("__at")]
    keyed = texts.select("doc_id", "text", F.xxhash64("text").alias("__key"), F.monotonically_increasing_id().alias("__at"))
    dealt = keyed.repartitionByRange(shuffle_partitions(texts.sparkSession), *order).sortWithinPartitions(*order)
    return dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Let Arrow batches to Python hold so many rows at most: texts can be long, and memory is to stay bounded."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


#: By a mapper's name, what empties the memo that it keeps in its worker from task to task.
KEPT: dict[str, Callable[[], None]] = {}


def slim(mapper: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``mapper`` for mapInArrow, after which the worker gives its free memory back: it stays beside its executor for later tasks.

    Memos that other mappers keep in the worker are emptied first.
    """
    name = mapper.__name__

    def run(batches):
        from lodestar.llm.common import KEPT  # the worker's own

        for other, empty in KEPT.items():
            if other != name:
                empty()
        yield from mapper(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
        if trim is not None:
            trim(0)

    return run
