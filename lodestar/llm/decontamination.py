"""Benchmark decontamination with SimHash windows.  DataFrame functions only.

A document's windows of a benchmark item's size are fingerprinted with SimHash:
each word votes on 64 bits.  Fingerprints meet the items' in a multi-index of
four blocks of 16 bits.  Of two fingerprints that differ in ``radius`` bits at
most, some block differs in radius // 4 bits at most; the items' blocks are
entered with that many bits flipped in every way, so every pair within the
radius is met.  Documents and items that meet are verified by the exact weighted
Jaccard similarity of their windows' shingle multisets.

Words and not shingles vote, since a changed word changes up to five shingles:
windows of a shingle similarity of 0.8 differ from their item in 3 to 9 of 64
bits on the median and in more than 15 once in some hundred pairs or less (see
README), where radius 23 would be needed for shingles' votes, and blocks of two
or three bits, which keep nothing apart.

Windows are laid only where one can reach the similarity: a window must hold a
certain number of the item's shingles, so it starts near one of them.  That
choice loses nothing.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import drop_written, fresh, hinted, materialise, size_of

BITS = 64

#: Blocks of the multi-index, of BITS // BLOCKS bits each.
BLOCKS = 4


def words(text: Column) -> Column:
    """The letter and digit runs of the lower-cased text."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(column: str, k: int) -> Column:
    """Hashes of the runs of ``k`` entries of a column of word hashes, in order."""
    run = ", ".join(f"{column}[i + {j}]" for j in range(k))
    return F.expr(f"if(size({column}) < {k}, cast(array() as array<bigint>), transform(sequence(0, size({column}) - {k}), i -> xxhash64({run})))")


def simhash(column: str) -> Column:
    """The sign of each bit's vote over an array of hashes; an entry votes as often as it occurs."""
    return F.expr(
        f"aggregate(sequence(0, {BITS - 1}), 0L, (f, b) -> f | shiftleft("
        f"if(2 * aggregate({column}, 0, (n, h) -> n + cast(shiftright(h, b) & 1L as int)) > size({column}), 1L, 0L), b))"
    )


def flips(radius: int) -> list[int]:
    """Masks of a block with radius // BLOCKS bits or fewer."""
    width = BITS // BLOCKS
    return [sum(1 << b for b in bits) for n in range(radius // BLOCKS + 1) for bits in combinations(range(width), min(n, width))]


def _blocks(column: str) -> Column:
    width = BITS // BLOCKS
    return F.posexplode(F.array(*[F.shiftrightunsigned(F.col(column), i * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int") for i in range(BLOCKS)])).alias("block", "bits")


def weighted_overlap(a: str, b: str) -> Column:
    """Size of the intersection of two multisets given as arrays."""
    return F.expr(
        f"if(size(array_distinct({a})) = size({a}) and size(array_distinct({b})) = size({b}), size(array_intersect({a}, {b})), "
        f"aggregate(array_intersect({a}, {b}), 0, (n, h) -> n + least(size(filter({a}, x -> x = h)), size(filter({b}, x -> x = h)))))"
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    k: int = 5,
    similarity: float = 0.8,
    radius: int = 15,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, similarity, start_word) of each document that holds a benchmark item, with its best and first window.

    Texts are lower-cased and cut into runs of letters and digits.  An item's
    shingles are its runs of ``k`` words, or with fewer words the whole item.
    A window holds as many shingles as the item, or all of a shorter document;
    similarity is the shared weight over the joint weight, a shingle weighing as often
    as it occurs.

    Null or empty texts and items match nothing.  Equal (id, text) rows give
    one row per item; null ids are carried; items of one id and text count once.
    Of windows equally good the first counts.  Texts of any length are read
    whole.  Empty tables give no rows; other columns are not read.
    """
    return _found(docs, benchmark, k, similarity, radius, id_col, text_col).drop("text_key")


def _found(docs, benchmark, k=5, similarity=0.8, radius=15, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of ``contaminated``, with the hash of the text that holds the item."""
    items = (
        benchmark.select("item_id", words(F.col("text")).alias("w"))
        .where(F.size("w") > 0)
        .select("item_id", F.least(F.lit(k), F.size("w")).alias("k"), F.transform("w", lambda x: F.xxhash64(x)).alias("w"))
        .distinct()
    )
    found = [
        _contaminated(docs, items.where(F.col("k") == size).select("item_id", "w"), size, similarity, radius, id_col, text_col)
        for size in sorted(r["k"] for r in items.select("k").distinct().collect())
    ]
    if not found:
        return docs.sparkSession.createDataFrame([], f"doc_id long, text_key long, item_id {benchmark.schema['item_id'].dataType.simpleString()}, similarity double, start_word int")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _contaminated(docs, items, k, similarity, radius, id_col, text_col) -> DataFrame:
    items = items.select("item_id", shingles("w", k).alias("item"), simhash("w").alias("item_print"))
    items = materialise(items.withColumns({"n": F.size("item"), "item_no": F.monotonically_increasing_id()}), "items")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))

    def shingled(of: DataFrame, *more: str) -> DataFrame:
        # Outer generators from here on: the others have a filter on their array, which is pushed below the
        # projections and there computes all the words again for each shingle.
        hashed = of.select("doc_id", "text_key", words(F.col("text")).alias("w"), *more).withColumn("w", F.transform("w", lambda x: F.xxhash64(x)))
        return hashed.withColumn("s", shingles("w", k))

    seeds = materialise(items.select("item_no", "n", F.explode("item").alias("h")).distinct(), "item-shingles")
    hits = (
        shingled(texts).select("doc_id", "text_key", F.size("s").alias("total"), "s")  # else each shingle's row would carry the array
        .select("doc_id", "text_key", "total", F.posexplode_outer("s").alias("pos", "h"))
        .join(hinted(seeds, size_of(seeds)), "h")
        .groupBy("doc_id", "text_key", "item_no", "n", "total")
        .agg(F.sort_array(F.collect_set("pos")).alias("p"))
    )
    # A window of m shingles reaches the similarity with an item of n only if it holds ``least`` of the item's shingles.
    least = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("n") + F.col("m")) - F.lit(1e-9)).cast("int")
    hits = hits.withColumn("m", F.least("n", "total")).withColumn("least", least).where(F.size("p") >= F.col("least"))
    in_reach = "filter(sequence(0, size(p) - least), i -> p[i + least - 1] - p[i] < m and greatest(0, p[i + least - 1] - m + 1, p[i] - m + least) <= least(p[i], total - m))"
    starts = F.expr(
        f"array_distinct(flatten(transform({in_reach}, i -> sequence(greatest(0, p[i + least - 1] - m + 1, p[i] - m + least), least(p[i], total - m)))))"
    )
    laid = hits.select(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text"), "n", "m", F.explode(starts).alias("start")).distinct()
    laid = laid.groupBy("of_doc", "of_text").agg(F.collect_list(F.struct("n", "m", "start")).alias("windows"))
    laid = materialise(laid, "windows")

    # Only documents that hold windows are cut into words again.
    own = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text"))
    held = texts.join(hinted(laid, size_of(laid)), own).dropDuplicates(["doc_id", "text_key"])
    cut = f"transform(windows, x -> struct(x.n, x.start, slice(s, x.start + 1, x.m) as window, slice(w, x.start + 1, x.m + {k - 1}) as words))"
    windows = (
        shingled(held, "windows")
        .select("doc_id", "text_key", F.explode_outer(F.expr(cut)).alias("x"))
        .select("doc_id", "text_key", "x.*")
        .withColumn("print", simhash("words"))
        .drop("words")
    )
    windows = materialise(windows, "fingerprints")
    entries = (
        items.select("item_no", "n", "item_print", _blocks("item_print"))
        .withColumn("bits", F.explode(F.transform(F.lit(flips(radius)), lambda mask: F.col("bits").bitwiseXOR(mask.cast("int")))))
    )
    entries = materialise(entries, "multi-index")
    near = (
        windows.select("doc_id", "text_key", "n", "print", _blocks("print"))
        .join(hinted(entries, size_of(entries)), ["n", "block", "bits"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .select(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text"), "item_no")
        .distinct()
    )
    # Of a document and an item that meet, all windows laid are verified, so the best is found.
    near = materialise(near, "near")
    joint = F.size("window") + F.size("item") - F.col("shared")
    met = near.join(items.select("item_no", "item_id", "item", F.col("n").alias("size")), "item_no")
    verified = (
        windows.join(met, own & (F.col("n") == F.col("size")))
        .withColumn("shared", weighted_overlap("window", "item"))
        .withColumn("similarity", F.col("shared").cast("double") / joint)
        .where(F.col("similarity") >= similarity)
    )
    found = materialise(
        verified.groupBy("doc_id", "text_key", "item_id")
        .agg(F.max(F.struct(F.col("similarity"), (-F.col("start")).alias("s"))).alias("best"))
        .select("doc_id", "text_key", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.s")).cast("int").alias("start_word")),
        "contaminated",
    )
    for df in (items, seeds, laid, windows, entries, near):
        drop_written(df)
    return found


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no benchmark item.

    Rows are judged by id and text: a clean text stays beside a leaking one of
    its id, be the id null or not.  Null and empty texts stay; repeated rows
    stay or go together; columns of any name may stand beside the two; without
    items all rows stay, and an empty table stays empty.
    """
    of_doc, of_text = fresh(docs, "of_doc", "of_text")
    found = _found(docs, benchmark, **options).select(F.col("doc_id").alias(of_doc), F.col("text_key").alias(of_text)).distinct()
    found = materialise(found, "leaking")
    id_, text = F.col(options.get("id_col", "doc_id")), F.coalesce(F.col(options.get("text_col", "text")), F.lit(""))
    return docs.join(hinted(found, size_of(found)), id_.eqNullSafe(F.col(of_doc)) & (F.xxhash64(text) == F.col(of_text)), "left_anti")
