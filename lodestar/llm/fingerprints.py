"""Document fingerprints: a canonical exact digest.

A text's canonical form is its NFKC normalisation, case-folded, with runs of
white space as one space and none at the ends.  Its fingerprint is the 128-bit
xxh3 digest of that form.  Inside equal digests the canonical bytes decide.
"""

from __future__ import annotations

import hashlib
import unicodedata

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import hinted, in_id_order, join_counted, materialise, slim, small_batches


def canonical(text: str | None) -> bytes:
    text = unicodedata.normalize("NFKC", text or "").casefold()
    return unicodedata.normalize("NFKC", " ".join(text.split())).encode("utf-8", "surrogatepass")


def digest(canonical_bytes: bytes, digits: int = 32) -> str:
    return xxhash.xxh3_128_hexdigest(canonical_bytes)[:digits]


def likeness(a: bytes, b: bytes, digest_a: str, digest_b: str) -> float:
    """1 if the digests are equal and so are the bytes under them, else 0."""
    return float(digest_a == digest_b and a == b)


def _forms(docs: DataFrame, digits: int) -> DataFrame:
    """(doc_id, fingerprint, form) of each row."""

    def keyed(batches):
        for batch in batches:
            forms = [canonical(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([digest(f, digits) for f in forms], pa.string()), pa.array(forms, pa.binary())],
                names=["doc_id", "fingerprint", "form"],
            )

    return docs.mapInArrow(slim(keyed), "doc_id long, fingerprint string, form binary")


def exact_groups(docs: DataFrame, prints: DataFrame | None = None, digits: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``prints`` with group_id: rows of one canonical text share the least doc_id among them.

    ``prints`` is a written table with doc_id and fingerprint, by default one row (doc_id,
    fingerprint) for each row of ``docs``.  Rows are grouped by digest.  Where a digest has more than one row,
    canonical bytes are compared: equal ones are merged in each task before
    they travel, so a hot group is small when it arrives.  Canonical texts that
    share a digest without being equal (``digits`` of it can be shortened to
    see that) form groups of their own; only rows that share both an id and such a digest are not
    told apart and take the least of their groups.  Null texts are empty; null ids name no
    group and have a null one alone; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if prints is None:
        prints = materialise(_forms(docs, digits).select("doc_id", "fingerprint"), "fingerprint-ids")
    every = prints.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("doc_id").alias("least_id"))
    every = materialise(every, "fingerprint-all")
    total = prints.count()
    ids = join_counted(prints, every.where("n > 1").select("fingerprint", "n"), "fingerprint", "n", total)
    ids = materialise(ids.select(F.col("doc_id").alias("id")).distinct(), "fingerprint-check")
    forms = _forms(docs.join(hinted(ids, ids.count() * 32), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi"), digits)
    equal = materialise(forms.groupBy("fingerprint", "form").agg(F.min("doc_id").alias("form_id"), F.count("*").alias("n")), "fingerprint-forms")
    clashing = materialise(equal.groupBy("fingerprint").agg(F.count("*").alias("forms")).where("forms > 1").select("fingerprint"), "fingerprint-clashes")
    whole = join_counted(prints, every, "fingerprint", "n", total)
    grouped = whole.withColumn("group_id", F.coalesce("least_id", "doc_id")).select(*prints.columns, "group_id")
    if not clashing.limit(1).count():
        return grouped
    apart = forms.join(clashing, "fingerprint", "left_semi").join(equal.select("fingerprint", "form", "form_id"), ["fingerprint", "form"])
    apart = apart.groupBy(F.col("doc_id").alias("id"), F.col("fingerprint").alias("print")).agg(F.min("form_id").alias("form_id"))
    return grouped.join(apart, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("fingerprint") == F.col("print")), "left").select(
        *prints.columns, F.when(F.col("print").isNull(), F.col("group_id")).otherwise(F.coalesce("form_id", "doc_id")).alias("group_id")
    )


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


class _Edited:
    """Result rows for (id, text, next text) triples."""

    def __init__(self):
        self.rows = []
        self.form = (None, b"", "")  # the last next text: most often the following row's own

    def forms(self, text: str) -> tuple[bytes, str]:
        if self.form[0] is not text:
            form = canonical(text)
            self.form = (text, form, digest(form))
        return self.form[1:]

    def add(self, doc_id, text: str, following: str) -> None:
        form, print_ = self.forms(text)
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        edited_form = canonical(edited)
        edited_print = digest(edited_form)
        next_form, next_print = self.forms(following)
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        self.rows.append(
            (doc_id, len(text), sha, print_, edited_print, likeness(form, edited_form, print_, edited_print), likeness(form, next_form, print_, next_print))
        )

    def batch(self, parts: int | None, extra=()) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * 7
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        names = [x.split()[0] for x in _OUT.split(", ")]
        if parts is not None:
            n = len(self.rows)
            edges = list(extra)
            arrays = [pa.concat_arrays([a, pa.nulls(len(edges), a.type)]) for a in arrays]
            arrays += [pa.array([parts] * (n + len(edges)), pa.int32()), pa.array([None] * n + [e[0] for e in edges], pa.string())]
            arrays += [pa.array([None] * n + [e[1] for e in edges], pa.int64()), pa.array([None] * n + [e[2] for e in edges], pa.string())]
            names += ["part", "edge", "edge_id", "edge_text"]
        self.rows = []
        return pa.RecordBatch.from_arrays(arrays, names=names)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text, and the text with its last quarter replaced by the head of the next document's.

    One row (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, group_id), see ``exact_groups``, for each row of ``docs``.  The next document is the
    next in ascending id order (nulls first, equal ids by a hash of the text), after the
    last the first; a single document follows itself.  Null texts are empty; texts
    of any length are read whole; an empty table gives no rows.  Other columns are not read.

    Texts are dealt by id ranges and sorted there once.  Only the first and
    last text of each range travel again, to meet their neighbours.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ordered = in_id_order(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))

    def within(batches):
        out, last = _Edited(), None
        part = None
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                edges = []
                for p, i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    if last is None:
                        part = p
                        edges.append(("head", i, t))
                    else:
                        out.add(*last, t)
                    last = (i, t)
                yield out.batch(part, edges)
        if last is not None:
            yield out.batch(part, [("tail", *last)])

    done = materialise(ordered.mapInArrow(slim(within), _OUT + ", part int, edge string, edge_id long, edge_text string"), "fingerprints")
    parts = sorted(r["part"] for r in done.where("edge = 'head'").select("part").collect())
    following = list(zip(parts, parts[1:] + parts[:1], strict=True))
    heads = done.where("edge = 'head'").select(F.col("part").alias("next_part"), F.col("edge_text").alias("next_text"))
    tails = done.where("edge = 'tail'").select("part", F.col("edge_id").alias("doc_id"), F.col("edge_text").alias("text"))
    pairs = (
        tails.join(F.broadcast(spark.createDataFrame(following, "part int, next_part int")), "part")
        .join(heads.hint("shuffle_hash"), "next_part")
        .select("doc_id", "text", "next_text")
    )

    def across(batches):
        out = _Edited()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.add(*row)
            yield out.batch(None)

    names = [x.split()[0] for x in _OUT.split(", ")]
    rows = materialise(done.where("edge is null").select(*names).unionByName(pairs.mapInArrow(slim(across), _OUT)), "fingerprint-rows")
    return exact_groups(docs, rows, id_col=id_col, text_col=text_col)
