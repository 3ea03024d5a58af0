"""Token-id output: Parquet list columns with controlled row groups and pages.

Texts are dealt by ranges of the id, encoded in id order and written, one file
for each range, as ``(doc_id, part, local_start, n_tokens, ids list<int>)``.
The ids are delta encoded by Parquet's v2 writer and the other columns
dictionary or delta encoded; page indexes let a reader fetch the metadata
columns or the ids of some documents alone.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import KEPT, in_id_order, new_path, slim, small_batches

FILE_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("local_start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)

#: A worker's memo of encoded chunks holds at most so many; beyond that the later third goes, so memory stays bounded.
MEMO_CHUNKS = 600_000

#: Texts are encoded in slices of so many bytes, or of one text.
SLICE_BYTES = 4 << 20

_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Letters for which all Unicode versions agree, signs that no contraction or special token holds, and one line's end: a piece each.
_LETTERS, _SIGNS = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+", r"""[!"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]+"""
_SIGN_CHARS = r"""!"#$%&()*+,-./:;=?@[\]^_`{}~"""
_WORD = re.compile(_LETTERS)
_PIECES = re.compile(f"{_LETTERS}|{_SIGNS}|\n")
#: Chunks that are such pieces alone; a line's end stands between two others, since runs of white space are cut otherwise.
_PIECEWISE = re.compile(f"(?:{_LETTERS}|{_SIGNS}|(?<=[^\n])\n(?=[^\n]))+")


class _Numbers(dict):
    """Numbers for keys in the order they are first met; ``new`` lists those met since it was last emptied."""

    def __init__(self, known=()):
        super().__init__(known)
        self.new: list = []

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Letters(dict):
    """``str.translate`` table from characters to the byte-level letters of their UTF-8 bytes."""

    def __init__(self):
        super().__init__()
        self.of_byte = _byte_letters()

    def __missing__(self, char: int) -> str:
        letters = self[char] = "".join(self.of_byte[b] for b in chr(char).encode())
        return letters


@contextmanager
def _no_gc():
    """No search for cycles meanwhile: encoding makes many small lists and no cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class ChunkEncoder:
    """Encodes texts with a byte-level ``tokenizers`` vocabulary.

    Such a vocabulary always begins a new piece at a lone space between two
    non-space characters, so a text is cut there, and each distinct chunk is
    encoded once per worker by the library: a chunk of words, signs and line
    ends piece by piece with its model, any other by the whole tokenizer.
    ``by_chunk=False`` encodes whole texts.
    """

    def __init__(self, path: str, end_id: int | None, by_chunk: bool = True, memo_chunks: int = MEMO_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.end = np.array([] if end_id is None else [end_id], np.int32)
        self.by_chunk = by_chunk
        self.memo_chunks = memo_chunks
        self.letters = _Letters()
        #: Keys: a chunk with a space before it is its string, one at a text's head is a tuple; () is the end id.
        self.numbers = _Numbers({(): 0})
        #: By number, where a chunk's ids start in ``flat`` and how many they are: -1 for a chunk with white space at an end.
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.length = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self._put(0, [self.end])
        #: Ids of signs and of pieces without a space before them, emptied with the memo.
        self.pieces: dict[str, list[int]] = {}

    def _put(self, first: int, ids: list) -> None:
        lengths = np.array([-1 if x is None else len(x) for x in ids], np.int32)
        real = np.maximum(lengths, 0)
        values = np.array(list(chain.from_iterable(x for x in ids if x is not None)), np.int32)
        while self.used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + len(ids) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.flat[self.used : self.used + len(values)] = values
        self.start[first : first + len(ids)] = self.used + np.cumsum(real) - real
        self.length[first : first + len(ids)] = lengths
        self.used += len(values)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        found = []
        for i in range(0, len(texts), 20_000):
            found += [e.ids for e in self.tokenizer.encode_batch_fast(texts[i : i + 20_000], add_special_tokens=False)]
        return found

    def _piece(self, piece: str) -> list[int]:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.pieces[piece] = [t.id for t in self.model.tokenize(piece.translate(self.letters))]
        return ids

    def _known(self, numbers: list[int]) -> list[list[int]]:
        """The ids of learnt chunks."""
        n = self.length[numbers].astype(np.int64)
        ends = np.cumsum(n)
        ids = self.flat[np.arange(n.sum()) + np.repeat(self.start[numbers] - (ends - n), n)].tolist()
        return [ids[a:b] for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]

    def _learn(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        first = len(self.numbers) - len(new)
        ids: list = [None] * len(new)
        others, composed, tokenize, letters = [], [], self.model.tokenize, self.letters
        fresh: dict[str, list[int]] = {}
        for i, key in enumerate(new):
            if type(key) is tuple:
                if not key[0][-1:].isspace():
                    others.append((i, key[0]))
            elif key.isalpha() and key.isascii():
                ids[i] = fresh[key] = [t.id for t in tokenize("\u0120" + key)]
            elif (word := key.rstrip(_SIGN_CHARS)).isalpha() and (word.isascii() or _WORD.fullmatch(word)):
                if len(word) < len(key):
                    composed.append((i, word, (key[len(word) :],)))
                else:
                    ids[i] = fresh[key] = [t.id for t in tokenize("\u0120" + key.translate(letters))]
            elif _PIECEWISE.fullmatch(key):
                word, *rest = _PIECES.findall(key)
                composed.append((i, word, rest))
            elif key and not key[0].isspace() and not key[-1].isspace():
                others.append((i, " " + key))
        known = {w: at for _, w, _ in composed if (at := self.numbers.get(w, first)) < first}
        fresh.update(zip(known, self._known(list(known.values())), strict=True) if known else ())
        pieces, piece_of = self.pieces.get, self._piece
        for i, word, rest in composed:
            x = fresh.get(word)
            if x is None:
                x = fresh[word] = [t.id for t in tokenize("\u0120" + (word if word.isascii() and word.isalpha() else word.translate(letters)))]
            x = x.copy()
            for piece in rest:
                x += pieces(piece) or piece_of(piece)
            ids[i] = x
        for (i, _), x in zip(others, self._encode([c for _, c in others]), strict=True):
            ids[i] = x
        self._put(first, ids)
        if len(self.pieces) > self.memo_chunks // 4:
            self.pieces.clear()

    def _forget(self) -> None:
        keep = self.memo_chunks * 2 // 3  # the first met are the frequent ones
        self.numbers = _Numbers(islice(self.numbers.items(), keep))
        self.used = int(self.start[keep - 1] + max(0, self.length[keep - 1]))

    def _spaced(self, text: str) -> np.ndarray:
        """A text with runs of white space: cut at its lone spaces only."""
        first, *rest = _LONE_SPACE.split(text)
        return np.concatenate([*(np.array(x, np.int32) for x in self._encode([first, *(" " + c for c in rest)])), self.end])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text), each text's end id included."""
        if not self.by_chunk:
            ids = [np.concatenate([np.array(x, np.int32), self.end]) for x in self._encode(texts.to_pylist())]
            return np.concatenate(ids or [self.end[:0]]), np.array([len(x) for x in ids], np.int64)
        if not len(texts):
            return self.end[:0], np.zeros(0, np.int64)
        if len(self.numbers) > self.memo_chunks:
            self._forget()
        split = pc.split_pattern(texts, pattern=" ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = coded.indices.to_numpy()
        numbers = np.fromiter(map(self.numbers.__getitem__, chunks), np.int64, len(chunks))
        at = numbers[codes]
        at[offsets[:-1]] = [self.numbers[(chunks[c],)] for c in codes[offsets[:-1]]]
        with _no_gc():
            self._learn()
        at = np.insert(at, offsets[1:], 0)
        bounds = offsets + np.arange(len(offsets))
        lengths = self.length[at]
        odd = np.minimum.reduceat(lengths, bounds[:-1]) < 0
        lengths = np.maximum(lengths, 0)
        ends = np.cumsum(lengths, dtype=np.int64)
        ids = self.flat[np.arange(ends[-1], dtype=np.int32) + np.repeat((self.start[at] - (ends - lengths)).astype(np.int32), lengths)]
        counts = np.add.reduceat(lengths, bounds[:-1], dtype=np.int64)
        if odd.any():
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in np.nonzero(odd)[0]:
                parts[i] = self._spaced(texts[int(i)].as_py())
            ids, counts = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return ids, counts


@lru_cache(maxsize=1)
def encoder_for(path: str, end_id: int | None, by_chunk: bool, memo_chunks: int) -> ChunkEncoder:
    """A worker's encoder, which keeps its memo from task to task."""
    return ChunkEncoder(path, end_id, by_chunk, memo_chunks)


KEPT["encode_ids"] = encoder_for.cache_clear


def _slices(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    """A batch by slices of SLICE_BYTES of its last column, or of one row."""
    part = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False), dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a]


def is_byte_level(path: str) -> bool:
    """Whether the vocabulary cuts at lone spaces: byte-level pre-tokenizer, no normaliser, special tokens in angle brackets."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    special = all("<" in t["content"] and " " not in t["content"] for t in spec.get("added_tokens") or ())
    return special and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int | None = 2,
    row_group_bytes: int = 16 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 2_000,
    memo_chunks: int = MEMO_CHUNKS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of all texts below ``path`` in ascending id order.

    Files are in order of their ``part``, rows in each by id; ``local_start``
    counts the ids before a row in its file.  Null texts are empty and hold the
    end id alone; null ids come first; equal ids stay together, ordered by a
    hash of their text.  Texts of any length are written whole.  An empty table writes a file without rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    by_chunk = is_byte_level(tokenizer_path)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = in_id_order(texts).select("doc_id", "part", "text")

    def encode_ids(batches):
        encoder = encoder_for(tokenizer_path, end_id, by_chunk, memo_chunks)
        start = 0
        for batch in chain.from_iterable(map(_slices, batches)):
            ids, lengths = encoder.encode(batch.column(2))
            ends = np.cumsum(lengths)
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(start + ends - lengths), pa.array(lengths), pa.ListArray.from_arrays(offsets, pa.array(ids))],
                names=FILE_SCHEMA.names,
            )
            start += int(lengths.sum())

    (
        ordered.mapInArrow(slim(encode_ids), FILE_SCHEMA)
        .write.option("parquet.enable.dictionary", "true")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary#ids.list.element", "false")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .option("compression", "zstd")
        .parquet(path)
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, part, start, n_tokens) of each row, read without touching the ids.

    ``start`` counts the ids of all rows before it, over all files.  Only one
    row for each file takes part in the running sum.
    """
    rows = spark.read.schema(FILE_SCHEMA).parquet(path).select("doc_id", "part", "local_start", "n_tokens")
    return rows.join(F.broadcast(_offsets(spark, path)), "part").select(
        "doc_id", "part", (F.col("local_start") + F.col("offset")).alias("start"), "n_tokens"
    )


def _offsets(spark: SparkSession, path: str) -> DataFrame:
    """(part, offset): ids in the files before each file.  One row for each file, that is each shuffle partition."""
    totals = (
        spark.read.schema(FILE_SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    )
    offsets, start = [], 0
    for r in sorted(totals, key=lambda r: r["part"]):
        offsets.append((r["part"], start))
        start += r["n"]
    return spark.createDataFrame(offsets, "part int, offset long")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    return rows.join(F.broadcast(_offsets(spark, path)), "part").select(
        "doc_id", (F.col("local_start") + F.col("offset")).alias("start"), "n_tokens", "ids"
    )


def token_digests(tokens: DataFrame) -> DataFrame:
    """``read_tokens`` rows with ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers) for the ids."""

    def digest(batches):
        for batch in batches:
            ids = batch.column(3)
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False)).astype("<u4").tobytes())
            at = (ids.offsets.to_numpy().astype(np.int64)) * 4
            crc = [zlib.crc32(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            n = (at[1:] - at[:-1]) // 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.mapInArrow(slim(digest), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer_path: str, path: str | None = None, end_id: int | None = 2, memo_chunks: int = MEMO_CHUNKS) -> DataFrame:
    """Write the ids of ``docs`` (see ``write_tokens``) and return the digests of what the files hold."""
    spark = docs.sparkSession
    path = path or new_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id, memo_chunks=memo_chunks)
    return token_digests(read_tokens(spark, path))
