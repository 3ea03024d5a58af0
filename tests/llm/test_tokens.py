from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from lodestar.llm.token_counts import CACHE_SCHEMA, token_counts, tokenizer_version  # noqa: E402
from lodestar.llm.token_output import SLICE_BYTES, ChunkEncoder, _slices, read_index, read_tokens, token_output, write_tokens  # noqa: E402

WORD, BYTE, PIECE = (str(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, n_tokens long, part int"
EDGES = [
    None, "", " ", "\t", " a", "a ", "  a  b", "\n x\n\ny  z ", "a b  c　d", "hi <|endoftext|> x<|endoftext|>y", "A <|startoftext|>B <|ENDOFTEXT|>",
    "\x1c a\x85b \x1dq", "it's  we'll 12 3 ñandú: 'tis", "é ́x", "ΑΣ ας", "a,b ab.) x! (y)", "word " * 9000, "x" * 30000, "a\n b\r\nc", "\U0001f600 ok",
]


@pytest.fixture(scope="module")
def docs(spark, sf):
    texts = EDGES + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    rows = [(i * 3, t, -1, -1) for i, t in enumerate(texts)] + [(9, EDGES[3], 0, 0), (30, "again", 0, 0)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_counts(docs, path):
    rows, df = docs
    tokenizer = Tokenizer.from_file(path)
    want = sorted((i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 50) for i, t, _, _ in rows)
    assert sorted(map(tuple, token_counts(df, path, token_limit=50).collect())) == want


def test_counts_of_pieces(docs):
    import sentencepiece

    rows, df = docs
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in token_counts(df, PIECE).collect()) == sorted((i, len(model.encode(t or ""))) for i, t, _, _ in rows)


def test_cache_is_used_and_appended(spark, docs, tmp_path):
    rows, df = docs
    cache = f"file://{tmp_path}/cache"
    half = df.where("doc_id < 90")
    token_counts(half, WORD, cache).count()
    first = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    n = first.count()
    assert n == first.select("content_digest").distinct().count()
    # Counts in the cache are believed, those of another version are not.
    first.selectExpr("version_digest", "content_digest", "n_tokens + 1000 as n_tokens").write.parquet(f"{cache}2")
    first.selectExpr("'other' as version_digest", "content_digest", "7L as n_tokens").write.mode("append").parquet(f"{cache}2")
    assert all(r["n_tokens"] >= 1000 for r in token_counts(half, WORD, f"{cache}2").collect())
    token_counts(df, WORD, cache).count()
    again = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    assert again.count() == again.select("content_digest").distinct().count() > n
    assert len(tokenizer_version(WORD)) == 64


def test_output_round_trip(spark, docs, tmp_path):
    rows, df = docs
    path = f"file://{tmp_path}/tokens"
    tokenizer = Tokenizer.from_file(BYTE)
    write_tokens(df, path, BYTE)
    want, start = [], 0
    for i, t, _, _ in sorted(rows, key=lambda r: (r[0], np.uint64(xxhash.xxh64_intdigest(r[1] or "", 42)).astype(np.int64))):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), ids))
        start += len(ids)
    got = sorted(map(tuple, read_tokens(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    assert sorted((r["doc_id"], r["start"], r["n_tokens"]) for r in read_index(spark, path).collect()) == sorted(w[:3] for w in want)
    crc = {(r["start"]): r["ids_crc32"] for r in token_output(df, BYTE).collect()}
    assert crc == {s: zlib.crc32(np.array(ids, "<u4").tobytes()) for _, s, _, ids in want}
    meta = pq.ParquetFile(sorted(tmp_path.glob("tokens/part-*.parquet"))[0]).metadata.row_group(0)
    assert all(meta.column(c).has_column_index and meta.column(c).has_offset_index for c in range(4))
    ids = next(meta.column(c) for c in range(meta.num_columns) if meta.column(c).path_in_schema.startswith("ids"))
    assert "DELTA_BINARY_PACKED" in ids.encodings and "PLAIN_DICTIONARY" not in ids.encodings and ids.compression == "ZSTD"


def test_repeated_rows_and_null_ids(spark):
    """Many rows of one id and one text, and many of null id: each has its place and its count."""
    rows = [(7, "same text here", 0, 0)] * 300 + [(None, f"text {i % 3}", 0, 0) for i in range(200)] + [(1, "first", 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    tokenizer = Tokenizer.from_file(BYTE)
    got = sorted(token_output(df, BYTE).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None] * 200 + [1] + [7] * 300
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert at == sum(len(tokenizer.encode(t).ids) + 1 for _, t, _, _ in rows)
    counts = token_counts(df, WORD).collect()
    word = Tokenizer.from_file(WORD)
    assert sorted(r["n_tokens"] for r in counts) == sorted(len(word.encode(t).ids) for _, t, _, _ in rows)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert token_counts(empty, WORD).count() == 0 and token_output(empty, BYTE).count() == 0


def test_pieces_equal_whole_texts():
    """Chunks of words, signs and line ends in any order, contractions and special strings among them."""
    parts = ["a", "Word", "ñandú", "Ǆ", "ʼn", "×", "'s", "'", "<|endoftext|>", "<", "|", "\n", "\n\n", "\r\n", "\t", " ", " ", "  ", ".", ",\n", "***", "%%%", "(", "[]\\^", "`~{}", "12", "ª", "é", "e\u0301", "中", "\x85"]
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(parts, size=rng.integers(0, 12))) for _ in range(6000)]
    pieces, whole = ChunkEncoder(BYTE, 2, memo_chunks=3000), ChunkEncoder(BYTE, 2, by_chunk=False)
    for i in range(0, len(texts), 500):
        a, b = (e.encode(pa.array(texts[i : i + 500])) for e in (pieces, whole))
        assert (a[1] == b[1]).all() and (a[0] == b[0]).all()


def test_encoder_memo_is_bounded(spark, sf):
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    chunked, whole = ChunkEncoder(BYTE, 2, memo_chunks=500), ChunkEncoder(BYTE, 2, by_chunk=False)
    for i in range(0, 60, 10):
        a, b = chunked.encode(pa.array(texts[i : i + 10])), whole.encode(pa.array(texts[i : i + 10]))
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
    assert len(chunked.numbers) < 20_000


def test_many_words_are_learnt_once():
    encoder, whole = ChunkEncoder(BYTE, 2), Tokenizer.from_file(BYTE)
    letters = "bcdfghjklm"
    words = ["".join(letters[int(d)] for d in f"{i:06d}") + ("", ".", "),", "\nQu\u00e9!", "\u00e9t\u00e9;")[i % 5] for i in range(400_000)]
    texts = pa.array([" ".join(words[i : i + 4_000]) for i in range(0, len(words), 4_000)])
    for i in range(0, len(texts), 20):
        ids, counts = encoder.encode(texts.slice(i, 20))
        want = whole.encode(texts[i].as_py(), add_special_tokens=False).ids
        assert ids[: counts[0]].tolist() == [*want, 2]
    known = len(encoder.numbers)
    for i in range(0, len(texts), 20):
        encoder.encode(texts.slice(i, 20))
    assert len(encoder.numbers) == known > 400_000


def test_slices_hold_every_row_once():
    texts = pa.array(["", "a" * (5 << 20), *["b" * (1 << 20)] * 9, ""])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["doc_id", "text"])
    parts = _slices(batch)
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert all(p.num_rows == 1 or sum(map(len, p.column(1).to_pylist())) <= 2 * SLICE_BYTES for p in parts) and len(parts) > 2
    assert _slices(batch.slice(0, 0)) == []
