"""Token counts with a digest cache.

Contents are looked up by the digest of the normalised content and the digest
of the tokenizer version.  Only distinct contents that the cache lacks are
encoded; their counts are appended to the cache, and every row then takes its
count from the cache by a join.
"""

from __future__ import annotations

import hashlib
import os
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import join_counted, materialise, new_path, slim, small_batches

CACHE_SCHEMA = T.StructType(
    [
        T.StructField("version_digest", T.StringType()),
        T.StructField("content_digest", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)

#: ASCII white space that a word tokenizer drops at either end of a text.
TRIMMED = " \t\n\r\x0b\x0c"

#: Separators that ``str.split`` cuts at but the tokenizers' white-space class may not.
ODD_SPACE = "\x1c\x1d\x1e\x1f\x85"

#: A worker's memo of word counts holds at most so many; beyond that the later half goes, so memory stays bounded.
MEMO_WORDS = 250_000


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file: another vocabulary never meets old counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class WordCounter:
    """Counts tokens of a text as the tokenizer file's library gives them.

    A JSON vocabulary whose pre-tokenizer drops white space (``by_word``) counts
    word by word, and a word's count is encoded once per worker.  Other
    vocabularies encode whole texts.
    """

    def __init__(self, path: str, by_word: bool):
        self.by_word = by_word
        self.memo: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece

            self.by_word = False
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode_some = lambda texts: map(len, model.encode(texts, num_threads=1))
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.encode_some = lambda texts: map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False))

    def encode_counts(self, texts: list[str]) -> list[int]:
        found: list[int] = []
        for i in range(0, len(texts), 5_000):
            found += self.encode_some(texts[i : i + 5_000])
        return found

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return self.encode_counts(texts)
        split = [None if any(c in t for c in ODD_SPACE) else t.split() for t in texts]
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo = self.memo = dict(islice(memo.items(), MEMO_WORDS // 2))  # the first met are the frequent ones
        unseen = {w for words in split if words is not None for w in words}.difference(memo)
        if unseen:
            unseen = list(unseen)
            memo.update(zip(unseen, self.encode_counts(unseen), strict=True))
        whole = iter(self.encode_counts([t for t, words in zip(texts, split, strict=True) if words is None]))
        return [next(whole) if words is None else sum(map(memo.__getitem__, words)) for words in split]


def _drops_white_space(path: str) -> bool:
    import json

    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        pre = json.load(f).get("pre_tokenizer") or {}
    parts = pre.get("pretokenizers", [pre])
    return any(p.get("type") == "Split" and p.get("behavior") == "Removed" and p.get("invert") for p in parts)


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    cache_dir: str | None = None,
    token_limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row (doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``.

    ``cache_dir`` holds the counts by (version_digest, content_digest) as
    Parquet and may be kept between runs; without it, the run starts with an
    empty cache of its own in the shared folder.

    Null texts count as empty: 0 bytes, 0 tokens.  Repeated rows each give a
    row, equal texts are encoded once, null ids are carried.  Texts of any
    length are encoded whole.  An empty table gives an empty result.  Other
    columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    version = tokenizer_version(tokenizer_path)
    by_word = _drops_white_space(tokenizer_path)
    cache_dir = cache_dir or new_path(spark, "token-cache")
    text = F.coalesce(F.col(text_col), F.lit(""))
    content = F.btrim(text, F.lit(TRIMMED)) if by_word else text
    digest = F.unhex(F.sha2(content, 256))

    keyed = materialise(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.octet_length(text).cast("long").alias("n_bytes"),
            digest.alias("content_digest"),
        ),
        "token-keys",
    )

    def cache() -> DataFrame:
        spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_dir)
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_dir).where(F.col("version_digest") == version)

    # One row stands for each missing content: the text crosses the network once, without its copies.
    contents = docs.select(digest.alias("content_digest"), text.alias("text")).dropDuplicates(["content_digest"])
    owned = contents.join(cache().select("content_digest").distinct(), "content_digest", "left_anti")

    def encode(batches):
        counter = WordCounter(tokenizer_path, by_word)
        for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
            counts = counter.counts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * len(counts), pa.string()), batch.column(0).cast(pa.binary()), pa.array(counts, pa.int64())],
                names=["version_digest", "content_digest", "n_tokens"],
            )

    owned.mapInArrow(slim(encode), CACHE_SCHEMA).write.mode("append").parquet(cache_dir)

    # A retried append may leave a count twice: equal by construction.
    counts = cache().groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    used = keyed.groupBy("content_digest").agg(F.count("*").alias("n")).join(counts, "content_digest")
    used = materialise(used, "token-used")
    return join_counted(keyed, used, "content_digest", "n", keyed.count()).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > token_limit).alias("over_limit")
    )
