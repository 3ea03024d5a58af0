"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Each coordinate has its own learning rate, and L1 keeps most weights at zero,
so the fitted model is a short list of (index, weight) that every worker gets.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import slim, small_batches
from lodestar.llm.words import WordHashes, chunks

#: Width of the hashed feature space.
BITS = 20

_ENDS = np.zeros(256, bool)
_ENDS[[c for c in range(33, 127) if not chr(c).isalnum()]] = True  # what is stripped from a word's ends


#: Texts that are cut into words at once, so the lists of words stay small.
AT_ONCE = 100


@dataclass
class Found:
    """Features of a list of texts: indices, the text of each, and the words of the texts."""

    index: np.ndarray
    of: np.ndarray
    words: list[list[str]]

    def each(self) -> list[np.ndarray]:
        """The distinct features of each text."""
        order = np.argsort(self.of, kind="stable")
        ends = np.searchsorted(self.of[order], np.arange(1, len(self.words)))
        return [np.unique(x) for x in np.split(self.index[order], ends)]


class Features:
    """Hashed presence features of texts: words, word pairs, and pairs with one word between."""

    def __init__(self, bits: int = BITS):
        self.mask = np.uint64((1 << bits) - 1)
        self.hashes = WordHashes(17)

    def __call__(self, texts: list[str]) -> Found:
        words = [t.split() for t in texts]
        index, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in chunks(list(map(len, texts))):
            found, doc = self._of(words[a:b])
            index.append(found), of.append(doc + a)
        return Found(np.concatenate(index), np.concatenate(of), words)

    def _of(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        doc = np.repeat(np.arange(len(words)), list(map(len, words)))
        joined = " ".join(chain.from_iterable(words)).lower()
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        edges = np.flatnonzero(np.diff(data != 32, prepend=False, append=False))
        starts, stops = edges[::2], edges[1::2]
        # Words lose the punctuation at their ends, unless they are nothing else.
        inner = np.flatnonzero(~_ENDS[data] & (data != 32))
        at, last = np.searchsorted(inner, starts), np.searchsorted(inner, stops)
        some = last > at
        starts[some], stops[some] = inner[at[some]], inner[last[some] - 1] + 1
        h = self.hashes(data, starts, stops) * np.uint64(0x9E3779B97F4A7C15)
        parts, docs = [h ^ (h >> np.uint64(29))], [doc]
        for step, salt in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
            pair = (h[:-step] * np.uint64(salt)) ^ (h[step:] + np.uint64(salt))
            same = doc[:-step] == doc[step:]
            parts.append((pair ^ (pair >> np.uint64(31)))[same]), docs.append(doc[:-step][same])
        return ((np.concatenate(parts) >> np.uint64(17)) & self.mask).astype(np.int64), np.concatenate(docs)


def summed(found: Found, dense: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The sums of the weights of each text's distinct features; ``dense`` has a column for each model, ``used`` marks its rows that are not zero."""
    hit = used[found.index]
    keys = np.unique((found.of[hit] << 32) | found.index[hit])
    of, weights = keys >> 32, dense[keys & 0xFFFFFFFF]
    return np.stack([np.bincount(of, weights=w, minlength=len(found.words)) for w in weights.T], axis=1)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


@dataclass
class Model:
    """A fitted model: bias and the nonzero weights."""

    bias: float = 0.0
    index: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bits: int = BITS

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits, np.float32)
        w[self.index] = self.weight
        return w

    def scorer(self):
        """A function from a list of texts to their scores."""
        features, dense = Features(self.bits), self.dense()[:, None]
        used = dense[:, 0] != 0

        def score(texts: list[str]) -> np.ndarray:
            z = [summed(features(texts[i : i + AT_ONCE]), dense, used)[:, 0] for i in range(0, len(texts), AT_ONCE)]
            return logistic(self.bias + np.concatenate([np.zeros(0), *z]))

        return score


class Examples:
    """Labelled rows of distinct features, held in a few large arrays."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.labels: list[int] = []

    def add(self, rows: list[np.ndarray], labels: list[int]) -> None:
        rows = [f.astype(np.int32) for f in rows]
        self.parts.append(np.concatenate([np.zeros(0, np.int32), *rows]))
        self.lengths += map(len, rows)
        self.labels += labels

    def arrange(self, order: list[int], labels: list[int] | None = None) -> Examples:
        """The rows of ``order``, with other labels if given."""
        flat = np.concatenate([np.zeros(0, np.int32), *self.parts])
        ends = np.cumsum(self.lengths)
        out = Examples()
        out.parts = [np.concatenate([np.zeros(0, np.int32), *(flat[ends[i] - self.lengths[i] : ends[i]] for i in order)])]
        out.lengths = [self.lengths[i] for i in order]
        out.labels = [self.labels[i] for i in order] if labels is None else labels
        return out

    def __len__(self) -> int:
        return len(self.labels)

    def __iter__(self):
        flat = self.parts[0] if len(self.parts) == 1 else np.concatenate([np.zeros(0, np.int32), *self.parts])
        at = 0
        for n, y in zip(self.lengths, self.labels, strict=True):
            yield flat[at : at + n], y
            at += n


def fit(
    examples: Examples,
    bits: int = BITS,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 8.0,
    l2: float = 0.1,
    epochs: int = 5,
    positive_weight: float = 3.0,
) -> Model:
    """FTRL-proximal over examples in the given order.

    ``positive_weight`` weighs examples of label 1, which are the rarer ones.
    """
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    l1_of = np.full(size + 1, l1)
    l1_of[size] = 0.0  # the bias is not shrunk
    for _ in range(epochs):
        for f, y in examples:
            f = np.append(f, size)
            zf, root = z[f], np.sqrt(n[f])
            w = np.where(np.abs(zf) <= l1_of[f], 0.0, -(zf - np.sign(zf) * l1_of[f]) / ((beta + root) / alpha + l2))
            g = (1.0 / (1.0 + np.exp(-min(max(w.sum(), -35.0), 35.0))) - y) * (positive_weight if y else 1.0)
            z[f] = zf + g - (np.sqrt(n[f] + g * g) - root) / alpha * w
            n[f] += g * g
    w = np.where(np.abs(z) <= l1_of, 0.0, -(z - np.sign(z) * l1_of) / ((beta + np.sqrt(n)) / alpha + l2))
    index = np.nonzero(w[:size])[0]
    return Model(float(w[size]), index, w[index], bits)


def held_out(id_col: str = "doc_id"):
    """True for the third of the ids whose labels are never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def labelled_texts(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text and the columns of ``chosen``) of each id in its column labelled: one row, of several texts that of least hash."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen.select("labelled")), F.col("doc_id") == F.col("labelled"), "left_semi")
    one = found.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``sample_rows`` labelled rows that are not held out, chosen by a hash of the id.

    Null labels and labels without a document are left out; an id labelled more than once counts
    once, as toxic if any of its labels is; of an id that several rows have, the text of least hash
    counts.  So the sample is bounded however often rows repeat.  Without examples the model has bias 0.
    """
    spark = docs.sparkSession
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(sample_rows)
    )
    sample = labelled_texts(docs, chosen, id_col, text_col)

    def learn(batches):
        features, found, keys = Features(), Examples(), []
        for batch in batches:
            ids, texts, ys = (batch.column(i).to_pylist() for i in range(3))
            keys += [(zlib.crc32(str(i).encode()), i, zlib.crc32(t.encode("utf-8", "surrogatepass"))) for i, t in zip(ids, texts, strict=True)]
            for i in range(0, len(texts), AT_ONCE):
                found.add(features(texts[i : i + AT_ONCE]).each(), list(map(int, ys[i : i + AT_ONCE])))
        found = found.arrange(sorted(range(len(keys)), key=keys.__getitem__))  # the same order however the rows came
        model = fit(found) if keys else Model()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(model.index, -1)), pa.array(np.append(model.weight, model.bias))], names=["index", "weight"]
        )

    fitted = sample.select("doc_id", "text", "toxic").repartition(1).mapInArrow(slim(learn), "index long, weight double").toPandas()
    if not len(fitted):
        return Model()
    fitted = fitted.sort_values("index")
    return Model(float(fitted["weight"].iloc[0]), fitted["index"].to_numpy()[1:], fitted["weight"].to_numpy()[1:])


def scores(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row.  Null and empty texts score the bias alone."""
    small_batches(docs.sparkSession)
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        score_of = spread.value.scorer()
        for batch in batches:
            s = score_of(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).mapInArrow(slim(score), "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = 12_000) -> DataFrame:
    """Train on the labelled rows that are not held out, then score every row of ``docs``.

    Only the text is an input of a score.  Null and empty texts score the bias
    alone; texts of any length are read whole; repeated rows score alike; null
    ids are kept and never held out; an empty table gives no rows; other columns are not read.
    """
    return scores(docs, train(docs, labels, sample_rows), threshold)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score stays below the threshold.

    Null and empty texts score the bias alone; repeated rows stay or go
    together; ids are not read; columns of any name may stand beside the text;
    texts of any length are read whole; an empty table stays empty.
    """
    small_batches(docs.sparkSession)
    spread = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches):
        score_of = spread.value.scorer()
        for batch in batches:
            yield batch.filter(pa.array(score_of([t or "" for t in batch.column(at).to_pylist()]) < threshold))

    return docs.mapInArrow(slim(keep), docs.schema)
