"""Soft-membership mixing: document rates whose expected domain tokens match target weights.

A classifier fitted on the labelled rows gives each document a posterior over
the domains.  Rates between least_rate and most_rate are fitted by projected
gradient descent on the squared miss of the domains' expected tokens

    sum over domains of (sum(rate * tokens * posterior) - target) ** 2

from the rate 1 on.  In the tokens' metric the gradient of a rate is posterior .
miss, so a step is one number for each domain, and a row's rate is the fold of
the steps so far, each clipped to the bounds, over its posterior.  Each step is
one distributed aggregation, which tries several lengths, each with several
shares of the step before it, and takes the best; the driver holds the steps,
and nothing that grows with the rows.
"""

from __future__ import annotations

import math
import re
import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from lodestar.llm.common import fresh, materialise, slim, small_batches
from lodestar.llm.toxicity import AT_ONCE, Examples, Features, Model, held_out, labelled_texts, logistic, summed
from lodestar.llm.toxicity import fit as fit_ftrl

#: Domains of a labelled row.
DOMAINS = ("plain", "poor", "toxic")


def domain_of(quality: Column, toxic: Column) -> Column:
    """toxic if so labelled, else plain or poor by the quality label; null where a label is missing."""
    return F.when(toxic == 1, 2).when((toxic == 0) & (quality == 1), 0).when((toxic == 0) & (quality == 0), 1)


_NOT_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())
_ASCII = re.compile(r"[\x00-\x7f]+")


def letters_in(text: str) -> int:
    """How many characters are letters: ASCII ones by a table, the others one by one."""
    n = len(text.encode("ascii", "ignore").translate(None, _NOT_LETTERS))
    return n if text.isascii() else n + sum(map(str.isalpha, _ASCII.sub("", text)))


def shape(text: str, words: list[str]) -> list[float]:
    """What a text looks like: sizes and shares, each about 0 to 1."""
    n = len(text) or 1
    k = len(words) or 1
    lines = text.split("\n")
    return [
        1.0,
        math.log1p(len(words)) / 10,
        min(3.0, n / k / 10),
        letters_in(text) / n,
        sum(map(text.count, "#$%&*|<>{}[]=_/\\@~^+")) / n * 10,
        sum(map(text.count, "0123456789")) / n * 10,
        text.count(" ") / n * 5,
        len(set(words)) / k,
        len(set(lines)) / len(lines),
        min(3.0, n / len(lines) / 300),
        sum(map(text.count, ".,;:!?")) / k,
    ]


@dataclass
class Domains:
    """A softmax over shape features, with the hashed-word score of each domain as a further feature."""

    weight: np.ndarray  # features x domains
    words: list  # one hashed-word model for each domain

    def reader(self):
        """A function from a list of texts to their words' numbers and posteriors."""
        inputs = _inputs(self.words)

        def read(texts: list[str]) -> tuple[list[int], np.ndarray]:
            x, n = inputs(texts)
            z = x @ self.weight
            e = np.exp(z - z.max(axis=1, keepdims=True))
            return n, e / e.sum(axis=1, keepdims=True)

        return read


def _inputs(models: list[Model]):
    """A function from a list of texts to their inputs, which are the shape features and the words' scores from -1 to 1, and their words' numbers."""
    features, bias = Features(), np.array([m.bias for m in models])
    dense = np.stack([m.dense() for m in models], axis=1)  # side by side, so one look-up of a feature finds all
    used = dense.any(axis=1)

    def of(texts: list[str]) -> tuple[np.ndarray, list[int]]:
        inputs, n = [np.zeros((0, 11 + len(models)))], []
        for i in range(0, len(texts), AT_ONCE):
            part = texts[i : i + AT_ONCE]
            found = features(part)
            scores = 2 * logistic(bias + summed(found, dense, used)) - 1
            inputs.append(np.concatenate([[shape(t, w) for t, w in zip(part, found.words, strict=True)], scores], axis=1))
            n += map(len, found.words)
        return np.concatenate(inputs), n

    return of


def _softmax(x: np.ndarray, y: np.ndarray, k: int, steps: int = 400, rate: float = 0.5, l2: float = 1e-4) -> np.ndarray:
    w, v = np.zeros((x.shape[1], k)), np.zeros((x.shape[1], k))
    target = np.eye(k)[y]
    for _ in range(steps):
        ahead = w + 0.9 * v
        z = x @ ahead
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        v = 0.9 * v - rate * (x.T @ (p - target) / len(x) + l2 * ahead)
        w = w + v
    return w


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 4_000, id_col: str = "doc_id", text_col: str = "text") -> Domains | None:
    """Fit on at most ``sample_rows`` labelled rows that are not held out, chosen by a hash of the id; None without any.

    Of an id that several rows have, the text of least hash counts.  The words' models learn from one half of the sample and
    the softmax from the other.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("labelled"), domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
        .where(F.col("domain").isNotNull() & F.col("labelled").isNotNull() & ~held_out("labelled"))
        .groupBy("labelled")
        .agg(F.max("domain").alias("domain"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(sample_rows)
    )
    sample = labelled_texts(docs, chosen, id_col, text_col).select("doc_id", "text", "domain")

    def learn(batches):
        features = Features()
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        rows.sort(key=lambda r: (xxhash.xxh3_64_intdigest(str(r[0])), r[0], r[1]))
        words = Examples()
        half = rows[::2]
        for i in range(0, len(half), AT_ONCE):
            words.add(features([t for _, t, _ in half[i : i + AT_ONCE]]).each(), [r[2] for r in half[i : i + AT_ONCE]])
        out = []
        if rows:
            models = [
                fit_ftrl(words.arrange(list(range(len(words))), [int(y == k) for y in words.labels]), positive_weight=1.0) for k in range(len(DOMAINS))
            ]
            rest = rows[1::2] or rows
            x, _ = _inputs(models)([t for _, t, _ in rest])
            w = _softmax(x, np.array([r[2] for r in rest]), len(DOMAINS))
            out = [(-1 - i, k, float(w[i, k])) for i in range(w.shape[0]) for k in range(w.shape[1])]
            for k, m in enumerate(models):
                out += [(1 << 40, k, m.bias), *((int(i), k, float(v)) for i, v in zip(m.index, m.weight, strict=True))]
        columns = list(zip(*out, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.float64()), strict=True)], names=["at", "domain", "weight"])

    found = sample.repartition(1).mapInArrow(slim(learn), "at long, domain int, weight double").toPandas()
    if not len(found):
        return None
    softmax = found[found["at"] < 0].pivot(index="at", columns="domain", values="weight").sort_index(ascending=False).to_numpy()
    models = []
    for k in range(len(DOMAINS)):
        own = found[found["domain"] == k]
        sparse = own[(own["at"] >= 0) & (own["at"] < 1 << 40)].sort_values("at")
        models.append(Model(float(own.loc[own["at"] == 1 << 40, "weight"].iloc[0]), sparse["at"].to_numpy(), sparse["weight"].to_numpy()))
    return Domains(softmax, models)


def _scored(docs: DataFrame, domains: Domains | None, text_col: str, keep: list[str], names: list[str]) -> DataFrame:
    """The columns of ``keep`` of each row with its tokens and the posterior of each domain under ``names``."""
    small_batches(docs.sparkSession)
    spread = docs.sparkSession.sparkContext.broadcast(domains)
    kept = docs.select(*keep, F.col(text_col).alias(names[0]))  # the text goes in under the first name

    def run(batches):
        read = spread.value.reader() if spread.value else lambda texts: ([len(t.split()) for t in texts], np.full((len(texts), len(DOMAINS)), 1.0 / len(DOMAINS)))
        for batch in batches:
            n, p = read([t or "" for t in batch.column(len(keep)).to_pylist()])
            new = [pa.array(n, pa.int64()), *(pa.array(p[:, k]) for k in range(len(DOMAINS)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*keep, *names])

    schema = StructType([*kept.schema.fields[:-1], StructField(names[0], LongType()), *(StructField(n, DoubleType()) for n in names[1:])])
    return kept.mapInArrow(slim(run), schema)


def posteriors(docs: DataFrame, domains: Domains | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, posterior of each domain) of each row; tokens are white-space words."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _scored(texts, domains, "text", ["doc_id"], ["n_tokens", *DOMAINS])


#: Steps that are tried: lengths as multiples of 1 / the largest curvature, each with so much of the step before it.
TRIED = tuple((4.0**i, momentum) for i in range(-1, 7) for momentum in (0.0, 0.5, 0.75, 1.0, 1.5, 3.0))


@dataclass
class Rates:
    """The steps of a fit, a vector over ``columns`` each, and the largest miss of a target that is left, as a share of it."""

    columns: list[str]
    least: float
    most: float
    steps: list[list[float]]
    miss: float = 0.0

    @property
    def start(self) -> float:
        return float(min(max(1.0, self.least), self.most))

    def _clipped(self, z: Column) -> Column:
        return F.greatest(F.lit(float(self.least)), F.least(F.lit(float(self.most)), z))

    def _along(self, vector: Column) -> Column:
        z = F.lit(0.0)
        for i, c in enumerate(self.columns):
            z = z + F.col(c) * F.get(vector, F.lit(i))
        return z

    def column(self) -> Column:
        """The rate of a row.  The steps are one array value, so every step of a fit runs the same compiled code."""
        if not self.steps:
            return F.lit(self.start)
        return F.aggregate(F.lit(self.steps), F.lit(self.start), lambda r, step: self._clipped(r - self._along(step)))

    def tried(self) -> list[list[Column]]:
        """Expressions over ``ahead`` for each step tried and domain: the tokens at the rates that it leads to."""
        steps = [F.lit(length) * F.col("__along") + F.lit(momentum) * F.col("__before") for length, momentum in TRIED]
        return [[F.col("__tokens") * self._clipped(F.col("__rate") - z) * F.col(c) for c in self.columns] for z in steps]

    def ahead(self, soft: DataFrame, tokens: str, direction: list[float]) -> DataFrame:
        before = self._along(F.lit(self.steps[-1])) if self.steps else F.lit(0.0)
        return soft.select(F.col(tokens).alias("__tokens"), *self.columns, self.column().alias("__rate"), self._along(F.lit(direction)).alias("__along"), before.alias("__before"))


def fit_rates(
    soft: DataFrame,
    weights: dict[str, float],
    least_rate: float = 0.0,
    most_rate: float = float("inf"),
    grow: bool = False,
    steps: int = 60,
    tolerance: float = 1e-3,
    names: list[str] | None = None,
) -> Rates:
    """Projected gradient descent on the squared miss of the targets, as shares of the tokens at hand.

    Domains with a weight share the total, by default the tokens at hand; with
    ``grow`` the least total for which no domain has to shrink.  A domain
    without a weight is left to itself.  ``names`` are the columns of the tokens
    and of each domain.

    It ends when every target is met to ``tolerance``, when the best step mends
    less than 1 / 2000 of the squared miss, or after ``steps``.  The miss
    that is left is told, and warned of where it is above a hundredth.
    """
    names = names or ["n_tokens", *DOMAINS]
    used = [d for d in DOMAINS if weights.get(d)]
    share = np.array([weights[d] for d in used]) / sum(weights[d] for d in used)
    rates = Rates([names[1 + DOMAINS.index(d)] for d in used], least_rate, most_rate, [])
    columns, tokens = [F.col(c) for c in rates.columns], F.col(names[0])

    def sums(df: DataFrame, terms: list[Column]) -> np.ndarray:
        return np.array([float(x or 0.0) for x in df.agg(*[F.sum(c).alias(f"c{i}") for i, c in enumerate(terms)]).first()])

    first = sums(soft, [tokens * a for a in columns] + [tokens * a * b for a in columns for b in columns])
    now, total = first[: len(used)], first[: len(used)].sum()
    if not total:
        return rates
    goal = share * (max(now / share) if grow else total) / total
    curvature = float(np.linalg.eigvalsh(first[len(used) :].reshape(len(used), -1) / total).max())
    miss = rates.start * now / total - goal
    while len(rates.steps) < steps and np.abs(miss / goal).max() >= tolerance:
        direction = (miss / curvature).tolist()
        tried = rates.tried()
        got = sums(rates.ahead(soft, names[0], direction), [c for row in tried for c in row])
        misses = got.reshape(len(TRIED), -1) / total - goal
        best = int(np.round((misses**2).sum(axis=1), 12).argmin())  # rounded: sums of another order are to choose alike
        if (misses[best] ** 2).sum() > 0.9995 * (miss**2).sum():
            break
        length, momentum = TRIED[best]
        before = rates.steps[-1] if rates.steps else [0.0] * len(used)
        rates.steps.append([length * x + momentum * y for x, y in zip(direction, before, strict=True)])
        miss = misses[best]
    rates.miss = float(np.abs(miss / goal).max())
    if rates.miss > 0.01:
        warnings.warn(f"mixing: a target is missed by {rates.miss:.3f} of it; no step within the bounds comes nearer", stacklevel=2)
    return rates


def mix(
    docs: DataFrame, labels: DataFrame, weights: dict[str, float], least_rate: float = 0.0, most_rate: float = float("inf"), sample_rows: int = 4_000
) -> DataFrame:
    """(doc_id, n_tokens, posterior of each domain, rate, target_miss) of each row of ``docs``.

    ``target_miss`` is the same in all rows: the largest miss of a target that the rates leave, as a share of it.
    Null texts are empty, with 0 tokens and the posterior of an empty text; repeated rows have equal
    rates; null ids are carried; texts of any length are read whole; without labelled rows all
    posteriors are equal; an empty table gives no rows.  Other columns are not read.
    """
    soft = materialise(posteriors(docs, train(docs, labels, sample_rows)), "posteriors")
    rates = fit_rates(soft, weights, least_rate, most_rate)
    return soft.withColumns({"rate": rates.column(), "target_miss": F.lit(rates.miss)})


def resample(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float],
    least_rate: float = 1.0,
    most_rate: float = float("inf"),
    sample_rows: int = 4_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, each as often as its rate tells.

    With ``least_rate`` 1 no row is lost: the total grows until no domain has to
    shrink, and a row has ``most_rate`` copies at most.  A rate's fraction is
    settled by a hash of the row's id and text, so its mean is kept.  Null texts
    count as empty; repeated rows have equal copies; columns of any name may
    stand beside the two; without labels all rates are alike; an empty table stays empty.
    """
    names = fresh(docs, "n_tokens", *DOMAINS)
    model = train(docs, labels, sample_rows, id_col, text_col)
    # Each text is scored once: its posterior is written beside it.
    scored = materialise(_scored(docs, model, text_col, docs.columns, names), "posteriors")
    rates = fit_rates(scored.select(names), weights, least_rate, most_rate, grow=least_rate >= 1, names=names)
    (copy,) = fresh(scored, "copy")
    once = F.explode(F.array_repeat(F.lit(0), copies(rates.column(), F.xxhash64(id_col, text_col)))).alias(copy)
    return scored.select(*docs.columns, once).drop(copy)


def copies(rate: Column, key: Column) -> Column:
    """Whole numbers of copies whose mean is the rate: the fraction is settled by the row's key."""
    return F.floor(rate + F.pmod(key, F.lit(1 << 52)) / float(1 << 52)).cast("int")
