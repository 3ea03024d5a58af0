"""Toxicity and mixing: held-out accuracy, edge cases, and rates against a dense solver."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lodestar.llm import mixing
from lodestar.llm.toxicity import Examples, Features, Model, fit, held_out, keep_clean, labelled_texts, toxicity, train

SCHEMA = "doc_id long, text string, toxic int, score double"
BAD = ["grum", "plox", "zarn", "vuke"]


def corpus(n, seed=1):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(n):
        t = [r.choice(words) for _ in range(r.randrange(5, 60))]
        bad = i % 6 == 0
        for _ in range(3 * bad):
            t.insert(r.randrange(len(t)), r.choice(BAD).upper() + "!")
        poor = i % 5 == 1
        rows.append((i, ("### " * 12 if poor else "") + " ".join(t), 9, 0.5))
        labels.append((i, int(not poor), int(bad)))
    return rows, labels


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rule(spark):
    got = {r[0]: r[1] for r in spark.range(200).select("id", held_out("id")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(200)}


def test_toxicity(spark):
    rows, labels = corpus(1500)
    rows += [(None, "grum plox zarn", 9, 0.1), (5000, None, 9, 0.1), (5001, "", 9, 0.1), rows[3]]
    docs, marks = frames(spark, rows, labels + [(None, 1, 1), (77777, 0, 1), (3, None, None)])
    got = toxicity(docs, marks).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels}
    out = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in out)
    assert right / len(out) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    same = {r["score"] for r in got if r["doc_id"] in (5000, 5001)}
    assert len(same) == 1
    kept = keep_clean(docs, train(docs, marks))
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if not r["predicted"]}


def test_no_labels_no_rows(spark):
    rows, labels = corpus(20)
    docs, marks = frames(spark, rows, labels)
    assert {r["score"] for r in toxicity(docs, marks.limit(0)).collect()} == {0.5}
    assert toxicity(docs.limit(0), marks).count() == 0
    assert mixing.mix(docs.limit(0), marks, {"plain": 1.0}).count() == 0
    assert {round(r["plain"], 6) for r in mixing.mix(docs, marks.limit(0), {"plain": 1.0}).collect()} == {0.333333}


def test_model_is_sparse():
    r = random.Random(2)
    f = Features()
    data = Examples()
    data.add(f([" ".join(r.choice("abcdefgh") for _ in range(20)) + (" bad" if i % 4 == 0 else "") for i in range(400)]).each(), [int(i % 4 == 0) for i in range(400)])
    m = fit(data)
    assert 0 < len(m.index) < 2000 and Model().scorer()(["any", ""]).tolist() == [0.5, 0.5]


def softly(spark, p, tokens):
    p = np.column_stack([p, np.zeros((len(p), 3 - p.shape[1]))])
    return spark.createDataFrame([(i, int(t), *map(float, x)) for i, (t, x) in enumerate(zip(tokens, p))], "doc_id long, n_tokens long, plain double, poor double, toxic double")


def rates_of(soft, fitted):
    return np.array([r[0] for r in soft.select(fitted.column().alias("rate"), "doc_id").orderBy("doc_id").collect()])


def projected_gradient(p, tokens, goal, least, most=np.inf, steps=20_000):
    """Plain projected gradient on the table of rates, in the tokens' metric, with one small step length."""
    r, total = np.full(len(p), min(max(1.0, least), most)), tokens.sum()
    length = 1 / np.linalg.eigvalsh((p * (tokens / total)[:, None]).T @ p).max()
    for _ in range(steps):
        r = np.clip(r - length * (p @ ((r * tokens) @ p / total - goal)), least, most)
    return r


def test_rates_match_targets(spark):
    rng = np.random.default_rng(3)
    p, tokens = rng.dirichlet([1, 0.5, 0.3], 3000), rng.integers(0, 500, 3000)
    soft = softly(spark, p, tokens)
    fitted = mixing.fit_rates(soft, {"plain": 0.2, "poor": 0.2, "toxic": 0.6})
    r = rates_of(soft, fitted)
    got = (r * tokens) @ p
    assert np.allclose(got / tokens.sum(), [0.2, 0.2, 0.6], atol=1e-3) and r.min() >= 0 and fitted.miss < 1e-3
    up = mixing.fit_rates(soft, {"plain": 0.5, "toxic": 0.5}, least_rate=1.0, most_rate=3.0, grow=True)
    r = rates_of(soft, up)
    assert r.min() >= 1 and r.max() <= 3 and up.columns == ["plain", "toxic"]


def test_growing_rates_match_targets(spark):
    """From the start all rates stand at the least one; overlapping posteriors need several steps."""
    rng = np.random.default_rng(11)
    tokens, p = rng.integers(1, 500, 3000), rng.beta(0.5, 0.5, 3000)
    p = np.column_stack([p, 1 - p])
    soft = softly(spark, p, tokens)
    fitted = mixing.fit_rates(soft, {"plain": 0.9, "poor": 0.1}, least_rate=1.0, grow=True)
    got = (rates_of(soft, fitted) * tokens) @ p
    goal = np.array([0.9, 0.1]) * max(tokens @ p / [0.9, 0.1])
    miss = np.abs(got / goal - 1).max()
    assert miss < 0.02 and abs(miss - fitted.miss) < 1e-6


def test_unreachable_targets_are_fitted_by_least_squares(spark):
    """No rates reach these targets; the plain iteration, run long, misses them no less, and the miss is told and warned of."""
    rng = np.random.default_rng(12)
    tokens, p = rng.integers(1, 500, 1000), rng.beta(4, 4, 1000)
    p = np.column_stack([p, 1 - p])
    soft = softly(spark, p, tokens)
    for least, most, grow in ((1.0, np.inf, True), (0.0, np.inf, False), (1.0, 2.0, True)):
        with pytest.warns(UserWarning, match="target is missed"):
            fitted = mixing.fit_rates(soft, {"plain": 0.97, "poor": 0.03}, least_rate=least, most_rate=most, grow=grow)
        now, total = tokens @ p, tokens.sum()
        goal = np.array([0.97, 0.03]) * (max(now / [0.97, 0.03]) if grow else total) / total

        def loss(r):
            return (((r * tokens) @ p / total - goal) ** 2).sum()

        mine = rates_of(soft, fitted)
        assert mine.min() >= least and mine.max() <= most
        assert loss(mine) <= loss(projected_gradient(p, tokens, goal, least, most)) * 1.02


# --- brute force: the same models by plain loops -------------------------------------------------

MASK = (1 << 64) - 1
STRIPPED = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def plain_word(w):
    """The sum of the bytes' numbers, each times a power for its place, mixed."""
    h = 0
    for i, b in enumerate((w.strip(STRIPPED) or w).encode()):
        h += xxhash.xxh3_64_intdigest(bytes([b]), 17) * pow(0x9E3779B97F4A7C15, i, 1 << 64)
    h &= MASK
    h ^= h >> 32
    h = (h * 0xD6E8FEB86659FD93) & MASK
    return ((h ^ (h >> 29)) * 0x9E3779B97F4A7C15) & MASK


def plain_features(text):
    """The set of hashed words, pairs and pairs around a word."""
    h = [plain_word(w) for w in text.lower().split()]
    out = [x ^ (x >> 29) for x in h]
    for step, salt in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        for a, b in zip(h, h[step:]):
            x = ((a * salt) & MASK) ^ ((b + salt) & MASK)
            out.append(x ^ (x >> 31))
    return {(x >> 17) & ((1 << 20) - 1) for x in out}


def test_features_equal_plain_ones():
    texts = ["", " \t", "One, two!  (three) -- 'Tis  é\u00a0Ü.", "...", "a", "a b", "x" * 3000, "!? end"] * 2 + ["word " * 300_000, "", "last one"]
    assert [set(f.tolist()) for f in Features()(texts).each()] == [plain_features(t) for t in texts]


def plain_ftrl(rows, positive_weight, alpha=1.0, beta=1.0, l1=8.0, l2=0.1, epochs=5):
    """Weights by feature, the bias under None: FTRL-proximal one coordinate at a time."""
    z, n = {}, {}

    def weight(f):
        zf, lam = z.get(f, 0.0), 0.0 if f is None else l1
        if abs(zf) <= lam:
            return 0.0
        return -(zf - math.copysign(lam, zf)) / ((beta + math.sqrt(n.get(f, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for features, y in rows:
            w = {f: weight(f) for f in [*features, None]}
            g = (1 / (1 + math.exp(-min(max(sum(w.values()), -35), 35))) - y) * (positive_weight if y else 1.0)
            for f, wf in w.items():
                old = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * wf
                n[f] = old + g * g
    return {f: weight(f) for f in z}


def plain_score(weights, features):
    z = weights.get(None, 0.0) + sum(weights.get(f, 0.0) for f in features)
    return 1 / (1 + math.exp(-min(max(z, -35), 35)))


def test_toxicity_equals_plain_ftrl(spark):
    rows, labels = corpus(420, seed=5)
    docs, marks = frames(spark, rows + [(None, None, 9, 0.5), (9000, "", 9, 0.5)], labels)
    learned = [(i, t) for (i, t, *_) in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    learned.sort(key=lambda x: (zlib.crc32(str(x[0]).encode()), x[0], zlib.crc32(x[1].encode())))
    truth = {i: y for i, _, y in labels}
    weights = plain_ftrl([(plain_features(t), truth[i]) for i, t in learned], 3.0)
    got = {r["doc_id"]: r["score"] for r in toxicity(docs, marks).collect()}
    want = {i: plain_score(weights, plain_features(t or "")) for i, t, *_ in rows + [(None, None), (9000, "")]}
    assert set(got) == set(want) and max(abs(got[i] - want[i]) for i in want) < 1e-4
    assert sum(1 for f, w in weights.items() if w and f is not None) < 400


def plain_shape(t):
    n, words, lines = len(t) or 1, t.split(), t.split("\n")
    k = len(words) or 1
    return [
        1.0, math.log1p(len(words)) / 10, min(3.0, n / k / 10), sum(c.isalpha() for c in t) / n, sum(c in "#$%&*|<>{}[]=_/\\@~^+" for c in t) / n * 10,
        sum(c in "0123456789" for c in t) / n * 10, sum(c == " " for c in t) / n * 5, len(set(words)) / k, len(set(lines)) / len(lines),
        min(3.0, n / len(lines) / 300), sum(c in ".,;:!?" for c in t) / k,
    ]


def test_mix_equals_brute_force(spark):
    rows, labels = corpus(300, seed=6)
    domain = {i: 2 if toxic else 0 if quality else 1 for i, quality, toxic in labels}
    order = sorted(((xxhash.xxh3_64_intdigest(str(i)), i, t) for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 3 != 1))
    models = [plain_ftrl([(plain_features(t), int(domain[i] == k)) for _, i, t in order[::2]], 1.0) for k in range(3)]

    def inputs(t):
        f = plain_features(t)
        return plain_shape(t) + [2 * plain_score(m, f) - 1 for m in models]

    x, y = np.array([inputs(t) for _, _, t in order[1::2]]), [domain[i] for _, i, _ in order[1::2]]
    w, v = np.zeros((x.shape[1], 3)), np.zeros((x.shape[1], 3))
    for _ in range(400):  # momentum on the softmax's cross entropy, with an l2 term
        ahead = w + 0.9 * v
        p = np.exp(x @ ahead)
        p /= p.sum(axis=1, keepdims=True)
        v = 0.9 * v - 0.5 * (x.T @ (p - np.eye(3)[y]) / len(x) + 1e-4 * ahead)
        w = w + v
    texts = [(i, t) for i, t, *_ in rows] + [(None, None), (9000, "")]
    p = np.exp(np.array([inputs(t or "") for _, t in texts]) @ w)
    p /= p.sum(axis=1, keepdims=True)
    tokens = np.array([len((t or "").split()) for _, t in texts])
    share = np.array([0.5, 0.3, 0.2])
    rate = projected_gradient(p, tokens, share, 0.0, steps=3000)

    docs, marks = frames(spark, rows + [(None, None, 9, 0.5), (9000, "", 9, 0.5)], labels)
    got = {r["doc_id"]: r for r in mixing.mix(docs, marks, {"plain": 0.5, "poor": 0.3, "toxic": 0.2}).collect()}
    assert set(got) == {i for i, _ in texts} and all(got[i]["n_tokens"] == n for (i, _), n in zip(texts, tokens))
    found = np.array([[got[i][d] for d in mixing.DOMAINS] for i, _ in texts])
    assert np.abs(found - p).max() < 1e-3
    mine = np.array([got[i]["rate"] for i, _ in texts])
    assert np.abs((mine * tokens) @ found / tokens.sum() - share).max() < 1e-3 and np.abs((rate * tokens) @ p / tokens.sum() - share).max() < 1e-3
    assert got[0]["target_miss"] < 1e-3 and mine.min() >= 0


def test_resample(spark):
    rows, labels = corpus(900)
    docs, marks = frames(spark, rows + [(None, None, 1, 1.0), rows[0]], labels)
    out = mixing.resample(docs, marks, {"plain": 0.5, "poor": 0.5})
    assert out.schema == docs.schema
    n = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert set(n) == {r[0] for r in rows} | {None}
    poor = sum(n[i] for i, q, t in labels if not q and not t) / sum(1 for _, q, t in labels if not q and not t)
    plain = sum(n[i] for i, q, t in labels if q and not t) / sum(1 for _, q, t in labels if q and not t)
    assert poor > 1.5 * plain


def test_letters_are_counted_over_the_whole_text():
    r = random.Random(4)
    texts = ["a1" * 4000, "", "é½²_Ω\ud800x" * 900, "".join(chr(r.randrange(0x3000)) for _ in range(6000)), "ab \n" * 1500 + "1" * 5000]
    for t in texts:
        assert abs(mixing.shape(t, t.split())[3] - sum(map(str.isalpha, t)) / (len(t) or 1)) < 1e-12


def test_copies_keep_the_mean(spark):
    n = [r[0] for r in spark.range(20_000).select(mixing.copies(F.lit(1.37), F.xxhash64("id"))).collect()]
    assert set(n) == {1, 2} and abs(sum(n) / len(n) - 1.37) < 0.02


def test_repeated_ids_and_long_texts(spark):
    """A labelled id that many rows have counts once in the sample; long texts are read whole; a clash of names does no harm."""
    rows, labels = corpus(200, seed=7)
    rows = [(i, t, 9, 0.5, 1) for i, t, *_ in rows] + [(0, f"again {k}", 9, 0.5, 1) for k in range(300)]
    rows += [(5000, "word " * 300_000 + "grum plox zarn " * 30, 9, 0.5, 1), (5001, "word " * 300_000, 9, 0.5, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, plain int, n_tokens double, copy int").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chosen = marks.select(F.col("doc_id").alias("labelled"), "toxic")
    assert labelled_texts(docs, chosen, "doc_id", "text").count() == 200
    score = {r["doc_id"]: r["score"] for r in toxicity(docs, marks).collect()}
    assert score[5000] > score[5001]
    assert mixing.mix(docs, marks, {"plain": 0.5, "poor": 0.5}).where("doc_id = 5000").first()["n_tokens"] == 300_090
    out = mixing.resample(docs, marks, {"plain": 0.5, "poor": 0.5}, most_rate=3.0)
    assert out.schema == docs.schema and out.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0] <= 6
    assert keep_clean(docs, train(docs, marks)).schema == docs.schema
