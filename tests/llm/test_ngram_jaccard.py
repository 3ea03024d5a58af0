from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from lodestar.llm.components import connected_components
from lodestar.llm.ngram_jaccard import Similarity, classes, keep_one

SCHEMA = "doc_id long, text string, n long, token long, of_doc string"


def shingles(text, k):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def brute(rows, s: Similarity):
    sets = [(i, shingles(t, s.words)) for i, t in rows]
    root, links = {i: i for i, _ in sets}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1 :]:
            if a and b and s.den * len(a & b) >= s.num * len(a | b):
                p, q = sorted((find(i), find(j)))
                root[q] = p
                links.update((i, j))
    return sorted((i, len(a), find(i), links[i]) for i, a in sets)


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    bases = [[r.choice(words) for _ in range(r.choice([3, 20, 60, 150]))] for _ in range(6)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE  two"), (5, "one two three"), (6, "é É x"), (7, "É É x")]
    for i in range(8, n):
        b = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
            b[r.randrange(len(b))] = r.choice(words)
        rows.append((i, " ".join(b)))
    return rows


@pytest.mark.parametrize("similarity,seed", [(Similarity(), 1), (Similarity(5, 80, 100), 2), (Similarity(2, 1, 2), 3)])
def test_classes_equal_brute_force(spark, similarity, seed):
    rows = corpus(seed, 150)
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA).repartition(3)
    assert sorted(map(tuple, classes(df, similarity).collect())) == brute(rows, similarity)


def test_homes_in_blocks(spark, monkeypatch):
    """One large group of near copies among strangers that share its opening, with small blocks: links are counted all the same."""
    from lodestar.llm import ngram_jaccard

    monkeypatch.setattr(ngram_jaccard, "BLOCK", 7)
    monkeypatch.setattr(ngram_jaccard, "HUB_MEMBERS", 5)
    monkeypatch.setattr(ngram_jaccard, "LIST_ENTRIES", 8)
    monkeypatch.setattr("lodestar.llm.common.HOT_ROWS", 3)
    r = random.Random(7)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(120):
        b = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 4, 5])):
            b[r.randrange(len(b))] = f"x{r.randrange(40)}"
        rows.append((i, " ".join(b)))
    rows += [(200 + i, " ".join(base[:60] + [f"s{i}.{k}" for k in range(r.choice([5, 9, 60]))])) for i in range(30)]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA).repartition(3)
    want = brute(rows, Similarity())
    assert len({c for _, _, c, _ in want}) > 5 and max(n for *_, n in want) < 140
    assert sorted(map(tuple, classes(df, Similarity()).collect())) == want
    kept = sorted(x["doc_id"] for x in keep_one(df, Similarity()).collect())
    assert kept == sorted({c for _, _, c, _ in want})


def test_long_text(spark):
    r = random.Random(8)
    words = [f"w{r.randrange(10**6)}" for _ in range(120_000)]
    other = list(words)
    for i in range(0, len(other), 200):
        other[i] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:1000]))]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA)
    assert sorted(map(tuple, classes(df).collect())) == brute(rows, Similarity())


def test_keep_one(spark):
    rows = corpus(4, 80)
    rows += rows[10:12]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows] + [(None, "one two", 1, 2, "x"), (None, "quite alone", 1, 2, "y")], SCHEMA)
    kept = keep_one(df, Similarity())
    assert kept.schema == df.schema
    roots = {c for _, _, c, _ in brute(rows[:80], Similarity())}
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == sorted(roots)


def test_keep_one_decides_by_row(spark):
    a, b, c = "one two three four five", "six seven eight nine ten", "eleven twelve thirteen fourteen"
    rows = [(None, a), (None, a.upper()), (5, a), (None, b), (None, b), (7, c), (7, a), (9, c.upper()), (9, "by itself"), (9, "by itself"), (8, ""), (8, ""), (8, " "), (None, ""), (None, None)]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA).repartition(3)
    got = [(r["doc_id"], r["text"]) for r in keep_one(df, Similarity()).collect()]
    want = [(5, a), (None, b), (7, c), (9, "by itself"), (8, ""), (8, " "), (None, ""), (None, None)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert classes(df).count() == 0 and keep_one(df, Similarity()).count() == 0


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 400)] + [(7, 7), (None, 1)]
    got = {(x["node"]): x["component"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    assert got == {x: find(x) for x in root}
