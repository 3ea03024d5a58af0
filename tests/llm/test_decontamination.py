from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from lodestar.llm.decontamination import contaminated, flips, keep_uncontaminated

DOCS = "doc_id long, text string, item_id long, of_doc int"
ITEMS = "item_id long, text string, doc_id long"


def runs(text, k):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)], len(w)


def brute(docs, items, t=0.8):
    out = {}
    for item_id, text in items:
        n_words = runs(text, 1)[1]
        if not n_words:
            continue
        k = min(5, n_words)
        item, _ = runs(text, k)
        want = Counter(item)
        for doc_id, d in docs:
            s, _ = runs(d, k)
            if not s:
                continue
            m = min(len(item), len(s))
            for i in range(len(s) - m + 1):
                shared = sum((Counter(s[i : i + m]) & want).values())
                x = shared / (m + len(item) - shared)
                if x >= t and x > out.get((doc_id, item_id), (0, 0))[0]:
                    out[doc_id, item_id] = (x, i)
    return sorted(((*k, *v) for k, v in out.items()), key=str)


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([2, 5, 12, 30, 50])))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "same same same same same same same same same same"), (23, items[3][1].upper() + "!")]
    docs = [(0, None), (1, ""), (2, items[2][1]), (3, "w1"), (None, items[4][1])]
    for i in range(5, 70):
        t = [r.choice(words) for _ in range(r.randrange(80))]
        for _ in range(r.randrange(3)):
            x = (r.choice(items)[1] or "").split()
            if x and r.random() < 0.6:
                x[r.randrange(len(x))] = "edit"
            if x and r.random() < 0.3:
                x.insert(r.randrange(len(x)), "more")
            at = r.randrange(len(t) + 1)
            t[at:at] = x
        docs.append((i, " ".join(t)))
    docs.append((70, "same, " * 30))
    return docs + docs[5:7], items + items[:1]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, items = corpus(seed)
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], DOCS).repartition(3)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    want = brute(docs, items)
    assert sorted(map(tuple, contaminated(d, b).collect()), key=str) == want
    leaking = {w[0] for w in want}
    kept = keep_uncontaminated(d, b)
    assert kept.schema == d.schema
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((i for i, _ in docs if i not in leaking), key=str)


def test_rows_of_one_id_are_judged_apart(spark):
    leak, clean = "a b c d e f g", "nothing of the kind is here"
    rows = [(None, leak), (None, clean), (None, None), (1, leak), (1, clean), (1, clean), (2, leak.upper()), (3, "")]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], DOCS)
    b = spark.createDataFrame([(1, leak, 1)], ITEMS)
    got = [(r["doc_id"], r["text"]) for r in keep_uncontaminated(d, b).collect()]
    assert sorted(got, key=str) == sorted([(i, t) for i, t in rows if (t or "").lower() != leak], key=str)


def test_empty(spark):
    d = spark.createDataFrame([(1, "a b c d e f", 1, 2)], DOCS)
    b = spark.createDataFrame([(1, "a b c d e f", 1)], ITEMS)
    assert contaminated(d.limit(0), b).count() == 0 and contaminated(d, b.limit(0)).count() == 0
    assert contaminated(d, b).count() == 1


def test_multi_index_meets_all_within_the_radius():
    r = random.Random(3)
    masks = set(flips(15))
    assert len(masks) == 1 + 16 + 120 + 560
    for _ in range(2000):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), r.randrange(16)):
            b ^= 1 << bit
        assert any(((a ^ b) >> 16 * i) & 0xFFFF in masks for i in range(4))


def test_recall_and_candidates(spark, monkeypatch):
    """Near copies just above the similarity, edits scattered or side by side: found as brute force finds them, and few others are met."""
    from lodestar.llm import decontamination

    r = random.Random(9)
    words = [f"v{i}" for i in range(3000)]
    items, docs = [], []
    for i in range(60):
        n = r.choice([25, 60, 120, 300])
        item = [r.choice(words) for _ in range(n)]
        lost = int((n - 4) / 9)
        copy = list(item)
        if r.random() < 0.5 and lost > 5:
            at = r.randrange(5, n - lost)
            copy[at : at + lost - 4] = [r.choice(words) for _ in range(lost - 4)]
        else:
            for at in r.sample(range(n), max(1, lost // 5)):
                copy[at] = r.choice(words)
        items.append((i, " ".join(item)))
        docs.append((i, " ".join([r.choice(words) for _ in range(20)] + copy + [r.choice(words) for _ in range(30)])))
    want = brute(docs, items)
    assert len(want) > 40
    met = []
    written = decontamination.materialise
    monkeypatch.setattr(decontamination, "materialise", lambda df, tag: met.append((tag, written(df, tag))) or met[-1][1])
    monkeypatch.setattr(decontamination, "drop_written", lambda df: None)
    got = contaminated(spark.createDataFrame([(*d, 1, 2) for d in docs], DOCS), spark.createDataFrame([(*i, 1) for i in items], ITEMS)).collect()
    assert len({(x["doc_id"], x["item_id"]) for x in got} & {w[:2] for w in want}) >= 0.99 * len(want)
    assert {tuple(x) for x in got} <= set(want)
    tables = dict(met)
    assert tables["near"].count() <= 1.1 * len(want) + 5


def test_long_and_repeated_texts(spark):
    item = "one two three four five six seven eight nine ten"
    long = " ".join(f"x{i}" for i in range(150_000)) + " " + item
    rows = [(1, long, 1, 2), (2, item + ".", 1, 2), (2, item + ".", 1, 2), (None, item, 1, 2)]
    d = spark.createDataFrame(rows, DOCS)
    b = spark.createDataFrame([(7, item, 1)], ITEMS)
    assert sorted(map(tuple, contaminated(d, b).collect()), key=str) == sorted([(1, 7, 1.0, 150_000), (2, 7, 1.0, 0), (None, 7, 1.0, 0)], key=str)
