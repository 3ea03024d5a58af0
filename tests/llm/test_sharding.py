from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm.sharding import best_fit_decreasing, pack_equal, shard

SCHEMA = "doc_id long, text string, size long, shard int, unit int, digest string, at int, bytes int, n int"


def naive(sizes, capacity):
    left, out = [], []
    for s in sizes:
        fits = [(c, i) for i, c in enumerate(left) if c >= s]
        if fits:
            i = min(fits)[1]
        else:
            left.append(capacity)
            i = len(left) - 1
        left[i] -= s
        out.append((s, i))
    return out, len(left)


def runs_of(sizes):
    return sorted(Counter(sizes).items(), reverse=True)


def loads_of(entries):
    load = Counter()
    for s, n, b in entries:
        load[b] += s * n
    return load


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=200), st.integers(1, 6))
def test_runs_are_best_fit_on_every_group(sizes, bins):
    sizes = sorted(sizes, reverse=True)
    placed, opened = best_fit_decreasing(runs_of(sizes), 60)
    want, n = naive(sizes, 60)
    load = Counter()
    for s, b in want:
        load[b] += s
    assert opened == n and sorted(loads_of(placed).values()) == sorted(load.values())
    assert Counter({s: sum(k for z, k, _ in placed if z == s) for s in set(sizes)}) == Counter(sizes)
    equal = loads_of(pack_equal(runs_of(sizes), bins))
    assert set(equal) <= set(range(bins)) and sum(equal.values()) == sum(sizes)
    assert max(equal.values()) <= max(sizes[0], -(-sum(sizes) // bins)) + sizes[0]


def test_hot_group_and_capacity():
    assert loads_of(pack_equal([(900, 1), (1, 300)], 4)) == {0: 900, 1: 100, 2: 100, 3: 100}
    placed, opened = best_fit_decreasing([(50, 1), (10, 2), (3, 4)], 12)
    assert opened == 4 and sorted(loads_of(placed).values()) == [10, 10, 12, 50]


def check(rows, got, shards, tolerance):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots, load = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if tolerance:
        assert max(load.values()) - min(load[k] for k in range(shards)) <= tolerance * sum(load.values()) / shards


def brute(rows, shards):
    """Loads of best-fit-decreasing over single groups, each group whole, at the least capacity that holds them."""
    sizes = Counter()
    for _, t in rows:
        sizes[t or ""] += len((t or "").encode()) + 8
    left, alone = sorted(sizes.values(), reverse=True), []
    while left and shards - len(alone) > 1 and left[0] * (shards - len(alone)) >= sum(left):
        alone.append(left.pop(0))
    bins = shards - len(alone)
    capacity = max(-(-sum(left) // bins), *left[:1], 1)
    while naive(left, capacity)[1] > bins:
        capacity += 1
    return alone, capacity, left


def test_groups_stay_whole(spark):
    """A hot group, equal groups and ties: one shard for each text, and loads as even as single groups allow."""
    r = random.Random(1)
    rows = [(i, "w" * r.randrange(1, 400)) for i in range(3000)]
    rows += [(3000 + i, "hot text " * 20) for i in range(1500)] + [(5000, None), (5001, ""), (5002, "é" * 3000), (None, "x"), (None, "x")]
    rows += [(6000 + 50 * g + i, f"group {g:02d} " * 5) for g in range(12) for i in range(40)]
    rows += [(9000 + i, f"{i:04d} as long") for i in range(500)]
    df = spark.createDataFrame([(i, t, 0, 0, 0, "d", 0, 0, 0) for i, t in rows], SCHEMA).repartition(5)
    got = shard(df).collect()
    check(rows, got, 24, None)
    text_of = dict(rows)
    where, load = defaultdict(set), Counter()
    for x in got:
        where[text_of[x["doc_id"]]].add(x["shard"])
        load[x["shard"]] += x["size"]
        assert x["over_share"] == (text_of[x["doc_id"]] == "hot text " * 20)
    assert all(len(v) == 1 for v in where.values())
    alone, capacity, left = brute(rows, 24)
    assert len(alone) == 1 and load[0] == alone[0]
    others = [load[k] for k in range(1, 24)]
    assert max(others) <= capacity and min(others) >= 0.95 * sum(left) / 23


def test_fixed_capacity(spark):
    rows = [(i, "x" * (i % 90)) for i in range(400)] + [(500, "y" * 5000)]
    df = spark.createDataFrame([(i, t, 0, 0, 0, "d", 0, 0, 0) for i, t in rows], SCHEMA)
    got = shard(df, capacity=1200).collect()
    sizes = Counter()
    for _, t in rows:
        sizes[t] += len(t) + 8
    load = Counter()
    for x in got:
        load[x["shard"]] += x["size"]
    want = 1 + naive(sorted((s for s in sizes.values() if s <= 1200), reverse=True), 1200)[1]
    assert len(load) == want and sorted(load.values())[-2] <= 1200 and max(load.values()) == 5008


def test_few_and_none(spark):
    rows = [(1, "a"), (1, "a"), (2, None)]
    df = spark.createDataFrame([(i, t, 0, 0, 0, "d", 0, 0, 0) for i, t in rows], SCHEMA)
    got = shard(df).collect()
    check(rows, got, 24, None)
    assert len({x["shard"] for x in got if x["doc_id"] == 1}) == 1
    assert shard(df.limit(0)).count() == 0
    long = [(i, "long " * 400_000 * (i + 1)) for i in range(2)]
    check(long, shard(spark.createDataFrame(long, "doc_id long, text string")).collect(), 24, None)
