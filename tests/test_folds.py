"""Window formulations against sequential folds."""

from __future__ import annotations

import random

from lodestar.operators import sets
from lodestar.operators.folds import merge_records, upsert, versioned
from lodestar.operators.logstats import exhaustion, streaks, token_bucket
from lodestar.streaming.state import STATE


def test_merge_equals_fold(spark):
    r = random.Random(1)
    rows = [(r.choice([f"u{k}" for k in range(40)] + [None, ""]), i, r.choice([None, 0, 1, 2]), r.choice([None, True, False]), r.choice([None, 1, 2, 3])) for i in range(600)]
    held: dict = {}
    for row in rows:
        k, _, v, u, s = row
        if not k:
            continue
        old = held.get(k)
        if old is None:
            held[k] = row
            continue
        a, b = (old[2] or 0, bool(old[3])), (v or 0, bool(u))
        if b > a or (b == a and s is not None and old[4] is not None and s > old[4]):
            held[k] = row
    df = spark.createDataFrame(rows, "canonical_url string, seq long, version int, is_updated boolean, last_seen long")
    assert sorted(r["seq"] for r in merge_records(df, "canonical_url", "seq").collect()) == sorted(x[1] for x in held.values())


def fold_versions(rows):
    held, out = {}, {}
    for k, seq, h, t in rows:
        if k not in held:
            held[k] = [h or None, t, 1]
            out[seq] = (1, False, t)
            continue
        s = held[k]
        changed = bool(h) and h != s[0]
        s[0], s[1], s[2] = h or s[0], t if changed else (t if t is not None else s[1]), s[2] + changed
        out[seq] = (s[2], changed, s[1])
    return out, held


def test_versions_equal_fold(spark):
    r = random.Random(2)
    rows = [(f"k{r.randrange(20)}", i, r.choice([None, "", "a", "b", "c"]), r.choice([None, "t", "u"])) for i in range(500)]
    want, held = fold_versions(rows)
    df = spark.createDataFrame(rows, "key string, seq long, content_hash string, primary_topic string")
    got = {x["seq"]: (x["version"], x["is_updated"], x["held_topic"]) for x in versioned(df, "key", "seq").collect()}
    assert got == want
    empty = spark.createDataFrame([], STATE)
    state = upsert(upsert(empty, df.where("seq < 200"), "key", "seq"), df.where("seq >= 200"), "key", "seq")
    assert {x["key"]: [x["content_hash"] or None, x["primary_topic"], x["version"]] for x in state.collect()} == held


def test_bucket_streak_exhaustion(spark):
    r = random.Random(3)
    t, rows = 0, []
    for i in range(300):
        t += r.randrange(2_000_000)
        rows.append((1, i, t))
    have, at, yes = 8.4, None, 0
    for _, _, us in rows:
        have = min(12.0, have + 1.2 * ((us - at) / 1e6 if at is not None else 0.0))
        at = us
        if have >= 1:
            have, yes = have - 1, yes + 1
    df = spark.createDataFrame(rows, "k int, n long, us long")
    assert tuple(token_bucket(df, "k", "n", "us").first()) == (1, yes, 300 - yes)

    times = spark.createDataFrame([(1, i, x) for i, x in enumerate([0, 100, 230, 231, 400])], "k int, event_id long, s long").selectExpr("k", "event_id", "timestamp_seconds(s) ts")
    assert [x["streak"] for x in streaks(times, "k", "ts", 120).orderBy("event_id").collect()] == [1, 2, 1, 2, 1]

    pages = [("a", 1, 2, True, None), ("a", 2, 0, True, None), ("a", 3, 0, True, None), ("b", 1, 0, False, None), ("c", 1, 0, True, 1), ("d", 1, 3, False, 1)]
    df = spark.createDataFrame(pages, "topic string, page int, guides int, has_next boolean, total_pages int")
    assert {x["topic"]: x["exhausted_at"] for x in exhaustion(df).collect()} == {"a": 3, "b": 1, "c": 1, "d": None}


def test_round_robin_places(spark):
    """Groups of several sizes and a null one, more of them than a range's sample holds: places are gapless in the order of the groups."""
    keys = [(f"{g % 97:02}{g}", o) for g in range(2500) for o in range(g % 4 + 1)] + [(None, 1), (None, None)]
    rows = spark.createDataFrame(keys, "k string, o int").repartition(7)
    got = sets.round_robin(rows, "k", "o").select("k", "o", "round", "place").collect()
    expected, rounds = [], {}
    for k in sorted({k for k, _ in keys}, key=lambda k: (k is None, k)):
        for n, o in enumerate(sorted((o for x, o in keys if x == k), key=lambda o: (o is None, o)), 1):
            rounds[n] = rounds.get(n, 0) + 1
            expected.append((k, o, n, rounds[n]))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert not sets.round_robin(rows.limit(0), "k", "o").collect()
