from __future__ import annotations

import hashlib

from lodestar.llm.fingerprints import canonical, digest, edited_fingerprints, exact_groups

SCHEMA = "doc_id long, text string, part int, edge string, form int"
TEXTS = [None, "", "Abc  def", "abc\tDEF ", "ﬁne Straße", "FINE STRASSE", "x" * 9, "q" * 5000, "é", "é", "abc def", "abc def"]


def test_canonical():
    assert canonical("  Ａ b\n") == b"a b" and canonical(None) == b""
    assert canonical("ﬁne Straße") == canonical("FINE STRASSE") and canonical("é") == canonical("é")


def brute(rows):
    rows = sorted((i, t or "") for i, t in rows)
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + following[:cut]
        f, g, h = (digest(canonical(x)) for x in (t, edited, following))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, g, float(f == g), float(f == h), group(rows, i, t)))
    return sorted(out)


def test_edited(spark):
    for parts, n in ((1, len(TEXTS)), (5, len(TEXTS)), (3, 1), (4, 2)):
        rows = [(i * 7 % 31, t) for i, t in enumerate(TEXTS[-n:])]
        df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA).repartition(parts)
        assert sorted(map(tuple, edited_fingerprints(df).collect())) == brute(rows)


def group(rows, i, t):
    return min((j for j, u in rows if j is not None and canonical(u) == canonical(t)), default=None)


def test_groups(spark):
    rows = list(enumerate(TEXTS)) + [(None, "Abc def"), (None, "alone")]
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA).repartition(3)
    for digits in (32, 1, 0):
        want = sorted(((i, digest(canonical(t), digits), group(rows, i, t)) for i, t in rows), key=str)
        got = sorted(map(tuple, exact_groups(df, digits=digits).collect()), key=str)
        assert len(got) == len(want)
        assert [g for g in got if g[0] is not None or digits] == [w for w in want if w[0] is not None or digits]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert edited_fingerprints(df).count() == 0 and exact_groups(df).count() == 0
