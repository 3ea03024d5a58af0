from __future__ import annotations

import pytest

pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline as cp  # noqa: E402
from lodestar.llm import queries  # noqa: E402
from lodestar.llm.ngram_jaccard import Similarity, classes  # noqa: E402


def test_stages(spark, sf):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "token_output"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = docs
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        docs = cp.materialise(out, "test")
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    assert set(ids) <= {r["doc_id"] for r in first.select("doc_id").collect()} and len(ids) > 50
    near = classes(docs.dropDuplicates(["doc_id"]), Similarity(5, 80, 100))
    assert near.where("doc_id <> component_id").count() == 0
    last = cp.STAGES[-1][1](spark, docs, sf)
    assert sorted(r["doc_id"] for r in last.collect()) == sorted(ids)


def test_nulls_repeats_and_clashing_names(spark, sf, tmp_path):
    """The stages over nulls, repeated rows and columns with the names that the operators use within."""
    names = "dropped leaking of_doc of_text n_tokens plain poor toxic rate copy sid root n labelled domain text_key held_out score item_id".split()
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    docs = docs.unionByName(docs.limit(5)).unionByName(docs.limit(3).selectExpr("cast(null as bigint) doc_id", "text", "lang", "source", "n_chars"))
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, " "), (None, None), (9004, "x " * 200_000)], "doc_id long, text string")
    docs = docs.unionByName(odd, allowMissingColumns=True).select("*", *[F.lit(1).alias(c) for c in names])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema == docs.schema
        docs = cp.materialise(out, "test")
        assert docs.where("doc_id = 9002").count() == 1 and docs.where("doc_id in (9001, 9003)").count() == 2
    assert cp.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_registered(spark, sf):
    q = queries.queries()
    assert [n.split("_")[0] for n in q] == [f"op{i}" for i in range(1, 11)]
    for name in ("op4_decontamination", "op5_html_extraction", "op10_mixing"):
        assert q[name](spark, sf).collect()


def test_run_equals_brute_force(spark, sf):
    """All five stages again, row by row in plain Python; only the fitted models and multipliers are taken from the operators."""
    import sys
    import zlib
    from pathlib import Path

    import numpy as np
    from tokenizers import Tokenizer

    sys.path.insert(0, str(Path(__file__).parent))
    from test_decontamination import brute as leaks
    from test_ngram_jaccard import brute as near_classes

    from lodestar.llm import mixing, toxicity

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

    scores = toxicity.train(docs, labels).scorer()([t or "" for _, t in rows])
    rows = [x for x, score in zip(rows, scores) if score < cp.TOXIC]
    root = {i: c for i, _, c, _ in near_classes(rows, cp.NEAR)}
    rows = [(i, t) for i, t in rows if root[i] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    leaking = {x[0] for x in leaks(rows, items)}
    rows = [(i, t) for i, t in rows if i not in leaking]

    kept = docs.join(spark.createDataFrame([(i,) for i, _ in rows], "doc_id long"), "doc_id", "left_semi")
    domains = mixing.train(kept, labels)
    soft = cp.materialise(mixing.posteriors(kept, domains), "test")
    rates = mixing.fit_rates(soft, cp.WEIGHTS, 1.0, cp.MOST_RATE, grow=True)
    assert rates.miss < 0.05
    _, posterior = domains.reader()([t or "" for _, t in rows])
    r = np.ones(len(rows))
    for step in rates.steps:
        r = np.clip(r - posterior[:, :2] @ step, 1.0, cp.MOST_RATE)
    key = {x[0]: x[1] for x in docs.selectExpr("doc_id", "xxhash64(doc_id, text)").collect()}
    n = [int(x + (key[i] % (1 << 52)) / (1 << 52)) for x, (i, _) in zip(r, rows)]
    assert max(n) > 1
    rows = sorted((i, t or "") for (i, t), k in zip(rows, n) for _ in range(k))

    tokenizer = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    want, start = [], 0
    for i, t in rows:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, cp.run(spark, sf).collect())) == sorted(want)


def test_written_tables_release_the_drivers_memory(spark, monkeypatch):
    from lodestar.llm import common

    calls = []
    monkeypatch.setattr(common, "release", calls.append)
    for _ in range(2 * common.RELEASE_EVERY):
        common.drop_written(common.materialise(spark.range(3), "released"))
    assert len(calls) == 2
    said = common.trim_native(spark)
    assert said is None or "rim" in said
