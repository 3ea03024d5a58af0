"""Every registered query against its DuckDB oracle."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from lodestar.plans import catalogue, handwritten  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_equals_oracle(spark, sf, duck, name):
    df = catalogue.QUERIES[name](spark, sf)
    cur = duck.execute(catalogue.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).collect()
