"""Every query with an SQL twin gives the same rows in both engines."""

import math
import os

import duckdb
import pytest

from reelsieve.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float) and v == int(v):
        return int(v)
    return v


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_twin(spark, duck, sf, name):
    df = registry.queries()[name](spark, sf)
    twin = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(twin.columns)
    ours = sorted(repr(tuple(map(plain, r))) for r in df.select(*sorted(df.columns)).collect())
    theirs = sorted(repr(tuple(map(plain, r))) for r in twin.project(", ".join(f'"{c}"' for c in sorted(twin.columns))).fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, sf, name):
    assert registry.queries()[name](spark, sf).count() > 0
