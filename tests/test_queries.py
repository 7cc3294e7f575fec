"""Every registered query against its DuckDB SQL on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from corpusloom import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v.isoformat() if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf, duck, name):
    df = registry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in registry.oracle_sql():
        assert got
        return
    r = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in r.fetchall()), key=repr)


def test_flagship(spark, sf):
    assert registry.flagship(spark, sf).count() > 0
