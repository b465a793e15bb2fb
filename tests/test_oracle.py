"""Every plan that SQL can express gives the same rows as DuckDB on the same tables."""

import math

import duckdb
import pytest

from tidewave.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in found], key=repr), sorted(names)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_plan_matches_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    want = duck.sql(registry.oracle_sql()[name])
    a, b = rows(got.columns, got.collect()), rows(want.columns, want.fetchall())
    assert a[1] == b[1]
    assert a[0] == b[0]
