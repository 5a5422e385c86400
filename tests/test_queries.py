"""Every registered genotype query against its DuckDB SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from genoeval.plans import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def normal(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    found = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    order = sorted(df.columns)
    assert order == sorted(columns)
    at = [columns.index(c) for c in order]
    assert sorted(tuple(normal(r[c]) for c in order) for r in df.collect()) == sorted(tuple(normal(r[i]) for i in at) for r in found.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
