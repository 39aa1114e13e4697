"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import os

import duckdb
import pytest

import __spark_entry__ as E
import tools.check_oracle as checker
from strivelake.plans.catalog import QUERIES
from tools.check_oracle import TABLES, digest

checker.EXACT = True  # doubles compared bit for bit

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(E.oracle_sql()) & set(QUERIES)
    assert len(QUERIES) >= 60


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, scols)[0] == digest(drows, dcols)[0]


def test_entry(spark):
    from strivelake.schemas import GOLD_SCHEMA
    df = E.entry(spark)
    assert df.count() > 0
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == \
        [(f.name, f.dataType.simpleString()) for f in GOLD_SCHEMA.fields]
