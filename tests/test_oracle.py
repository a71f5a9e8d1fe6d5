"""Every registered query against its DuckDB oracle on the smallest data."""

import pytest

from spendscope.queries import ORACLE, QUERIES
from compare import digest, duck

SF = "/root/testdata/sf0.001"
SQL = ORACLE
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(df.columns) > 0
        return
    res = con.execute(SQL[name])
    cols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(cols, drows)[0]


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() >= 0
    assert "attributed_cost_usd" in df.columns
