"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

from duckdb_oracle import ORACLE
from ledgerlens.queries import QUERIES
from tests.conftest import SF_SMALL
from tools.compare_oracle import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from '{p}'")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    d_cols, d_rows = [c[0] for c in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]
