"""Every registered query against its DuckDB twin (sf0.001), plus the entry smoke check."""
import re

import pytest

import __spark_entry__ as E
from conftest import SF0001
from scripts.check_oracle import canon, duck

# queries of the optional subpackage have their own tests
OWN = re.compile(r"op\d+_|pipeline$")
QUERIES = {k: v for k, v in E.queries().items() if not OWN.match(k)}
ORACLE = {k: v for k, v in E.oracle_sql().items() if not OWN.match(k)}


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["measure_id", "patient_id", "in_numerator", "last_evidence_date"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF0001)
    a = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE[name])
    b = canon([d[0] for d in cur.description], cur.fetchall())
    assert a[0] == b[0]
    assert len(a[1]) == len(b[1])
    assert a[1] == b[1]
