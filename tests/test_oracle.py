"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as E
import tools.oracle_check as oc
from chronogrid.plans import registered
from tools.oracle_check import digest, duck, spark_pdf

from .conftest import SF001

# the queries of the library itself; an optional subpackage tests its own
QUERIES = {k: v for k, v in E.queries().items() if k in registered.QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in registered.QUERIES}


@pytest.fixture(scope="module")
def con():
    oc.STRICT = True            # floats compared bit for bit
    yield duck(SF001)
    oc.STRICT = False


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    got = digest(spark_pdf(QUERIES[name](spark, SF001)))
    want = digest(con.execute(ORACLE[name]).df())
    assert got[0] == want[0], f"columns {got[0]} != {want[0]}"
    assert got[1] == want[1], f"rows {got[1]} != {want[1]}"
    assert got[2] == want[2], "values differ"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["time", "y", "x", "T2MAX", "T2MIN", "RAIN"]
