"""Every registered query against DuckDB at the smallest scale."""

import pytest
from check_oracle import compare, connect

from adlake.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        verdict, note = compare(df, duck, ORACLES[name])
        assert verdict == "OK", note
    else:
        assert df.count() > 0
