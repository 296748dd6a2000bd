"""The driver's correctness gate, locally: every catalog query against its
DuckDB oracle (row count, column names, exact order-insensitive value hash)."""

import pytest

import __spark_entry__ as contract
from tempora.plans import catalog
from tests.conftest import SF_SMALL
from tools.compare import digest, duck, type_diffs

KEYS = sorted(contract.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns == ["City", "Country", "year", "temperature_moyenne", "source"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = contract.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(contract.oracle_sql()[key])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert type_diffs(sdf, rel) == []
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(rel.columns, drows)[0]
