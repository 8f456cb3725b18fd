"""Every registered query against its DuckDB statement (sf0.001)."""
import pytest

import __spark_entry__ as entry
from tools.oracle_check import duck, rows

#: The reference's own queries; those of the llm subpackage have their tests
#: in tests/llm.
NAMES = sorted(entry._QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_oracle():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    want = con.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows(got) == rows(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["category", "spend"]
    assert df.count() > 0
