"""Every registered query against its DuckDB oracle (rows-only when it has none)."""

import pytest

from tests.oracle_harness import compare, duck_con
from tidepool.plans import registry_dicts

SF = "/root/testdata/sf0.001"
FNS, ORACLES = registry_dicts()


@pytest.fixture(scope="module")
def con():
    return duck_con(SF)


@pytest.mark.parametrize("key", sorted(FNS))
def test_query_matches_oracle(spark, con, key):
    assert compare(spark, key, SF, con, verbose=False)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
