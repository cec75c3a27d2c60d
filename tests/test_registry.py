"""Every registered query equals its DuckDB SQL (the driver's gate), here at
sf0.001; ``python tests/oracle_compare.py /root/testdata/sf0.01`` runs the
driver's scale.  Also checks the entry contract."""

import os

import pytest

import __spark_entry__ as entry
from editpulse.plans import registry
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, SF, name, registry.queries()[name], registry.oracle_sql()[name])
    assert info["match"], info


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "user_name", "edit_count"]
    assert df.count() == 951
