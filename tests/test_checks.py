import pytest

import __spark_entry__ as contract
from suite.compare import difference, duck_tables

SMALL = "/root/testdata/sf0.001"
FAST = ["cast_int", "std_city", "similar_names", "hierarchy_lenient", "name_maps", "phases", "stage_cache", "batches_orders", "best_choice"]


@pytest.mark.parametrize("name", FAST)
def test_query_equals_its_sql(spark, name):
    assert difference(spark, duck_tables(SMALL), SMALL, name) == ""


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
