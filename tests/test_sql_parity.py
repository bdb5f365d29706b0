"""Every registered query on the smallest tables: its physical plan, and its result against its SQL."""

import pytest

from tablewright.plans.catalog import REGISTRY
from tests.oracle import compare, connect
from tests.test_plans import plan_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", list(REGISTRY))
def test_query_plan_and_result(spark, con, key):
    item = REGISTRY[key]
    assert item.oracle, f"{key} has no SQL"
    df = item.run(spark, SF)
    text = plan_of(df)
    # no product of two tables, no row-by-row Python
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "EvalPython" not in text and "InPandas" not in text
    assert compare(df, con, item.oracle) == []
