"""Every registered query against its oracle on the given tables."""

import pytest

from checks import ORACLES, QUERIES
from checks.compare import connect, differences
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


UNWANTED = (
    "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct",
)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    assert differences(df, duck, ORACLES[name]) is None
