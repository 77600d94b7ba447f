import pytest

from checks.catalog import ORACLES, QUERIES
from checks.run import connect, difference


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_query_has_a_counterpart():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_sql(spark, folder, duck, key):
    got = QUERIES[key](spark, folder).toPandas()
    assert difference(got, duck.execute(ORACLES[key]).df()) is None
    assert len(got) > 0
