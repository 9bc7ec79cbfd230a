import pytest

from lindero.plans import catalog, contracts

from .conftest import DATA
from .oracle import same_as_sql


assert contracts  # adds its queries


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, name):
    same_as_sql(catalog.QUERIES[name](spark, DATA), catalog.ORACLES[name], DATA)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
