"""Every registered query of the library against its SQL, and the driver's contract."""

import pytest

from comparing import connect, same_rows
from lodestrata import catalog


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, small, duck, name):
    same_rows(catalog.queries()[name](spark, small), duck, catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_has_rows(spark, small, name):
    assert catalog.queries()[name](spark, small).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["c_custkey", "c_name", "n_lines", "amount"]
    assert set(catalog.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
