"""Every registered query of the catalogue engine against its oracle."""

import pytest

from tests.conftest import same


def _names():
    import __spark_entry__ as e

    return sorted(n for n in e.oracle_sql() if not n.startswith("op"))


@pytest.mark.parametrize("name", _names())
def test_oracle(name, spark, folder, duck):
    import __spark_entry__ as e

    same(e.queries()[name], e.oracle_sql()[name], spark, folder, duck)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0


def test_every_query_without_an_oracle_runs(spark, folder):
    import __spark_entry__ as e

    for n, q in e.queries().items():
        if n not in e.oracle_sql() and not n.startswith("op") and n != "pipeline":
            assert q(spark, folder).count() > 0
