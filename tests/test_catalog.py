"""Every registered query of the engine against its SQL, on the smallest tables."""

import pytest

from cellweave.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(name, spark, sf_dir, duck, same_rows):
    df = catalog.QUERIES[name](spark, sf_dir)
    if name in catalog.ORACLES:
        same_rows(df, duck, catalog.ORACLES[name])
    else:
        assert df.count() > 0


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
