"""Driver contract and SQL-oracle agreement on the smallest data set."""

import pytest

from conftest import SF_MED

def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["category_name", "product_count"]
    assert len(rows) == 25 and [r["product_count"] for r in rows] == sorted((r["product_count"] for r in rows), reverse=True)


def test_every_oracle_has_a_query():
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())


def library_queries():
    """The queries of the library itself that have an oracle (the optional subpackage tests its own)."""
    from rareclass.plans.catalog import oracle_sql

    return sorted(oracle_sql())


@pytest.mark.parametrize("name", library_queries())
def test_query_matches_oracle(spark, name):
    """Values, column names and column types, at the scale of the driver's own check."""
    import __spark_entry__ as E
    from oracle_check import compare, duck

    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_MED, duck(SF_MED))
    assert r["status"] == "match", r
