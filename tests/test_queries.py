"""Every core query against its SQL on the smallest tables; queries without SQL have to run and keep their columns."""

import pytest

from quarryline import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, same_as_sql):
    same_as_sql(QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(name, spark, small):
    df = QUERIES[name](spark, small)
    assert df.columns and len(set(df.columns)) == len(df.columns)
    df.collect()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
