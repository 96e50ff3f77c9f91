"""Every query with SQL gives the rows that DuckDB gives."""

import pytest

from fennmark.plans import queries
from tests.oracle import SF, duck, duck_rows, spark_rows


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    names, expected = duck_rows(duck(), queries.SQL[name])
    assert sorted(df.columns) == names
    assert spark_rows(df) == expected


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
