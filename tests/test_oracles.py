"""Every query against its SQL, on tables split into seven files.

The SQL reads the original one-file tables, so each test also shows that the
result does not depend on how the rows are laid out.
"""

import pytest
from conftest import DATA
from harness import canonical, difference, duck

from terrella import catalog

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()

#: Reproducible queries without SQL: equal on both layouts, row by row.
LAYOUT_FREE = ("gen_key_value", "gen_blobs", "gen_regression", "split_random", "epoch_shards")


@pytest.fixture(scope="module")
def connection():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, seven_parts, connection, name):
    assert difference(spark, seven_parts, QUERIES[name], SQL[name], connection) is None


@pytest.mark.parametrize("name", LAYOUT_FREE)
def test_result_does_not_depend_on_layout(spark, seven_parts, name):
    one, seven = QUERIES[name](spark, DATA), QUERIES[name](spark, seven_parts)
    assert canonical(map(tuple, one.collect()), one.columns) == canonical(map(tuple, seven.collect()), seven.columns)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
