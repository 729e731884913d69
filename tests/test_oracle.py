"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF001
from tests.oracle import compare, duck, type_diff

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    assert not type_diff(df, con, ORACLE[name])
    s, d = compare(df, con, ORACLE[name])
    assert s[0] == d[0], f"columns {s[0]} vs {d[0]}"
    assert s[1] == d[1], f"rows {s[1]} vs {d[1]}"
    assert s[2] == d[2], "values differ"


def test_every_query_has_oracle_or_is_listed():
    missing = set(QUERIES) - set(ORACLE)
    assert missing <= set(entry.ROWS_ONLY), missing
