"""Every registered query against its DuckDB text."""

import pytest

from corpusflow.catalog import ORACLE, QUERIES
from tests.conftest import SF_DIR

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    cursor = duck.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert columns == sorted(types)
    assert {c: TYPES[t] for c, t in frame.dtypes} == types
    at = [list(types).index(c) for c in columns]
    expected = sorted(repr(tuple(row[i] for i in at)) for row in cursor.fetchall())
    assert sorted(repr(tuple(row[c] for c in columns)) for row in frame.collect()) == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
