"""Every query of the package runs on the smallest tables, and equals its SQL where it has one."""

import pytest

from framemill.llm import queries
from tests.oracle import same, views


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, small, name):
    if name in queries.SQL:
        got, want = same(spark, views(small), small, queries.QUERIES[name], queries.SQL[name])
        assert got == want
    else:
        assert queries.QUERIES[name](spark, small).collect() or name == "p4_quarantine"  # the smallest table has no conflict


def test_registered():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries())
