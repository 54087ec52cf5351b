"""Every query outside the training-data package runs on the smallest tables, and equals its SQL where it has one."""

import pytest

from framemill.plans import corpus, curation, pipelines
from tests.oracle import same, views

QUERIES = {**curation.QUERIES, **pipelines.QUERIES, **corpus.QUERIES}
SQL = {**curation.SQL, **pipelines.SQL, **corpus.SQL}


@pytest.fixture(scope="module")
def con(small):
    return views(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, small, con, name):
    got, want = same(spark, con, small, QUERIES[name], SQL[name])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    rows = QUERIES[name](spark, small).collect()
    assert rows or name in ("peaks_or_fallback", "pl_sequences")  # the smallest tables hold no long sequence


def test_entry(spark, small):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
