"""Every core query with SQL against it, over the smallest tables."""

import oracle
import pytest

from siltstone import catalog_queries, domain_queries, queries

QUERIES = queries.QUERIES | domain_queries.QUERIES | catalog_queries.QUERIES
SQL = queries.ORACLE | domain_queries.ORACLE | catalog_queries.ORACLE
#: What the smallest tables have no case of; those of sf0.01 have.
NONE_HERE = {"top_users", "raw_quarantine", "top_datasets_by_mentions"}


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_and_sql_agree(spark, sf, con, name):
    columns, ours, theirs, n = oracle.differences(spark, con, QUERIES[name], SQL[name], sf)
    assert columns is None and not ours and not theirs, (columns, ours[:3], theirs[:3])
    assert n or name in NONE_HERE


def test_the_flagship_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
