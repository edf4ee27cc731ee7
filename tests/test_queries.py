"""Every registered query gives the rows of its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from chainmark.plans.all_queries import QUERIES
from compare import compare

SQL = oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    build = queries()[name]
    if name in SQL:
        found = compare(spark, sf_dir, build, SQL[name])
        if found == "no rows on either side":  # the smallest tables lack the case; agreement on nothing says nothing
            found = compare(spark, "/root/testdata/sf0.01", build, SQL[name])
        assert found == ""
    else:
        assert build(spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_most_queries_have_sql():
    assert set(SQL) <= set(queries())
