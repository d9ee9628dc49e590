"""Every registered query against its SQL twin, exactly."""

import os

import pytest

from workload.catalog import QUERIES, SQL
from workload.check import differences, duck, type_notes

pytestmark = pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="needs the test tables")


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name not in SQL:
        assert df.count() > 0
        return
    assert differences(df, con, SQL[name]) == []
    assert type_notes(df, con, SQL[name]) == []


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
