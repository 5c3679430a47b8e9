import pytest
from compare import connect, differences

from __spark_entry__ import entry
from kerbside.plans.catalog import QUERIES
from kerbside.plans.oracle import ORACLE

FOLDERS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.fixture(scope="module", params=FOLDERS)
def tables(request):
    return request.param


@pytest.fixture(scope="module")
def db(tables):
    return connect(tables)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, tables, db, name):
    assert differences(QUERIES[name](spark, tables), db, ORACLE[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() == 10
