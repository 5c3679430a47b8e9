"""Every query on tables in which one order holds a third of the lines, as exact copies."""

import duckdb
import pytest
from compare import TABLES, connect, differences

from kerbside.plans.catalog import QUERIES
from kerbside.plans.oracle import ORACLE

SOURCE = "/root/testdata/sf0.001"

# The row key of the mapping.
H = (
    "l_orderkey*7 + l_partkey*13 + l_suppkey*17 + l_linenumber*19 + CAST(l_quantity AS BIGINT)*23"
)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in TABLES:
        rows = f"SELECT * FROM '{SOURCE}/{name}.parquet'"
        if name == "lineitem":
            # 3000 copies of one line that every rule set keeps, and a few lines without order.
            plain = " AND ".join(
                f"({H}) % {d} <> 0" for d in (11, 53, 59, 89, 97, 101, 211, 223, 401)
            )
            rows = (
                f"{rows} UNION ALL (SELECT l.* FROM (SELECT * FROM '{SOURCE}/lineitem.parquet' "
                f"WHERE {plain} AND l_linenumber < 7 AND l_quantity < 20 ORDER BY ALL LIMIT 1) l, "
                "range(3000)) UNION ALL "
                f"SELECT * REPLACE (l_orderkey + 1000000 AS l_orderkey) "
                f"FROM '{SOURCE}/lineitem.parquet' WHERE l_orderkey < 20"
            )
        duckdb.sql(f"COPY ({rows}) TO '{folder}/{name}.parquet'")
    return folder


@pytest.fixture(scope="module")
def db(skewed):
    return connect(skewed)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, skewed, db, name):
    assert differences(QUERIES[name](spark, skewed), db, ORACLE[name]) == []


def test_the_hot_line_survives_cleaning(spark, skewed):
    for rules in ("quality", "payment", "carpool", "feature", "model"):
        assert QUERIES[f"clean_{rules}"](spark, skewed).first()["n"] > 7000
