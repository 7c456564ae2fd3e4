import duckdb
import pytest

import __spark_entry__
from quarrylens.plans.catalogue import ORACLE, QUERIES
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, con, sf, name):
    got, want, _ = compare(spark, con, sf, QUERIES[name], ORACLE[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).limit(1).count() == 1


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_best_member_of_equal_prices(spark, tmp_path):
    price = lambda k: "5.0::double" if k in (1, 2, 7, 8) else "null" if k in (3, 10) else "'nan'::double" if k in (5, 9) else "1.0::double"
    rows = [f"({'null' if k == 1 else k}::bigint, {k // 5}::bigint, 'p', {price(k)})" for k in range(11)]
    found = []
    for name, order in (("up", "asc nulls first"), ("down", "desc")):
        (tmp_path / name).mkdir()
        con = duckdb.connect()
        con.execute("set threads = 1")
        # one thread reads the orders by key, so that the first of equal prices is that of the smallest key
        con.execute(f"create view orders as select * from (values {', '.join(rows)}) t(o_orderkey, o_custkey, o_orderpriority, o_totalprice) order by o_orderkey nulls first")
        con.execute(f"copy (select * from orders order by o_orderkey {order}) to '{tmp_path / name}/orders.parquet' (format parquet)")
        got, want, _ = compare(spark, con, str(tmp_path / name), QUERIES["best_member"], ORACLE["best_member"])
        assert got == want
        found.append(got)
    assert found[0] == found[1]
    assert [r[1] for r in found[0][1]] == [0, 1, 2] and [r[2] for r in found[0][1]] == [2, 5, None]
