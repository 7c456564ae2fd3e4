"""Queries that read a part of a table once: neither they nor their SQL do so now."""

import pytest

from quarrylens.plans.catalogue import ORACLE
from tests.compare import connect

SUBSETS = {
    "decision_validation": "p_partkey <= 200",
    "taxonomy_expand": "p_partkey <= 200",
    "global_taxonomy": "p_partkey <= 200",
    "attribution_join": "l_orderkey % 5 = 0",
    "theme_candidates": "l_orderkey % 5 = 0",
    "trend_grid": "product_id < 5",
}


@pytest.mark.parametrize("name", sorted(SUBSETS))
def test_sql_reads_whole_tables(name):
    # test_catalogue holds the query against this SQL
    assert SUBSETS[name] not in ORACLE[name]


@pytest.mark.parametrize("name", ["api_product_search", "orphan_anti", "demand_candidates"])
def test_the_data_hit(sf, name):
    con = connect(sf)
    assert con.sql(f"SELECT count(*) FROM ({ORACLE[name]})").fetchall()[0][0] > 0
