import pytest

from quarrylens.llm.queries import ORACLE, QUERIES
from tests.compare import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf, name):
    got, want, _ = compare(spark, connect(sf), sf, QUERIES[name], ORACLE[name])
    assert got == want


def test_all_ten_are_there():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
