"""The contract queries against their SQL, and the registry."""

import pytest

import __spark_entry__ as E
from civicflow.llm.oracles import oracle_sql
from civicflow.llm.queries import queries
from tests.llm.helpers import SF
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_its_sql(spark, name):
    res = compare(spark, name, queries()[name], oracle_sql()[name], SF, duck(SF))
    assert res["status"] == "ok", res


def test_entry_adds_operators_and_pipeline():
    names = set(E.queries())
    assert set(queries()) | {"pipeline"} <= names and set(oracle_sql()) <= set(E.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
