"""Queries with a statement give the values DuckDB gives."""

import pytest
from oracle_check import compare

from stayline.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, small, name):
    status, note = compare(spark, small, name, catalog.QUERIES[name], catalog.ORACLES[name])
    assert status == "ok", note


def test_every_operator_is_registered():
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in catalog.QUERIES)] == []
    assert "pipeline" in catalog.QUERIES
