"""Registered queries against their SQL, on whole tables."""

import pytest
from check import compare, duck
from .tables import SMALL

from folioscan.llm.queries import LLM_ORACLES, LLM_QUERIES


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SMALL), name, LLM_QUERIES[name], LLM_ORACLES[name], SMALL) is None


def test_one_query_for_each_operator():
    from __spark_entry__ import queries

    names = set(queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([name for name in names if name.startswith(f"op{n}_")]) == 1
