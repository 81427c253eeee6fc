"""The operators' queries against their SQL on the smallest tables."""

from __future__ import annotations

import pytest

from basketlens.llm.oracles import llm_oracles
from basketlens.llm.queries import llm_queries
from tests.compare import differences, duck

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_same_rows_as_sql(spark, connection, name):
    found = differences(llm_queries()[name](spark, DATA), connection, llm_oracles()[name])
    assert not found, "\n".join(found)


def test_the_others_have_tests_of_their_own():
    assert set(llm_queries()) - set(llm_oracles()) == {
        "op2_quality",
        "op4_substring_dedup",
        "op5_decontaminate",
        "op9_near_dedup",
        "op10_lm_score",
        "pipeline",
    }
