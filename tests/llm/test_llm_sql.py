"""Corpus queries that SQL can express give its rows."""

from __future__ import annotations

import os

import pytest

from oracle import connection, difference
from sensorloom.llm import queries, sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(connection(SF_DIR), sql.ORACLE[name], queries.QUERIES[name](spark, SF_DIR)) is None


def test_sql_covers_all_that_it_can():
    assert set(queries.QUERIES) - set(sql.ORACLE) == {
        "op1_packing", "op2_language", "op6_ngram_join", "op8_tokens", "op9_repeats", "op10_toxicity",
        "op11_quality",
    }
