"""Every batch query, and some streaming twins, against SQL on the same tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from oracle_check import compare, connect
from tideline.workload import batch, streams

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SOME_STREAMS = ("stream_window_sums", "stream_province_orders_30d", "stream_order_detail_wide",
                "stream_unique_visitor_daily", "stream_dimension_snapshot")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [*batch.QUERIES, *SOME_STREAMS])
def test_query_equals_sql(spark, con, name):
    problem = compare(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], SF)
    assert problem is None, problem


def test_contract(spark):
    corpus = contract.LLM_QUERIES.keys()
    assert contract.queries().keys() - corpus == contract.oracle_sql().keys() - corpus
    assert set(streams.TWINS) <= contract.queries().keys()
    assert contract.entry(spark).columns[:2] == ["stt", "edt"]
