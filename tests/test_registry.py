"""Registered queries against their SQL at the smallest scale.

A few of every kind by default; all of them with TALLYHOUSE_ALL=1 (or ``python -m suite.compare``).
"""

import os

import pytest

from suite.compare import connect, difference
from suite.oracles import ORACLES
from suite.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SOME = ("monthly_performance", "rfm_summary", "validation_log", "referential_integrity", "sales_ytd", "quality_flags",
        "line_features", "robust_scaling_narrowed", "forest_nodes", "anomaly_classification", "adhoc_sql")
NAMES = sorted(QUERIES) if os.environ.get("TALLYHOUSE_ALL") else SOME


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("the given tables are not here")
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, con, name):
    assert difference(spark, con, name, FOLDER) in (None, "no rows")


def test_every_query_but_the_sample_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"table_sample"}
    assert set(ORACLES) <= set(QUERIES)
