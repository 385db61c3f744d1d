"""Registered queries against their SQL twins, on the smallest tables that give rows."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
import oracle

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
#: The smallest tables hold no full year, or too few rows for a model's choices to be clear.
ON_LARGER = {"weekly_climatology", "smoothed_climatology", "stream_score", "stump_train", "stump_three_classes"}
#: Minutes each here; ``python tests/oracle.py`` compares them, and tests/test_models.py covers their parts.
SLOW = {"stump_tuning", "stump_alerts", "permutation_rule", "stream_refresh"}
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the generated tables are not here")


@pytest.fixture(scope="module")
def con():
    return {folder: oracle.duck(folder) for folder in (FOLDER, LARGER)}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_query_equals_sql(spark, con, name):
    folder = LARGER if name in ON_LARGER else FOLDER
    assert oracle.compare(QUERIES[name](spark, folder), con[folder], ORACLES[name]) is None
