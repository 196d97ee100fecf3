"""Registered queries against their SQL on the smallest tables."""

import pytest

from tests.compare import compare, connect
from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
#: these score two snapshots; tests/compare.py and the driver run them
LONG = {"cl_09_diff_events", "cl_10_cohort_minutes", "tk_05_priority_cap", "sf_15_event_ids", "sk_06_feed_items", "cl_15_promotion_criteria", "jn_05_snapshot_pair", "so_05_thresholds_crossed", "cl_16_shadow_report"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in registry.queries() if n not in LONG])
def test_query(spark, duck, name):
    why, rows = compare(spark, duck, name, registry.queries()[name], registry.oracle_sql().get(name), SF)
    assert not why, why
    assert rows > 0
