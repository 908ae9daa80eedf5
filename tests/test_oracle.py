"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from martkit.catalog import ORACLE, QUERIES
from tests.conftest import SF
from tests.helpers import plan
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def con():
    return connect(SF)


NEVER = ("EvalPython", "MapInPandas", "FlatMapGroups", "Cartesian", "NestedLoop")
# Queries in which one task sees a whole input: global aggregates (one row per
# map task), snapshot times, labels or label ranges of bounded size.
ONE_TASK = {
    "json_rejects", "mart_crm_stage_history", "mart_ads_b", "mart_ads_b_audience", "dense_ids_sorted",
    "dense_ids_many", "dense_ids_text", "profile", "max_value", "high_watermark", "missing_days",
    "load_windows", "scd2_from_snapshots", "snapshot_diff",
    # sizes of range partitions, one row each
    "order_mixed_positions", "dense_ids_ranges",
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    text = plan(df)
    assert not [w for w in NEVER if w in text]
    if name not in ONE_TASK:
        assert "SinglePartition" not in text
    assert differences(df, con, ORACLE[name]) is None


def test_entry_has_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["event_id", "deal_id", "flg_ultimo_movimento", "flag_deal_ativo", "date"]
    assert df.count() == 1000


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(entry_points.oracle_sql())


# The joins that choose their way by size, forced to shuffle on both sides.
SHUFFLED = [
    "latest_movement_flag", "latest_flag_ties_nulls", "latest_load_per_key", "dense_ids_sorted",
    "dense_ids_text", "member_flag", "lookup_default", "left_composite", "remap_to_current",
    "enrich_attributes", "map_to_columns", "mart_crm", "mart_ads_a", "mart_contacts", "mart_crm_remap",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_shuffled_lookups(no_broadcast, sf, con, name):
    assert differences(QUERIES[name](no_broadcast, sf), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", ["dense_ids_sorted", "dense_ids_many", "dense_ids_text", "mart_ads_b"])
def test_ids_by_ranges(spark, sf, con, name, monkeypatch):
    from martkit.operators import ids

    monkeypatch.setattr(ids, "ONE_TASK_BYTES", -1)
    assert differences(QUERIES[name](spark, sf), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", SHUFFLED)
def test_spread_hot_keys(no_broadcast, sf, con, name, monkeypatch):
    """Every key counts as hot, so all rows go through the spread join."""
    from martkit.operators import spread

    plain = spread.hot_from_counts
    monkeypatch.setattr(
        spread, "hot_from_counts", lambda counts, keys, col, _: plain(counts, keys, col, 3)
    )
    assert differences(QUERIES[name](no_broadcast, sf), con, ORACLE[name]) is None
