"""Shape of single plans; test_oracle checks every query for operators that must not occur."""

from __future__ import annotations

from martkit.catalog import QUERIES
from martkit.catalog.registry import table
from martkit.operators import history
from tests.helpers import plan

def test_only_needed_columns_are_read(spark, sf):
    text = plan(QUERIES["fact_contract"](spark, sf).select("l_orderkey", "l_quantity"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_filters_reach_the_scan(spark, sf):
    text = plan(QUERIES["latest_movement_flag"](spark, sf))
    assert "GreaterThan(c_acctbal,5000.0)" in text


def test_flag_latest_has_no_window(spark, sf):
    flagged = history.flag_latest(table(spark, sf, "events"), "user_id", "ts", "f")
    text = plan(flagged)
    assert "Window" not in text and "partial_max" in text


def test_dedup_limits_before_the_shuffle(spark, sf):
    for name in ("dim_by_key", "last_wins", "dedup_first_nonempty", "mart_contacts_leads"):
        text = plan(QUERIES[name](spark, sf))
        assert text.count("WindowGroupLimit") == 2, name
    assert "text" not in plan(QUERIES["dedup_first_nonempty"](spark, sf)).split("Exchange")[0]


def test_snapshot_diff_joins_nothing(spark, sf):
    text = plan(QUERIES["snapshot_diff"](spark, sf))
    assert "Join" not in text


def test_versions_are_gathered_before_they_are_written(spark, sf):
    df = table(spark, sf, "orders").hint("rebalance", "o_orderstatus")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(df)
