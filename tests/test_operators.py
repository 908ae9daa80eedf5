"""Operators on small frames: semantics, independence of partitioning, plan shape."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martkit.operators import (
    aggregate, combine, dedup, explode, filters, history, ids, incremental, joins, project, spread, star,
)
from tests.helpers import frame, plan, rows

END = dt.datetime(9999, 12, 31, 23, 59, 59)


def day(n):
    return dt.datetime(2025, 1, n)


# --- latest flag ----------------------------------------------------------------


def test_flag_latest_ties_and_nulls(spark):
    df = frame(
        spark, "k string, ts timestamp_ntz, n int",
        ("a", day(1), 1), ("a", day(2), 2), ("a", day(2), 3), ("a", None, 4),
        (None, day(1), 5), (None, day(3), 6), ("b", None, 7),
    )
    got = {r["n"]: r["f"] for r in history.flag_latest(df, "k", "ts", "f").collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: None, 5: 0, 6: 1, 7: None}


# --- spread join ------------------------------------------------------------------


def test_hot_keys(spark):
    df = frame(spark, "k string", *[("hot",)] * 70, *[(None,)] * 35, ("cold",))
    got = rows(spread.hot_keys(df, ["k"], 10))
    assert got == [("hot", 7), (None, 4)] or got == [(None, 4), ("hot", 7)]


@pytest.mark.parametrize("nulls_match", [True, False])
def test_spread_join_with_hot_and_null_keys(no_broadcast, nulls_match):
    spark = no_broadcast
    big = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
    )
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = spread.left_lookup(big, small, ["k"], nulls_match=nulls_match, rows_per_task=100)
    text = plan(out)
    assert "__salt" in text and "SortMergeJoin" in text
    counts = {r["k"]: r["count"] for r in big.groupBy("k").count().collect()}
    got = out.collect()
    assert len(got) == 3000
    for r in got:
        assert r["n"] == (counts[r["k"]] if r["k"] is not None or nulls_match else None)


def test_spread_join_divides_the_hot_key(no_broadcast):
    spark = no_broadcast
    big = spark.range(10000).select("id", F.lit("hot").alias("k"))
    small = frame(spark, "k string, v int", ("hot", 1))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = spread.left_lookup(big, small, ["k"], rows_per_task=100)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sum(sizes) == 10000 and max(sizes) < 6000


def test_identical_rows_are_split_by_adaptive_execution(no_broadcast):
    """Copies share a hash, so the spread cannot divide them; the skew rule does."""
    spark = no_broadcast
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.shuffle.partitions": "32",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        copies = spark.range(0, 600000, 1, 8).select(F.lit("hot").alias("k"), F.lit("same").alias("v"))
        others = spark.range(0, 2000, 1, 8).select(
            F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")).alias("k"), F.lit("x").alias("v")
        )
        big = copies.unionByName(others)
        small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        out = spread.left_lookup(big, small, ["k"], rows_per_task=300000)
        assert out.where("k = 'hot' and n = 600000").count() == 600000
        counted = out.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_spread_by_reads_only_named_columns(no_broadcast, sf):
    spark = no_broadcast
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    small = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    out = spread.left_lookup(
        orders, small, ["o_custkey"], spread_by=["o_orderkey"], rows_per_task=1
    ).select("o_custkey", "n")
    text = plan(out)
    assert "__salt" in text and "o_totalprice" not in text
    assert out.where("n is null").count() == 0 and out.count() == 1500


def test_lookup_without_hot_keys_is_plain(no_broadcast):
    spark = no_broadcast
    big = spark.range(100).select("id", (F.col("id") % 10).alias("k"))
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = spread.left_lookup(big, small, ["k"])
    assert "__salt" not in plan(out) and out.where("n = 10").count() == 100


def test_large_estimate_small_result_is_broadcast(spark):
    """An aggregate that Spark estimates as large as its input is measured."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        big = spark.range(5000).select("id", (F.col("id") % 10).alias("k"))
        small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        assert spread.estimated_bytes(small) > 1000
        out = spread.left_lookup(big, small, ["k"])
        assert "BroadcastHashJoin" in plan(out) and "SortMergeJoin" not in plan(out)
        assert out.where("n = 500").count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_broadcast_threshold_units(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, want in (("10mb", 10 << 20), ("5k", 5 << 10), ("7", 7), ("-1", -1), ("10485760b", 10 << 20)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert spread.broadcast_threshold(spark.range(1)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# --- dense ids --------------------------------------------------------------------


@pytest.fixture(params=["one task", "ranges"])
def id_way(request, monkeypatch):
    if request.param == "ranges":
        monkeypatch.setattr(ids, "ONE_TASK_BYTES", -1)
    return request.param


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_dense_ids_do_not_depend_on_partitioning(spark, parts, id_way):
    labels = [f"l{i:03d}" for i in range(200)]
    df = frame(spark, "x string", *[(l,) for l in labels * 2], ("",), (None,)).repartition(parts)
    got = sorted((r["id"], r["x"]) for r in ids.dense_ids(df, "x", "id").collect())
    assert got == [(i, l) for i, l in enumerate(labels, 1)]


def test_dense_ids_over_many_partitions(spark, id_way):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select(F.format_string("%05d", "id").alias("x"))
        got = sorted((r["id"], r["x"]) for r in ids.dense_ids(df, "x", "id", start=5).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == [(i + 5, f"{i:05d}") for i in range(1000)]


def test_add_dim_ids_missing_and_null_label(spark, id_way):
    df = frame(spark, "x string", ("b",), ("a",), (None,), ("",))
    assert rows(ids.add_dim_ids(df, "x", "i")) == sorted([("b", 2), ("a", 1), (None, 0), ("", 0)], key=repr)
    text = ids.add_dim_ids(df, "x", "i", missing=None, include_null=True, as_text=True)
    assert rows(text) == sorted([("", "1"), ("a", "2"), ("b", "3"), (None, "4")], key=repr)


# --- dedup ------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dedup_is_deterministic(spark, parts):
    df = spark.range(500).select((F.col("id") % 20).alias("k"), (F.col("id") * 7 % 101).alias("v")).repartition(parts)
    got = rows(dedup.dedup_by_key(df, ["k"]))
    want = {}
    for i in range(500):
        want[i % 20] = min(want.get(i % 20, 999), i * 7 % 101)
    assert got == sorted(want.items(), key=repr)


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    text = plan(dedup.dedup_by_key(df, ["k"], [F.col("id")]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_last_wins_keeps_rows_without_key(spark):
    df = frame(spark, "tx string, pos int", ("a", 1), ("a", 5), ("b", 2), (None, 3), (None, 4), ("", 6))
    got = rows(dedup.last_wins(df, "tx", [F.col("pos").desc()]))
    assert got == sorted([("a", 5), ("b", 2), (None, 3), (None, 4), ("", 6)], key=repr)


# --- projection and filters ---------------------------------------------------------


def test_rename_needs_a_free_target(spark):
    df = frame(spark, "id int, name string, campaign_name string", (1, "n", "c"))
    got = project.rename_aliases(df, {"id": "campaign_id", "name": "campaign_name"})
    assert got.columns == ["campaign_id", "name", "campaign_name"]


def test_align_to_contract(spark):
    df = frame(spark, "b string, z int", ("x", 1))
    schema = spark.range(0).selectExpr("1L AS a", "'' AS b", "cast(null as date) AS d").schema
    got = project.align_to_contract(df, schema, {"a": 7})
    assert got.columns == ["a", "b", "d"] and rows(got) == [(7, "x", None)]


def test_odd_column_names(spark):
    df = frame(spark, "`Cod. de Barras` string, `CPF/CNPJ` string", ("1", None))
    assert rows(project.select_present(df, ["CPF/CNPJ", "Cod. de Barras", "Mês"])) == [(None, "1")]
    assert rows(filters.require_not_null(df, ["Cod. de Barras"])) == [("1", None)]
    assert project.all_to_string(df).columns == df.columns


def test_select_all_rejects_missing(spark):
    with pytest.raises(PySparkException):
        project.select_all(frame(spark, "a int", (1,)), ["a", "b"]).collect()


def test_stack_strict_rejects_other_types(spark):
    with pytest.raises(ValueError):
        combine.stack_strict(frame(spark, "a int", (1,)), frame(spark, "a string", ("x",)))


def test_stack_contract_skips_incomplete_inputs(spark):
    whole, part = frame(spark, "a int, b int, c int", (1, 2, 3)), frame(spark, "a int", (9,))
    assert rows(combine.stack_contract([whole, part], ["b", "a"])) == [(2, 1)]
    with pytest.raises(ValueError):
        combine.stack_contract([part], ["b"])


def test_exclude_ids_drops_null_ids(spark):
    df = frame(spark, "i long", (1,), (2,), (None,))
    assert rows(filters.exclude_ids(df, "i", [2])) == [(1,)]
    assert rows(filters.exclude_ids(df, "i", frame(spark, "i long", (2,), (2,), (None,)))) == [(1,)]


def test_lenient_cast_converts_typed_columns(spark):
    df = frame(spark, "a double, b int, c string, t timestamp_ntz", (1.5, 2, "x", day(1)), (None, None, "3", None))
    got = project.lenient_cast(df, ints=["a", "c"], floats=["b"], timestamps=["t"])
    assert [t for _, t in got.dtypes] == ["bigint", "double", "bigint", "timestamp_ntz"]
    assert rows(got) == sorted([(1, 2.0, None, day(1)), (None, None, 3, None)], key=repr)
    zero = project.lenient_cast(df, ints=["a", "c"], floats=["b"], zero_nulls=True).drop("t")
    assert rows(zero) == sorted([(1, 2.0, 0), (0, 0.0, 3)], key=repr)


def test_any_positive(spark):
    df = frame(
        spark, "s string, n string, i int", ("0.0", "0", 1), ("0.1", None, 2), (None, "0.9", 3), ("x", "1", 4)
    )
    assert [r["i"] for r in filters.any_positive(df, ["s"], ["n"]).collect()] == [2, 4]


def test_split_valid_is_a_partition(spark):
    df = frame(spark, "a int, b int", (1, 1), (None, 1), (1, None), (None, None))
    valid, rejected = filters.split_valid(df, ["a", "b"])
    assert valid.count() == 1 and rejected.count() == 3


def test_order_rows_places_nulls_last(spark):
    df = frame(spark, "k int, v int", (None, 1), (1, None), (1, 2), (1, 3))
    got = [tuple(r) for r in project.order_rows(df, [("k", "asc"), ("v", "desc")], whole=True).collect()]
    assert got == [(1, 3), (1, 2), (1, None), (None, 1)]


# --- joins -------------------------------------------------------------------------


def test_member_flag_compares_as_text(spark):
    df = frame(spark, "k string", ("1",), ("2",), (None,), ("1",))
    other = frame(spark, "k long", (1,), (1,), (None,))
    assert rows(joins.member_flag(df, other, "k", "f")) == sorted(
        [("1", 1), ("1", 1), ("2", 0), (None, 0)], key=repr
    )


def test_new_rows_and_control(spark):
    df, control = frame(spark, "id long", (1,), (2,), (None,)), frame(spark, "id long", (2,), (2,))
    fresh = joins.new_rows(df, control, "id")
    assert rows(fresh) == [(1,)]
    assert rows(joins.append_control(control, fresh, "id")) == [(1,), (2,)]


def test_map_to_columns_last_entry_wins(spark, monkeypatch):
    texts = [
        (1, '{"utm_source": "a", "h1": "b", "x": "z"}'), (2, '{"UTM Source": null}'), (3, "{}"),
    ]
    df = frame(spark, "id long, t string", *texts).select(
        "id", F.from_json("t", "map<string,string>").alias("m")
    )
    labels = frame(spark, "key string, name string", ("h1", " UTM_source "), ("x", "Unrelated"))
    aliases = {"utm source": "s", "utm_medium": "m"}
    for most in (joins.LABELS, 0):  # labels in an expression, and joined
        monkeypatch.setattr(joins, "LABELS", most)
        assert rows(joins.map_to_columns(df, "id", "m", labels, aliases)) == [(1, "b", ""), (2, "", "")]
    monkeypatch.undo()
    alone = joins.map_to_columns(df, "id", "m", labels, aliases, one_per_key=True)
    assert rows(alone) == [(1, "b", ""), (2, "", "")]
    assert "Exchange" not in plan(alone) and "Generate" not in plan(alone)
    # a key that is an alias's name, but has another label, is not the alias
    other = frame(spark, "key string, name string", ("utm_source", "Unrelated"), ("x", None))
    assert rows(joins.map_to_columns(df, "id", "m", other, aliases)) == [(2, "", "")]


# --- aggregates ----------------------------------------------------------------------


def test_first_per_group(spark):
    df = frame(spark, "k int, o int, a string, b string", (1, 2, "x", "y"), (1, 1, None, None), (1, 3, "z", "w"))
    got = aggregate.first_per_group(df, ["k"], F.col("o"), {"a": False, "b": True})
    assert rows(got) == [(1, None, "y")]


def test_observed_counts_need_no_extra_job(spark):
    df, seen = aggregate.observed(frame(spark, "a int", (1,), (None,)), "seen", ["a"])
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"n_rows": 2, "a_nulls": 1}


# --- incremental ---------------------------------------------------------------------


def test_high_watermark(spark):
    names = frame(spark, "name string", ("ads_2025-01-03.json",), ("ads_2025-02-30.json",), ("x.json",))
    assert rows(incremental.high_watermark(names, "name")) == [(dt.date(2025, 1, 3),)]
    with pytest.raises(PySparkException, match="no file name"):
        incremental.high_watermark(names.where("name = 'x.json'"), "name").collect()


def test_missing_days(spark):
    mark = frame(spark, "watermark date", (dt.date(2025, 1, 30),))

    def days(upto):
        return [r[0].day for r in incremental.missing_days(mark, F.lit(upto).cast("date")).collect()]

    assert days("2025-02-02") == [31, 1, 2]
    assert days("2025-01-31") == [31]
    assert days("2025-01-30") == [] and days("2025-01-01") == []


def test_load_windows(spark):
    b = frame(spark, "a timestamp_ntz, z timestamp_ntz", (day(1), dt.datetime(2025, 3, 12, 5)))
    got = [tuple(r) for r in incremental.load_windows(b, "a", "z").collect()]
    assert [(r[1], r[2]) for r in got] == [
        (day(1), day(31)), (day(31), dt.datetime(2025, 3, 2)),
        (dt.datetime(2025, 3, 2), dt.datetime(2025, 3, 12, 5)),
    ]
    assert all(a[4] == b[3] for a, b in zip(got, got[1:]))
    exact = frame(spark, "a timestamp_ntz, z timestamp_ntz", (day(1), day(31)))
    assert incremental.load_windows(exact, "a", "z").count() == 1
    empty = frame(spark, "a timestamp_ntz, z timestamp_ntz", (day(1), day(1)))
    assert incremental.load_windows(empty, "a", "z").count() == 0


def test_load_windows_ignore_the_time_zone(spark):
    """Thirty days are thirty days, also across a change of daylight saving time."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        b = frame(spark, "a timestamp_ntz, z timestamp_ntz", (dt.datetime(1999, 9, 20), dt.datetime(1999, 12, 1)))
        got = [tuple(r) for r in incremental.load_windows(b, "a", "z").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [r[1] for r in got] == [dt.datetime(1999, 9, 20), dt.datetime(1999, 10, 20), dt.datetime(1999, 11, 19)]
    assert got[0][4] - got[0][3] == 30 * 86_400_000 and got[-1][2] == dt.datetime(1999, 12, 1)


def test_upsert_control(spark):
    control = frame(spark, "feed string, max_date date", (" Ads ", dt.date(2024, 1, 1)), ("old", dt.date(2020, 1, 1)))
    updates = frame(spark, "feed string, max_date date", ("ads", dt.date(2025, 1, 1)), ("ads", dt.date(2025, 2, 1)),
                    ("new", dt.date(2025, 3, 1)))
    assert rows(incremental.upsert_control(control, updates, "feed", "max_date")) == sorted(
        [(" Ads ", dt.date(2025, 2, 1)), ("old", dt.date(2020, 1, 1)), ("new", dt.date(2025, 3, 1))], key=repr
    )


# --- nested ----------------------------------------------------------------------------


def test_explode_children_keeps_childless_elements(spark):
    ddl = "r int, users array<struct<role:string,docs:array<string>>>"
    df = frame(
        spark, ddl, (1, [("B", ["x", "y"]), ("S", ["z"]), ("B", None), ("B", [])]), (2, None), (3, []),
        (4, [(None, ["q"])]),
    )
    got = explode.explode_children(
        df, "users", lambda u: u["role"] == "B", lambda u: u["docs"], {}, {"doc": lambda d: d}, ["r"]
    )
    assert rows(got.select("r", "pos", "doc")) == sorted(
        [(1, 0, "x"), (1, 0, "y"), (1, 1, None), (1, 2, None)], key=repr
    )


def test_flatten_report_with_fewer_dimensions(spark):
    df = frame(
        spark, "dimension_values array<struct<value:string>>, metric_values array<struct<value:string>>",
        ([("20250101",)], [("7",)]), (None, [("x",)]),
    )
    assert rows(explode.flatten_report(df, ["a", "b"], ["m"])) == [("20250101", None, 7), (None, None, None)]


# --- history -----------------------------------------------------------------------------


def scd2(df):
    return history.scd2_from_snapshots(df, ["k"], ["a"], "t")


def test_scd2_intervals(spark):
    df = frame(
        spark, "k string, a string, t timestamp_ntz",
        ("same", "1", day(1)), ("same", "1", day(2)), ("same", "1", day(3)), ("same", "1", day(4)),
        ("change", "1", day(1)), ("change", "1", day(2)), ("change", "2", day(3)), ("change", "2", day(4)),
        ("gone", "1", day(1)), ("gone", "1", day(2)),
        ("back", "1", day(1)), ("back", "1", day(3)), ("back", "1", day(4)),
        ("new", None, day(4)),
    )
    assert rows(scd2(df)) == sorted(
        [
            ("same", "1", day(1), END), ("change", "1", day(1), day(3)), ("change", "2", day(3), END),
            ("gone", "1", day(1), day(3)), ("back", "1", day(1), day(2)), ("back", "1", day(3), END),
            ("new", None, day(4), END),
        ],
        key=repr,
    )


def test_scd2_null_attributes_and_duplicates(spark):
    df = frame(
        spark, "k string, a string, t timestamp_ntz",
        ("n", None, day(1)), ("n", None, day(2)), ("n", "x", day(3)),
        ("d", "2", day(1)), ("d", "1", day(1)), ("d", "1", day(2)), ("d", "1", day(3)),
    )
    assert rows(scd2(df)) == sorted(
        [("n", None, day(1), day(3)), ("n", "x", day(3), END), ("d", "1", day(1), END)], key=repr
    )


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(1, 5)), min_size=1, max_size=25))
def test_scd2_property(spark, facts):
    """The intervals of a key do not overlap and cover exactly the snapshots that show it."""
    seen = {}
    for k, a, t in facts:
        seen[k, t] = min(a, seen.get((k, t), 9))
    df = frame(spark, "k int, a int, t timestamp_ntz", *[(k, a, day(t)) for k, a, t in facts])
    times = sorted({day(t) for _, _, t in facts})
    got = rows(scd2(df))
    for t in times:
        for k in range(4):
            hits = [a for kk, a, lo, hi in got if kk == k and lo <= t < hi]
            want = seen.get((k, t.day))
            assert hits == ([] if want is None else [want])
    for k, a, lo, hi in got:
        assert not any(k == k2 and a == a2 and lo2 == hi for k2, a2, lo2, _ in got)


def test_snapshot_diff(spark):
    old = frame(spark, "k string, a int", ("s", 1), ("c", 1), ("r", 1), (None, 1), ("n", None))
    new = frame(spark, "k string, a int", ("s", 1), ("c", 2), ("x", 1), (None, 1), ("n", None))
    got = {r["k"]: r["status"] for r in history.snapshot_diff(old, new, ["k"], ["a"]).collect()}
    assert got == {"s": "same", "c": "changed", "r": "removed", "x": "added", None: "same", "n": "same"}


def test_remap_keeps_rows_and_uses_the_current_id(spark):
    past = frame(
        spark, "stage_id long, stage_name string, pipeline_id long, dt_fim_vigencia timestamp_ntz",
        (1, "Won", 1, day(2)), (2, "Won", 1, END), (3, "Lost", 1, END), (9, "Dropped", 1, day(3)),
        # id 1 was renamed: it stood for two stages
        (1, "Lost", 1, day(1)), (4, "Won", 2, END),
    )
    fact = frame(spark, "new_stage_id long, pipeline_id long", (1, 7), (1, 7), (2, 7), (9, 7), (None, 7), (50, 7))
    got = history.remap_to_current(fact, past, ["new_stage_id"], "stage_id", ["stage_name", "pipeline_id"])
    assert rows(got) == sorted([(2, 7), (2, 7), (2, 7), (9, 7), (None, 7), (50, 7)], key=repr)


def test_latest_load_per_key_keeps_whole_load(spark):
    df = frame(spark, "k int, v string, load string", (1, "a", "1"), (1, "b", "2"), (1, "c", "2"), (2, "d", "1"))
    got = star.build_fact(df, ["k", "v"], ["k"], "load")
    assert rows(got) == sorted([(1, "b"), (1, "c"), (2, "d")], key=repr)
    assert star.build_fact(df, ["k", "v"]).count() == 4
