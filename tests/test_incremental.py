"""Incremental runs: the same tables as a full rebuild, with only the new files and the touched partitions read."""

from __future__ import annotations

import datetime as dt
import glob
import json
import random

import pytest
from pyspark.sql import functions as F

from martkit.operators.history import flag_latest, scd2_from_snapshots
from martkit.operators.state import merge_newest, merge_snapshot, newest_times
from martkit.plans import ads_a, daily, deliveries, layers, sales_a
from martkit.plans import contracts as c
from martkit.sources.pointed import PointedTable
from martkit.sources.readers import as_schema
from martkit.streaming.ingest import ingest_last_wins, last_wins_table
from tests.helpers import frame, rows
from tests.test_files import put


def spoil(folder):
    """Overwrite files, so that whoever reads them fails or sees it."""
    found = [f for f in glob.glob(f"{folder}/**/*", recursive=True) if f.endswith((".parquet", ".json"))]
    for f in found:
        with open(f, "w") as out:
            out.write("spoiled")
    for f in glob.glob(f"{folder}/**/.*.crc", recursive=True):
        with open(f, "w") as out:
            out.write("")
    return len(found)


# --- pointed tables -------------------------------------------------------------


def test_partitions_are_replaced_together(spark, tmp_path, monkeypatch):
    t = PointedTable(spark, str(tmp_path / "t"), "k int, v string, part string", ["part", "k"])
    assert rows(t.read()) == [] and t.partitions() == {}
    kind = "k int, v string, part string"
    assert t.replace(frame(spark, kind, (1, "a", "x"), (1, "b", "x"), (2, "c", "x"), (None, "d", None))) == ["null|null", "x|1", "x|2"]
    assert rows(t.read(["x|1", "nowhere"])) == [(1, "a", "x"), (1, "b", "x")]

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(PointedTable, "_commit", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            t.replace(frame(spark, kind, (1, "new", "x"), (2, "new", "x")))
    assert len(rows(t.read())) == 4  # as before

    older = t.read()
    t.replace(frame(spark, kind, (1, "new", "x")), drop=["x|2", "x|9"])
    assert rows(t.read()) == [(1, "new", "x"), (None, "d", None)]
    assert len(rows(older)) == 4  # a reader that began before goes on with its state
    assert t.sweep() >= 2 and len(rows(t.read())) == 2 and t.sweep() == 0
    t.replace(frame(spark, kind), drop=["x|1"])
    assert rows(t.read()) == [(None, "d", None)]


def test_of_two_writers_one_fails(spark, tmp_path):
    kind = "k int"
    a, b = (PointedTable(spark, str(tmp_path / "t"), kind, ["k"]) for _ in range(2))
    a.replace(frame(spark, kind, (1,)))
    with pytest.raises(RuntimeError, match="another run"):
        b._commit({}, 1)
    assert rows(b.read()) == [(1,)]


# --- newest times ---------------------------------------------------------------


def test_newest_times_follow_deliveries(spark):
    """Random deliveries with ties, missing times and missing keys; each merged twice."""
    draw = random.Random(4)
    state = frame(spark, "key string, newest timestamp, versions array<string>")
    everything = []
    for n in range(4):
        new = [(draw.choice(["a", "b", "c", None]), draw.choice([None, dt.datetime(2025, 1, draw.randint(1, 6))]), f"v{n}")
               for _ in range(6)]
        everything += new
        got = newest_times(frame(spark, "k string, t timestamp, v string", *new), "k", "t", "v")
        before = {r["key"]: (r["newest"], r["versions"]) for r in state.collect()}
        merged = merge_newest(state, got)
        again = merge_newest(merged.drop("stale"), got)
        assert rows(again.drop("stale")) == rows(merged.drop("stale")) and not [r for r in again.collect() if r["stale"]]
        want = {}
        for k, t, v in everything:
            if t is not None:
                best, held = want.get(k, (t, set()))
                want[k] = (t, {v}) if t > best else (best, held | {v} if t == best else held)
        assert {r["key"]: (r["newest"], set(r["versions"])) for r in merged.collect()} == want
        for r in merged.collect():
            t, versions = before.get(r["key"], (None, []))
            assert r["stale"] == (versions if t is not None and t < r["newest"] else [])
        state = spark.createDataFrame(merged.drop("stale").collect(), state.schema)


def moves(spark, tmp_path, n_deals, run, monkeypatch=None):
    persons = frame(spark, "id bigint, fields map<string,string>")
    names = frame(spark, "key string, name string")
    deals = frame(spark, "id bigint, status string", *[(i, "open") for i in range(n_deals)])
    return daily.run_moves(spark, str(tmp_path / "feed"), str(tmp_path / "silver"), str(tmp_path / "gold"), run, persons, names, deals)


def deliver_moves(tmp_path, name, events):
    (tmp_path / "feed").mkdir(exist_ok=True)
    lines = [json.dumps({"deal_id": str(d), "title": t, "timestamp": f"2025-01-{day:02}T00:00:00+00:00"}) for d, t, day in events]
    (tmp_path / "feed" / name).write_text("\n".join(lines))


def test_only_touched_partitions_are_read(spark, tmp_path):
    """A delivery of one deal reads that deal's buckets of the fact and the state; all others are spoiled before."""
    deliver_moves(tmp_path, "a.json", [(d, f"a{d}", 1) for d in range(40)])
    assert moves(spark, tmp_path, 40, "20250101_000000") == ["20250101_000000"]
    deliver_moves(tmp_path, "b.json", [(d, f"b{d}", 2) for d in range(20)])
    moves(spark, tmp_path, 40, "20250102_000000")
    fact, newest = daily.moves_table(spark, str(tmp_path / "gold")), daily.newest_table(spark, str(tmp_path / "gold"))
    whole = daily.read_moves(spark, str(tmp_path / "gold")).select(F.col("deal_id").cast("string").alias("deal_id"), "title", "timestamp",
                                                                  "flg_ultimo_movimento")
    want = flag_latest(whole, "deal_id", "timestamp", "flg")
    assert [r for r in want.collect() if r["flg"] != r["flg_ultimo_movimento"]] == []
    bucket = next(r["bucket"] for r in newest.read().collect() if str(r["key"]) == "7")
    deliver_moves(tmp_path, "c.json", [(7, "c7", 3)])
    spoiled = sum(spoil(tmp_path / "gold" / "ft_move" / f) for p, f in fact.partitions().items() if p != f"20250102_000000|{bucket}")
    spoiled += sum(spoil(tmp_path / "gold" / "ft_move_newest" / f) for p, f in newest.partitions().items() if p != str(bucket))
    assert spoiled > 20
    assert moves(spark, tmp_path, 40, "20250103_000000") == ["20250103_000000"]
    now = fact.read([f"2025010{i}_000000|{bucket}" for i in (2, 3)])
    assert {r["title"]: r["flg_ultimo_movimento"] for r in now.collect() if r["title"][1:] == "7"} == {"b7": 0, "c7": 1}


@pytest.mark.parametrize("step", ["fact", "state", "control"])
def test_a_stopped_run_is_made_good(spark, tmp_path, monkeypatch, step):
    """Stopped before the fact's commit, before the state's, and before the control entry."""
    deliver_moves(tmp_path, "a.json", [(1, "a1", 1), (2, "a2", 5)])
    moves(spark, tmp_path, 3, "20250101_000000")
    deliver_moves(tmp_path, "b.json", [(1, "b1", 2), (2, "b2", 2), (1, "b1 again", 2)])
    commit, calls = PointedTable._commit, []

    def stop(self, *args):
        calls.append(self.path)
        if step != "control" and len(calls) == {"fact": 1, "state": 2}[step]:
            raise RuntimeError("stopped")
        commit(self, *args)
        if step == "control" and len(calls) == 2:
            raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(PointedTable, "_commit", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            moves(spark, tmp_path, 3, "20250102_000000")
    deliver_moves(tmp_path, "c.json", [(2, "c2", 6)])
    assert moves(spark, tmp_path, 3, "20250103_000000") == ["20250102_000000", "20250103_000000"]
    got = {(r["title"], r["flg_ultimo_movimento"]) for r in daily.read_moves(spark, str(tmp_path / "gold")).collect()}
    assert got == {("a1", 0), ("a2", 0), ("b1", 1), ("b1 again", 1), ("b2", 0), ("c2", 1)}


# --- history --------------------------------------------------------------------


def test_snapshots_merged_one_by_one(spark):
    """Random snapshots with changes, gaps, returns, null keys and attributes and doubled rows, against all of them at once."""
    draw = random.Random(8)
    kind = "k string, a string, b int, ts timestamp_ntz"
    every, state = [], frame(spark, "k string, a string, b int, s timestamp_ntz, e timestamp_ntz")
    end = dt.datetime(9999, 12, 31, 23, 59, 59)
    closed = []
    for day in range(1, 8):
        at = dt.datetime(2025, 1, day)
        new = [(k, draw.choice(["x", "y", None]), draw.choice([1, None]), at)
               for k in ["p", "q", "r", "s", None] for _ in range(draw.choice([0, 1, 1, 2]))]
        new.append(("always", "x", day // 3, at))
        every += new
        merged = merge_snapshot(state, frame(spark, kind, *new).drop("ts"), ["k"], ["a", "b"], F.lit(at), "s", "e").collect()
        closed += [tuple(r) for r in merged if r["e"] != end]
        state = frame(spark, "k string, a string, b int, s timestamp_ntz, e timestamp_ntz", *[tuple(r) for r in merged if r["e"] == end])
        want = rows(scd2_from_snapshots(frame(spark, kind, *every), ["k"], ["a", "b"], "ts", "s", "e"))
        assert sorted([*closed, *rows(state)], key=repr) == want


def test_stage_history_from_new_snapshots(spark, tmp_path):
    gold = str(tmp_path)

    def merge(day, *stages):
        return daily.merge_stage_snapshot(spark, frame(spark, c.STAGE, *stages), dt.datetime(2025, 1, day), gold)

    a, b = (1, "A", 1, 10, "Funnel"), (2, "B", 2, 10, "Funnel")
    assert merge(1, a, b, (3, None, 1, 1, "lacks a name"))
    assert merge(2, a)
    assert not merge(2, b) and not merge(1, b)  # merged before, or too late
    table = daily.history_table(spark, gold)
    assert all(spoil(tmp_path / "scd2_dim_stage" / f) for p, f in table.partitions().items() if p != "open")
    assert merge(3, (9, "A", 1, 10, "Funnel"), b)
    got = [tuple(r) for r in table.read(["open", "closed 2025-01-03 00:00:00"]).select("stage_id", "dt_inicio_vigencia", "dt_fim_vigencia").collect()]
    day, end = (lambda n: dt.datetime(2025, 1, n)), dt.datetime(9999, 12, 31, 23, 59, 59)
    assert sorted(x for x in got if x[0]) == [(1, day(1), day(3)), (2, day(3), end), (9, day(3), end)]
    assert merge(4) and not merge(4, a) and merge(5, a)  # an empty snapshot ends all and is remembered


# --- advertising and sales ------------------------------------------------------


def insight(camp, day, spend, **more):
    return {"campaign_id": camp, "campaign_name": f"N{camp}{day}", "date_stop": day, "spend": spend, "impressions": "3", **more}


def test_ads_in_two_deliveries(spark, tmp_path):
    bronze, gold = tmp_path / "bronze", str(tmp_path / "gold")
    lookups = {
        "targeting": frame(spark, c.ADS_A_TARGETING), "creatives": frame(spark, c.ADS_A_CREATIVE), "media": frame(spark, c.ADS_A_MEDIA),
    }
    for feed in ("targeting", "creatives", "media"):
        put(str(bronze / feed), "none.json", "[]")

    def land(feed, day, *records, name=""):
        put(str(bronze / feed), f"{feed}{name}_{day}.json", json.dumps(list(records)))

    for feed, key in (("campaigns", {}), ("adsets", {"adset_id": "s1", "adset_name": "S"}), ("ads", {"ad_id": "a1", "ad_name": "A"})):
        land(feed, "2025-01-01", insight("c1", "2025-01-01", "1.5", **key), {"campaign_id": "bad", "actions": 5})
        land(feed, "2025-01-02", insight("c1", "2025-01-02", "2", **key), insight("c2", "2025-01-02", "0", impressions="0", **key))
        land(feed, "2025-01-09", insight("c9", "2025-01-09", "9", **key))
        put(str(bronze / feed), "undated.json", json.dumps([insight("cX", "2025-01-01", "1", **key)]))
    first = deliveries.run_ads_a(spark, str(bronze), gold, lookups, upto=dt.date(2025, 1, 5))
    assert {f: [p.rsplit("_", 1)[1] for p in paths] for f, paths in first.items()} == {
        f: ["2025-01-01.json", "2025-01-02.json"] for f in ("campaigns", "adsets", "ads")
    }
    control = deliveries.control_table(spark, gold).read()
    assert rows(deliveries.watermarks(control)) == [(f, dt.date(2025, 1, 2)) for f in ("ads", "adsets", "campaigns")]
    missing = deliveries.days_to_pull(spark, control, "ads", dt.date(2025, 1, 4))
    assert rows(missing) == [(dt.date(2025, 1, 3),), (dt.date(2025, 1, 4),)]
    assert deliveries.run_ads_a(spark, str(bronze), gold, lookups, upto=dt.date(2025, 1, 5)) == {}

    # a late file of a day that is in, and new days; the files of the first day are read no more
    land("campaigns", "2025-01-02", insight("c3", "2025-01-02", "7"), name="_late")
    saved = (bronze / "campaigns" / "campaigns_2025-01-01.json").read_text()
    put(str(bronze / "campaigns"), "campaigns_2025-01-01.json", "spoiled")
    second = deliveries.run_ads_a(spark, str(bronze), gold, lookups)
    assert [p.rsplit("/", 1)[1] for p in second["campaigns"]] == ["campaigns_2025-01-02.json", "campaigns_2025-01-09.json", "campaigns_late_2025-01-02.json"]
    put(str(bronze / "campaigns"), "campaigns_2025-01-01.json", saved)
    for feed in ("campaigns", "adsets", "ads"):
        (bronze / feed / "undated.json").rename(tmp_path / f"{feed}-undated.json")
    want = ads_a.build_ads_a(layers.read_ads_a(spark, str(bronze)))
    got = deliveries.read_ads_a(spark, gold)
    assert set(got) == set(want)
    for name in want:
        assert rows(got[name].select(*want[name].columns)) == rows(want[name]), name
    bad = deliveries.read_rejects(spark, gold)
    assert sorted((r["feed"], r["reason"]) for r in bad.collect()) == [(f, "wrong type: actions") for f in ("ads", "adsets", "campaigns")]


def sale(tx, price, buyer="b"):
    return {"purchase": {"transaction": tx, "approved_date": 1735689600000, "price": {"value": price, "currency_code": "BRL"}},
            "buyer": {"ucode": buyer, "name": "n", "email": "e"}, "product": {"id": 1, "name": "p"}}


def user(code, name, doc):
    return {"users": [{"role": "BUYER", "user": {"ucode": code, "name": name, "documents": [{"value": doc}]}}]}


def test_sales_in_two_deliveries(spark, tmp_path, monkeypatch):
    bronze, gold = tmp_path / "bronze", str(tmp_path / "gold")

    def land(feed, day, *records):
        put(str(bronze / feed), f"{feed}_{day}.json", json.dumps({"dados": list(records)}))

    land("sales", "2024-01-01", *[sale(f"t{i}", float(i)) for i in range(30)], sale(None, 1.0), sale(None, 1.0), sale("t1", 99.0))
    land("users", "2024-01-01", user("u1", "old", "d1"), user("u2", "two", "d2"), user("u1", "old again", "d9"))
    first = deliveries.run_sales_a(spark, str(bronze), gold)
    assert set(first) == {"sales", "users"}
    control = deliveries.control_table(spark, gold).read()
    windows = deliveries.windows_to_pull(spark, control, "sales", dt.date(2024, 2, 5)).orderBy("window_no").collect()
    assert [(r["window_start"], r["window_end"]) for r in windows] == [
        (dt.datetime(2024, 1, 2), dt.datetime(2024, 2, 1)), (dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 6)),
    ]
    saved = {f: (bronze / f / f"{f}_2024-01-01.json").read_text() for f in ("sales", "users")}
    for feed in saved:
        put(str(bronze / feed), f"{feed}_2024-01-01.json", "spoiled")
    land("sales", "2024-01-31", sale("t3", 33.0), sale("t77", 7.0), sale(None, 2.0), {"purchase": 5})
    land("users", "2024-01-31", user("u1", "new", None), user("u3", "three", "d3"))
    buckets = {p: f for p, f in deliveries.sales_table(spark, gold).partitions().items()}
    commit = PointedTable._commit

    def stop(self, *args):
        if self.path.endswith("control"):
            raise RuntimeError("stopped")
        commit(self, *args)

    with monkeypatch.context() as m:
        m.setattr(PointedTable, "_commit", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            deliveries.run_sales_a(spark, str(bronze), gold)
    assert [p.rsplit("/", 1)[1] for p in deliveries.run_sales_a(spark, str(bronze), gold)["sales"]] == ["sales_2024-01-31.json"]
    assert deliveries.run_sales_a(spark, str(bronze), gold) == {}
    after = deliveries.sales_table(spark, gold).partitions()
    assert sum(buckets[p] != after[p] for p in buckets) <= 3 < len(buckets)  # three keys were delivered
    for feed, text in saved.items():
        put(str(bronze / feed), f"{feed}_2024-01-01.json", text)
    want = sales_a.build_sales_a(layers.read_sales_a(spark, str(bronze)))
    got = deliveries.read_sales_a(spark, gold)
    for name in want:
        assert rows(got[name].select(*want[name].columns)) == rows(want[name]), name
    assert [(r["feed"], r["reason"]) for r in deliveries.read_rejects(spark, gold, "pull").collect()] == [("sales", "wrong type: purchase")]
    assert rows(deliveries.undated_files(spark, str(bronze), ["sales", "users"])) == []


# --- streaming ------------------------------------------------------------------


def test_streamed_pulls_keep_the_newest_row(spark, tmp_path, monkeypatch):
    """Overlapping pulls in several batches; a batch that stops before its commit, and one that stops after it."""
    schema = as_schema("k string, v string, at int")
    feed, kept = tmp_path / "feed", str(tmp_path / "kept")

    def land(name, *records):
        put(str(feed), name, "\n".join(json.dumps(r) for r in records))

    def run():
        newest = [F.col("at").desc(), F.col("source_file").desc()]
        ingest_last_wins(spark, str(feed), schema, kept, str(tmp_path / "marks"), "k", newest, options={"maxFilesPerTrigger": 1})

    def got():
        return rows(last_wins_table(spark, kept, schema).read().select("k", "v", "at"))

    land("a.json", {"k": "1", "v": "a", "at": 1}, {"k": "2", "v": "a", "at": 5}, {"v": "none", "at": 1}, {"v": "none", "at": 1})
    run()
    land("b.json", {"k": "1", "v": "b", "at": 2}, {"k": "2", "v": "late", "at": 4}, {"k": "3", "v": "b", "at": 1}, {"v": "other", "at": 1})
    commit = PointedTable._commit
    for after in (False, True):
        def stop(self, *args, after=after):
            if after:
                commit(self, *args)
            raise RuntimeError("stopped")

        with monkeypatch.context() as m:
            m.setattr(PointedTable, "_commit", stop)
            with pytest.raises(Exception, match="stopped"):
                run()
    run()
    run()
    assert got() == sorted([("1", "b", 2), ("2", "a", 5), ("3", "b", 1), (None, "none", 1), (None, "none", 1), (None, "other", 1)], key=repr)
