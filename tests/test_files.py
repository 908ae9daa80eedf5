"""Readers, writers and ingestion on hand-made files."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException

from martkit.session import cluster_settings
from martkit.sources import readers, writers
from martkit.streaming.ingest import ingest_new_files
from martkit.workspace import new_folder, shared_dir
from tests.helpers import frame, rows

REC = "id bigint, name string"


def put(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(text.encode(encoding))


def test_json_records(spark, tmp_path):
    d = str(tmp_path / "j")
    put(d, "a.json", '[{"id": 1, "name": "x"},\n {"id": 2}]')
    put(d, "b.json", '{"id": 3, "name": "y", "extra": true}')
    put(d, "c.json", "[]")
    put(d, "d.json", '[{"id": 4, "na')
    assert rows(readers.read_json_records(spark, d, REC)) == [(1, "x"), (2, None), (3, "y")]
    bad = readers.read_json_rejects(spark, d, REC).collect()
    assert [os.path.basename(r["source_file"]) for r in bad] == ["d.json"]


def test_json_lines(spark, tmp_path):
    d = str(tmp_path / "l")
    put(d, "a.json", '{"id": 1}\n{"id": 2, "name": "b"}\n{"id": 3, "na\n')
    assert rows(readers.read_json_records(spark, d, REC, lines=True)) == [(1, None), (2, "b")]


def test_json_text_field_takes_text_and_object(spark, tmp_path):
    d = str(tmp_path / "j")
    put(d, "a.json", '{"id": 1, "name": "plain"}')
    put(d, "b.json", '{"id": 2, "name": {"k": 1}}')
    assert rows(readers.read_json_records(spark, d, REC)) == [(1, "plain"), (2, '{"k": 1}')]


def test_json_envelope(spark, tmp_path):
    d = str(tmp_path / "e")
    put(d, "a.json", '{"filtros": {}, "dados": [{"id": 1}, {"id": 2, "name": "b"}]}')
    put(d, "b.json", '{"filtros": {}}')
    assert rows(readers.read_json_envelope(spark, d, REC)) == [(0, 1, None), (1, 2, "b")]
    put(d, "c.json", '{"dados": "none"}')
    with pytest.raises(PySparkException, match="not a list"):
        readers.read_json_envelope(spark, d, REC).collect()


def test_csv_classes(spark, tmp_path):
    d = str(tmp_path / "c")
    put(d, "comma.csv", "a,b\n1,x\n2,\"y, z\"\n")
    put(d, "bom.csv", "﻿a,b\n3,q\n")
    put(d, "semi.csv", "b;a\nSão;4\n", "latin-1")
    put(d, "older.csv", "a\n5\n")
    put(d, "header.csv", "a,b\n\n")
    put(d, "empty.csv", "")
    put(d, "lines.csv", 'a,b\n6,"two\nlines ""quoted"""\n')
    put(d, "nulls.csv", "a,b\n7,NULL\n8,None\n9,\n")
    df = readers.read_csv_text(
        spark, d, null_tokens=("", "null", "NULL", "None", "NaN"), columns=["a", "b", "c"]
    )
    assert rows(df) == sorted(
        [("1", "x", None), ("2", "y, z", None), ("3", "q", None), ("4", "São", None), ("5", None, None),
         ("6", 'two\nlines "quoted"', None), ("7", None, None), ("8", None, None), ("9", None, None)],
        key=repr,
    )


def test_csv_nothing_to_read(spark, tmp_path):
    d = str(tmp_path / "c")
    put(d, "header.csv", "a,b\n")
    assert readers.read_csv_text(spark, d, columns=["a"]).count() == 0


def test_csv_with_byte_order_mark_is_written(spark, tmp_path):
    d = str(tmp_path / "w")
    writers.write_csv(frame(spark, "a string, b string", ("1", 'q"r')).coalesce(1), d, bom=True)
    part = next(p for p in os.listdir(d) if p.startswith("part-"))
    with open(os.path.join(d, part), "rb") as f:
        assert f.read(3) == b"\xef\xbb\xbf"
    assert rows(readers.read_csv_text(spark, d + "/*.csv")) == [("1", 'q"r')]


def test_parquet_feed(spark, tmp_path):
    d = str(tmp_path / "p")
    frame(spark, "a int, b string", (1, "x")).coalesce(1).write.parquet(d)
    frame(spark, "a long, b string, c int", (2, "y", 1)).coalesce(1).write.mode("append").parquet(d)
    frame(spark, "a int", (3,)).coalesce(1).write.mode("append").parquet(d)
    frame(spark, "a int, b string", (4, "n")).write.parquet(d + "/nested")
    put(d, "tiny.parquet", "PAR1")
    put(d, "broken.parquet", "no parquet at all " * 20)
    put(d, "notes.txt", "x" * 200)
    assert rows(readers.read_parquet_feed(spark, d, ["a", "b"])) == [(1, "x"), (2, "y")]
    assert rows(readers.read_parquet_feed(spark, d).select("a")) == [(1,), (2,), (3,)]
    with pytest.raises(ValueError):
        readers.read_parquet_feed(spark, d, ["zz"])


def test_single_file_guard(spark, tmp_path):
    d = str(tmp_path / "s")
    put(d, "a.csv", "a\n1\n")
    readers.require_single_file(spark, d + "/*.csv")
    put(d, "b.csv", "a\n1\n")
    with pytest.raises(ValueError):
        readers.require_single_file(spark, d + "/*.csv")


def test_versions(spark, tmp_path):
    d = str(tmp_path / "v")
    for n, version in ((1, "20250101_000000"), (2, "20250102_101112"), (3, "20250102_101112")):
        writers.write_version(frame(spark, "n int", (n,)), d, version)
    got = readers.stack_snapshots(spark, d)
    assert rows(got) == [(1, dt.datetime(2025, 1, 1)), (3, dt.datetime(2025, 1, 2, 10, 11, 12))]


def test_rewrite_leaves_other_columns_and_versions(spark, tmp_path):
    d = str(tmp_path / "v")
    writers.write_version(frame(spark, "n int", (1,), (2,)), d, "20250101_000000")
    writers.write_version(frame(spark, "n int", (3,)), d, "20250102_000000")
    writers.rewrite_versions(spark, d, lambda df: df.withColumn("n", df["n"] * 10))
    assert rows(spark.read.parquet(d).select("n", "load_ts")) == [
        (10, "20250101_000000"), (20, "20250101_000000"), (30, "20250102_000000"),
    ]


def test_backup(spark, tmp_path):
    d, b = str(tmp_path / "t"), str(tmp_path / "b")
    writers.write_table(frame(spark, "n int", (1,), (2,)), d)
    writers.backup_table(spark, d, b)
    assert rows(spark.read.parquet(b)) == [(1,), (2,)]


def test_ingest_each_file_once(spark, tmp_path):
    base = str(tmp_path)
    landing, target, marks, archive = (f"{base}/{n}" for n in ("in", "out", "marks", "archive"))
    schema = readers.as_schema("id bigint")

    def run():
        ingest_new_files(
            spark, landing, schema, target, marks, archive=archive, options={"multiLine": True},
            transform=lambda df: df.withColumn("twice", df["id"] * 2),
        )
        return rows(spark.read.parquet(target))

    for i in (1, 2, 3):
        put(landing, f"{i}.json", f'[{{"id": {i}}}]')
    assert run() == [(1, 2), (2, 4), (3, 6)]
    assert run() == [(1, 2), (2, 4), (3, 6)]
    put(landing, "4.json", '{"id": 4}')
    assert run() == [(1, 2), (2, 4), (3, 6), (4, 8)]
    put(landing, "5.json", '{"id": 5}')
    run()
    archived = [f for _, _, files in os.walk(archive) for f in files]
    assert {"1.json", "2.json", "3.json"} <= set(archived)


def test_cluster_settings_size_tasks():
    small, large = cluster_settings(1 << 30), cluster_settings(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert large["spark.sql.shuffle.partitions"] == "200000"
    assert cluster_settings(1 << 40)["spark.sql.shuffle.partitions"] == "4096"


def test_shared_folder_is_the_configured_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_records_are_judged_one_by_one(spark, tmp_path):
    d = str(tmp_path / "j")
    put(d, "a.json", '[{"id": 1, "name": "x"}, {"id": "x"}, {"id": 3.5}, {"id": ""}, {"id": "7"}]')
    assert rows(readers.read_json_records(spark, d, REC)) == sorted([(1, "x"), (None, None), (7, None)], key=repr)
    bad = readers.read_json_rejects(spark, d, REC).collect()
    assert [r["reason"] for r in bad] == ["wrong type: id"] * 2
    nested = "id long, parts array<struct<n:long>>"
    put(str(tmp_path / "n"), "a.json", '[{"id": 1, "parts": [{"n": 1}]}, {"id": 2, "parts": [{"n": "x"}]}, {"id": 3}]')
    got = readers.read_json_records(spark, str(tmp_path / "n"), nested).select("id")
    assert rows(got) == [(1,), (3,)]


def test_damage_behind_a_good_footer_stops_the_job(spark, tmp_path):
    path = tmp_path / "feed"
    spark.range(200_000).coalesce(1).write.parquet(str(path))
    [part] = path.glob("*.parquet")
    data = bytearray(part.read_bytes())
    data[1000:60_000] = bytes(59_000)
    part.write_bytes(data)
    for crc in path.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        readers.read_parquet_feed(spark, str(path)).selectExpr("sum(id)").collect()


def test_intermediates_are_dropped(spark, tmp_path):
    import os

    from martkit import workspace

    with workspace.intermediates(spark):
        assert workspace.written(spark.range(3)).count() == 3
        assert os.path.isdir(workspace.run_dir(spark).removeprefix("file:"))
    assert not os.path.isdir(workspace.run_dir(spark).removeprefix("file:"))
