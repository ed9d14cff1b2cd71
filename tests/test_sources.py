import json
import sys
import types
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.sources import csv_daily, grids, products, records
from pelagia.streaming import reports


def test_reports_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿Name;Radio Call Sign (RC);Location date;Latitude;Longitude;Heading;Speed (kt)\nKALI;CB1;d1;1;2;3;4\nPIA;CB2;d2;1;2;3;4\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("Speed;Heading;Longitud;Latitud;Fecha;RC;Nombre;Extra\n40;30;20;10;d3;CB3;ANA;x\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("Name;Latitude\nx;1\n", encoding="utf-8")
    (tmp_path / "d.csv").write_bytes("Name;Señal\nñ;1\n".encode("latin-1"))
    (tmp_path / "e.csv").write_text("Name;Radio Call Sign (RC);Location date;Latitude;Longitude;Heading;Speed (kt)\n", encoding="utf-8")
    got, rejected = csv_daily.read_reports(spark, str(tmp_path / "*.csv"))
    rows = got.orderBy("file", "ord").collect()
    assert [(r.vessel_name, r.radio_call_sign, r.latitude, r.speed_kt) for r in rows] == [("KALI", "CB1", "1", "4"), ("PIA", "CB2", "1", "4"), ("ANA", "CB3", "10", "40")]
    assert {(r.path[-5:], r.reason) for r in rejected.collect()} == {("c.csv", "columns missing"), ("d.csv", "not utf-8")}


def test_tolerant_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes('A;B;C;\n1;"two;3;\n4;5\n6;7;8;9;10\n'.encode("latin-1"))
    got = csv_daily.read_tolerant(spark, str(tmp_path / "x.csv"))
    assert got.columns == ["A", "B", "C"]
    assert [tuple(r) for r in got.orderBy("A").collect()] == [("1", '"two', "3"), ("4", "5", None)]


def test_only_the_first_line_is_the_header(spark, tmp_path):
    (tmp_path / "y.csv").write_bytes("A;B\nA;B\n1;2\n".encode("latin-1"))
    assert sorted(tuple(r) for r in csv_daily.read_tolerant(spark, str(tmp_path / "y.csv")).collect()) == [("1", "2"), ("A", "B")]


def test_latin_tables(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes('A\xc3\x91O,B;C,\n2020,"x,y",\n'.encode("latin-1"))
    assert [(r["AÑO"], r["B;C"]) for r in csv_daily.read_named(spark, str(tmp_path / "w.csv"), ",", "ISO-8859-1").collect()] == [("2020", "x,y")]
    got = csv_daily.read_latin(spark, str(tmp_path / "w.csv"), T.StructType([T.StructField(n, T.StringType()) for n in ("AÃ\x91O", "b", "Unnamed: 2")]))
    assert [(r["AÑO"], r["b"]) for r in got.collect()] == [("2020", "x,y")]


def test_candidate_urls_of_two_eras(spark):
    got = {str(r.day): r.urls for r in csv_daily.candidate_urls(spark.range(1).select(F.explode(F.sequence(F.lit("2022-12-31").cast("date"), F.lit("2023-02-01").cast("date"))).alias("day")), "n/{month}/r_{day}.csv", "o/r-{day}_{second}.csv", "2023/02", "2023-01-01").collect()}
    assert len(got) == 33 and len(got["2022-12-31"]) == 60 and got["2022-12-31"][7] == "o/r-2022-12-31_07.csv"
    assert got["2023-01-01"] == ["n/2023/01/r_20230101.csv", "n/2023/02/r_20230101.csv"] and got["2023-02-01"] == ["n/2023/02/r_20230201.csv"]


def test_directory_and_manifest(spark, tmp_path):
    people = [{"nombres": " A B ", "division": "Investigación", "base": "X"}, {"nombres": "C", "division": "investigacion ", "base": None}, {"nombres": "D", "division": "Otra"}]
    (tmp_path / "d.json").write_text(json.dumps(people), encoding="utf-8")
    read = lambda base: records.read_directory(spark, str(tmp_path / "d.json"), {"division": "INVESTIGACION", "base": base}, ("nombres", "cargo"))
    assert sorted(tuple(r) for r in read("TODAS").collect()) == [("A B", ""), ("C", "")] and [r.nombres for r in read("x").collect()] == ["A B"]
    progress = spark.createDataFrame([("2024-01-01", None), ("2024-01-02", 3)], "day string, n int")
    lines = records.progress_to_json(progress)
    back = records.progress_from_json(lines.union(spark.createDataFrame([("{broken",)], "value string")), "day string, n int")
    assert sorted((r.day, r.n) for r in back.collect()) == [("2024-01-01", None), ("2024-01-02", 3)]


def test_products_replace_whole(spark, tmp_path):
    at = str(tmp_path / "q")
    df = spark.createDataFrame([("10", datetime(2024, 1, 1, 2)), ("9", None), ("x", None)], "k string, t timestamp")
    products.write(df, at, csv=True, order=(products.by_number("k"),))
    assert [tuple(r) for r in spark.read.csv(at, header=True).collect()] == [("9", None), ("10", "2024-01-01 02:00:00"), ("x", None)]
    with pytest.raises(products.EmptyProduct):
        products.write(df.limit(0), at, force=True, csv=True, empty=False)
    assert spark.read.csv(at, header=True).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["q"]
    with pytest.raises(Exception, match="boom"):
        products.write(df.withColumn("bad", F.raise_error(F.lit("boom")).cast("string")), at, force=True, csv=True)
    assert spark.read.csv(at, header=True).count() == 3  # the old product is still whole


def test_netcdf_blocks(monkeypatch):
    """The reader against a stand-in for the library, which is not installed here."""

    class Variable:
        units = "days"

        def __init__(self, v):
            self.v = v

        def __getitem__(self, at):
            return self.v[at]

    class Dataset(dict):
        def __init__(self, path):
            field = np.ma.masked_invalid(np.arange(12.0).reshape(2, 2, 3))
            field[0, 0, 1] = np.ma.masked
            super().__init__(time=Variable(np.array([0, 1])), latitude=Variable(np.array([-2.0, -1.0])), longitude=Variable(np.array([5.0, 6.0, 7.0])), sst=Variable(field))
            self.dimensions = {"time": [0, 1]}

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

    fake = types.SimpleNamespace(Dataset=Dataset, num2date=lambda t, units, only_use_cftime_datetimes: [datetime(2024, 1, 1 + int(x)) for x in t])
    monkeypatch.setitem(sys.modules, "netCDF4", fake)
    reader = grids.NetCdfReader({"path": "x", "variable": "sst"})
    batches = [b for part in reader.partitions() for b in reader.read(part)]
    rows = [r for b in batches for r in b.to_pylist()]
    assert len(rows) == 12 and rows[1]["sst"] is None and rows[5]["sst"] == 5.0 and (rows[5]["latitude"], rows[5]["longitude"], rows[5]["i_lat"]) == (-1.0, 7.0, 1)


def test_headers_are_repaired():
    assert [csv_daily.repair_header(h) for h in ("AÃ\x91O", " X ", "Unnamed: 7")] == ["AÑO", "X", ""]


def test_date_urls(spark):
    assert [r.url for r in csv_daily.date_urls(spark, "2024-02-28", "2024-03-01", "u/{day}").collect()] == ["u/2024-02-28", "u/2024-02-29", "u/2024-03-01"]


def test_grid_filters_reach_the_scan(spark, tmp_path):
    rows = [(datetime(2024, 1, d), i, 0, float(i), 0.0, 1.0, 2.0) for d in (1, 2, 3) for i in range(4)]
    spark.createDataFrame(rows, "time timestamp, i_lat int, i_lon int, latitude double, longitude double, sst double, chl double").write.parquet(str(tmp_path / "g"))
    got = grids.read_grid(spark, str(tmp_path / "g"), ["sst"], "2024-01-02", "2024-01-02", (1.0, 2.0, -1.0, 1.0))
    assert got.count() == 2 and "chl" not in got.columns
    plan = got._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull" in plan and "chl" not in plan.split("ReadSchema")[1]
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert sorted(str(r.v) for r in grids.nan_to_null(nan, ["v"]).collect()) == ["1.0", "None"]


def test_products(spark, tmp_path):
    df, at = spark.range(5).withColumn("x", F.col("id") * 2.0), str(tmp_path / "p")
    assert products.write(df, at) and not products.write(df, at) and products.write(df, at, force=True)
    r = products.report(df, ["x"]).first()
    assert (r.n, r.n_valid, r.low, r.high, r["mean"]) == (5, 5, 0.0, 8.0, 4.0)
    assert products.described(df, {"x": "twice"}).schema["x"].metadata == {"comment": "twice"}


@pytest.fixture
def daily(spark, tmp_path):
    t = lambda d, h: datetime(2024, 1, d, h)
    days = [[("K", "CB1", t(1, 1), 1.0), ("K", "CB1", t(1, 2), 2.0)], [("K", "CB1", t(1, 2), 9.0), ("K", "CB1", t(2, 1), 3.0)]]
    for i, rows in enumerate(days):
        full = [(*r, 0.0, 0.0, 1.0) for r in rows]
        spark.createDataFrame(full, reports.REPORT_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return tmp_path


def test_stream_keep_first(spark, daily):
    stream = reports.report_stream(spark, str(daily / "in"))
    reports.consolidate_to(stream, str(daily / "out"), str(daily / "ck")).awaitTermination(120)
    got = spark.read.parquet(str(daily / "out"))
    assert got.count() == 3 and got.select("location_datetime").distinct().count() == 3


def test_stream_dedup_and_sessions(spark, daily):
    stream = reports.deduplicated(reports.report_stream(spark, str(daily / "in")))
    q = stream.writeStream.format("memory").queryName("dedup").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("dedup").count() == 3
    q = reports.live_sessions(reports.report_stream(spark, str(daily / "in"))).writeStream.format("memory").queryName("live").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("live").columns[:3] == ["radio_call_sign", "start", "end"]


def test_headers_are_checked_by_split(spark, tmp_path):
    """Files of many splits: a bad byte in the last one is found, no file is a value, and a letter at a split's border is no bad byte."""
    line = "ÑANDÚ;" * 20 + "\n"
    (tmp_path / "good é.csv").write_bytes(("\ufeffa;b\r\n" + line * 3_000).encode())
    (tmp_path / "bad.csv").write_bytes(("a;b\n" + line * 3_000).encode() + b"\xff\xfe;1\n")
    (tmp_path / "cut.csv").write_bytes(("a;b\n" + line * 10 + "Ñ").encode()[:-1])  # ends within a letter
    (tmp_path / "latin.csv").write_bytes("a;Ñ\n1;2\n".encode("latin-1"))
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "last.csv").write_bytes("a;Ñ".encode())
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10001")
        found = csv_daily.headers(spark, str(tmp_path / "*.csv"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r.path.rsplit("/", 1)[-1]: r.header for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == {"good é.csv": "a;b", "bad.csv": None, "cut.csv": None, "latin.csv": None, "last.csv": "a;Ñ"}
    assert ("empty.csv", "empty") in {(r.path.rsplit("/", 1)[-1], r.reason) for r in csv_daily.read_reports(spark, str(tmp_path / "*.csv"))[1].collect()}
    assert "content" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" in plan
