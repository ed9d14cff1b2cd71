"""A stream over a folder of dates: gaps, late files, a manifest, restarts."""

import io
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pelagia.streaming import daily

D0 = date(2024, 1, 1)


def day(k):
    return D0 + timedelta(days=k)


def put(at, k, n=3):
    at.mkdir(exist_ok=True)
    (at / f"flota_{day(k)}.csv").write_bytes("".join(f"{k};{i};ñ\r\n" for i in range(n)).encode() + b"last")


def run(spark, at, fail=None, **options):
    spark.dataSource.register(daily.DailySource)
    stream = spark.readStream.format("daily").options(path=str(at / "in"), start=str(D0), pattern="flota_{day}.csv", manifest=str(at / "missing.jsonl"), **options).load()

    def save(batch, number):
        if fail and batch.where(F.col("day") == F.lit(str(fail))).count():
            raise RuntimeError("killed")
        batch.write.mode("overwrite").parquet(str(at / f"out/batch={number}"))

    q = stream.writeStream.foreachBatch(save).option("checkpointLocation", str(at / "ck")).trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def got(spark, at):
    rows = spark.read.parquet(str(at / "out")).collect()
    assert len(rows) == len({(r.day, r.line_no) for r in rows})  # each line once
    return sorted({r.day for r in rows}), rows


def test_frontier_gaps_manifest_and_restarts(spark, tmp_path):
    for k in (0, 1, 3, 4):
        put(tmp_path / "in", k)
    (tmp_path / "in/other.txt").write_text("x")
    run(spark, tmp_path)
    days, rows = got(spark, tmp_path)
    assert days == [day(0), day(1)] and len(rows) == 8 and {r.line for r in rows if r.line_no == 3} == {"last"} and "0;0;ñ" in {r.line for r in rows}
    put(tmp_path / "in", 2)  # it comes late, and is read in its turn
    with pytest.raises(Exception, match="killed"):
        run(spark, tmp_path, fail=day(3))
    run(spark, tmp_path)
    assert got(spark, tmp_path)[0] == [day(k) for k in range(5)]
    put(tmp_path / "in", 7)
    run(spark, tmp_path)
    assert got(spark, tmp_path)[0][-1] == day(4)
    assert daily.missing_days([day(5), day(6)], str(tmp_path / "missing.jsonl"), "404") == 2 and daily.missing_days([day(6)], str(tmp_path / "missing.jsonl"), "404") == 0
    run(spark, tmp_path)
    assert got(spark, tmp_path)[0] == [day(k) for k in (0, 1, 2, 3, 4, 7)]


def test_budget_and_lines(tmp_path, monkeypatch):
    put(tmp_path / "in", 0)
    reader = daily.DailyReader({"path": str(tmp_path / "in"), "start": str(D0), "pattern": "flota_{day}.csv", "seconds": "0"})
    assert reader.latestOffset() == {"day": str(D0)}
    put(tmp_path / "in", 1)
    assert reader.latestOffset() == {"day": str(D0)}  # its time is over
    assert daily.frontier(D0, set(), set()) == D0 - timedelta(days=1)
    monkeypatch.setattr(daily, "CHUNK", 3)
    assert [x for part in daily.lines(io.BytesIO("ab\n\ncdeñ\r\nz".encode())) for x in part] == ["ab", "", "cdeñ", "z"]
    assert list(daily.lines(io.BytesIO(b""))) == []
