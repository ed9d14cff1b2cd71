import pytest
from pyspark.sql import functions as F

from pelagia.config import region
from pelagia.plans.catch import clean_wide
from pelagia.sources.ledger import Ledger, Unbalanced, plain

def _rules():
    return {"no value": F.col("v").isNotNull(), "odd": F.col("v") % 2 == 0}


def _rows(spark):
    return spark.range(100).select("id", F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"))


def _told(ledger, product, rows):
    return {(step, what): n for _, _, step, what, n in ledger.settle(product, rows)}


def test_counts_come_with_the_write_and_equal_the_plain_filter(spark, tmp_path):
    ledger, path = Ledger(), str(tmp_path / "p")
    kept = ledger.sift("large", ledger.sift("even", _rows(spark), _rules()), {"small": F.col("v") >= 50})
    kept.write.parquet(path)
    assert {r.id for r in spark.read.parquet(path).collect()} == {r.id for r in plain("x", plain("x", _rows(spark), _rules()), {"small": F.col("v") >= 50}).collect()}
    told = _told(ledger, "p", 20)
    assert told == {("even", "in"): 100, ("even", "no value"): 10, ("even", "odd"): 50, ("even", "out"): 40, ("large", "in"): 40, ("large", "small"): 20, ("large", "out"): 20}


def test_a_plan_worked_out_twice_is_counted_again(spark, tmp_path):
    ledger = Ledger()
    ledger.sift("even", _rows(spark).repartition(4), _rules()).orderBy("v").write.parquet(str(tmp_path / "p"))
    assert _told(ledger, "p", 40)["even", "in"] == 100
    both = Ledger()
    kept = both.sift("even", _rows(spark), _rules())
    kept.select("id").union(kept.select("id")).distinct().write.parquet(str(tmp_path / "q"))
    assert _told(both, "q", 40)["even", "out"] == 40


def test_a_step_never_run_is_counted(spark, monkeypatch):
    monkeypatch.setattr("pelagia.sources.ledger.ARRIVAL", 0.2)
    ledger = Ledger()
    ledger.sift("even", _rows(spark), _rules())
    assert _told(ledger, "p", 40)["even", "odd"] == 50


def test_rows_lost_or_doubled_end_the_run(spark, tmp_path):
    ledger = Ledger()
    ledger.sift("even", _rows(spark), _rules()).where("id > 2").write.parquet(str(tmp_path / "p"))
    with pytest.raises(Unbalanced, match="39 rows"):
        ledger.settle("p", 39)
    doubled = Ledger()
    first = doubled.sift("even", _rows(spark), _rules())
    doubled.sift("all", first.union(first), {"small": F.col("v") >= 0}).write.parquet(str(tmp_path / "q"))
    with pytest.raises(Unbalanced):
        doubled.settle("q", 80)
    grouped = Ledger()
    first = grouped.sift("even", _rows(spark), _rules()).groupBy((F.col("v") % 4).alias("v")).count()
    grouped.sift("all", first, {"small": F.col("v") >= 0}, fresh=True).write.parquet(str(tmp_path / "r"))
    assert _told(grouped, "r", 2)["all", "in"] == 2


def test_empty_tables_and_a_column_named_like_a_count(spark, tmp_path):
    ledger = Ledger()
    ledger.sift("even", _rows(spark).where("id < 0").withColumn("came", F.lit(1)), _rules()).write.parquet(str(tmp_path / "p"))
    assert set(_told(ledger, "p", 0).values()) == {0}


def test_logbook_rows_that_are_no_numbers_are_dropped_by_cause(spark, tmp_path):
    good = ("2023", "3", "69", "3/6/2023 6:00", "270400", "704909", "12.5")
    bad = [(*good[:4], "sin dato", *good[5:]), (good[0], "III", *good[2:]), (*good[:3], "ayer", *good[4:]), (good[0], None, *good[2:])]
    raw = spark.createDataFrame([good, *bad], "`AÑO` string, REGION string, COD_BARCO string, FECHA_HORA_RECALADA string, LATITUD string, LONGITUD string, JUREL string")
    ledger = Ledger()
    clean_wide(raw, region("caldera").points, ledger.sift).write.parquet(str(tmp_path / "p"))
    told = _told(ledger, "p", 1)
    assert [told["logbook rows", c] for c in ("in", "without a region", "landing time unreadable", "year or region unreadable", "place unreadable", "out")] == [5, 1, 1, 1, 1, 1]
