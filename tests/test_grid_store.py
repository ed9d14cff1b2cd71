import pytest
from pyspark.sql import functions as F
from test_tiles import LAT, LON, T0, field

from pelagia.config import region
from pelagia.operators import tiles
from pelagia.plans.run_all import Run, axes
from pelagia.sources import grid_store


def _plan(df):
    return df._jdf.queryExecution().toString()


def _rows(df):
    return sorted(df.select("time", "i_lat", "i_lon", "v").collect())


def test_files_merge_by_name_and_days_are_folders(spark, tmp_path):
    days = field(spark, 1, 0.3, days=4).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    at = tmp_path / "sst_files"
    days.where(F.col("time") < F.lit("2023-03-08")).withColumn("v", F.col("v") - 9).write.parquet(str(at / "2022.parquet"))
    days.where(F.col("time") >= F.lit("2023-03-06")).drop("w").write.parquet(str(at / "2023.parquet"))
    files = grid_store.read_files(spark, str(at))
    assert {r.file for r in files.select("file").distinct().collect()} == {"2022.parquet", "2023.parquet"}
    kept = grid_store.store(grid_store.merged(files, LAT, LON), str(tmp_path / "store"))
    first = F.col("time") < F.lit("2023-03-06")
    assert _rows(kept) == _rows(days.withColumn("v", F.when(first, F.col("v") - 9).otherwise(F.col("v"))))
    assert len(list((tmp_path / "store").glob("store_day=*"))) == 4 and kept.where("w IS NOT NULL").select("time").distinct().count() == 1
    again = grid_store.store(days.where("false"), str(tmp_path / "store"))
    assert again.count() == days.count()  # a store that is there is not made again


@pytest.mark.parametrize("wrong", ["latitude", "i_lat", "one file"])
def test_axes_that_differ_end_the_merge(spark, wrong):
    days = field(spark, 1, 0.3).withColumn("file", F.date_format("time", "d"))
    moved = {
        "latitude": days.withColumn("latitude", F.col("latitude") + 0.01),
        "i_lat": days.withColumn("i_lat", F.col("i_lat") + 1),
        "one file": days.withColumn("longitude", F.col("longitude") + F.when(F.col("file") == "5", 0.02).otherwise(0.0)),
    }[wrong]
    with pytest.raises(ValueError, match="axes"):
        grid_store.merged(moved, LAT, LON)
    assert grid_store.merged(days, LAT, LON).count() == days.count()


def test_only_days_of_points_are_read(spark, tmp_path):
    grid = field(spark, 2, 0.5, days=12)
    kept = grid_store.store(grid, str(tmp_path / "store"))
    points = spark.createDataFrame([(k, T0.replace(day=7 + k % 2, hour=k), -28.9 + k / 30, -71.9 + k / 40) for k in range(12)], "id long, ts timestamp, latitude double, longitude double")
    ask = lambda g: tiles.sample(points, g, [tiles.Field("v", "v"), tiles.Field("f", "v", True)], LAT, LON, "id", "ts")
    got = ask(kept)
    assert sorted(got.collect()) == sorted(ask(grid).collect())
    plan = _plan(got)
    assert "dynamicpruning" in plan and plan.split("== Physical Plan ==")[1].count("store_day") > 0
    near = grid_store.on_days(kept, points.withColumnRenamed("ts", "time"))
    assert {r.store_day.day for r in near.select("store_day").distinct().collect()} == {7, 8}
    assert "dynamicpruning" in _plan(near)


def test_days_do_not_hang_on_the_session_time_zone(spark, tmp_path):
    grid = field(spark, 3, 0.0)
    kept = grid_store.store(grid, str(tmp_path / "store"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        assert grid_store.on_days(kept, grid).count() == grid.count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rows_without_time_empty_grids_and_empty_points(spark, tmp_path):
    grid = field(spark, 4, 0.0)
    odd = grid.unionByName(grid.limit(3).withColumn("time", F.lit(None).cast("timestamp")))
    assert grid_store.store(odd, str(tmp_path / "a")).count() == grid.count()
    none = grid_store.store(grid.where("false"), str(tmp_path / "b"))
    assert none.count() == 0
    assert grid_store.on_days(grid_store.store(grid, str(tmp_path / "c")), grid.where("false")).count() == 0
    assert grid_store.on_days(grid, grid.where("false")).count() == grid.count()  # no store: nothing to prune by


def test_run_merges_a_folder_of_files(spark, tmp_path):
    from pelagia.operators.grid import cells

    where = region("caldera")
    day = cells(spark, *axes(where)).withColumns({"time": F.lit("2023-03-05").cast("timestamp"), "CHL": F.lit(1.0)})
    for name, moved in (("2023", 0.0), ("2024", 0.5)):
        day.withColumns({"latitude": F.col("latitude") + moved, "CHL": F.lit(float(name))}).write.parquet(str(tmp_path / f"bad_files/{name}.parquet"))
        day.withColumn("CHL", F.lit(float(name))).write.parquet(str(tmp_path / f"chl_files/{name}.parquet"))
    work = Run(spark, str(tmp_path), str(tmp_path / "out"), where)
    assert work.grid("chl") is work.grid("chl") and [r.CHL for r in work.grid("chl").select("CHL").distinct().collect()] == [2024.0]
    with pytest.raises(ValueError, match="different axes"):
        work.grid("bad")
