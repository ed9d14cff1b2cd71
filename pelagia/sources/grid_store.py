"""Grids kept by day: files of one product merged once, so that who asks for a few days reads those days alone.

A store is Parquet in a folder for each UTC day (store_day), each day's cells in order of place, so a box is pruned by row group too. Days of points come to the scan at run time (dynamic
partition pruning): the days a query names are at most those of the store, a row a day, which bounds their broadcast without counting anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.operators.grid import Axis, check_axes, union_keep_last
from pelagia.shared import file_system
from pelagia.sources.products import exists, write

DAY = "store_day"
#: Rows of cells in a band, the unit of a writing task within a day.
BAND = 256
#: Degrees that a file's axes may lie beside the target's.
SLACK = 1e-6


def day_of(time: Column) -> Column:
    """The UTC day of a time, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(time.cast("timestamp")) / 86_400_000_000).cast("int"))


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """The Parquet files (or datasets) directly below a folder, with the name of each as file; columns that one lacks are null there."""
    inside = F.regexp_extract(F.col("_metadata.file_path"), f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/([^/]+)", 1)
    return spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(folder).select("*", inside.alias("file"))


def check_places(grid: DataFrame, lat: Axis, lon: Axis) -> None:
    """Raises unless every cell lies where its numbers say on the axes."""
    inside = F.col("i_lat").between(0, lat.n - 1) & F.col("i_lon").between(0, lon.n - 1)
    beside = F.greatest(F.abs(F.col("latitude") - lat.value(F.col("i_lat"))), F.abs(F.col("longitude") - lon.value(F.col("i_lon"))))
    n = grid.agg(F.count_if(~F.coalesce(inside & (beside <= SLACK), F.lit(False)))).first()[0]
    if n:
        raise ValueError(f"{n} cells do not lie on the axes")


def merged(files: DataFrame, lat: Axis, lon: Axis, file: str = "file") -> DataFrame:
    """Overlapping files as one grid: all have the same axes, the target's, or ValueError is raised; a time comes whole from the last file by name that has it."""
    check_axes(files, file)
    check_places(files, lat, lon)
    return union_keep_last(files, file).drop(file)


def by_day(grid: DataFrame) -> DataFrame:
    """A grid's rows as a store holds them. Rows without a time are on no day and belong to no point: they are left out."""
    rows = grid.where(F.col("time").isNotNull()).withColumn(DAY, day_of(F.col("time")))
    return rows.repartition(DAY, F.floor(F.col("i_lat") / BAND)).sortWithinPartitions(DAY, "time", "i_lat", "i_lon")


def store(grid: DataFrame, path: str, force: bool = False, empty: bool = True) -> DataFrame:
    """Writes a grid as a store unless it is there, and reads it."""
    spark, rows = grid.sparkSession, by_day(grid)
    if force or not exists(spark, path):
        write(rows, path, force, partition_by=(DAY,), empty=empty)
    fs, days = file_system(spark, f"{path}/{DAY}=*")
    return spark.read.parquet(path) if fs.globStatus(days) else spark.createDataFrame([], rows.schema)  # without any day there is no file to tell the columns


def on_days(grid: DataFrame, times: DataFrame, time: str = "time") -> DataFrame:
    """A store's rows of the days that times (any table with such a column) name; a grid that is no store stays whole."""
    if DAY not in grid.columns:
        return grid
    # the comparison is always true of a day; pruning at run time wants a filter on that side
    days = times.select(day_of(F.col(time)).alias(DAY)).where(F.col(DAY) > F.lit("0001-01-01").cast("date")).distinct()
    return grid.join(F.broadcast(days), DAY, "left_semi")
