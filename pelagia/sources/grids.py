"""Gridded fields: long Parquet as the working form, NetCDF files where a reader is installed."""

from __future__ import annotations

import importlib.util
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def read_grid(spark: SparkSession, path: str, variables: list[str], start: str | None = None, end: str | None = None, bbox: tuple[float, float, float, float] | None = None, max_depth: float | None = None) -> DataFrame:
    """A product's rows in a range of days, box and depths; all four reach the Parquet scan as filters and columns."""
    grid = spark.read.parquet(path)
    if start:
        grid = grid.where(F.col("time") >= F.lit(start).cast("timestamp"))
    if end:
        grid = grid.where(F.col("time") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    if bbox:
        grid = grid.where(F.col("latitude").between(bbox[0], bbox[1]) & F.col("longitude").between(bbox[2], bbox[3]))
    keys = [c for c in ("time", "depth", "i_lat", "i_lon", "latitude", "longitude") if c in grid.columns]
    if max_depth is not None and "depth" in grid.columns:
        grid = grid.where(F.col("depth") <= max_depth)
    return grid.select(*keys, *variables)


def nan_to_null(grid: DataFrame, variables: list[str]) -> DataFrame:
    return grid.withColumns({v: F.when(~F.isnan(v), F.col(v)) for v in variables})


class Block(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class NetCdfSource(DataSource):
    """format("netcdf"): options path, variable; one partition for each block of 60 times. Needs netCDF4 on the executors."""

    @classmethod
    def name(cls) -> str:
        return "netcdf"

    def schema(self) -> str:
        return f"time timestamp, i_lat int, i_lon int, latitude double, longitude double, {self.options['variable']} double"

    def reader(self, schema) -> DataSourceReader:
        return NetCdfReader(self.options)


class NetCdfReader(DataSourceReader):
    BLOCK = 60

    def __init__(self, options):
        self.path, self.variable = options["path"], options["variable"]

    def partitions(self):
        from netCDF4 import Dataset

        with Dataset(self.path) as f:
            n = len(f.dimensions["time"])
        return [Block(self.path, i, min(i + self.BLOCK, n)) for i in range(0, n, self.BLOCK)]

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        """A batch for each time, its cells as columns."""
        from netCDF4 import Dataset, num2date

        with Dataset(partition.path) as f:
            times = num2date(f["time"][partition.first : partition.last], f["time"].units, only_use_cftime_datetimes=False)
            lat, lon = np.asarray(f["latitude"][:], float), np.asarray(f["longitude"][:], float)
            i, j = (x.ravel() for x in np.indices((len(lat), len(lon)), dtype=np.int32))
            for t, field in zip(times, f[self.variable][partition.first : partition.last]):
                value = np.asarray(field.filled(np.nan), float).ravel()
                time = pa.array(np.full(len(i), np.datetime64(t, "us")), pa.timestamp("us", "UTC"))
                columns = [time, pa.array(i), pa.array(j), pa.array(lat[i]), pa.array(lon[j]), pa.array(value, mask=np.isnan(value))]
                yield pa.record_batch(columns, names=["time", "i_lat", "i_lon", "latitude", "longitude", self.variable])


def register_netcdf(spark: SparkSession) -> bool:
    """Whether NetCDF files can be read here; the format is registered if so."""
    if importlib.util.find_spec("netCDF4") is None:
        return False
    spark.dataSource.register(NetCdfSource)
    return True
