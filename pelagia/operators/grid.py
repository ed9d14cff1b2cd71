"""Gridded fields as long tables: one row a cell and time, with integer cell numbers.

Grids are dense: a cell without a value is a row with null. Joins are on the integer numbers, never on doubles.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pelagia.functions.geo import KM_PER_DEG, haversine_km

RADIUS_KM = 25.0


@dataclass(frozen=True)
class Axis:
    """A regular axis: value(i) = start + i * step for i from 0 to n - 1."""

    start: float
    step: float
    n: int

    @staticmethod
    def covering(low: float, high: float, step: float) -> Axis:
        return Axis(low, step, math.ceil((high + step / 2 - low) / step))

    def value(self, i: Column) -> Column:
        return F.lit(self.start) + i * self.step

    def nearest(self, x: Column) -> Column:
        """The nearest place, the larger on a tie; beyond the ends the end."""
        return F.least(F.greatest(F.floor((x - self.start) / self.step + 0.5), F.lit(0)), F.lit(self.n - 1)).cast("int")

    def bracket(self, target: Axis) -> list[tuple[int, int, int, float]]:
        """(target place, lower place, upper place, weight of the upper) for targets inside this axis."""
        out = []
        for t in range(target.n):
            f = (target.start + t * target.step - self.start) / self.step
            if abs(f - round(f)) < 1e-9:
                f = float(round(f))
            if 0 <= f <= self.n - 1:
                low = min(int(f), self.n - 1)
                out.append((t, low, min(low + 1, self.n - 1), f - low))
        return out


def cells(spark: SparkSession, lat: Axis, lon: Axis) -> DataFrame:
    """i_lat, i_lon, latitude, longitude of every cell, made where it is used."""
    k = spark.range(lat.n * lon.n)
    i, j = F.floor(F.col("id") / lon.n).cast("int"), (F.col("id") % lon.n).cast("int")
    return k.select(i.alias("i_lat"), j.alias("i_lon"), lat.value(i).alias("latitude"), lon.value(j).alias("longitude"))


def union_keep_last(grid: DataFrame, file: str = "file") -> DataFrame:
    """Overlapping files of one product: a time comes whole from the last file that has it."""
    last = grid.groupBy("time").agg(F.max(file).alias("__last"))
    return grid.join(last, "time").where(F.col(file) == F.col("__last")).drop("__last")


def check_axes(grid: DataFrame, file: str = "file") -> None:
    """Raises if files differ in their latitudes or longitudes."""
    each = grid.groupBy(file).agg(*(F.hash(F.array_sort(F.collect_set(c))).alias(c) for c in ("latitude", "longitude")))
    if each.agg(F.max(F.struct("latitude", "longitude")) != F.min(F.struct("latitude", "longitude"))).first()[0]:
        raise ValueError("files of one product have different axes")


def depth_min(profile: DataFrame, value: str, keys: list[str]) -> DataFrame:
    return profile.groupBy(*keys).agg(F.min(value).alias(value))


def depth_nearest(profile: DataFrame, value: str, depth: float, keys: list[str]) -> DataFrame:
    """The value at the level nearest to a depth, the deeper one on a tie."""
    return profile.groupBy(*keys).agg(F.min_by(value, F.struct(F.abs(F.col("depth") - depth), -F.col("depth"))).alias(value))


def gradient(grid: DataFrame, value: str, lat: Axis, lon: Axis, name: str = "gradient", by: str = "time") -> DataFrame:
    """Adds the size of the horizontal gradient per km: central differences, one-sided at the edges.

    The centre cell does not enter its own central difference, so a cell without a value can have a gradient.
    """

    def along(line: str, across: str, n: int) -> Column:
        w = Window.partitionBy(by, across).orderBy(line)
        before, after = F.lag(F.struct(F.col(value).alias("v"))).over(w), F.lead(F.struct(F.col(value).alias("v"))).over(w)
        inner = (after["v"] - before["v"]) / 2
        return F.when(before.isNull(), after["v"] - F.col(value)).when(after.isNull(), F.col(value) - before["v"]).otherwise(inner)

    dy = along("i_lat", "i_lon", lat.n) / (KM_PER_DEG * lat.step)
    dx = along("i_lon", "i_lat", lon.n) / (KM_PER_DEG * lon.step * F.cos(F.radians("latitude")))
    return grid.withColumn("__dy", dy).withColumn("__dx", dx).withColumn(name, F.sqrt(F.col("__dy") ** 2 + F.col("__dx") ** 2)).drop("__dy", "__dx")


def regrid(grid: DataFrame, value: str, source: tuple[Axis, Axis], target: tuple[Axis, Axis], by: str = "time") -> DataFrame:
    """Bilinear values on the target axes; outside the source, or with a weighing corner missing, null.

    A corner of weight zero plays no part. Brackets are a few rows an axis, known in advance.
    """
    spark = grid.sparkSession
    sides = []
    for axis, (src, dst) in enumerate(zip(source, target)):
        rows = [(t, s, w) for t, a, b, w2 in src.bracket(dst) for s, w in ((a, 1 - w2), (b, w2)) if w > 0]
        names = ("t_lat", "i_lat", "w_lat") if axis == 0 else ("t_lon", "i_lon", "w_lon")
        sides.append(F.broadcast(spark.createDataFrame(rows, f"{names[0]} int, {names[1]} int, {names[2]} double")))
    corners = grid.join(sides[0], "i_lat").join(sides[1], "i_lon")
    total = F.sum(F.col(value) * F.col("w_lat") * F.col("w_lon"))
    whole = F.count("*") == F.count(value)
    out = corners.groupBy(by, "t_lat", "t_lon").agg(F.when(whole, total).alias(value))
    out = out.select(by, F.col("t_lat").alias("i_lat"), F.col("t_lon").alias("i_lon"), value)
    return out.withColumns({"latitude": target[0].value(F.col("i_lat")), "longitude": target[1].value(F.col("i_lon"))})


def offsets(lat: Axis, lon: Axis, radius: float = RADIUS_KM) -> list[tuple[int, int]]:
    """Cell steps that can lie within a radius of a point nearest to a cell, at any latitude of the grid."""
    far = max(abs(lat.start), abs(lat.start + lat.step * (lat.n - 1)))
    up = math.floor(radius / (KM_PER_DEG * lat.step) + 0.5)
    side = math.floor(radius / (KM_PER_DEG * lon.step * math.cos(math.radians(far))) + 0.5)
    return [(i, j) for i in range(-up, up + 1) for j in range(-side, side + 1)]


def _around(points: DataFrame, lat: Axis, lon: Axis, radius: float) -> DataFrame:
    steps = F.array(*(F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i, j in offsets(lat, lon, radius)))
    near = points.withColumn("__s", F.explode(steps))
    return near.withColumns({"__i": F.col("i_lat") + F.col("__s.di"), "__j": F.col("i_lon") + F.col("__s.dj")}).drop("__s")


def nearest_valid(points: DataFrame, grid: DataFrame, value: str, lat: Axis, lon: Axis, key: str, by: str = "time", radius: float = RADIUS_KM) -> DataFrame:
    """key, value, dist of the nearest cell with a value within the radius, first by latitude and longitude on a tie.

    Wants points with key, by, latitude, longitude, i_lat and i_lon. Cells in reach are named and joined by
    equality; no point meets the whole grid.
    """
    valid = grid.where(F.col(value).isNotNull()).select(F.col(by).alias("__by"), F.col("i_lat").alias("__ci"), F.col("i_lon").alias("__cj"), F.col(value).alias("__v"))
    met = _around(points, lat, lon, radius).join(valid, (F.col(by) == F.col("__by")) & (F.col("__i") == F.col("__ci")) & (F.col("__j") == F.col("__cj")))
    dist = haversine_km(F.col("latitude"), F.col("longitude"), lat.value(F.col("__ci")), lon.value(F.col("__cj")))
    best = F.min(F.struct(F.col("__d").alias("dist"), F.col("__ci"), F.col("__cj"), F.col("__v").alias("v"))).alias("b")
    found = met.withColumn("__d", dist).where(F.col("__d") <= radius).groupBy(key).agg(best)
    return found.select(key, F.col("b.v").alias(value), F.col("b.dist").alias("dist"))


def nearest_day(points: DataFrame, grid: DataFrame, ts: str, tolerance_hours: float = 48.0) -> DataFrame:
    """Adds time (the grid's nearest time, the later on a tie) and in_range; times are few and are looked up as an array."""
    days = grid.select("time").distinct().agg(F.array_sort(F.collect_set("time")).alias("__days"))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    gap = lambda d: F.abs(micros(d) - micros(F.col(ts)))
    pick = F.array_min(F.transform("__days", lambda d: F.struct(gap(d).alias("gap"), (-micros(d)).alias("m"), d.alias("d"))))
    out = points.join(F.broadcast(days)).withColumn("__p", F.when(F.col(ts).isNotNull(), pick))
    return out.withColumns({"time": F.col("__p.d"), "in_range": F.col("__p.gap") <= tolerance_hours * 3_600_000_000}).drop("__p", "__days")


def needed_times(points: DataFrame, grid: DataFrame, at_most: int = 10_000) -> DataFrame:
    """The grid's rows of the times that points have; the times are broadcast only if counted to be few."""
    times = points.select("time").where(F.col("time").isNotNull()).distinct()
    return grid.join(F.broadcast(times) if times.count() <= at_most else times, "time", "left_semi")


#: Fixed value: the status of a point that no grid time is near to.
OUT_OF_RANGE = "fuera_de_rango"


def sample(points: DataFrame, grid: DataFrame, values: str | list[str], lat: Axis, lon: Axis, key: str, ts: str) -> DataFrame:
    """key, time and, for each value, the value, dist and status of a field at points and times (latitude, longitude, ts).

    The long form, a join for every value: operators.tiles.sample gives the same from one read of the grid and is what plans use.
    With several values their columns are dist_<value> and status_<value>. The grid is read for the needed times alone;
    only points whose cell lacks a value look around.

    ok: the nearest cell has a value. fallback: it has none; the nearest one within the radius stands in, if any.
    fuera_de_rango: no grid time within two days; time is given all the same, the value is not.
    """
    names = [values] if isinstance(values, str) else list(values)
    located = nearest_day(points.select(key, ts, "latitude", "longitude"), grid, ts)
    located = located.withColumns({"i_lat": lat.nearest(F.col("latitude")), "i_lon": lon.nearest(F.col("longitude"))})
    field = needed_times(located, grid.select("time", "i_lat", "i_lon", *names))
    own = field.select("time", "i_lat", "i_lon", *(F.col(v).alias(f"__v_{v}") for v in names))
    out = located.join(own, ["time", "i_lat", "i_lon"], "left")
    here = haversine_km(F.col("latitude"), F.col("longitude"), lat.value(F.col("i_lat")), lon.value(F.col("i_lon")))
    inside = F.coalesce("in_range", F.lit(False))
    columns = []
    for v in names:
        open_ = out.where(inside & F.col(f"__v_{v}").isNull()).select(key, "time", "latitude", "longitude", "i_lat", "i_lon")
        near = nearest_valid(open_, field, v, lat, lon, key).select(F.col(key).alias("__k"), F.col(v).alias(f"__f_{v}"), F.col("dist").alias(f"__d_{v}"))
        out = out.join(near, out[key] == F.col("__k"), "left").drop("__k")
        has = inside & F.col(f"__v_{v}").isNotNull()
        suffix = "" if isinstance(values, str) else f"_{v}"
        columns += [
            F.when(has, F.col(f"__v_{v}")).when(inside, F.col(f"__f_{v}")).alias(v),
            F.when(has, here).when(inside, F.col(f"__d_{v}")).alias(f"dist{suffix}"),
            F.when(has, "ok").when(inside, "fallback").otherwise(OUT_OF_RANGE).alias(f"status{suffix}"),
        ]
    return out.select(key, "time", *columns)


def coastal_fill(grid: DataFrame, values: list[str], lat: Axis, lon: Axis, by: str = "time", radius: float = RADIUS_KM) -> DataFrame:
    """Missing values take the nearest original value within the radius, variable by variable; coast_filled marks such cells."""
    keyed = grid.withColumn("__key", F.struct(by, "i_lat", "i_lon"))
    out = keyed
    for v in values:
        missing = keyed.where(F.col(v).isNull()).select("__key", by, "latitude", "longitude", "i_lat", "i_lon")
        near = nearest_valid(missing, grid, v, lat, lon, "__key", by, radius).select("__key", F.col(v).alias(f"__f_{v}"))
        out = out.join(near, "__key", "left")
    filled = None
    for v in values:
        test = F.col(v).isNull() & F.col(f"__f_{v}").isNotNull()
        filled = test if filled is None else filled | test
    out = out.withColumn("coast_filled", filled)
    return out.withColumns({v: F.coalesce(v, f"__f_{v}") for v in values}).drop("__key", *(f"__f_{v}" for v in values))
