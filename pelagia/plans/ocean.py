"""What the sea was like at each haul, and the forecast grid."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.functions.geo import kelvin_to_celsius, moon_illumination, scaled_round
from pelagia.operators import tiles
from pelagia.operators.grid import OUT_OF_RANGE, Axis, depth_min, depth_nearest
from pelagia.sources import netcdf3

#: What became of a haul's covariates, from good to bad, and hauls without a place.
STATUS = ("ok", "fallback", OUT_OF_RANGE)
NO_PLACE = "sin_coords"


@dataclass(frozen=True)
class Sampler:
    """One covariate: a grid's value, or the size of its gradient, and what is done to it afterwards."""

    name: str
    grid: str
    value: str
    front: bool = False
    change: Callable[[Column], Column] | None = None


#: The covariates of the final product in order; the first one gives env_time.
SAMPLERS = (
    Sampler("sst_c", "sst", "analysed_sst", change=kelvin_to_celsius),
    Sampler("chl_mg_m3", "chl", "CHL"),
    Sampler("mld_m", "phy", "mlotst"),
    Sampler("sss_psu", "phy", "so_0m"),
    Sampler("o2_min_mmol_m3", "bgc", "o2_min_0_200m"),
    Sampler("sst_front_c_per_km", "sst", "analysed_sst", front=True),
    Sampler("chl_front_mg_m3_per_km", "chl", "CHL", front=True),
)
FORECAST = ("sst_c", "chl_mg_m3", "mld_m", "sss_psu", "o2_min_mmol_m3")


def haul_environment(hauls: DataFrame, grids: dict[str, DataFrame], lat: Axis, lon: Axis, key: str = "zarpe_id", ts: str = "haul_start", samplers: tuple[Sampler, ...] = SAMPLERS) -> DataFrame:
    """Hauls with their covariates, env_time, env_cell_dist_km and env_status (the worst of the samplers').

    Hauls without a place or time keep null covariates and the status sin_coords; the moon needs the time alone.
    Every grid is read once, for the tiles that hold hauls; fronts are worked out there.
    """
    points = hauls.select(key, ts, F.col("haul_lat").alias("latitude"), F.col("haul_lon").alias("longitude")).na.drop(how="any")
    rank = lambda c: F.array_position(F.array(*map(F.lit, STATUS)), F.col(c))
    out, ranks, dists = hauls, [], []
    for name in dict.fromkeys(s.grid for s in samplers):
        mine = [s for s in samplers if s.grid == name]
        got = tiles.sample(points, grids[name], [tiles.Field(s.name, s.value, s.front) for s in mine], lat, lon, key, ts)
        values = [(s.change(F.col(s.name)) if s.change else F.col(s.name)).alias(s.name) for s in mine]
        marks = [x for s in mine for x in (rank(f"status_{s.name}").alias(f"__r_{s.name}"), F.col(f"dist_{s.name}").alias(f"__d_{s.name}"))]
        first = [F.col("time").alias("env_time")] if samplers[0].grid == name else []
        got = got.select(F.col(key).alias("__k"), *values, *marks, *first)
        out = out.join(got, out[key] == F.col("__k"), "left").drop("__k")
        ranks += [F.coalesce(f"__r_{s.name}", F.lit(0)) for s in mine]
        dists += [F.coalesce(f"__d_{s.name}", F.lit(0.0)) for s in mine]
    worst = F.greatest(*ranks) if len(ranks) > 1 else ranks[0]
    far = F.greatest(*dists) if len(dists) > 1 else dists[0]
    status = F.when(worst > 0, F.get(F.array(*map(F.lit, STATUS)), (worst - 1).cast("int"))).otherwise(NO_PLACE)
    out = out.withColumns({"moon_illumination": moon_illumination(F.col(ts)), "env_status": status, "env_cell_dist_km": F.when(worst > 0, scaled_round(far, 3))})
    return out.select(*hauls.columns, *(s.name for s in samplers), "moon_illumination", "env_time", "env_cell_dist_km", "env_status")


#: The raw variables of each grid, and how a depth profile becomes one value.
RAW = {
    "sst": {"analysed_sst": ("analysed_sst", None)},
    "chl": {"CHL": ("CHL", None)},
    "phy": {"mlotst": ("mlotst", None), "so_0m": ("so", ("nearest", 0.0))},
    "bgc": {"o2_min_0_200m": ("o2", ("least", 200.0))},
}


def raw_grid(spark: SparkSession, path: str, values: dict[str, tuple[str, tuple[str, float] | None]], lat: Axis, lon: Axis, start: str | None = None, end: str | None = None) -> DataFrame:
    """A product's NetCDF files as a grid on the target axes: files merged, profiles sliced, values interpolated.

    values: name -> (variable, slice); a slice is the level nearest to a depth, or the least value down to one. Each variable reads its own files, for the days alone.
    """
    source, out = netcdf3.axes(path), None
    box = []
    for src, dst in zip(source, (lat, lon), strict=True):  # a source cell more on each side
        ends = sorted((dst.start, dst.start + dst.step * (dst.n - 1)))
        box += [ends[0] - abs(src.step), ends[1] + abs(src.step)]
    for name, (variable, cut) in values.items():
        deepest = cut[1] if cut and cut[0] == "least" else None
        one = netcdf3.read(spark, path, [variable], start, end, tuple(box), deepest, merge=True).withColumnRenamed(variable, name)
        keys = ["time", "i_lat", "i_lon"]
        if cut and "depth" in one.columns:
            one = depth_min(one, name, keys) if cut[0] == "least" else depth_nearest(one, name, cut[1], keys)
        one = one.select(*keys, name) if source == (lat, lon) else tiles.regrid(one, name, source, (lat, lon)).select(*keys, name)
        out = one if out is None else out.join(one, keys, "full")
    return out.withColumns({"latitude": lat.value(F.col("i_lat")), "longitude": lon.value(F.col("i_lon"))})


def forecast_grid(physics: DataFrame, biology: DataFrame, lat: Axis, lon: Axis, values: tuple[str, ...] = FORECAST) -> DataFrame:
    """Both layers side by side; cells without anything go, gaps near the coast are filled, cells still lacking a value go."""
    keys = ["time", "i_lat", "i_lon"]
    both = physics.drop("latitude", "longitude").join(biology.drop("latitude", "longitude"), keys, "full")
    both = both.withColumns({"latitude": lat.value(F.col("i_lat")), "longitude": lon.value(F.col("i_lon"))})
    filled = tiles.coastal_fill(both.na.drop(how="all", subset=list(values)), list(values), lat, lon)
    return filled.na.drop(how="any", subset=list(values)).select(*keys, "latitude", "longitude", *values, "coast_filled")
