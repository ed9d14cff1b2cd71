"""What a run's products look like in numbers, and what their columns mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.operators.quantile import exact_quantiles, value_counts
from pelagia.plans.ocean import SAMPLERS, STATUS
from pelagia.sources.products import report

#: The columns of the forecast grid and of the covariates.
NOTES = {
    "time": "day of the forecast",
    "latitude": "degrees north, centre of the cell",
    "longitude": "degrees east, centre of the cell",
    "sst_c": "degrees Celsius at the surface",
    "chl_mg_m3": "mg a cubic metre, chlorophyll at the surface",
    "mld_m": "metres, depth of the mixed layer",
    "sss_psu": "practical salinity at the surface",
    "o2_min_mmol_m3": "mmol a cubic metre, least oxygen in the upper 200 m",
    "sst_front_c_per_km": "degrees Celsius a km, size of the gradient of surface temperature",
    "chl_front_mg_m3_per_km": "mg a cubic metre and km, size of the gradient of chlorophyll",
    "coast_filled": "whether a value comes from the nearest cell of sea, as the cell's own layer has none",
    "moon_illumination": "lit share of the moon, 0 to 1",
    "env_time": "time of the field of surface temperature",
    "env_cell_dist_km": "km to the farthest cell that a value comes from",
    "env_status": "worst of the covariates: ok, fallback (a cell near by), fuera_de_rango (none), sin_coords (no place or time)",
}


def _told(rows: DataFrame, about: str, measure: str, value: str, label: Column | None = None) -> DataFrame:
    return rows.select(F.lit(about).alias("about"), F.lit(measure).alias("measure"), (F.lit("") if label is None else label.cast("string")).alias("label"), F.col(value).cast("double").alias("value"))


def _spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """n_valid, low, mean and high of columns, a row each."""
    rows = report(df, columns).withColumn("n_valid", F.col("n_valid").cast("double"))
    return rows.unpivot("column", ["n_valid", "low", "mean", "high"], "measure", "value")


def summary(trips: DataFrame, located: DataFrame, environment: DataFrame | None = None) -> DataFrame:
    """about, measure, label, value: trips' length, hauls by confidence, and the environment by status with the spread of its values.

    Measures of nothing (no trip has a length, no haul is a fallback) have no row or a null value; a label that is missing is null.
    """
    hours = exact_quantiles(trips, [], "duration_h", {"median": 0.5, "p90": 0.9})
    rows = _told(trips.agg(F.count("*").alias("n")), "trips", "n", "n")
    rows = rows.unionByName(_told(hours, "duration_h", "median", "median")).unionByName(_told(hours, "duration_h", "p90", "p90"))
    rows = rows.unionByName(_told(value_counts(located, "haul_confidence"), "haul_confidence", "n", "n", F.col("haul_confidence")))
    if environment is None:
        return rows
    rows = rows.unionByName(_told(value_counts(environment, "env_status"), "env_status", "n", "n", F.col("env_status")))
    far = environment.where(F.col("env_status") == STATUS[1]).agg(F.max("env_cell_dist_km").alias("far"))
    rows = rows.unionByName(_told(far, "env_cell_dist_km", "high", "far", F.lit(STATUS[1])))
    spread = _spread(environment, [s.name for s in SAMPLERS] + ["moon_illumination"])
    return rows.unionByName(spread.select(F.col("column").alias("about"), "measure", F.lit("").alias("label"), "value"))
