"""Nearest point among a few, as an expression without a join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pelagia.functions.geo import haversine_km


def nearest_point(lat: Column, lon: Column, points: list[tuple[str, float, float]], metric: Callable = haversine_km) -> Column:
    """struct(dist, ord, name) of the nearest of a short list of points, the first on a tie; null without coordinates."""
    each = [F.struct(metric(lat, lon, F.lit(y), F.lit(x)).alias("dist"), F.lit(i).alias("ord"), F.lit(name).alias("name")) for i, (name, y, x) in enumerate(points)]
    return F.when(lat.isNotNull() & lon.isNotNull(), F.array_min(F.array(*each)))
