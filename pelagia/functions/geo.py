"""Distances, angles, coordinates and the moon as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
KM_PER_DEG = 111.195
#: A new moon, and the mean length of a lunation in days.
NEW_MOON = "2000-01-06 18:14:00"
LUNATION = 29.530588853


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))  # least() would skip nulls


def equirectangular(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """A squared flat distance in degrees, for ranking only."""
    return F.pow(lat2 - lat1, 2) + F.pow((lon2 - lon1) * F.cos(F.radians(lat1)), 2)


def circular_delta(now: Column, before: Column) -> Column:
    """The signed turn between two headings in degrees, from -180 up to 180."""
    return F.pmod(now - before + 180.0, F.lit(360.0)) - 180.0


def sexagesimal(v: Column) -> Column:
    """DDMMSS to degrees, south and west negative; null for what is no number."""
    v = v.try_cast("double")
    return -(F.floor(v / 10000) + F.floor((v % 10000) / 100) / 60 + (v % 100) / 3600)


def moon_illumination(ts: Column) -> Column:
    days = (F.unix_micros(ts.cast("timestamp")) - F.unix_micros(F.to_timestamp(F.lit(NEW_MOON)))) / 86_400_000_000
    return (1 - F.cos(2 * F.pi() * F.pmod(days / LUNATION, F.lit(1.0)))) / 2


def scaled_round(x: Column, digits: int) -> Column:
    """Half to even at a number of decimals, by scaling."""
    return F.rint(x * 10**digits) / 10**digits


def hours_between(a: Column, b: Column) -> Column:
    return (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / 3_600_000_000


def kelvin_to_celsius(x: Column) -> Column:
    return x - 273.15


def in_box(lat: Column, lon: Column, bbox: tuple[float, float, float, float]) -> Column:
    return lat.between(bbox[0], bbox[1]) & lon.between(bbox[2], bbox[3])
