"""Gridded fields as packed tiles: one exchange brings a time's square of cells together, and numpy works on it.

A tile is SIZE x SIZE cells of one time with a halo of its neighbours' cells, all variables side by side. A row of the long form goes to its own
tile and to those whose halo it is in; no line of cells is ever sorted whole, and no cell becomes a row for each cell in reach. Results equal the
long forms of operators.grid on dense grids, distances being compared to the micrometre (DIGITS) and ties going to the lower latitude, then longitude.

NaN counts as no value. A cell named twice keeps one of its rows. Rows without a time go together as a time of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.functions.geo import EARTH_KM, KM_PER_DEG
from pelagia.operators.grid import OUT_OF_RANGE, RADIUS_KM, Axis, nearest_day, offsets
from pelagia.shared import materialize
from pelagia.sources import grid_store

SIZE = 64
#: Points of one tile that a task takes at once; a tile with more is copied for each further lot.
POINTS = 100_000
DIGITS = 9


@dataclass(frozen=True)
class Field:
    """What is asked of a grid under a name: a column's value, or the size of its gradient per km."""

    name: str
    value: str
    front: bool = False


def distance(lat: np.ndarray, lon: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Great-circle km, to the micrometre."""
    a, b = np.radians(lat), np.radians(lat2)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lon2 - lon) / 2) ** 2
    return np.round(2 * EARTH_KM * np.arcsin(np.sqrt(np.clip(h, 0, 1))), DIGITS)


def _along(i: Column, halo: int, n: int, size: int) -> Column:
    """The tiles along an axis that want the cells of place i."""
    return F.sequence(F.greatest(F.floor((i - halo) / size), F.lit(0)), F.least(F.floor((i + halo) / size), F.lit((n - 1) // size)))


def tiled(grid: DataFrame, values: list[str], lat: Axis, lon: Axis, halo: tuple[int, int], by: str = "time", size: int = SIZE) -> DataFrame:
    """by, a, b (the tile), i_lat, i_lon and values as doubles: each cell once for every tile that wants it."""
    rows = grid.select(by, F.col("i_lat").cast("int").alias("i_lat"), F.col("i_lon").cast("int").alias("i_lon"), *(F.col(v).cast("double").alias(v) for v in values))
    rows = rows.withColumn("a", F.explode(_along(F.col("i_lat"), halo[0], lat.n, size)))
    return rows.withColumn("b", F.explode(_along(F.col("i_lon"), halo[1], lon.n, size)))


class Tile:
    """The dense arrays of one tile; place (0, 0) is the cell (top, left) of the grid."""

    def __init__(self, rows: pa.Table, values: list[str], a: int, b: int, lat: Axis, lon: Axis, halo: tuple[int, int], size: int = SIZE):
        self.lat, self.lon, self.halo, self.size = lat, lon, halo, size
        self.top, self.left = a * size - halo[0], b * size - halo[1]
        shape = (size + 2 * halo[0], size + 2 * halo[1])
        i, j = (rows[c].to_numpy() - o for c, o in (("i_lat", self.top), ("i_lon", self.left)))
        self.there = np.zeros(shape, bool)
        self.there[i, j] = True
        self.fields: dict[str, np.ndarray] = {}
        for v in values:
            self.fields[v] = np.full(shape, np.nan)
            self.fields[v][i, j] = rows[v].fill_null(math.nan).to_numpy()

    def latitude(self, i: np.ndarray) -> np.ndarray:
        return self.lat.start + (i + self.top) * self.lat.step

    def longitude(self, j: np.ndarray) -> np.ndarray:
        return self.lon.start + (j + self.left) * self.lon.step

    def own(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tile's own cells that have a row."""
        (u, w), s = self.halo, self.size
        i, j = np.nonzero(self.there[u : u + s, w : w + s])
        return i + u, j + w

    def gradient(self, value: str) -> np.ndarray:
        """Central differences per km, one-sided at the ends of the axes; where the halo ends there is no value."""
        f = self.fields[value]

        def along(axis: int, first: int, n: int) -> np.ndarray:
            g = np.moveaxis(f, axis, 0)
            before, after = np.full_like(g, np.nan), np.full_like(g, np.nan)
            before[1:], after[:-1] = g[:-1], g[1:]
            place = np.arange(len(g)) + first
            d = (after - before) / 2
            d[place == 0] = (after - g)[place == 0]
            d[place == n - 1] = (g - before)[place == n - 1]
            if n == 1:
                d[:] = np.nan
            return np.moveaxis(d, 0, axis)

        dy = along(0, self.top, self.lat.n) / (KM_PER_DEG * self.lat.step)
        dx = along(1, self.left, self.lon.n) / (KM_PER_DEG * self.lon.step * np.cos(np.radians(self.latitude(np.arange(f.shape[0])))))[:, None]
        return np.sqrt(dy**2 + dx**2)

    def nearest(self, values: list[np.ndarray], i: np.ndarray, j: np.ndarray, latitude: np.ndarray, longitude: np.ndarray, radius: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each array the value and distance of the nearest cell with one within the radius of points in cells i, j; NaN if none.

        Rings of cells around the points' own are gone through from the inside; a point leaves when no further ring can hold anything nearer.
        """
        out = [(np.full(len(i), np.nan), np.full(len(i), np.inf)) for _ in values]
        steps = offsets(self.lat, self.lon, radius)
        far = min(max(abs(self.lat.start), abs(self.lat.start + self.lat.step * (self.lat.n - 1))) + self.lat.step, 90.0)
        width = KM_PER_DEG * min(self.lat.step, self.lon.step * math.cos(math.radians(far))) * 0.999
        best = [np.full((2, len(i)), np.iinfo(np.int64).max) for _ in values]
        open_ = np.arange(len(i))
        for ring in range(max((max(abs(a), abs(b)) for a, b in steps), default=-1) + 1):
            reach = (ring - 0.5) * width  # no cell of this ring is nearer
            worst = np.max([np.where(np.isinf(d[open_]), np.inf, d[open_]) for _, d in out], axis=0) if out else np.zeros(0)
            open_ = open_[worst >= reach]
            if not len(open_) or reach > radius:
                break
            for di, dj in (s for s in steps if max(abs(s[0]), abs(s[1])) == ring):
                ci, cj = i[open_] + di, j[open_] + dj
                inside = (ci >= 0) & (cj >= 0) & (ci < self.there.shape[0]) & (cj < self.there.shape[1])
                who, ci, cj = open_[inside], ci[inside], cj[inside]
                has = [~np.isnan(v[ci, cj]) for v in values]
                some = np.logical_or.reduce(has) if has else np.zeros(0, bool)
                who, ci, cj, has = who[some], ci[some], cj[some], [h[some] for h in has]
                if not len(who):
                    continue
                d = distance(latitude[who], longitude[who], self.latitude(ci), self.longitude(cj))
                for (found, dist), first, v, h in zip(out, best, values, has, strict=True):
                    tie = (d == dist[who]) & ((ci < first[0, who]) | ((ci == first[0, who]) & (cj < first[1, who])))
                    better = h & (d <= radius) & ((d < dist[who]) | tie)
                    at = who[better]
                    found[at], dist[at] = v[ci[better], cj[better]], d[better]
                    first[0, at], first[1, at] = ci[better], cj[better]
        return [(v, np.where(np.isinf(d), np.nan, d)) for v, d in out]


def _doubles(x: np.ndarray) -> pa.Array:
    return pa.array(x, pa.float64(), mask=np.isnan(x))


def _each(grid: DataFrame, values: list[str], lat: Axis, lon: Axis, halo: tuple[int, int], by: str, work: Callable[[Tile], dict[str, pa.Array]], added: str, size: int) -> DataFrame:
    """What `work` makes of every tile (i_lat, i_lon and the added columns), with by; one exchange."""
    schema = T.StructType([grid.schema[by], *T.StructType.fromDDL(f"i_lat int, i_lon int, {added}").fields])
    names = schema.names

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        made = work(Tile(rows, values, key[1].as_py(), key[2].as_py(), lat, lon, halo, size))
        n = len(made["i_lat"])
        columns = {by: rows[by].combine_chunks().take(pa.array(np.zeros(n, np.int64))), **made}
        return pa.table({c: columns[c] for c in names})

    return tiled(grid, values, lat, lon, halo, by, size).groupBy(by, "a", "b").applyInArrow(run, schema)


def _placed(df: DataFrame, lat: Axis, lon: Axis) -> DataFrame:
    return df.withColumns({"latitude": lat.value(F.col("i_lat")), "longitude": lon.value(F.col("i_lon"))})


def gradient(grid: DataFrame, value: str, lat: Axis, lon: Axis, name: str = "gradient", by: str = "time", size: int = SIZE) -> DataFrame:
    """by, i_lat, i_lon, latitude, longitude, value and the size of its horizontal gradient per km."""

    def work(t: Tile) -> dict[str, pa.Array]:
        i, j = t.own()
        return {"i_lat": pa.array((i + t.top).astype(np.int32)), "i_lon": pa.array((j + t.left).astype(np.int32)), value: _doubles(t.fields[value][i, j]), name: _doubles(t.gradient(value)[i, j])}

    return _placed(_each(grid, [value], lat, lon, (1, 1), by, work, f"`{value}` double, `{name}` double", size), lat, lon)


def regrid(grid: DataFrame, value: str, source: tuple[Axis, Axis], target: tuple[Axis, Axis], by: str = "time", size: int = SIZE) -> DataFrame:
    """Bilinear values on the target axes: by, i_lat, i_lon, value, latitude, longitude.

    A target belongs to the tile of its lower corner. Targets outside the source have no row; one with a weighing corner missing has null.
    """
    along = [np.array(s.bracket(t), float).reshape(-1, 4) for s, t in zip(source, target, strict=True)]

    def work(t: Tile) -> dict[str, pa.Array]:
        picked = []
        for line, first, halo in zip(along, (t.top, t.left), t.halo, strict=True):
            low = line[:, 1].astype(int) - first
            mine = (low >= halo) & (low < halo + t.size)
            picked.append((line[mine, 0].astype(np.int32), low[mine], line[mine, 2].astype(int) - first, line[mine, 3]))
        (ti, i0, i1, wi), (tj, j0, j1, wj) = picked
        f, total, met = t.fields[value], np.zeros((len(ti), len(tj))), np.zeros((len(ti), len(tj)), bool)
        for i, u in ((i0, 1 - wi), (i1, wi)):
            for j, w in ((j0, 1 - wj), (j1, wj)):
                weight = u[:, None] * w[None, :]
                corner = f[np.ix_(i, j)]
                total += np.where(weight > 0, weight * corner, 0)
                met |= (weight > 0) & t.there[np.ix_(i, j)]
        a, b = np.nonzero(met)
        return {"i_lat": pa.array(ti[a]), "i_lon": pa.array(tj[b]), value: _doubles(total[a, b])}

    return _placed(_each(grid, [value], *source, (1, 1), by, work, f"`{value}` double", size), *target)


def coastal_fill(grid: DataFrame, values: list[str], lat: Axis, lon: Axis, by: str = "time", radius: float = RADIUS_KM, size: int = SIZE) -> DataFrame:
    """by, i_lat, i_lon, latitude, longitude, values, coast_filled: missing values take the nearest original one within the radius, each variable for itself."""
    steps = offsets(lat, lon, radius)
    halo = (max(abs(a) for a, _ in steps), max(abs(b) for _, b in steps))

    def work(t: Tile) -> dict[str, pa.Array]:
        i, j = t.own()
        filled, columns = np.zeros(len(i), bool), {}
        for v in values:
            x = t.fields[v][i, j]
            gap = np.flatnonzero(np.isnan(x))
            near, _ = t.nearest([t.fields[v]], i[gap], j[gap], t.latitude(i[gap]), t.longitude(j[gap]), radius)[0]
            x[gap] = near
            filled[gap] |= ~np.isnan(near)
            columns[v] = _doubles(x)
        return {"i_lat": pa.array((i + t.top).astype(np.int32)), "i_lon": pa.array((j + t.left).astype(np.int32)), **columns, "coast_filled": pa.array(filled)}

    added = ", ".join([*(f"`{v}` double" for v in values), "coast_filled boolean"])
    return _placed(_each(grid, values, lat, lon, halo, by, work, added, size), lat, lon)


def sample(points: DataFrame, grid: DataFrame, fields: list[Field], lat: Axis, lon: Axis, key: str, ts: str, radius: float = RADIUS_KM, size: int = SIZE) -> DataFrame:
    """key, time and, for each field, <name>, dist_<name> and status_<name> at points and times (latitude, longitude, ts); a row for each point.

    The points are read once and written with their cell and time; then the grid is read once, whatever the number of fields: cells of the
    tiles that hold points meet those points (of a grid_store, only the days of points are read), gradients and nearest values are worked out there. A tile with more than POINTS points is met in lots.

    ok: the nearest cell has a value. fallback: it has none; the nearest one within the radius stands in, if any.
    fuera_de_rango: no grid time within two days, no time or no place; the grid's time is given all the same, the value is not.
    """
    values = list(dict.fromkeys(f.value for f in fields))
    edge = int(any(f.front for f in fields))
    steps = offsets(lat, lon, radius)
    halo = (max(abs(a) for a, _ in steps) + edge, max(abs(b) for _, b in steps) + edge)
    located = nearest_day(points.select(key, ts, "latitude", "longitude"), grid, ts).withColumns({"i_lat": lat.nearest(F.col("latitude")), "i_lon": lon.nearest(F.col("longitude"))})
    in_range = F.coalesce("in_range", F.lit(False)) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    located = located.select(F.col(key).alias("key"), "time", "latitude", "longitude", "i_lat", "i_lon", in_range.alias("in_range"))
    located = materialize(located.withColumns({"a": F.floor(F.col("i_lat") / size).cast("long"), "b": F.floor(F.col("i_lon") / size).cast("long")}))
    lot = max(POINTS, located.count() // 100_000)  # so fewer than 100,000 tiles are split, a list for every task
    wanted = located.where("in_range").groupBy("time", "a", "b").agg(F.ceil(F.count("*") / lot).alias("lots"))
    near = grid_store.on_days(grid, wanted)
    cells = tiled(near, values, lat, lon, halo, "time", size).join(wanted, ["time", "a", "b"]).withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1))).drop("lots")
    split = F.broadcast(wanted.where("lots > 1"))
    mine = located.where("in_range").join(split, ["time", "a", "b"], "left").withColumn("lot", F.pmod(F.xxhash64("key"), F.coalesce("lots", F.lit(1).cast("long")))).drop("lots")
    each = [x for f in fields for x in (f"v_{f.name}", f"d_{f.name}", f"s_{f.name}")]
    kinds = ["double", "double", "string"] * len(fields)
    found = T.StructType([located.schema["key"], located.schema["time"], *T.StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in zip(each, kinds, strict=True))).fields])

    def run(group: tuple, at: pa.Table, rows: pa.Table) -> pa.Table:
        t = Tile(rows, values, group[1].as_py(), group[2].as_py(), lat, lon, halo, size)
        i, j = (at[c].to_numpy() - o for c, o in (("i_lat", t.top), ("i_lon", t.left)))
        y, x = at["latitude"].to_numpy(), at["longitude"].to_numpy()
        arrays = [t.gradient(f.value) if f.front else t.fields[f.value] for f in fields]
        here = [a[i, j] for a in arrays]
        own = distance(y, x, t.latitude(i), t.longitude(j))
        gaps = np.flatnonzero(np.logical_or.reduce([np.isnan(h) for h in here])) if len(at) else np.zeros(0, int)
        near = t.nearest(arrays, i[gaps], j[gaps], y[gaps], x[gaps], radius)
        columns = {"key": at["key"], "time": at["time"]}
        for f, h, (v, d) in zip(fields, here, near, strict=True):
            has = ~np.isnan(h)
            value, dist = h.copy(), np.where(has, own, np.nan)
            lacking = ~has[gaps]
            value[gaps[lacking]], dist[gaps[lacking]] = v[lacking], d[lacking]
            columns |= {f"v_{f.name}": _doubles(value), f"d_{f.name}": _doubles(dist), f"s_{f.name}": pa.array(np.where(has, "ok", "fallback").astype(object), pa.string())}
        return pa.table({c: columns[c] for c in found.names})

    keys = ("time", "a", "b", "lot")
    met = mine.groupBy(*keys).cogroup(cells.groupBy(*keys)).applyInArrow(run, found)
    none = located.where("NOT in_range").select("key", "time", *(F.lit(OUT_OF_RANGE if n.startswith("s_") else None).cast(k).alias(n) for n, k in zip(each, kinds, strict=True)))
    out = met.unionByName(none)
    return out.select(F.col("key").alias(key), "time", *(x for f in fields for x in (F.col(f"v_{f.name}").alias(f.name), F.col(f"d_{f.name}").alias(f"dist_{f.name}"), F.col(f"s_{f.name}").alias(f"status_{f.name}"))))
