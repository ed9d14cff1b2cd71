"""Classic NetCDF files written byte by byte."""

import struct
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.operators.grid import Axis
from pelagia.plans import ocean
from pelagia.sources import netcdf3

CODES = {"i1": 1, "i2": 3, "i4": 4, "f4": 5, "f8": 6}


def write(path, version, dims, variables, records):
    """dims: name -> length, 0 for the record axis; variables: (name, dims, code, attributes, array)."""
    count = (lambda n: struct.pack(">q", n)) if version == 5 else (lambda n: struct.pack(">i", n))
    pad = lambda b: b + b"\0" * (-len(b) % 4)
    name = lambda s: count(len(s.encode())) + pad(s.encode())

    def attributes(given):
        out = struct.pack(">i", 12 if given else 0) + count(len(given))
        for k, v in given.items():
            if isinstance(v, str):
                out += name(k) + struct.pack(">i", 2) + count(len(v.encode())) + pad(v.encode())
            else:
                code, x = v
                out += name(k) + struct.pack(">i", CODES[code]) + count(1) + pad(np.array([x], ">" + code).tobytes())
        return out

    names = list(dims)
    head = b"CDF" + bytes([version]) + count(records) + struct.pack(">i", 10) + count(len(dims)) + b"".join(name(k) + count(n) for k, n in dims.items()) + attributes({"title": "x"})
    moving = [v for v in variables if dims[v[1][0]] == 0]
    one = lambda v: v[4][0].nbytes
    size = lambda v: one(v) if dims[v[1][0]] == 0 else v[4].nbytes

    def table(begins):
        out = struct.pack(">i", 11) + count(len(variables))
        for v in variables:
            out += name(v[0]) + count(len(v[1])) + b"".join(count(names.index(d)) for d in v[1]) + attributes(v[3]) + struct.pack(">i", CODES[v[2]]) + count(size(v) + -size(v) % 4)
            out += struct.pack(">i" if version == 1 else ">q", begins[v[0]])
        return out

    at, begins = len(head) + len(table({v[0]: 0 for v in variables})), {}
    for v in variables:
        if v not in moving:
            begins[v[0]], at = at, at + v[4].nbytes + -v[4].nbytes % 4
    for v in moving:
        begins[v[0]], at = at, at + one(v) + (-one(v) % 4 if len(moving) > 1 else 0)
    body = b"".join(pad(v[4].tobytes()) for v in variables if v not in moving)
    for r in range(records):
        for v in moving:
            body += pad(v[4][r : r + 1].tobytes()) if len(moving) > 1 else v[4][r : r + 1].tobytes()
    path.write_bytes(head + table(begins) + body)


def product(path, version=1, unlimited=True, deep=False, days=130, start="2019-12-31 12:00:00", seed=0):
    r = np.random.default_rng(seed)
    lat, lon, depth = np.linspace(-30, -27, 5).astype(">f4"), np.linspace(-73, -71, 7).astype(">f8"), np.array([0.5, 10, 200], ">f4")
    shape = (days, 3, 5, 7) if deep else (days, 5, 7)
    raw = r.integers(-100, 100, shape).astype(">i2")
    raw[0, ..., 0, 0] = -999
    plain = r.random(shape[:1] + (5, 7)).astype(">f4")
    plain[1, 2, 3] = np.nan
    plain[2, 0, 0] = 1e20
    dims = {"time": 0 if unlimited else days, **({"depth": 3} if deep else {}), "lat": 5, "lon": 7}
    axes = ["time", "depth", "lat", "lon"] if deep else ["time", "lat", "lon"]
    variables = [
        ("lat", ["lat"], "f4", {}, lat), ("lon", ["lon"], "f8", {}, lon), *([("depth", ["depth"], "f4", {}, depth)] if deep else []),
        ("time", ["time"], "i4", {"units": f"hours since {start}", "calendar": "gregorian"}, (np.arange(days) * 24).astype(">i4")),
        ("so", axes, "i2", {"_FillValue": ("i2", -999), "scale_factor": ("f8", 0.5), "add_offset": ("f8", 10.0)}, raw),
        ("CHL", ["time", "lat", "lon"], "f4", {"missing_value": ("f4", 1e20)}, plain),
    ]
    write(path, version, dims, variables, days if unlimited else 0)
    so = np.where(raw == -999, np.nan, raw * 0.5 + 10)
    chl = np.where(plain == np.float32(1e20), np.nan, plain.astype(float))
    return lat.astype(float), lon.astype(float), depth.astype(float), so, chl


def shown(x):
    return None if np.isnan(x) else float(x)


@pytest.mark.parametrize(("version", "unlimited", "deep"), [(1, True, False), (2, False, False), (5, True, True), (1, True, True)])
def test_every_cell_of_a_file(spark, tmp_path, version, unlimited, deep):
    lat, lon, depth, so, chl = product(tmp_path / "a.nc", version, unlimited, deep)
    got = netcdf3.read(spark, str(tmp_path / "a.nc"), ["so", "CHL"])
    assert got.rdd.getNumPartitions() == 3
    rows = got.withColumn("t", F.unix_micros("time")).collect()
    assert len(rows) == so.size
    t0 = datetime.fromisoformat("2019-12-31T12:00:00+00:00").timestamp()
    for r in rows:
        k = round((r.t / 1e6 - t0) / 86400)
        place = (k, list(depth).index(r.depth), r.i_lat, r.i_lon) if deep else (k, r.i_lat, r.i_lon)
        assert (r.latitude, r.longitude, r.so, r.CHL) == (lat[r.i_lat], lon[r.i_lon], shown(so[place]), shown(chl[k, r.i_lat, r.i_lon]))


def test_filters_reach_the_file(spark, tmp_path):
    product(tmp_path / "a.nc", deep=True)
    product(tmp_path / "b.nc", deep=True, start="2021-01-01 00:00:00", seed=1)
    got = netcdf3.read(spark, str(tmp_path), ["so"], "2020-03-05", "2020-03-07", (-29.5, -27.0, -72.7, -71.0), 50.0)
    whole = netcdf3.read(spark, str(tmp_path), ["so"])
    want = whole.where(F.to_date("time").between("2020-03-05", "2020-03-07")).where("latitude >= -29.5 and longitude >= -72.7 and depth <= 50").collect()
    assert sorted(got.collect()) == sorted(want) and len(want) == 3 * 2 * 4 * 6
    assert got.rdd.getNumPartitions() == 1  # one block of one file has those days
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan, plan  # nothing is left for Spark to filter
    some = whole.where("so > 12 and i_lat = 2 and latitude < -28").collect()
    assert some and all(r.so > 12 and r.i_lat == 2 for r in some)
    assert netcdf3.read(spark, str(tmp_path), ["so"], "2030-01-01").count() == 0


def test_what_is_no_classic_file_or_calendar(spark, tmp_path):
    (tmp_path / "x.nc").write_bytes(b"\x89HDF\r\n")
    with open(tmp_path / "x.nc", "rb") as f, pytest.raises(ValueError):
        netcdf3.read_header(f)
    with pytest.raises(ValueError):
        netcdf3.micros(np.arange(3), {"units": "days since 2000-01-01", "calendar": "360_day"})
    assert netcdf3.micros(np.array([0.5]), {"units": "days since 2000-01-01 00:00:00 UTC"})[0] == datetime.fromisoformat("2000-01-01T12:00:00+00:00").timestamp() * 1e6


def test_overlapping_files_merge_and_axes_must_agree(spark, tmp_path):
    product(tmp_path / "2019.nc", days=10)
    _, _, _, so, _ = product(tmp_path / "2020.nc", days=10, start="2020-01-05 12:00:00", seed=1)
    got = netcdf3.read(spark, str(tmp_path), ["so"], merge=True)
    assert got.count() == 15 * 35 and got.select("time", "i_lat", "i_lon").distinct().count() == 15 * 35
    late = {(r.t, r.i_lat, r.i_lon): r.so for r in got.where("time >= '2020-01-05'").withColumn("t", F.datediff("time", F.lit("2020-01-05"))).collect()}
    assert len(late) == 350 and all(late[k] == shown(so[k]) for k in late)  # the last file wins
    assert netcdf3.axes(str(tmp_path)) == (Axis(-30.0, 0.75, 5), Axis(-73.0, pytest.approx(1 / 3), 7))
    raw = (tmp_path / "2020.nc").read_bytes()
    (tmp_path / "2021.nc").write_bytes(raw.replace(np.linspace(-30, -27, 5).astype(">f4").tobytes(), np.linspace(-31, -28, 5).astype(">f4").tobytes()))
    with pytest.raises(Exception, match="different axes"):
        netcdf3.read(spark, str(tmp_path), ["so"], merge=True).count()


def test_raw_product_on_the_target_axes(spark, tmp_path):
    lat, lon, depth, so, chl = product(tmp_path / "p.nc", days=3, deep=True)
    target = Axis(-30.0, 0.375, 9), Axis(-73.0, 1 / 6, 13)
    grid = ocean.raw_grid(spark, str(tmp_path), {"CHL": ("CHL", None), "so_0m": ("so", ("nearest", 0.0)), "so_min": ("so", ("least", 50.0))}, *target)
    rows = {(r.time, r.i_lat, r.i_lon): r for r in grid.collect()}
    days = sorted({k[0] for k in rows})
    assert len(rows) == 3 * 9 * 13
    for (t, i, j), r in rows.items():
        if i % 2 == 0 and j % 2 == 0:
            place = (days.index(t), i // 2, j // 2)
            near, least = so[place[0], 0, place[1], place[2]], so[place[0], :2, place[1], place[2]]
            assert r.CHL == (None if np.isnan(chl[place]) else pytest.approx(chl[place])) and r.so_0m == (None if np.isnan(near) else pytest.approx(near))
            assert r.so_min == (None if np.isnan(least).all() else pytest.approx(np.nanmin(least)))
