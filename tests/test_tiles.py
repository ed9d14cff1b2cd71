"""Tiles against the long forms and against loops over the whole grid."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.operators import grid as g
from pelagia.operators import tiles

T0 = datetime(2023, 3, 5)
LAT, LON = g.Axis(-29.0, 1 / 24, 23), g.Axis(-72.0, 1 / 24, 17)


def field(spark, seed, share, days=2):
    r = random.Random(seed)
    rows = []
    for d in range(days):
        for i in range(LAT.n):
            for j in range(LON.n):
                v, w = (None if r.random() < share else round(r.random(), 3) for _ in range(2))
                rows.append((T0 + timedelta(days=d), i, j, LAT.start + i * LAT.step, LON.start + j * LON.step, v if i or j else math.nan, w))
    return spark.createDataFrame(rows, "time timestamp, i_lat int, i_lon int, latitude double, longitude double, v double, w double")


def keyed(df, *values):
    return {(r.time, r.i_lat, r.i_lon): tuple(round(r[v], 9) if isinstance(r[v], float) else r[v] for v in values) for r in df.collect()}


@pytest.mark.parametrize(("share", "size"), [(0.3, 5), (0.9, 8), (0.0, 64)])
def test_gradient_regrid_and_fill_equal_the_long_forms(spark, share, size):
    grid = field(spark, size, share)
    clean = grid.withColumn("v", F.when(~F.isnan("v"), F.col("v"))).cache()
    assert keyed(tiles.gradient(grid, "v", LAT, LON, size=size), "v", "gradient") == keyed(g.gradient(clean, "v", LAT, LON), "v", "gradient")
    target = (g.Axis(-29.0 + 1 / 48, 0.7 / 24, 60), g.Axis(-72.5, 1.3 / 24, 30))
    assert keyed(tiles.regrid(grid, "v", (LAT, LON), target, size=size), "v") == keyed(g.regrid(clean, "v", (LAT, LON), target), "v")
    got = tiles.coastal_fill(grid, ["v", "w"], LAT, LON, size=size)
    want = {}
    rows = clean.collect()
    for day in {r.time for r in rows}:
        mine = [r for r in rows if r.time == day]
        for r in mine:
            filled = []
            for c in ("v", "w"):
                value = r[c]
                if value is None:
                    near = [(float(tiles.distance(*(np.array(x) for x in (r.latitude, r.longitude, o.latitude, o.longitude)))), o.i_lat, o.i_lon, o[c]) for o in mine if o[c] is not None]
                    best = min(near, default=(99,))
                    value = best[3] if best[0] <= 25 else None
                filled.append(value)
            want[day, r.i_lat, r.i_lon] = (*filled, any(r[c] is None and f is not None for c, f in zip("vw", filled, strict=True)))
    assert keyed(got, "v", "w", "coast_filled") == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_sample_of_five_values_reads_once_and_equals_the_whole_search(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tiles, "POINTS", 20)  # so that tiles are met in lots
    r = random.Random(8)
    field(spark, 3, 0.85).withColumns({"u": F.col("v") + 1, "x": F.col("w") * 2}).write.parquet(str(tmp_path / "grid"))
    grid = spark.read.parquet(str(tmp_path / "grid"))
    rows = [(k, T0 + timedelta(hours=r.randrange(-60, 100)), -29 + r.random() * 1.3 - 0.2, -72 + r.random() * 1.1 - 0.2) for k in range(300)]
    rows += [(k, T0, -29 + (k % 20) / 24, -72 + (k % 15) / 24) for k in range(300, 360)] + [(None, T0, None, -72.0), (None, None, -29.0, -72.0), (7, T0, -28.7, -71.8), (400, T0, -40.0, -80.0)]
    points = spark.createDataFrame(rows, "id int, ts timestamp, latitude double, longitude double")
    fields = [tiles.Field(n, n) for n in ("v", "w", "u", "x")] + [tiles.Field("front", "w", front=True)]
    out = tiles.sample(points, grid, fields, LAT, LON, "id", "ts", size=6)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation" in line]
    assert sum("i_lat" in s and "latitude" in s and "v#" in s for s in scans) == 1, plan  # one read of the grid
    fronts = {(x.time, x.i_lat, x.i_lon): x.gradient for x in g.gradient(grid, "w", LAT, LON).collect()}
    cells = [(c.time, c.i_lat, c.i_lon, c.latitude, c.longitude, {"v": c.v, "w": c.w, "u": c.u, "x": c.x, "front": fronts[c.time, c.i_lat, c.i_lon]}) for c in grid.collect()]
    cells = [(*c[:5], {k: None if v is None or math.isnan(v) else v for k, v in c[5].items()}) for c in cells]
    got = out.collect()
    assert len(got) == len(rows)
    by = {(x.id, x.time): x for x in got}
    for k, ts, y, x in rows:
        if k is None:
            continue
        day = max((T0, T0 + timedelta(days=1)), key=lambda d: (-abs((d - ts).total_seconds()), d))
        row = by[k, day]
        near = abs((day - ts).total_seconds()) <= 48 * 3600
        i = min(max(math.floor((y - LAT.start) / LAT.step + 0.5), 0), LAT.n - 1)
        j = min(max(math.floor((x - LON.start) / LON.step + 0.5), 0), LON.n - 1)
        for f in fields:
            found = sorted((float(tiles.distance(*(np.array(q) for q in (y, x, c[3], c[4])))), c[1], c[2], c[5][f.name]) for c in cells if c[0] == day and c[5][f.name] is not None)
            own = [c for c in found if (c[1], c[2]) == (i, j)]
            if not near:
                want = (None, None, "fuera_de_rango")
            elif own:
                want = (own[0][3], own[0][0], "ok")
            else:
                want = (found[0][3], found[0][0], "fallback") if found and found[0][0] <= 25 else (None, None, "fallback")
            if k == 7 and ts == rows[7][1] and rows[7][1] != T0:
                continue  # the id that occurs twice
            assert (row[f.name], row[f"dist_{f.name}"], row[f"status_{f.name}"]) == (want[0] if want[0] is None else pytest.approx(want[0]), want[1] if want[1] is None else pytest.approx(want[1], abs=1e-6), want[2]), (k, f)
    lost = [x for x in got if x.id is None]
    assert {x.status_v for x in lost} == {"fuera_de_rango"} and all(x.v is None for x in lost)


def test_empty_grid_and_points(spark):
    grid = field(spark, 1, 0.5)
    points = spark.createDataFrame([(1, T0, -29.0, -72.0)], "id int, ts timestamp, latitude double, longitude double")
    ask = [tiles.Field("v", "v")]
    got = tiles.sample(points, grid.limit(0), ask, LAT, LON, "id", "ts").collect()
    assert [(x.time, x.v, x.status_v) for x in got] == [(None, None, "fuera_de_rango")]
    assert tiles.sample(points.limit(0), grid, ask, LAT, LON, "id", "ts").count() == 0
    assert tiles.coastal_fill(grid.limit(0), ["v"], LAT, LON).count() == 0
