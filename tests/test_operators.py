import difflib
import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pelagia.operators import grid as g
from pelagia.operators import html, match
from pelagia.operators import ordered as o
from pelagia.operators.match import best_match, fuzzy_match
from pelagia.operators.nearest import nearest_point

T0 = datetime(2024, 1, 1)


def test_asof_forward_against_loops(spark):
    rng = random.Random(3)
    left = [(i, rng.choice("ab"), T0 + timedelta(hours=rng.randrange(200))) for i in range(150)]
    right = [(i, rng.choice("abc"), T0 + timedelta(hours=rng.randrange(200))) for i in range(30)]
    got = o.asof_forward(
        spark.createDataFrame(left, "id long, k string, t timestamp"), spark.createDataFrame(right, "ord long, k string, r timestamp").withColumn("trip", F.col("ord")), "k", "t", "r", ["trip"], 24 * 3600, "ord"
    )
    want = {}
    for i, k, t in left:
        mine = sorted((r, n) for n, kk, r in right if kk == k)
        after = [(r, n) for r, n in mine if r >= t]
        want[i] = None
        if after and after[0][0] - t <= timedelta(hours=24):
            before = [r for r, n in mine if (r, n) < after[0]]
            if not before or t > before[-1]:
                want[i] = after[0][1]
    assert {r["id"]: r["trip"] for r in got.collect()} == want


def test_sessions_cut_past_the_gap_only(spark):
    rows = [(0, T0), (1, T0 + timedelta(minutes=20)), (2, T0 + timedelta(minutes=40, seconds=1))]
    got = o.sessionize(spark.createDataFrame(rows, "id int, t timestamp").withColumn("k", F.lit(1)), ["k"], "t", 1200, "s", "id")
    assert {r["id"]: r["s"] for r in got.collect()} == {0: 0, 1: 0, 2: 1}


def test_keep_first_ambiguous_conflicts_mode(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 4)], "k string, v int")
    assert {(r.k, r.v) for r in o.keep_first(df, ["k"], F.col("v")).collect()} == {("a", 1), ("b", 3), (None, 4)}
    assert {r.k for r in o.drop_ambiguous(df, ["k"]).collect()} == {"b", None}
    assert [r.k for r in o.conflicts(df, "k", "v").collect()] == ["a"]
    names = spark.createDataFrame([("x", "b"), ("x", "a"), ("y", None)], "k string, n string")
    assert {r.k: r.n for r in o.mode_first(names, "k", "n").collect()} == {"x": "a", "y": None}


def test_sequence_ids_follow_the_order(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("h")).repartition(7)
    rows = o.sequence_ids(df, "n", F.col("h")).orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 1001))
    assert [r.h for r in rows] == sorted(r.h for r in rows)


def test_sequence_ids_of_many_wide_rows_written(spark, tmp_path):
    """Wide rows over many tasks, written and read back: exactly 1 to N, in order, no row lost."""
    n = 300_000
    wide = spark.range(n).select(F.xxhash64("id").alias("h"), *(F.sha2((F.col("id") + k).cast("string"), 256).alias(f"c{k}") for k in range(6))).repartition(16)
    o.sequence_ids(wide, "n", F.col("h")).write.parquet(str(tmp_path / "ids"))
    got = spark.read.parquet(str(tmp_path / "ids"))
    assert tuple(got.agg(F.count("*"), F.count_distinct("n"), F.min("n"), F.max("n"), F.count_distinct("h")).first()) == (n, n, 1, n, n)
    ordered = got.select("n", F.lag("h").over(Window.orderBy("n")).alias("before"), "h")
    assert ordered.where("before > h").count() == 0


def test_asof_forward_of_one_long_history(spark):
    """One key with all rows; work is linear, and null keys and times keep their rows."""
    n = 40_000
    left = spark.range(n).select("id", F.when(F.col("id") % 1000 != 7, "a").alias("k"), F.when(F.col("id") % 1000 != 8, F.timestamp_seconds(1_700_000_000 + F.col("id") * 60)).alias("t"))
    right = spark.range(n // 500).select(F.col("id").alias("ord"), F.lit("a").alias("k"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 30_000 + 29_000).alias("r"), F.col("id").alias("trip"))
    got = o.asof_forward(left, right, "k", "t", "r", ["trip"], 3600 * 4, "ord").toPandas().set_index("id")["trip"]
    assert len(got) == n
    for i in (0, 243, 244, 483, 484, 1007, 1008, 25_000, n - 1):
        at = 60 * i
        after = [k for k in range(n // 500) if 30_000 * k + 29_000 >= at]
        want = after[0] if after and 30_000 * after[0] + 29_000 - at <= 3600 * 4 and i % 1000 not in (7, 8) else None
        assert (None if pd.isna(got[i]) else int(got[i])) == want


def test_first_and_last_skip_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "c"), (4, None)], "t int, v string")
    r = df.agg(o.first_not_null("v", F.col("t")).alias("f"), o.last_not_null("v", F.col("t")).alias("l")).first()
    assert (r.f, r.l) == ("b", "c")


def test_lookup_priority_coalesces_each_value(spark):
    left = spark.createDataFrame([(1, "s1", "n1"), (2, "", "n2"), (3, "zz", "zz")], "id int, s string, n string")
    book = spark.createDataFrame([("s1", "n9", "r1", None, 1), ("", "n2", "r2", "v2", 2), ("s3", "n1", "r3", "v3", 3)], "s string, n string, rpa string, vc string, ord int")
    got = o.lookup_priority(left, [("s", book.withColumnRenamed("s", "bs"), "bs"), ("n", book.withColumnRenamed("n", "bn"), "bn")], ["rpa", "vc"], "ord")
    assert {r.id: (r.rpa, r.vc) for r in got.collect()} == {1: ("r1", "v3"), 2: ("r2", "v2"), 3: (None, None)}


def test_frontier(spark):
    days = spark.createDataFrame([(T0.date() + timedelta(days=i), i != 2) for i in range(5)], "day date, ok boolean")
    assert o.frontier(days, "day", "ok").first()[0] == T0.date() + timedelta(days=1)


def test_nearest_point_ties_and_nulls(spark):
    points = [("a", 0.0, 1.0), ("b", 0.0, -1.0)]
    df = spark.createDataFrame([(0.0, 0.0), (None, 0.0)], "y double, x double").select(nearest_point(F.col("y"), F.col("x"), points)["name"].alias("n"))
    assert [r.n for r in df.collect()] == ["a", None]


LAT, LON = g.Axis(-29.0, 1 / 24, 8), g.Axis(-72.0, 1 / 24, 6)


def _field(seed=1, holes=((2, 3), (5, 1))):
    v = np.random.default_rng(seed).random((8, 6))
    for i, j in holes:
        v[i, j] = np.nan
    return v


def _table(spark, v):
    rows = [(T0, i, j, LAT.start + i * LAT.step, LON.start + j * LON.step, None if math.isnan(v[i, j]) else float(v[i, j])) for i in range(8) for j in range(6)]
    return spark.createDataFrame(rows, "time timestamp, i_lat int, i_lon int, latitude double, longitude double, v double")


def test_gradient_equals_numpy(spark):
    v = _field()
    dy = np.gradient(v, axis=0) / (111.195 / 24)
    lat = LAT.start + np.arange(8) * LAT.step
    dx = np.gradient(v, axis=1) / (111.195 / 24 * np.cos(np.radians(lat)))[:, None]
    want = np.hypot(dy, dx)
    for r in g.gradient(_table(spark, v), "v", LAT, LON).collect():
        w = want[r.i_lat, r.i_lon]
        assert (r.gradient is None) == math.isnan(w)
        assert r.gradient is None or r.gradient == pytest.approx(w)


def test_sample_and_fallback(spark):
    v = _field(holes=((2, 3), (2, 2)))
    points = [(1, T0, -29 + 2 / 24, -72 + 3 / 24), (2, T0 + timedelta(days=3), -29.0, -72.0), (3, T0, -40.0, -80.0)]
    got = {r.id: r for r in g.sample(spark.createDataFrame(points, "id int, ts timestamp, latitude double, longitude double"), _table(spark, v), "v", LAT, LON, "id", "ts").collect()}
    near = min(((math.hypot((i - 2), (j - 3) * math.cos(math.radians(29))), i, j) for i in range(8) for j in range(6) if not math.isnan(v[i, j])))
    assert got[1].status == "fallback" and got[1].v == pytest.approx(v[near[1], near[2]])
    assert got[2].status == "fuera_de_rango" and got[2].v is None and got[2].time == T0
    assert got[3].status == "ok" and got[3].v == pytest.approx(v[0, 0])  # beyond the ends: the corner


def test_regrid_on_nodes_and_beside_holes(spark):
    v = _field()
    same = {(r.i_lat, r.i_lon): r.v for r in g.regrid(_table(spark, v), "v", (LAT, LON), (LAT, LON)).collect()}
    assert all(same[i, j] is None if math.isnan(v[i, j]) else same[i, j] == pytest.approx(v[i, j]) for i in range(8) for j in range(6))
    half = (g.Axis(-29.0 + 1 / 48, 1 / 24, 8), g.Axis(-72.0, 1 / 24, 6))
    got = {(r.i_lat, r.i_lon): r.v for r in g.regrid(_table(spark, v), "v", (LAT, LON), half).collect()}
    assert max(i for i, _ in got) == 6  # nothing beyond the source
    assert got[0, 0] == pytest.approx((v[0, 0] + v[1, 0]) / 2) and got[1, 3] is None


def test_coastal_fill_uses_original_values(spark):
    v = np.full((8, 6), np.nan)
    v[0, 0] = 1.0
    got = {(r.i_lat, r.i_lon): r for r in g.coastal_fill(_table(spark, v), ["v"], LAT, LON).collect()}
    assert got[0, 1].v == 1.0 and got[0, 1].coast_filled and not got[0, 0].coast_filled
    assert got[7, 0].v is None  # 32 km away


def test_union_keep_last_and_axes(spark):
    grid = _table(spark, _field()).withColumn("file", F.lit("a")).unionByName(_table(spark, _field(2)).withColumn("file", F.lit("b")))
    assert {r.file for r in g.union_keep_last(grid).select("file").collect()} == {"b"}
    g.check_axes(grid)
    with pytest.raises(ValueError):
        g.check_axes(grid.withColumn("latitude", F.when(F.col("file") == "b", F.col("latitude") + 1).otherwise(F.col("latitude"))))


def test_depth(spark):
    p = spark.createDataFrame([(1, 0.0, 5.0), (1, 10.0, 3.0), (1, 20.0, None)], "k int, depth double, o2 double")
    assert g.depth_min(p, "o2", ["k"]).first().o2 == 3.0
    assert g.depth_nearest(p, "o2", 5.0, ["k"]).first().o2 == 3.0  # a tie goes deeper


def test_fuzzy_match(spark):
    left = spark.createDataFrame([(1, "ROCIO III"), (2, "DANIELA ANDREA"), (3, "GAROTA"), (4, "DON BENITO")], "l int, n string")
    right = spark.createDataFrame([(10, "ROCIO I"), (11, "ROCIO IIII"), (12, "Daniela Andrea"), (13, "DON BENITTO"), (14, "UNLIKE")], "r int, m string")
    got = {r.l: r.r for r in fuzzy_match(left, "l", "n", right, "r", "m").collect()}
    assert got == {1: 11, 2: 12, 4: 13}


def test_fuzzy_match_against_difflib(spark):
    """The bounds lose no pair: as get_close_matches over all names, at two cutoffs."""
    rng = random.Random(8)
    names = sorted({" ".join(rng.choice(["DON", "ROCIO", "MAR", "AZUL", "KALI", "ANA", "SOL", "PEZ", "LUZ", "RAYO"]) for _ in range(rng.randint(1, 3))) for _ in range(150)})
    asked = []
    for i, n in enumerate(names):
        t = list(n)
        for _ in range(rng.choice([1, 1, 2])):
            t[rng.randrange(len(t))] = rng.choice("ABCDEFGHIJKLMNO")
        asked.append((i, "".join(t).strip() or "X"))
    right = list(enumerate(names))
    for cutoff in (0.7, 0.85):
        got = {r.l: (r.r, r.score) for r in fuzzy_match(spark.createDataFrame(asked, "l int, n string"), "l", "n", spark.createDataFrame(right, "r int, m string"), "r", "m", cutoff).collect()}
        want = {}
        for i, n in asked:
            close = difflib.get_close_matches(" ".join(n.split()), names, n=5, cutoff=cutoff)
            if close:
                best = n if n in names else close[0]
                want[i] = (names.index(best), difflib.SequenceMatcher(None, best, " ".join(n.split())).ratio())
        assert got.keys() == want.keys() and len(want) > 40
        assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1]) for i in want)


def test_fuzzy_match_folds_a_name_once_however_many_rows_have_it(spark, monkeypatch):
    rows = spark.range(2000).select("id", F.when(F.col("id") % 50 == 0, "").when(F.col("id") % 2 == 0, "Don Benito").otherwise("Rocio Azul").alias("n"))
    offered = spark.range(1000, 3000).select(F.col("id").alias("other"), F.when(F.col("id") % 2 == 0, "DON BENITTO").otherwise("rocio azul").alias("m"))
    n = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def fold(text):
        n.add(1)
        return None if text is None else text.upper()

    monkeypatch.setattr(match, "vessel_name", fold)
    got = {r.id: (r.other, round(r.score, 3)) for r in fuzzy_match(rows, "id", "n", offered, "other", "m").collect()}
    assert got == {i: (1001, 1.0) if i % 2 else (1000, 0.952) for i in range(2000) if i % 50}
    assert 0 < n.value < 200


def test_best_match(spark):
    pairs = spark.createDataFrame([(1, "ROCIO", "ROCIO I"), (1, "ROCIO", "MARIA"), (2, "ABCDEF", "ABXX")], "k int, a string, b string")
    got = {r.k: (r.b, r.status) for r in best_match(pairs, "k", "a", "b").collect()}
    assert got == {1: ("ROCIO I", "match"), 2: ("ABXX", "match_dudoso")}


def test_html(spark):
    page = "<table><tr><th>h</th></tr><tr><td>1</td><td>a&nbsp;<b>b</b></td></tr></table><td><strong>Eslora:</strong></td><td>12 m</td><td><strong>Eslora</strong></td><td>13</td>"
    df = spark.createDataFrame([("III", page)], "region string, html string")
    assert [tuple(r) for r in html.result_table(df, "html", ["id", "name"]).collect()] == [("III", "1", "a b")]
    assert df.select(html.label_values(F.col("html")).alias("m")).first().m == {"Eslora": "12 m"}
    cells = F.array(*map(F.lit, ["Name", "KALI", "Arte", "Especie", "Fecha", "Tipo", "cerco", "jurel", "01-02-2020", "x", "red", "jibia", "none", "y"]))
    assert spark.range(1).select(html.cell_after(cells, "Name").alias("v")).first().v == "KALI"
    assert spark.range(1).select(html.groups_after(cells, "Arte").alias("v")).first().v == [["cerco", "jurel", "01-02-2020", "x"]]


def test_pivot_like_pandas(spark):
    rows = [("a", "JUREL", 1.0), ("a", "JUREL", 2.0), ("b", "OTHER", 5.0)]
    got = spark.createDataFrame(rows, "k string, s string, w double").groupBy("k").pivot("s", ["JUREL", "BONITO"]).agg(F.sum("w")).na.fill(0.0).toPandas().set_index("k")
    want = pd.DataFrame(rows, columns=list("ksw")).pivot_table(index="k", columns="s", values="w", aggfunc="sum", fill_value=0.0)
    assert got.loc["a", "JUREL"] == want.loc["a", "JUREL"] == 3.0 and got.loc["b", "JUREL"] == 0.0


def test_asof_forward_breaks_ties_by_an_order_of_any_type(spark):
    left = spark.createDataFrame([(1, "v", datetime(2024, 1, 1, 10))], "id int, k string, t timestamp")
    at = datetime(2024, 1, 1, 12)
    right = spark.createDataFrame([("v", at, "b", 2), ("v", at, "a", 1)], "k string, r timestamp, ord string, trip int")
    got = o.asof_forward(left, right, "k", "t", "r", ["trip"], 3600 * 4, "ord").first()
    assert got.trip == 1
