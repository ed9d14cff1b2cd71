"""Driver queries of the fisheries operators over the star-schema test tables, and the same in DuckDB SQL.

Events stand in for position reports and their purchases for landings; places, headings and speeds are worked
out of ids. Thresholds that only make sense for real tracks are parameters and are set for this data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.config import region
from pelagia.functions import geo, text
from pelagia.operators import grid as g
from pelagia.operators import ordered as o
from pelagia.operators import tiles
from pelagia.operators.html import row_cells
from pelagia.operators.match import best_by_variants, fuzzy_match
from pelagia.operators.nearest import nearest_point
from pelagia.operators.quantile import exact_quantiles
from pelagia.operators.quantile import value_counts as counts_of
from pelagia.plans import vms
from pelagia.shared import scratch
from pelagia.sources import grid_store, products

GAP = 720 * 60
POINTS = region("atacama").points
LAT, LON = g.Axis(-29.0, 1 / 24, 24), g.Axis(-72.0, 1 / 24, 20)
_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _r(c: Column | str, n: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def _us(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def _pings(spark: SparkSession, sf: str) -> DataFrame:
    e, i = _t(spark, sf, "events"), F.col("event_id")
    return e.select(
        "event_id", F.col("user_id").alias("vessel"), "ts", (F.lit(-29.0) + (i % 97) / 24.0).alias("latitude"), (F.lit(-72.0) + (i % 49) / 24.0).alias("longitude"),
        ((i * 37) % 360).cast("double").alias("heading"), (((i * 13) % 50) / 10.0).alias("speed_kt"),
    )


def _landings(spark: SparkSession, sf: str) -> DataFrame:
    e = _t(spark, sf, "events").where("event_type = 'purchase'")
    return e.select(F.col("user_id").alias("vessel"), F.col("ts").alias("landed"), F.col("event_id").alias("ord"), F.col("event_id").alias("zarpe_id"))


def _tripped(spark: SparkSession, sf: str) -> DataFrame:
    found = vms.assign_trips(_pings(spark, sf), _landings(spark, sf), "vessel", "ts", "landed")
    return vms.with_steps(vms.with_ports(found, POINTS), at="ts", order="event_id")


def _bouts(spark: SparkSession, sf: str) -> DataFrame:
    return vms.bouts(vms.candidates(_tripped(spark, sf)), at="ts", order="event_id", gap_seconds=GAP)


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return vms.bout_metrics(_bouts(spark, sf), at="ts", order="event_id")


def _hav(a: str, b: str, c: str, d: str) -> str:
    return f"2 * 6371.0 * asin(sqrt(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)))"


_PORT_ROWS = ", ".join(f"({i}, '{n}', {y}::DOUBLE, {x}::DOUBLE)" for i, (n, y, x) in enumerate(POINTS))
_P = """pings AS (SELECT event_id, user_id AS vessel, ts, -29e0 + (event_id % 97) / 24e0 AS latitude, -72e0 + (event_id % 49) / 24e0 AS longitude,
  ((event_id * 37) % 360)::DOUBLE AS heading, ((event_id * 13) % 50) / 10e0 AS speed_kt FROM events)"""
_TRIPS = f"""{_P}, landings AS (SELECT user_id AS vessel, ts AS landed, event_id AS zarpe_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
  FROM events WHERE event_type = 'purchase'),
 nexts AS (SELECT p.*, l.landed, l.zarpe_id, l.prev FROM pings p JOIN landings l ON p.vessel = l.vessel AND l.landed >= p.ts
  QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY l.landed, l.zarpe_id) = 1),
 assigned AS (SELECT * EXCLUDE (landed, prev) FROM nexts WHERE epoch_us(landed) - epoch_us(ts) <= 5 * 86400 * 1000000::BIGINT AND (prev IS NULL OR ts > prev)),
 ports(ord, name, y, x) AS (VALUES {_PORT_ROWS}),
 near AS (SELECT a.*, p.name AS nearest_port, {_hav("a.latitude", "a.longitude", "p.y", "p.x")} AS dist_port_km FROM assigned a CROSS JOIN ports p
  QUALIFY row_number() OVER (PARTITION BY a.event_id ORDER BY {_hav("a.latitude", "a.longitude", "p.y", "p.x")}, p.ord) = 1),
 tripped AS (SELECT *, coalesce({_hav("lag(latitude) OVER w", "lag(longitude) OVER w", "latitude", "longitude")}, 0) AS step_km FROM near WINDOW w AS (PARTITION BY zarpe_id ORDER BY ts, event_id))"""
_TURN = "coalesce(((((heading - lag(heading) OVER {w} + 180) % 360) + 360) % 360) - 180, 0)"
_BOUTS = f"""{_TRIPS}, cand AS (SELECT * FROM tripped WHERE dist_port_km >= 8 AND speed_kt BETWEEN 0.3 AND 4.0),
 cuts AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > {GAP} * 1000000::BIGINT THEN 1 ELSE 0 END AS cut FROM cand WINDOW w AS (PARTITION BY zarpe_id ORDER BY ts, event_id)),
 numbered AS (SELECT *, sum(cut) OVER (PARTITION BY zarpe_id ORDER BY ts, event_id)::BIGINT AS bout FROM cuts),
 bouts AS (SELECT *, coalesce({_hav("lag(latitude) OVER b", "lag(longitude) OVER b", "latitude", "longitude")}, 0) AS bout_km, {_TURN.format(w="b")} AS bout_turn
  FROM numbered WINDOW b AS (PARTITION BY zarpe_id, bout ORDER BY ts, event_id)),
 sums AS (SELECT zarpe_id, bout, abs(sum(bout_turn)) AS net_turn, sum(abs(bout_turn)) AS total_turn, sum(bout_km) AS path_km,
  {_hav("min(latitude)", "min(longitude)", "max(latitude)", "max(longitude)")} AS span_km, count(*) AS n_pings, min(ts) AS haul_start, max(ts) AS haul_end,
  avg(latitude) AS haul_lat, avg(longitude) AS haul_lon, avg(speed_kt) AS haul_mean_speed_kt FROM bouts GROUP BY ALL HAVING count(*) >= 3),
 metrics AS (SELECT *, path_km / greatest(span_km, 0.05) AS compactness, path_km / greatest(span_km, 0.05) >= 1.6 OR (net_turn >= 160 AND path_km / greatest(span_km, 0.05) >= 1.2) AS is_set FROM sums)"""


@_query(f"WITH {_TRIPS} SELECT event_id, zarpe_id FROM assigned")
def trip_assign(spark, sf):
    return vms.assign_trips(_pings(spark, sf), _landings(spark, sf), "vessel", "ts", "landed").select("event_id", "zarpe_id")


@_query(f"""WITH {_TRIPS} SELECT zarpe_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9, 6) AS duration_h,
 count(*) AS n_pings, round(max(dist_port_km), 6) AS max_dist_km, round(sum(step_km), 6) AS track_km, round(avg(speed_kt), 6) AS mean_speed_kt, max(speed_kt) AS max_speed_kt,
 round(avg(latitude), 6) AS centroid_lat, round(avg(longitude), 6) AS centroid_lon, arg_min(nearest_port, (ts, event_id)) AS start_port, arg_max(nearest_port, (ts, event_id)) AS end_port
 FROM tripped GROUP BY zarpe_id""")
def trip_summary(spark, sf):
    s = vms.trip_summary(_tripped(spark, sf), at="ts", order="event_id")
    return s.select(
        "zarpe_id", _us("start_datetime").alias("start_us"), _us("end_datetime").alias("end_us"), _r("duration_h").alias("duration_h"), "n_pings", _r("max_dist_km").alias("max_dist_km"),
        _r("track_km").alias("track_km"), _r("mean_speed_kt").alias("mean_speed_kt"), "max_speed_kt", _r("centroid_lat").alias("centroid_lat"), _r("centroid_lon").alias("centroid_lon"), "start_port", "end_port",
    )


@_query(f"WITH {_BOUTS} SELECT event_id, zarpe_id, bout, round(bout_turn, 6) AS bout_turn FROM bouts")
def bouts(spark, sf):
    return _bouts(spark, sf).select("event_id", "zarpe_id", F.col("bout").cast("long").alias("bout"), _r("bout_turn").alias("bout_turn"))


@_query(f"WITH {_BOUTS} SELECT zarpe_id, bout, round(net_turn, 6) AS net_turn, round(total_turn, 6) AS total_turn, round(path_km, 6) AS path_km, round(span_km, 6) AS span_km, n_pings, is_set FROM metrics")
def bout_metrics(spark, sf):
    m = _metrics(spark, sf)
    return m.select("zarpe_id", F.col("bout").cast("long").alias("bout"), *(_r(c).alias(c) for c in ("net_turn", "total_turn", "path_km", "span_km")), "n_pings", "is_set")


@_query(f"""WITH {_BOUTS} SELECT zarpe_id, bout, round(haul_lat, 6) AS haul_lat, round(haul_lon, 6) AS haul_lon, n_pings, is_set FROM metrics
 QUALIFY row_number() OVER (PARTITION BY zarpe_id ORDER BY is_set DESC, round(compactness, 9) DESC, net_turn DESC, n_pings DESC, haul_start, bout) = 1""")
def haul_pick(spark, sf):
    m = _metrics(spark, sf).withColumn("compactness", _r("compactness", 9))
    return vms.representative(m).select("zarpe_id", F.col("bout").cast("long").alias("bout"), _r("haul_lat").alias("haul_lat"), _r("haul_lon").alias("haul_lon"), "n_pings", "is_set")


@_query(f"WITH {_BOUTS} SELECT zarpe_id, bout, row_number() OVER (PARTITION BY zarpe_id ORDER BY haul_start, bout) AS haul_index FROM metrics WHERE is_set")
def haul_index(spark, sf):
    return vms.haul_index(_metrics(spark, sf)).select("zarpe_id", F.col("bout").cast("long").alias("bout"), F.col("haul_index").cast("long").alias("haul_index"))


@_query(f"""WITH {_BOUTS}, best AS (SELECT * FROM metrics QUALIFY row_number() OVER (PARTITION BY zarpe_id ORDER BY is_set DESC, round(compactness, 9) DESC, net_turn DESC, n_pings DESC, haul_start, bout) = 1),
 sets AS (SELECT zarpe_id, count(*) AS n FROM metrics WHERE is_set GROUP BY 1),
 harbour AS (SELECT zarpe_id, name AS nearest_port, round({_hav("haul_lat", "haul_lon", "y", "x")}, 6) AS haul_dist_port_km FROM best CROSS JOIN ports
  QUALIFY row_number() OVER (PARTITION BY zarpe_id ORDER BY {_hav("haul_lat", "haul_lon", "y", "x")}, ord) = 1)
 SELECT zarpe_id, CASE WHEN is_set THEN 'alta' ELSE 'baja' END AS haul_confidence, coalesce(n, 0)::BIGINT AS n_hauls, CASE WHEN is_set THEN 1.0 ELSE 0.5 END::DOUBLE AS sample_weight, coalesce(n, 0) = 1 AS is_single_haul, nearest_port, haul_dist_port_km
 FROM best LEFT JOIN sets USING (zarpe_id) LEFT JOIN harbour USING (zarpe_id)""")
def haul_model(spark, sf):
    trips = _tripped(spark, sf).select("zarpe_id").distinct()
    m = _metrics(spark, sf).withColumn("compactness", _r("compactness", 9))
    hauls = vms.model_hauls(vms.haul_locations(m, trips, POINTS))
    return hauls.select("zarpe_id", "haul_confidence", F.col("n_hauls").cast("long").alias("n_hauls"), "sample_weight", "is_single_haul", "nearest_port", _r("haul_dist_port_km").alias("haul_dist_port_km"))


@_query(f"""WITH {_BOUTS}, idx AS (SELECT zarpe_id, bout, row_number() OVER (PARTITION BY zarpe_id ORDER BY haul_start, bout) AS haul_index FROM metrics WHERE is_set)
 SELECT t.event_id, CASE WHEN i.haul_index IS NOT NULL THEN 'pesca' WHEN b.event_id IS NOT NULL THEN 'candidato' ELSE 'transito' END AS behavior, (i.haul_index IS NOT NULL)::INT AS is_haul, i.haul_index
 FROM tripped t LEFT JOIN bouts b USING (event_id) LEFT JOIN idx i ON b.zarpe_id = i.zarpe_id AND b.bout = i.bout""")
def ping_behavior(spark, sf):
    out = vms.label_pings(_tripped(spark, sf), _bouts(spark, sf), _metrics(spark, sf), ["event_id"])
    return out.select("event_id", "behavior", "is_haul", F.col("haul_index").cast("long").alias("haul_index"))


def _near_sql(metric: str) -> str:
    return f"""WITH {_P}, ports(ord, name, y, x) AS (VALUES {_PORT_ROWS}) SELECT event_id, name AS port, round({metric}, 6) AS dist FROM pings CROSS JOIN ports
 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY {metric}, ord) = 1"""


@_query(_near_sql(_hav("latitude", "longitude", "y", "x")))
def nearest_port(spark, sf, metric=geo.haversine_km):
    near = nearest_point(F.col("latitude"), F.col("longitude"), POINTS, metric)
    return _pings(spark, sf).select("event_id", near["name"].alias("port"), _r(near["dist"]).alias("dist"))


@_query(_near_sql("pow(y - latitude, 2) + pow((x - longitude) * cos(radians(latitude)), 2)"))
def nearest_port_equirect(spark, sf):
    return nearest_port(spark, sf, geo.equirectangular)


@_query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) = 1")
def dedup_keep_first(spark, sf):
    return o.keep_first(_t(spark, sf, "orders"), ["o_custkey", "o_orderdate"], F.col("o_orderkey")).select("o_custkey", "o_orderkey")


@_query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1")
def dedup_latest(spark, sf):
    return o.keep_first(_t(spark, sf, "orders"), ["o_custkey"], F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")).select("o_custkey", "o_orderkey")


@_query("SELECT o_orderkey FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey, o_orderdate) = 1")
def drop_ambiguous(spark, sf):
    return o.drop_ambiguous(_t(spark, sf, "orders"), ["o_custkey", "o_orderdate"]).select("o_orderkey")


@_query("SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey::VARCHAR, o_orderdate, o_orderkey) AS zarpe_id FROM orders")
def seq_id(spark, sf):
    out = o.sequence_ids(_t(spark, sf, "orders"), "zarpe_id", F.col("o_custkey").cast("string"), F.col("o_orderdate"), F.col("o_orderkey"))
    return out.select("o_orderkey", "zarpe_id")


@_query("SELECT c_nationkey::BIGINT AS port_id, c_mktsegment AS port_name FROM customer UNION SELECT s_nationkey, substr(s_name, 1, 8) FROM supplier")
def ports_union(spark, sf):
    c = _t(spark, sf, "customer").select(F.col("c_nationkey").cast("long").alias("port_id"), F.col("c_mktsegment").alias("port_name"))
    s = _t(spark, sf, "supplier").select(F.col("s_nationkey").cast("long"), F.col("s_name").substr(1, 8))
    return c.union(s).distinct()


@_query("SELECT c_nationkey, count(DISTINCT c_mktsegment) AS n_values FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1")
def id_conflicts(spark, sf):
    return o.conflicts(_t(spark, sf, "customer"), "c_nationkey", "c_mktsegment")


@_query("""WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
 SELECT o_custkey, o_orderpriority FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1""")
def mode_name(spark, sf):
    return o.mode_first(_t(spark, sf, "orders"), "o_custkey", "o_orderpriority")


_WIDE = "SELECT l_orderkey, coalesce(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 0) AS a_tons, coalesce(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 0) AS n_tons, coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 0) AS r_tons FROM lineitem GROUP BY 1"


@_query(_WIDE)
def pivot_catch(spark, sf):
    wide = _t(spark, sf, "lineitem").groupBy("l_orderkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity")).na.fill(0.0)
    return wide.withColumnsRenamed({c: f"{c.lower()}_tons" for c in "ANR"})


@_query(f"SELECT l_orderkey, r_tons, r_tons = greatest(a_tons, n_tons, r_tons) AS principal_catch FROM ({_WIDE}) WHERE r_tons > 0")
def principal_catch(spark, sf):
    wide = pivot_catch(spark, sf).where("r_tons > 0")
    return wide.select("l_orderkey", "r_tons", (F.col("r_tons") == F.greatest("a_tons", "n_tons", "r_tons")).alias("principal_catch"))


@_query("""WITH k AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE lpad(o_custkey::VARCHAR, 9, '0') END AS sign, 'c' || (o_custkey % 700) AS name FROM orders),
 b AS (SELECT lpad(c_custkey::VARCHAR, 9, '0') AS sign, 'c' || (c_custkey % 700) AS name, c_custkey AS rpa, c_mktsegment AS vessel_code FROM customer),
 n AS (SELECT name, arg_max(rpa, rpa) AS rpa, arg_max(vessel_code, rpa) AS vessel_code FROM b GROUP BY 1)
 SELECT o_orderkey, coalesce(b.rpa, n.rpa) AS rpa, coalesce(b.vessel_code, n.vessel_code) AS vessel_code FROM k LEFT JOIN b ON k.sign = b.sign AND k.sign <> '' LEFT JOIN n ON k.name = n.name WHERE coalesce(b.rpa, n.rpa) IS NOT NULL""")
def lookup_priority(spark, sf):
    orders = _t(spark, sf, "orders")
    sign = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    left = orders.select("o_orderkey", sign.alias("sign"), F.concat(F.lit("c"), (F.col("o_custkey") % 700).cast("string")).alias("name"))
    k = F.col("c_custkey")
    book = _t(spark, sf, "customer").select(F.lpad(k.cast("string"), 9, "0").alias("bs"), F.concat(F.lit("c"), (k % 700).cast("string")).alias("bn"), k.alias("rpa"), F.col("c_mktsegment").alias("vessel_code"), k.alias("ord"))
    found = o.lookup_priority(left, [("sign", book, "bs"), ("name", book, "bn")], ["rpa", "vessel_code"], "ord")
    return found.where(F.col("rpa").isNotNull()).select("o_orderkey", "rpa", "vessel_code")


@_query("SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def left_enrich(spark, sf):
    c = _t(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey", "c_name")
    return _t(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name")


@_query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def semi_join(spark, sf):
    done = _t(spark, sf, "orders").where("o_orderstatus = 'F'")
    return _t(spark, sf, "customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@_query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def anti_join(spark, sf):
    return _t(spark, sf, "customer").join(_t(spark, sf, "orders").where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@_query("SELECT coalesce(a.k, b.k) AS k, a.n AS n_f, b.n AS n_o FROM (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a FULL JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b ON a.k = b.k")
def full_outer(spark, sf):
    part = lambda s, n: _t(spark, sf, "orders").where(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias(n))
    return part("F", "n_f").join(part("O", "n_o"), "k", "full")


@_query(f"WITH {_P} SELECT event_id FROM pings WHERE latitude BETWEEN -28.5 AND -26.0 AND longitude BETWEEN -71.5 AND -70.5 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'")
def bbox_daterange(spark, sf):
    p = _pings(spark, sf).where(geo.in_box(F.col("latitude"), F.col("longitude"), (-28.5, -26.0, -71.5, -70.5)))
    return p.where((F.col("ts") >= F.lit("2024-01-05").cast("timestamp")) & (F.col("ts") < F.lit("2024-01-21").cast("timestamp"))).select("event_id")


@_query("""SELECT p_partkey, regexp_replace(regexp_replace(upper(p_name), '\\(.*?\\)', '', 'g'), '[^A-Z0-9]', '', 'g') AS name_key, regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits,
 nullif(regexp_extract(p_size || ' - ' || p_type, '^\\s*(\\d+)\\s*-\\s*(.*?)\\s*$', 1), '') AS code, nullif(regexp_extract(p_size || ' - ' || p_type, '^\\s*(\\d+)\\s*-\\s*(.*?)\\s*$', 2), '') AS name FROM part""")
def text_norm(spark, sf):
    code, name = text.split_code(F.concat(F.col("p_size").cast("string"), F.lit(" - "), F.col("p_type")))
    return _t(spark, sf, "part").select("p_partkey", text.name_key(F.col("p_name")).alias("name_key"), text.digits(F.col("p_brand")).alias("digits"), code.alias("code"), name.alias("name"))


@_query("SELECT doc_id, md5(regexp_replace(lower(trim(text, ' ')), '[^\\x00-\\x7f]+', '?', 'g')) AS folded FROM documents")
def text_fold(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.md5(text.skeleton(F.col("text"))).alias("folded"))


@_query("SELECT o_orderkey, printf('%X', o_orderkey + 5) AS cod_barco, o_orderkey AS vessel_code FROM orders")
def hex_code(spark, sf):
    out = _t(spark, sf, "orders").select("o_orderkey", text.code_to_hex(F.col("o_orderkey")).alias("cod_barco"))
    return out.withColumn("vessel_code", text.hex_to_code(F.col("cod_barco")))


@_query("SELECT event_id, round(-(floor(v / 10000) + floor((v % 10000) / 100) / 60 + (v % 100) / 3600), 9) AS degrees FROM (SELECT event_id, (270000 + (event_id % 60) * 100 + event_id % 59)::DOUBLE AS v FROM events)")
def ddmmss(spark, sf):
    v = 270000 + (F.col("event_id") % 60) * 100 + F.col("event_id") % 59
    return _t(spark, sf, "events").select("event_id", _r(geo.sexagesimal(v), 9).alias("degrees"))


@_query("""WITH d AS (SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2000-01-06 18:14:00')) / 86400000000e0 / 29.530588853e0 AS p FROM events)
 SELECT event_id, round((1 - cos(2 * pi() * (p - floor(p)))) / 2, 6) AS moon FROM d""")
def moon(spark, sf):
    return _t(spark, sf, "events").select("event_id", _r(geo.moon_illumination(F.col("ts"))).alias("moon"))


@_query(f"WITH {_P} SELECT event_id, {_TURN.format(w='(PARTITION BY vessel ORDER BY ts, event_id)')} AS turn FROM pings")
def circ_delta(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("vessel").orderBy("ts", "event_id")
    return _pings(spark, sf).select("event_id", F.coalesce(geo.circular_delta(F.col("heading"), F.lag("heading").over(w)), F.lit(0.0)).alias("turn"))


@_query("""WITH m AS (SELECT l_orderkey, l_returnflag AS f, string_agg(DISTINCT l_linenumber::VARCHAR, ',' ORDER BY l_linenumber::VARCHAR) AS ids FROM lineitem GROUP BY 1, 2)
 SELECT l_orderkey, string_agg(f || ':' || ids, '|' ORDER BY f) AS packed FROM m GROUP BY 1""")
def gear_map(spark, sf):
    m = _t(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.array_sort(F.collect_set(F.col("l_linenumber").cast("string"))).alias("ids"))
    packed = m.groupBy("l_orderkey").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("l_returnflag", "ids")))).alias("m"))
    once = packed.select("l_orderkey", text.encode_gears(F.col("m")).alias("p"))
    return once.select("l_orderkey", text.encode_gears(text.decode_gears(F.col("p"))).alias("packed"))


@_query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) = 1 AND min(l_linenumber) = 1")
def exclusive_gear(spark, sf):
    return gear_map(spark, sf).where(text.only_gear(text.decode_gears(F.col("packed")), "1")).select("l_orderkey")


@_query("""SELECT page_id, len(rows)::BIGINT AS n_rows, coalesce(list_sum(list_transform(rows, lambda r: len(regexp_extract_all(r, '(?s)<td[^>]*>(.*?)</td>', 1)))), 0)::BIGINT AS n_cells
 FROM (SELECT page_id, regexp_extract_all(html, '(?s)<tr[^>]*>(.*?)</tr>', 1) AS rows FROM pages)""")
def html_cells(spark, sf):
    rows = _t(spark, sf, "pages").select("page_id", row_cells(F.col("html")).alias("rows"))
    return rows.select("page_id", F.size("rows").cast("long").alias("n_rows"), F.aggregate("rows", F.lit(0).cast("long"), lambda a, r: a + F.size(r)).alias("n_cells"))


@_query("""SELECT page_id, i AS place, md5(trim(replace(regexp_replace(items[i], '<[^>]+>', '', 'g'), '&nbsp;', ' '), ' ')) AS item
 FROM (SELECT page_id, items, unnest(range(1, len(items) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s)<(?:li|p|h1)>(.*?)</(?:li|p|h1)>', 1) AS items FROM pages))""")
def html_items(spark, sf):
    items = F.regexp_extract_all(F.col("html"), F.lit(r"(?s)<(?:li|p|h1)>(.*?)</(?:li|p|h1)>"), F.lit(1))
    rows = _t(spark, sf, "pages").select("page_id", F.posexplode(items).alias("k", "raw"))
    return rows.select("page_id", (F.col("k") + 1).cast("long").alias("place"), F.md5(text.strip_tags(F.col("raw"))).alias("item"))


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    """A dense field for every day that has events: a cell's largest value, none on land or where nothing happened."""
    e, i = _t(spark, sf, "events"), F.col("event_id")
    seen = e.groupBy(F.to_date("ts").alias("day"), (i % 24).cast("int").alias("i_lat"), (F.floor(i / 24) % 20).cast("int").alias("i_lon")).agg(F.max("value").alias("v"))
    days = e.select(F.to_date("ts").alias("day")).distinct()
    dense = g.cells(spark, LAT, LON).crossJoin(F.broadcast(days)).join(seen, ["day", "i_lat", "i_lon"], "left")  # every cell has a row each day
    sea = (F.col("i_lon") < 14) & ((F.col("i_lat") * 5 + F.col("i_lon") * 3) % 11 != 0)
    return dense.select(F.col("day").cast("string").alias("day"), F.col("day").cast("timestamp").alias("time"), "i_lat", "i_lon", "latitude", "longitude", F.when(sea, 280.0 + F.col("v")).alias("sst"))


_GRID = """grid AS MATERIALIZED (SELECT d.day::VARCHAR AS day, d.day::TIMESTAMP AS time, i.range::INT AS i_lat, j.range::INT AS i_lon, -29e0 + i.range / 24e0 AS latitude, -72e0 + j.range / 24e0 AS longitude,
 CASE WHEN j.range < 14 AND (i.range * 5 + j.range * 3) % 11 <> 0 THEN 280e0 + e.v END AS sst FROM (SELECT DISTINCT ts::DATE AS day FROM events) d CROSS JOIN range(24) i CROSS JOIN range(20) j
 LEFT JOIN (SELECT ts::DATE AS day, event_id % 24 AS a, event_id // 24 % 20 AS b, max(value) AS v FROM events GROUP BY ALL) e ON e.day = d.day AND e.a = i.range AND e.b = j.range)"""
_AT = f"""{_P}, {_GRID}, days AS (SELECT DISTINCT time FROM grid),
 placed AS MATERIALIZED (SELECT p.event_id, p.ts, p.latitude, p.longitude, d.time, least(greatest(floor((p.latitude + 29e0) * 24e0 + 0.5), 0), 23)::INT AS i_lat, least(greatest(floor((p.longitude + 72e0) * 24e0 + 0.5), 0), 19)::INT AS i_lon,
  abs(epoch_us(d.time) - epoch_us(p.ts)) <= 2 * 86400 * 1000000::BIGINT AS in_range FROM pings p CROSS JOIN days d QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(d.time) - epoch_us(p.ts)), d.time DESC) = 1)"""


def _reach(name: str, points: str, cells: str, value: str, by: str = "time") -> str:
    """The nearest cell with a value within 25 km of the points that lack it; only cells in a box around them are measured."""
    d = f"round({_hav('c.latitude', 'c.longitude', 'v.latitude', 'v.longitude')}, 9)"
    return f"""{name} AS MATERIALIZED (SELECT c.*, v.{value} AS near, {d} AS dist FROM {points} c JOIN (SELECT * FROM {cells} WHERE {value} IS NOT NULL) v ON v.{by} = c.{by} AND v.i_lat BETWEEN c.i_lat - 6 AND c.i_lat + 6 AND v.i_lon BETWEEN c.i_lon - 7 AND c.i_lon + 7
  WHERE c.{value} IS NULL AND {d} <= 25 QUALIFY row_number() OVER (PARTITION BY c.key ORDER BY {d}, v.i_lat, v.i_lon) = 1)"""


@_query(f"""WITH {_AT}, cell AS MATERIALIZED (SELECT p.*, p.event_id AS key, g.sst FROM placed p JOIN grid g ON g.time = p.time AND g.i_lat = p.i_lat AND g.i_lon = p.i_lon WHERE in_range), {_reach("f", "cell", "grid", "sst")}
 SELECT c.event_id, round(coalesce(c.sst, f.near), 6) AS sst, CASE WHEN c.sst IS NULL THEN 'fallback' ELSE 'ok' END AS status FROM cell c LEFT JOIN f USING (event_id)
 UNION ALL SELECT event_id, NULL, 'fuera_de_rango' FROM placed WHERE NOT in_range""")
def grid_sample(spark, sf):
    points = _pings(spark, sf).select("event_id", "ts", "latitude", "longitude")
    return tiles.sample(points, _grid(spark, sf), [tiles.Field("sst", "sst")], LAT, LON, "event_id", "ts").select("event_id", _r("sst").alias("sst"), F.col("status_sst").alias("status"))


@_query(_SQL["grid_sample"])
def stored_grid_sample(spark, sf):
    """grid_sample from a store by day, made of two overlapping files of which the later one is right."""
    field = _grid(spark, sf).drop("day")
    files = field.withColumns({"file": F.lit("2023"), "sst": F.col("sst") - 100}).unionByName(field.withColumn("file", F.lit("2024")))
    kept = grid_store.store(grid_store.merged(files, LAT, LON), scratch(spark))
    points = _pings(spark, sf).select("event_id", "ts", "latitude", "longitude")
    return tiles.sample(points, kept, [tiles.Field("sst", "sst")], LAT, LON, "event_id", "ts").select("event_id", _r("sst").alias("sst"), F.col("status_sst").alias("status"))


@_query(f"""WITH {_GRID}, s AS (SELECT *, lag(sst) OVER a AS u0, lead(sst) OVER a AS u1, lag(sst) OVER b AS w0, lead(sst) OVER b AS w1 FROM grid WINDOW a AS (PARTITION BY time, i_lon ORDER BY i_lat), b AS (PARTITION BY time, i_lat ORDER BY i_lon)),
 d AS (SELECT *, CASE i_lat WHEN 0 THEN u1 - sst WHEN 23 THEN sst - u0 ELSE (u1 - u0) / 2 END / (111.195e0 / 24e0) AS dy, CASE i_lon WHEN 0 THEN w1 - sst WHEN 19 THEN sst - w0 ELSE (w1 - w0) / 2 END / (111.195e0 / 24e0 * cos(radians(latitude))) AS dx FROM s)
 SELECT day, i_lat, i_lon, round(sqrt(dy * dy + dx * dx), 6) AS gradient FROM d""")
def grid_gradient(spark, sf):
    return tiles.gradient(_grid(spark, sf), "sst", LAT, LON, by="day").select("day", "i_lat", "i_lon", _r("gradient").alias("gradient"))


@_query(f"""WITH {_GRID}, t AS (SELECT i.range::INT AS t_lat, j.range::INT AS t_lon, i.range * 0.4e0 AS y, j.range * 0.7e0 AS x FROM range(60) i, range(30) j WHERE i.range * 4 <= 230 AND j.range * 7 <= 190),
 e AS (SELECT t_lat, t_lon, a.o AS oy, b.o AS ox, CASE a.o WHEN 0 THEN 1 - (y - floor(y)) ELSE y - floor(y) END AS wy, CASE b.o WHEN 0 THEN 1 - (x - floor(x)) ELSE x - floor(x) END AS wx, floor(y + 1e-9)::INT + a.o AS ci, floor(x + 1e-9)::INT + b.o AS cj,
  abs(y - round(y)) < 1e-9 AS ey, abs(x - round(x)) < 1e-9 AS ex FROM t, (VALUES (0), (1)) a(o), (VALUES (0), (1)) b(o)),
 k AS (SELECT t_lat, t_lon, ci, cj, CASE WHEN ey THEN 1 - oy ELSE wy END * CASE WHEN ex THEN 1 - ox ELSE wx END AS w FROM e)
 SELECT g.day, k.t_lat AS i_lat, k.t_lon AS i_lon, round(CASE WHEN count(*) = count(g.sst) THEN sum(k.w * g.sst) END, 6) AS sst FROM k JOIN grid g ON g.i_lat = k.ci AND g.i_lon = k.cj WHERE k.w > 0 GROUP BY 1, 2, 3""")
def regrid(spark, sf):
    target = (g.Axis(-29.0, 0.4 / 24, 60), g.Axis(-72.0, 0.7 / 24, 30))
    return tiles.regrid(_grid(spark, sf), "sst", (LAT, LON), target, by="day").select("day", "i_lat", "i_lon", _r("sst").alias("sst"))


@_query(f"""WITH {_GRID}, cell AS MATERIALIZED (SELECT *, (day, i_lat, i_lon) AS key FROM grid), {_reach("f", "cell", "grid", "sst", "day")}
 SELECT h.day, h.i_lat, h.i_lon, f.near IS NOT NULL AS coast_filled, round(coalesce(h.sst, f.near), 6) AS sst FROM grid h LEFT JOIN f USING (day, i_lat, i_lon)""")
def coastal_fill(spark, sf):
    return tiles.coastal_fill(_grid(spark, sf), ["sst"], LAT, LON, by="day").select("day", "i_lat", "i_lon", "coast_filled", _r("sst").alias("sst"))


@_query("SELECT l_orderkey, min(l_quantity) AS l_quantity FROM lineitem GROUP BY 1")
def depth_min(spark, sf):
    return g.depth_min(_t(spark, sf, "lineitem"), "l_quantity", ["l_orderkey"])


@_query("SELECT l_orderkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY abs(l_linenumber - 2.5), -l_linenumber, l_quantity) = 1")
def depth_nearest(spark, sf):
    one = _t(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("l_quantity"))
    return g.depth_nearest(one.withColumnRenamed("l_linenumber", "depth"), "l_quantity", 2.5, ["l_orderkey"])


@_query("SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.5), 6) AS median, round(quantile_cont(o_totalprice, 0.9), 6) AS p90 FROM orders GROUP BY 1")
def quantiles(spark, sf):
    found = exact_quantiles(_t(spark, sf, "orders"), ["o_orderstatus"], "o_totalprice", {"median": 0.5, "p90": 0.9})
    return found.select("o_orderstatus", _r("median").alias("median"), _r("p90").alias("p90"))


@_query("SELECT year(o_orderdate)::INT AS ano, n_name AS region, round(sum(o_totalprice), 2) AS toneladas FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE year(o_orderdate) BETWEEN 1994 AND 1996 AND lower(n_name) IN (SELECT lower(n_name) FROM nation WHERE n_regionkey = 2) GROUP BY 1, 2")
def landings_filter(spark, sf):
    from pelagia.plans.landings import filter_landings

    n = _t(spark, sf, "nation")
    names = tuple(r[0] for r in n.where("n_regionkey = 2").select("n_name").collect())  # a region's few nations
    rows = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.year("o_orderdate").alias("ano"), F.col("n_name").alias("region"), F.col("o_totalprice").alias("toneladas"))
    return filter_landings(rows, names, 1994, 1996).groupBy("ano", "region").agg(_r(F.sum("toneladas"), 2).alias("toneladas"))


@_query(None)
def best_person(spark, sf):
    """Part names as people, surname first, some accented, cut short or with other given names, looked up among all part names by variants of the surname."""
    p, k = _t(spark, sf, "part"), F.col("p_partkey") % 5
    word, rest = F.substring_index("p_name", " ", 1), F.regexp_replace("p_name", "^[^ ]+", "")
    cut, other = F.regexp_replace(word, ".$", ""), F.concat(F.lit(" "), F.reverse(rest))
    changed = F.when(k == 0, F.concat(cut, rest)).when(k == 1, F.concat(F.translate(word, "aeo", "áéó"), rest)).when(k == 2, F.concat(word, other)).when(k == 3, F.concat(F.lit("z"), word, rest)).otherwise(F.col("p_name"))
    got = best_by_variants(p.select("p_partkey", changed.alias("said")), "p_partkey", "said", p.select(F.col("p_partkey").alias("found"), "p_name"), "found", "p_name")
    return got.select("p_partkey", "query", "n_found", "found", "p_name", _r("score").alias("score"), "status")


@_query(None)
def fuzzy_names(spark, sf):
    """Every part's name with its second letter lost, against the whole catalogue of names."""
    p = _t(spark, sf, "part").select("p_partkey", F.concat(F.substring("p_name", 1, 1), F.expr("substring(p_name, 3)")).alias("written"), "p_name")
    return fuzzy_match(p, "p_partkey", "written", p.select(F.col("p_partkey").alias("other"), "p_name"), "other", "p_name")


@_query("SELECT count(*) AS n, round(min(value), 6) AS low, round(max(value), 6) AS high, round(avg(value), 4) AS mean FROM events")
def run_report(spark, sf):
    r = products.report(_t(spark, sf, "events"), ["value"])
    return r.select("n", _r("low").alias("low"), _r("high").alias("high"), _r("mean", 4).alias("mean"))


@_query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, sf):
    return counts_of(_t(spark, sf, "events"), "event_type")


@_query("WITH d AS (SELECT range::DATE AS day FROM range(DATE '2024-01-01', DATE '2024-03-01', INTERVAL 1 DAY)), e AS (SELECT DISTINCT ts::DATE AS day FROM events) SELECT (min(d.day) - 1)::VARCHAR AS frontier FROM d LEFT JOIN e USING (day) WHERE e.day IS NULL")
def frontier(spark, sf):
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-02-29')) AS day")
    seen = _t(spark, sf, "events").select(F.to_date("ts").alias("day")).distinct().withColumn("seen", F.lit(True))
    rows = days.join(seen, "day", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
    return o.frontier(rows, "day", "seen").select(F.col("frontier").cast("string").alias("frontier"))


def queries() -> dict:
    from pelagia.plans import driver_more  # noqa: F401  adds its queries

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from pelagia.plans import driver_more  # noqa: F401

    return dict(_SQL)
