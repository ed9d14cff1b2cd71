"""More driver queries: whole plans and records over the star-schema test tables, with the same in DuckDB SQL.

Raw text is written out of table columns in the queries and read back by the plans; SQL takes the columns themselves.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pelagia.functions import geo, text
from pelagia.operators import grid as g
from pelagia.operators import html
from pelagia.operators import ordered as o
from pelagia.plans import catch, driver, observers, ocean, registry, summaries, vms
from pelagia.plans.driver import _AT, _GRID, _SQL, LAT, LON, _grid, _hav, _pings, _query, _r, _reach, _t, _us
from pelagia.sources import csv_daily, products, records

_VESSELS = "ARRAY['KALI', 'Don Beníto II', 'ROCIO - III', 'Pía-Kata  X', 'ÑANDÚ 12']"


@_query("""SELECT event_id, epoch_us(date_trunc('second', ts)) AS us, round(-29e0 + (event_id % 97) / 24e0, 5) AS latitude, CASE WHEN event_id % 7 <> 0 THEN ((event_id * 37) % 360)::DOUBLE END AS heading, round((event_id * 13) % 50 / 10e0, 2) AS speed_kt
 FROM events WHERE event_id % 11 <> 0 AND round(-29e0 + (event_id % 97) / 24e0, 5) BETWEEN -29.0 AND -26.0""")
def clean_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Reports as text with units, some unreadable, cleaned: every eleventh has no place, every seventh no readable heading."""
    p, i = _pings(spark, sf), F.col("event_id")
    raw = p.select(
        "event_id", F.lit("x").alias("vessel_name"), F.date_format("ts", "d/M/yyyy H:m:s").alias("location_datetime"),
        F.when(i % 11 == 0, "").otherwise(F.concat(F.format_string("%.5f", F.col("latitude")), F.lit("°"))).alias("latitude"),
        F.lit(" -71.5").alias("longitude"), F.when(i % 7 == 0, "n/a").otherwise(F.col("heading").cast("string")).alias("heading"),
        F.format_string("%.2f kt", F.col("speed_kt")).alias("speed_kt"),
    )
    got = vms.clean(raw, (-29.0, -26.0, -72.0, -71.0))
    return got.select("event_id", _us("location_datetime").alias("us"), "latitude", "heading", "speed_kt")


@_query("SELECT event_id FROM events QUALIFY row_number() OVER (PARTITION BY CASE WHEN user_id % 5 = 0 THEN '' ELSE user_id::VARCHAR END, ts::DATE ORDER BY event_type, event_id) = 1")
def consolidate(spark, sf):
    """A report a sign and day, the first file's; a sign that is missing equals an empty one."""
    e = _t(spark, sf, "events")
    sign = F.when(F.col("user_id") % 10 == 0, F.lit(None).cast("string")).when(F.col("user_id") % 5 == 0, "").otherwise(F.col("user_id").cast("string"))
    raw = e.select("event_id", sign.alias("radio_call_sign"), F.to_date("ts").cast("string").alias("location_datetime"), F.col("event_type").alias("file"), F.col("event_id").alias("ord"))
    return vms.consolidate(raw).select("event_id")


_CATCH = """w AS (SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS jm, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS an, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS sa FROM lineitem GROUP BY 1),
 c AS (SELECT w.*, o_custkey::VARCHAR AS vessel_code, o_orderdate AS landed, o_orderkey::VARCHAR AS cod, o_orderpriority AS port FROM w JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderdate >= TIMESTAMP '1994-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH')),
 p AS (SELECT *, coalesce(jm = greatest(jm, an, sa), FALSE) AS principal_catch FROM c)"""


def _catch(spark: SparkSession, sf: str, scope: str) -> DataFrame:
    """Orders as landings, returned goods as jack mackerel, the others as anchovy and sardine."""
    line, order = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    of = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")))
    tons = {"JACK_MACKEREL": of("R"), "ANCHOVY": of("A"), "SARDINE": of("N")}
    none = {s: F.lit(None).cast("double") for s in catch.SPECIES if s not in tons}
    wide = line.groupBy("l_orderkey").agg(*(v.alias(k) for k, v in tons.items())).withColumns(none).join(order, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = wide.select(F.col("o_custkey").cast("string").alias("vessel_code"), F.col("o_orderdate").alias("LANDING_DATETIME"), F.col("o_orderkey").cast("string").alias("COD_BARCO"), F.col("o_orderpriority").alias("PORT"), *catch.SPECIES)
    return catch.filter_catch(rows, ("1-URGENT", "2-HIGH"), date(1994, 1, 1), date(1996, 12, 31), scope)


@_query(f"WITH {_CATCH} SELECT cod, jm AS jack_mackerel, principal_catch FROM p WHERE jm > 0")
def catch_of_interest(spark, sf):
    rows = _catch(spark, sf, "jurel")
    return rows.select(F.col("COD_BARCO").alias("cod"), F.col("JACK_MACKEREL").alias("jack_mackerel"), F.col("PRINCIPAL_CATCH").alias("principal_catch"))


@_query(f"""WITH {_CATCH}, n AS (SELECT c_custkey::VARCHAR AS vessel_code, c_name AS vessel_name FROM customer)
 SELECT row_number() OVER (ORDER BY landed, vessel_code, cod) AS zarpe_id, cod AS cod_barco, vessel_name, jm AS jack_mackerel_tons, an AS anchovy_tons, sa AS sardine_tons, principal_catch
 FROM p LEFT JOIN n USING (vessel_code) WHERE greatest(jm, an, sa) > 0""")
def trip_spine(spark, sf):
    names = _t(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("vessel_code"), F.col("c_name").alias("vessel_name"))
    out = catch.trip_spine(_catch(spark, sf, "all"), names)
    return out.select("zarpe_id", "cod_barco", "vessel_name", "jack_mackerel_tons", "anchovy_tons", "sardine_tons", "principal_catch")


@_query("""SELECT printf('%X', o_custkey + 5) AS cod_barco, epoch_us(o_orderdate) AS us, CASE o_orderpriority[1] WHEN '1' THEN 3 WHEN '2' THEN 14 WHEN '3' THEN 8 ELSE 0 END AS region, o_custkey::VARCHAR AS vessel_code,
 sum(CASE WHEN l_returnflag = 'R' AND l_linenumber <> 7 THEN l_quantity ELSE 0 END) AS jack_mackerel, sum(CASE WHEN l_returnflag = 'A' AND l_linenumber <> 7 THEN l_quantity ELSE 0 END) AS squid
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F' AND l_returnflag <> 'N' GROUP BY ALL""")
def logbook_long(spark, sf):
    """Line items as rows of a long logbook: open ones as another fleet, N as a species that is not known, seventh lines with a weight that is no number."""
    line, order = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    place = F.create_map(*(F.lit(x) for x in ("1", "Región de Atacama", "2", "Región de Los Rios", "3", "BIOBIO")))
    raw = line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit(" "), F.hex(F.col("o_custkey") + 5)).alias("BARCO"), F.date_format("o_orderdate", "d-M-yyyy H:m:s").alias("FECHA_HORA_RECALADA"),
        F.lit("puerto o'higgins").alias("PUERTO_DE_RECALADA"), F.coalesce(F.try_element_at(place, F.substring("o_orderpriority", 1, 1)), F.lit("?")).alias("REGION"),
        F.when(F.col("l_linestatus") == "F", " Artesanal").otherwise("INDUSTRIAL").alias("FLOTA"),
        F.when(F.col("l_returnflag") == "R", "jurel").when(F.col("l_returnflag") == "A", "JIBIA ").otherwise("otra").alias("ESPECIE"),
        F.when(F.col("l_linenumber") == 7, "x").otherwise(F.col("l_quantity").cast("string")).alias("PESO"),
    )
    got = catch.clean_long(raw)
    return got.select(F.col("COD_BARCO").alias("cod_barco"), _us("LANDING_DATETIME").alias("us"), F.col("REGION").alias("region"), "vessel_code", F.col("JACK_MACKEREL").alias("jack_mackerel"), F.col("SQUID").alias("squid"))


@_query("""SELECT o_orderkey, epoch_us(date_trunc('minute', d)) AS minutes_us, epoch_us(d) AS seconds_us, d::DATE::VARCHAR AS day, strftime(d, '%Y-%m-%d %H:%M:%S') AS iso
 FROM (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS d FROM orders)""")
def date_formats(spark, sf):
    """The input formats of dates, written and read back, and ISO text at the sink."""
    d = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400 * 1_000_000)
    rows = _t(spark, sf, "orders").select("o_orderkey", d.alias("d"))
    read = lambda form: F.try_to_timestamp(F.date_format("d", form), F.lit(form))
    out = rows.select("o_orderkey", F.unix_micros(read("M/d/yyyy H:m")).alias("minutes_us"), F.unix_micros(read("d-M-yyyy H:m:s")).alias("seconds_us"), read("d-M-yyyy").cast("date").alias("day"), F.col("d").alias("iso"))
    return products.iso_times(out)


@_query(f"""WITH n AS (SELECT s_suppkey, {_VESSELS}[1 + s_suppkey % 5] AS name FROM supplier),
 f AS (SELECT *, trim(regexp_replace(replace(upper(strip_accents(name)), '-', ' '), '\\s+', ' ', 'g')) AS vessel_name FROM n)
 SELECT s_suppkey, vessel_name, lower(trim(regexp_replace(strip_accents(name), '\\s+', ' ', 'g'))) AS folded, CASE s_suppkey % 5 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 10 WHEN 4 THEN 12 END AS ordinal FROM f""")
def vessel_names(spark, sf):
    name = F.get(F.array(*map(F.lit, ("KALI", "Don Beníto II", "ROCIO - III", "Pía-Kata  X", "ÑANDÚ 12"))), (F.col("s_suppkey") % 5).cast("int"))
    rows = _t(spark, sf, "supplier").select("s_suppkey", name.alias("name"))
    full = text.vessel_name(F.col("name"))
    return rows.select("s_suppkey", full.alias("vessel_name"), text.folded(F.col("name")).alias("folded"), text.ordinal_suffix(full).alias("ordinal"))


@_query("SELECT o_orderkey, round_even(o_totalprice / 7e0 * 1e3, 0) / 1e3 AS three, round_even(o_totalprice / 8e0 * 1e1, 0) / 1e1 AS one FROM orders")
def rounding(spark, sf):
    price = F.col("o_totalprice")
    return _t(spark, sf, "orders").select("o_orderkey", geo.scaled_round(price / 7, 3).alias("three"), geo.scaled_round(price / 8, 1).alias("one"))


_GRAD = """g2 AS MATERIALIZED (SELECT *, lag(sst) OVER a AS u0, lead(sst) OVER a AS u1, lag(sst) OVER b AS w0, lead(sst) OVER b AS w1 FROM grid WINDOW a AS (PARTITION BY time, i_lon ORDER BY i_lat), b AS (PARTITION BY time, i_lat ORDER BY i_lon)),
 g3 AS MATERIALIZED (SELECT time, i_lat, i_lon, latitude, longitude, sst, sqrt(pow(CASE i_lat WHEN 0 THEN u1 - sst WHEN 23 THEN sst - u0 ELSE (u1 - u0) / 2 END / (111.195e0 / 24e0), 2)
  + pow(CASE i_lon WHEN 0 THEN w1 - sst WHEN 19 THEN sst - w0 ELSE (w1 - w0) / 2 END / (111.195e0 / 24e0 * cos(radians(latitude))), 2)) AS front FROM g2)"""


@_query(f"""WITH {_AT}, {_GRAD}, cell AS MATERIALIZED (SELECT p.*, p.event_id AS key, g.sst, g.front, {_hav("p.latitude", "p.longitude", "g.latitude", "g.longitude")} AS here FROM placed p JOIN g3 g ON g.time = p.time AND g.i_lat = p.i_lat AND g.i_lon = p.i_lon WHERE in_range),
 {_reach("s", "cell", "g3", "sst")}, {_reach("t", "cell", "g3", "front")}
 SELECT c.event_id, round(coalesce(c.sst, s.near) - 273.15, 6) AS sst_c, round(coalesce(c.front, t.near), 6) AS front, CASE WHEN c.sst IS NULL OR c.front IS NULL THEN 'fallback' ELSE 'ok' END AS env_status,
  round_even(greatest(coalesce(CASE WHEN c.sst IS NULL THEN s.dist ELSE c.here END, 0), coalesce(CASE WHEN c.front IS NULL THEN t.dist ELSE c.here END, 0)) * 1e3, 0) / 1e3 AS dist FROM cell c LEFT JOIN s USING (event_id) LEFT JOIN t USING (event_id)
 UNION ALL SELECT event_id, NULL, NULL, 'fuera_de_rango', 0 FROM placed WHERE NOT in_range""")
def haul_environment(spark, sf):
    """Events as hauls: a value and a front of one field, the worst status of both, the farther distance."""
    hauls = _pings(spark, sf).select(F.col("event_id").alias("zarpe_id"), F.col("ts").alias("haul_start"), F.col("latitude").alias("haul_lat"), F.col("longitude").alias("haul_lon"))
    samplers = (ocean.Sampler("sst_c", "sst", "sst", change=geo.kelvin_to_celsius), ocean.Sampler("front", "sst", "sst", front=True))
    got = ocean.haul_environment(hauls, {"sst": _grid(spark, sf)}, LAT, LON, samplers=samplers)
    return got.select(F.col("zarpe_id").alias("event_id"), _r("sst_c").alias("sst_c"), _r("front").alias("front"), "env_status", F.col("env_cell_dist_km").alias("dist"))


@_query(f"""WITH {_GRID}, b AS (SELECT time, i_lat, i_lon, latitude, longitude, sst - 273.15 AS p, CASE WHEN (i_lat + i_lon) % 4 <> 0 AND i_lon < 17 THEN 1e0 + i_lat / 10e0 END AS q, (day, i_lat, i_lon) AS key FROM grid),
 k AS MATERIALIZED (SELECT * FROM b WHERE p IS NOT NULL OR q IS NOT NULL), {_reach("fp", "k", "k", "p")}, {_reach("fq", "k", "k", "q")}
 SELECT k.time::DATE::VARCHAR AS day, k.i_lat, k.i_lon, round(coalesce(k.p, fp.near), 6) AS p, round(coalesce(k.q, fq.near), 6) AS q, k.p IS NULL OR k.q IS NULL AS coast_filled
 FROM k LEFT JOIN fp USING (time, i_lat, i_lon) LEFT JOIN fq USING (time, i_lat, i_lon) WHERE coalesce(k.p, fp.near) IS NOT NULL AND coalesce(k.q, fq.near) IS NOT NULL""")
def forecast_grid(spark, sf):
    """Two layers with masks of their own side by side, cells without anything dropped, gaps near values filled."""
    base = _grid(spark, sf)
    physics = base.select("time", "i_lat", "i_lon", (F.col("sst") - 273.15).alias("p"))
    biology = base.select("time", "i_lat", "i_lon", F.when(((F.col("i_lat") + F.col("i_lon")) % 4 != 0) & (F.col("i_lon") < 17), 1.0 + F.col("i_lat") / 10).alias("q"))
    out = ocean.forecast_grid(physics, biology, LAT, LON, ("p", "q"))
    return out.select(F.to_date("time").cast("string").alias("day"), "i_lat", "i_lon", _r("p").alias("p"), _r("q").alias("q"), "coast_filled")


@_query("""WITH w AS (SELECT c_custkey::VARCHAR AS rpa, c_mktsegment AS species, 'GEAR ' || (o_orderkey % 9) AS gear FROM customer JOIN orders ON c_custkey = o_custkey), i AS (SELECT gear, row_number() OVER (ORDER BY gear) AS id FROM (SELECT DISTINCT gear FROM w))
 SELECT rpa, species || ':' || string_agg(DISTINCT id::VARCHAR, ',' ORDER BY id::VARCHAR) AS packed FROM w JOIN i USING (gear) GROUP BY rpa, species""")
def gear_ids(spark, sf):
    """Gears by name in a map, re-keyed by a catalogue numbered by name."""
    rows = _t(spark, sf, "customer").join(_t(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    gear = F.concat(F.lit("GEAR "), (F.col("o_orderkey") % 9).cast("string"))
    sheets = rows.groupBy(F.col("c_custkey").cast("string").alias("rpa"), "c_mktsegment").agg(F.collect_set(gear).alias("names")).select("rpa", F.create_map("c_mktsegment", "names").alias("gears"))
    return registry.with_gear_ids(sheets, registry.gear_catalogue(sheets)).select("rpa", F.col("species_fishing_types").alias("packed"))


@_query("""SELECT o_orderkey, o_orderkey::VARCHAR AS id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END DESC NULLS LAST, o_orderkey) = 1 AND o_orderkey % 13 <> 0
 UNION ALL SELECT o_orderkey, o_orderkey::VARCHAR, NULL FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END DESC NULLS LAST, o_orderkey) = 1 AND o_orderkey % 13 = 0""")
def register_latest(spark, sf):
    """Orders as registrations of hulls: the latest of each, undated ones last."""
    rows = _t(spark, sf, "orders")
    when = F.when(F.col("o_orderkey") % 13 == 0, "unknown").otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
    raw = rows.select(F.col("o_orderkey").cast("string").alias("id"), "o_orderkey", F.col("o_custkey").alias("registration_number"), F.col("o_orderpriority").alias("port"), when.alias("registration_date"), F.col("o_orderkey").alias("ord"))
    return registry.clean_register(raw).select("o_orderkey", "id", F.col("registration_date").cast("string").alias("day"))


@_query("""WITH t AS (SELECT c_custkey::VARCHAR AS code, c_mktsegment AS name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey), v AS (SELECT code, name, count(*) AS n FROM t GROUP BY ALL)
 SELECT code AS vessel_code, name AS vessel_name, printf('%X', code::BIGINT + 5) AS cod_barco FROM v QUALIFY row_number() OVER (PARTITION BY code ORDER BY n DESC, name) = 1""")
def observed_vessels(spark, sf):
    """Orders as observer trips: codes and names split, the vessels' table made."""
    rows = _t(spark, sf, "customer").join(_t(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    port = F.concat(F.substring("o_orderpriority", 1, 1), F.lit(" - "), F.substring("o_orderpriority", 3, 99))
    raw = rows.select(F.lit("Embarcado").alias("lugar"), F.date_format("o_orderdate", "d/M/yyyy H:m").alias("fecha_zarpe"), F.lit("x").alias("fecha_recalada"), F.concat(F.col("c_custkey").cast("string"), F.lit(" -  "), "c_mktsegment").alias("cod_barco"), port.alias("puerto_zarpe"), F.lit("7 -").alias("puerto_recalada"), F.lit("n").alias("observador"))
    return observers.vessels(observers.clean_trips(raw)).select("vessel_code", "vessel_name", "cod_barco")


@_query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders QUALIFY place <= 5")
def top_five(spark, sf):
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return _t(spark, sf, "orders").select("o_custkey", "o_orderkey", place.cast("long").alias("place")).where("place <= 5")


@_query("SELECT row_number() OVER (ORDER BY length(p), p) AS place, p AS code FROM (SELECT DISTINCT (p_size * 7)::VARCHAR AS p FROM part) UNION ALL SELECT count(DISTINCT p_size) + 1, 'n/a' FROM part")
def by_number(spark, sf):
    """Codes in the order of their numbers, text last."""
    codes = _t(spark, sf, "part").select((F.col("p_size") * 7).cast("string").alias("code")).distinct().unionByName(spark.range(1).select(F.lit("n/a").alias("code")))
    return o.sequence_ids(codes, "place", products.by_number("code"), F.col("code")).select("place", "code")


@_query("SELECT s_suppkey, s_name AS name, s_nationkey::VARCHAR AS nation, 'Eslora & más <ñ>' AS note FROM supplier")
def sheet_values(spark, sf):
    """Values read out of label/value sheets written with entities; the first of equal labels wins."""
    row = lambda label, value: F.concat(F.lit(f"<tr><td><strong>{label} :</strong></td>\n<td class=x>"), value, F.lit("</td></tr>"))
    page = F.concat(F.lit("<script>var a = '<td>x</td>'</script>"), row("N&#250;mero", F.col("s_nationkey").cast("string")), row("Nombre", F.concat(F.lit("<b>"), "s_name", F.lit("</b> "))), row("Nombre", F.lit("other")), row("Nota", F.lit("Eslora &amp; m&aacute;s\n&lt;&#xF1;&gt;")))
    v = _t(spark, sf, "supplier").select("s_suppkey", html.label_values(page).alias("v"))
    return v.select("s_suppkey", F.col("v")["Nombre"].alias("name"), F.col("v")["Número"].alias("nation"), F.col("v")["Nota"].alias("note"))


@_query("SELECT d::VARCHAR AS day, CASE WHEN d >= DATE '1996-01-15' THEN CASE WHEN strftime(d, '%Y/%m') = '1997/02' THEN 1 ELSE 2 END ELSE 60 END::BIGINT AS n, CASE WHEN d >= DATE '1996-01-15' THEN 'n/' || strftime(d, '%Y/%m') || '/r_' || strftime(d, '%Y%m%d') ELSE 'o/' || strftime(d, '%Y-%m-%d') || '_00' END AS first FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)")
def url_eras(spark, sf):
    """Where the file of every day with an order would lie."""
    days = _t(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    urls = csv_daily.candidate_urls(days, "n/{month}/r_{day}", "o/{day}_{second}", "1997/02", "1996-01-15")
    return urls.select(F.col("day").cast("string").alias("day"), F.size("urls").cast("long").alias("n"), F.get("urls", F.lit(0)).alias("first"))


@_query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_records(spark, sf):
    """Properties read from JSON, written out and read again."""
    e = _t(spark, sf, "events").select("event_id", F.from_json("props", "k bigint").alias("p")).select("event_id", "p.k")
    return records.progress_from_json(records.progress_to_json(e), "event_id bigint, k bigint")


@_query("SELECT o_orderkey AS time, arg_max(l_quantity, (l_linenumber, l_partkey, l_suppkey, l_quantity)) AS v FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def keep_last_file(spark, sf):
    """Overlapping files of one product: a time comes from the last file that has it."""
    rows = _t(spark, sf, "orders").join(_t(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    rows = rows.select(F.col("o_orderkey").alias("time"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("file"), F.col("l_quantity").alias("v"))
    return g.union_keep_last(rows).select("time", "v").distinct()


@_query("SELECT o_orderkey, c_name, o_totalprice = max(o_totalprice) OVER (PARTITION BY o_custkey) AS largest FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def spine_lookup(spark, sf):
    """A left join by id where what is missing stays null, and a flag against the best of the row's group."""
    c = _t(spark, sf, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_name")
    largest: Column = F.col("o_totalprice") == F.max("o_totalprice").over(Window.partitionBy("o_custkey"))
    return _t(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name", largest.alias("largest"))


@_query(f"""WITH t AS ({_SQL["trip_summary"]}), h AS ({_SQL["haul_model"]})
 SELECT 'trips' AS about, 'n' AS measure, '' AS label, count(*)::DOUBLE AS value FROM t
 UNION ALL SELECT 'duration_h', 'median', '', round(quantile_cont(duration_h, 0.5), 6) FROM t HAVING count(duration_h) > 0
 UNION ALL SELECT 'duration_h', 'p90', '', round(quantile_cont(duration_h, 0.9), 6) FROM t HAVING count(duration_h) > 0
 UNION ALL SELECT 'haul_confidence', 'n', haul_confidence, count(*)::DOUBLE FROM h GROUP BY haul_confidence""")
def scope_summary(spark, sf):
    """A scope's summary of its trips and hauls."""
    rows = summaries.summary(driver.trip_summary(spark, sf), driver.haul_model(spark, sf))
    return rows.withColumn("value", F.round("value", 6))
