import math
from datetime import date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from pelagia.config import SPECIES, region
from pelagia.operators.grid import Axis
from pelagia.plans import catch, driver, landings, observers, ocean, registry, vms
from pelagia.plans.run_all import Run, hauls, run
from pelagia.sources import versions

SF = "/root/testdata/sf0.001"
T0 = datetime(2023, 3, 5, 6)


def _track(kind, n=25, lat=-27.3, lon=-71.4):
    """Positions and headings of a small ring, or of a straight drift."""
    for k in range(n):
        a = 2 * math.pi * k / (n - 1)
        if kind == "ring":
            yield lat + 0.01 * math.sin(a), lon + 0.01 * math.cos(a), (math.degrees(-a)) % 360
        else:
            yield lat + 0.001 * k, lon, 10.0


def _reports(spark, kinds):
    rows, t = [], T0
    for kind in kinds:
        for lat, lon, heading in _track(kind):
            rows.append((len(rows), "100", "KALI", t, lat, lon, heading, 1.5))
            t += timedelta(minutes=5)
        t += timedelta(hours=1)
    return spark.createDataFrame(rows, "ord long, vessel_code string, vessel_name string, location_datetime timestamp, latitude double, longitude double, heading double, speed_kt double")


def _trips(spark):
    row = [(1, "100", "KALI", "69", T0 + timedelta(days=1), "Caldera", 12.0, True)]
    return spark.createDataFrame(row, "zarpe_id long, vessel_code string, vessel_name string, cod_barco string, landing_datetime timestamp, landing_port string, jack_mackerel_tons double, principal_catch boolean")


def test_ring_is_a_set_and_a_drift_is_not(spark):
    both = hauls(_trips(spark), _reports(spark, ["drift", "ring"]), region("atacama")).first()
    assert both.haul_confidence == "alta" and both.n_hauls == 1 and both.is_single_haul and both.sample_weight == 1.0
    assert both.haul_start == T0 + timedelta(minutes=125, hours=1) and 2.0 < both.haul_compactness < 2.4 and both.jack_mackerel_tons == 12.0
    drift = hauls(_trips(spark), _reports(spark, ["drift"]), region("atacama")).first()
    assert drift.haul_confidence == "baja" and drift.sample_weight == 0.5 and drift.haul_compactness == pytest.approx(1, abs=0.01)


def test_two_rings_are_numbered(spark):
    tripped = vms.with_ports(vms.assign_trips(_reports(spark, ["ring", "drift", "ring"]), _trips(spark).withColumn("ord", F.lit(1))), region("atacama").points)
    rows = vms.bouts(vms.candidates(tripped))
    labelled = vms.label_pings(tripped, rows, vms.bout_metrics(rows), ["ord"])
    got = {r.haul_index: r.n for r in labelled.groupBy("haul_index").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 25, 2: 25, None: 25}
    assert {r.behavior for r in labelled.collect()} == {"pesca", "candidato"} and labelled.schema["is_haul"].dataType.simpleString() == "int"


def test_clean_and_consolidate(spark):
    rows = [
        ("A", "CB1", "05/03/2023 10:08:00", "-27.05000°", "-71.0", "355", "2.40 kt", "f1", 1),
        ("A", "CB1", "05/03/2023 10:08:00", "-27.99°", "-71.0", "355", "2.40 kt", "f2", 1),
        ("A", "CB1", "5/3/2023 9:8:0", "", "-71.0", "x", "1 kt", "f1", 2),
        ("A", "CB1", "bad", "-25.0°", "-70.0°", "x", "", "f1", 3),
    ]
    df = spark.createDataFrame(rows, "vessel_name string, radio_call_sign string, location_datetime string, latitude string, longitude string, heading string, speed_kt string, file string, ord int")
    got = vms.clean(vms.consolidate(df), region("atacama").bbox).orderBy("ord").collect()
    assert [(r.ord, r.latitude) for r in got] == [(1, -27.05), (3, -25.0)]
    assert got[0].speed_kt == 2.4 and got[1].location_datetime is None and got[1].heading is None


def test_fleet_by_sign_or_name(spark):
    pings = spark.createDataFrame([("x", "CB-8165"), ("Kali (ART)", "SUST."), ("other", "1")], "vessel_name string, radio_call_sign string")
    register = spark.createDataFrame([("r1", "v1", "CB8165", "ROCIO", 1), ("r2", "v2", "", "KALI", 2)], "rpa string, vessel_code string, signal_code string, vessel_name string, ord int")
    assert {(r.vessel_name, r.rpa) for r in vms.to_fleet(pings, register).collect()} == {("x", "r1"), ("Kali (ART)", "r2")}


def test_catch_wide_to_spine(spark):
    names = ["AÑO", "REGION", "COD_BARCO", "FECHA_HORA_RECALADA", "LATITUD", "LONGITUD", "JUREL", "BONITO;MONO"]
    rows = [(2023, 3, "69", "3/6/2023 6:00", 270400, 704909, 5.0, 5.0), (2023, 3, "zz", "3/6/2023 7:00", 270400, 704909, 0.0, 1.0), (2023, None, "69", "3/6/2023 6:00", 270400, 704909, 1.0, 0.0), (2023, 3, "69", "bad", 1, 1, 1.0, 1.0)]
    raw = spark.createDataFrame(rows, ", ".join(f"`{n}` {t}" for n, t in zip(names, ("int", "int", "string", "string", "int", "int", "double", "double"))))
    cleaned = catch.clean_wide(raw, region("atacama").points)
    assert sorted((r.COD_BARCO, r.vessel_code, r.PORT) for r in cleaned.collect()) == [("69", "100", "Caldera"), ("zz", None, "Caldera")]
    vessels = spark.createDataFrame([("100", "KALI"), ("100", "KALI 2")], "vessel_code string, vessel_name string")
    kept = catch.filter_catch(cleaned, ("Caldera",), date(2023, 3, 6), date(2023, 3, 6))
    spine = catch.trip_spine(kept, vessels).collect()
    assert [(r.zarpe_id, r.vessel_name, r.jack_mackerel_tons, r.principal_catch) for r in spine] == [(1, "KALI", 5.0, True)]
    every = catch.filter_catch(cleaned, ("Caldera",), date(2023, 3, 6), date(2023, 3, 6), "all")
    assert {(r.COD_BARCO, r.PRINCIPAL_CATCH) for r in every.collect()} == {("69", True), ("zz", False)}  # a tie counts, in both scopes
    columns = catch.trip_spine(every, vessels).columns
    assert columns[6:9] == ["jack_mackerel_tons", "needlefish_tons", "anchovy_tons"] and columns[-1] == "principal_catch"


def test_trips_are_numbered_by_landing_then_vessel(spark):
    rows = [("9", T0 + timedelta(days=1)), ("10", T0), ("9", T0), (None, T0), ("1", T0 + timedelta(days=2))]
    df = spark.createDataFrame(rows, "vessel_code string, LANDING_DATETIME timestamp").withColumns({"COD_BARCO": F.col("vessel_code"), "PORT": F.lit("p"), "JACK_MACKEREL": F.lit(1.0), "PRINCIPAL_CATCH": F.lit(True)})
    got = catch.trip_spine(df, spark.createDataFrame([], "vessel_code string, vessel_name string")).orderBy("zarpe_id").collect()
    assert [(r.zarpe_id, r.vessel_code, r.landing_datetime.day) for r in got] == [(1, "10", 5), (2, "9", 5), (3, None, 5), (4, "9", 6), (5, "1", 7)]


def test_haul_port_is_the_one_nearest_to_its_centre(spark):
    """A bout that starts off Caldera and lies, as a whole, nearer to Carrizal Bajo."""
    rows = [(k, 1, T0 + timedelta(minutes=5 * k), lat, -71.4, 10.0, 1.5) for k, lat in enumerate([-27.5, -27.9, -28.2, -28.3])]
    pings = spark.createDataFrame(rows, "ord long, zarpe_id long, location_datetime timestamp, latitude double, longitude double, heading double, speed_kt double")
    placed = vms.with_ports(pings, region("atacama").points)
    metrics = vms.bout_metrics(vms.bouts(vms.candidates(placed)))
    got = vms.haul_locations(metrics, placed.select("zarpe_id").distinct(), region("atacama").points).first()
    assert got.nearest_port == "Carrizal Bajo" and got.haul_dist_port_km == pytest.approx(29, abs=1) and got.haul_confidence == "baja"
    none = vms.haul_locations(metrics.limit(0), placed.select("zarpe_id").distinct(), region("atacama").points).first()
    assert none.haul_confidence == "sin_pesca" and none.haul_n_pings == 0 and none.nearest_port is None


def test_catch_long(spark):
    key = ("69", "06-03-2023 06:00:59", "CALDERA", "Región de Atacama")
    rows = [(*key, "Artesanal", "Jurel", "2"), (*key, " artesanal ", "JUREL", "x"), (*key, "INDUSTRIAL", "JUREL", "9"), (*key, "Artesanal", "merluza", "9"), (None, *key[1:], "Artesanal", "JUREL", "9")]
    raw = spark.createDataFrame(rows, "BARCO string, FECHA_HORA_RECALADA string, PUERTO_DE_RECALADA string, REGION string, FLOTA string, ESPECIE string, PESO string")
    got = catch.clean_long(raw).collect()
    assert [(r.JACK_MACKEREL, r.BONITO, r.PORT, r.vessel_code, r.REGION, r.LANDING_DATETIME) for r in got] == [(2.0, 0.0, "Caldera", "100", 3, datetime(2023, 3, 6, 6))]
    assert got[0].asDict().keys() >= set(SPECIES)


def test_registry(spark):
    rows = [("7", "10", "ROCIO I", "LANCHA", "01-02-2020", "H1", "P", "III REGION", 1), ("8", "11", "ROCIO II", "LANCHA", None, "H1", "P", "III REGION", 2), ("9", "12", "GAROTA", "BOTE", "01-02-2020", "H2", "P", "III REGION", 3)]
    raw = spark.createDataFrame(rows, "id string, rpa string, vessel_name string, category string, registration_date string, registration_number string, port string, region string, ord int")
    for c in ("owner_id", "owner_name", "registration_end", "type", "office"):
        raw = raw.withColumn(c, F.lit("x"))
    register = registry.in_scope(registry.clean_register(raw), ("III REGION",))
    assert [r.rpa for r in register.collect()] == ["10"] and "owner_name" not in register.columns
    vessels = spark.createDataFrame([("100", "Rocío I", "69"), ("101", "ROCIO II", "6A")], "vessel_code string, vessel_name string, cod_barco string")
    assert [(r.rpa, r.vessel_code, r.cod_barco) for r in registry.match_observed(register, vessels).collect()] == [("10", "100", "69")]
    sheets = spark.createDataFrame([("10", {"JUREL": ["cerco"], "JIBIA": ["linea", "cerco"]}), ("12", {"JUREL": ["cerco"]})], "rpa string, gears map<string,array<string>>")
    ids = registry.gear_catalogue(sheets)
    packed = {r.rpa: r.species_fishing_types for r in registry.with_gear_ids(sheets, ids).collect()}
    assert packed == {"10": "JIBIA:1,2|JUREL:1", "12": "JUREL:1"}
    book = registry.with_gear_ids(sheets, ids).withColumn("signal_code", F.lit("CB1"))
    assert [r.rpa for r in registry.exclusive(book, "1").collect()] == ["12"]


def test_observers(spark):
    rows = [("Embarcado", "01/02/2023 06:30", "02/02/2023 06:30", "5 - KALI", "10 - CALDERA", "10 - CALDERA", "n", "r"), ("Tierra", "1/2/2023 6:30", "x", "5 - KALO", "11 - HUASCO", "12 - OTRO", "n", "r"), ("?", None, None, "5 - KALI", "11 - HUASCO", "10 - Caldera", "n", "r")]
    raw = spark.createDataFrame(rows, "lugar string, fecha_zarpe string, fecha_recalada string, cod_barco string, puerto_zarpe string, puerto_recalada string, observador string, rut string")
    trips = observers.clean_trips(raw)
    assert not set(observers.PERSONAL) & set(trips.columns)
    assert [(r.vessel_code, r.vessel_name, r.cod_barco) for r in observers.vessels(trips).collect()] == [("5", "KALI", "A")]
    assert observers.ports(trips).count() == 4  # one id has two spellings
    assert observers.species(trips).count() == 0
    kept = observers.in_region(observers.trips_table(trips), observers.ports(trips), ("Cáldera",))
    assert sorted(r.zarpe_id for r in kept.collect()) == [1, 2]
    assert [r.port_name for r in observers.unresolved(observers.ports(trips), spark.createDataFrame([("Huasco",), ("Nada",)], "port_name string")).collect()] == ["Nada"]


def test_landings(spark):
    df = spark.createDataFrame([(2020, "Ays��n", 1.0), (2020, "Aysén", 2.0), (2010, "Aysén", 4.0)], "ano int, region string, toneladas double")
    assert landings.total(landings.filter_landings(df, ("Aysén",), 2019, 2024)).first()[0] == 3.0


def test_haul_environment_and_forecast(spark):
    lat, lon = Axis(-27.5, 1 / 24, 10), Axis(-71.5, 1 / 24, 10)
    from pelagia.operators.grid import cells

    day = cells(spark, lat, lon).withColumn("time", F.lit("2023-03-05").cast("timestamp"))
    field = lambda name, v: day.withColumn(name, v)
    grids = {
        "sst": field("analysed_sst", F.lit(290.0) + F.col("i_lat") / 10), "chl": field("CHL", F.when(F.col("i_lon") < 8, 1.0)),
        "phy": field("mlotst", F.lit(20.0)).withColumn("so_0m", F.lit(34.0)), "bgc": field("o2_min_0_200m", F.lit(100.0)),
    }
    points = [(1, T0, -27.5, -71.5), (2, T0, -27.5, -71.5 + 9 / 24), (3, None, None, None), (4, T0 + timedelta(days=9), -27.5, -71.5)]
    df = spark.createDataFrame(points, "zarpe_id long, haul_start timestamp, haul_lat double, haul_lon double")
    got = {r.zarpe_id: r for r in ocean.haul_environment(df, grids, lat, lon).collect()}
    assert got[1].env_status == "ok" and got[1].sst_c == pytest.approx(16.85) and got[1].sst_front_c_per_km > 0 and got[1].chl_front_mg_m3_per_km == 0
    assert got[2].env_status == "fallback" and got[2].chl_mg_m3 == 1.0
    assert got[3].env_status == "sin_coords" and got[3].moon_illumination is None
    assert got[4].env_status == "fuera_de_rango" and got[4].env_time is not None and got[4].sst_c is None and got[4].moon_illumination is not None
    physics = field("sst_c", F.lit(15.0)).withColumns({"mld_m": F.lit(20.0), "sss_psu": F.lit(34.0)})
    biology = field("chl_mg_m3", F.when(F.col("i_lon") < 8, 1.0)).withColumn("o2_min_mmol_m3", F.lit(100.0))
    out = ocean.forecast_grid(physics, biology, lat, lon)
    assert out.count() == 100 and out.where("coast_filled").count() == 20


def test_vessel_sheet(spark):
    head = ["N Matricula", "Capitania", "Nombre", "Se&ntilde;al Distintiva", "Vence", "77", "X", "KALI", "CB-4352", "2020"]
    gear = ["M&eacute;todo de Captura", "Especie", "Fecha", "Tipo", "CERCO", "JUREL", "01-02-2020", "a", "RED", "JUREL", "01-02-2020", "a", "CERCO", "JIBIA", "01-02-2020", "b", "RED", "X", "never", "c"]
    status = ["N", "Fecha", "Oficina", "Estado", "1", "2", "3", "VIGENTE"]
    page = "<script>x('<td>Estado</td>')</script>" + "".join(f"<td>{c}</td>" for c in head + gear + status)
    got = registry.read_sheet(spark.createDataFrame([("10", page), ("11", "")], "rpa string, html string")).orderBy("rpa").collect()
    assert (got[0].signal_code, got[0].gears) == ("4352", {"JUREL": ["CERCO", "RED"], "JIBIA": ["CERCO"]}) and got[0].status == "VIGENTE"
    assert got[1].gears == {} and got[1].signal_code == ""


def test_registry_from_result_pages(spark):
    """Rows of 19 data cells; header rows and short rows are no data, and a page's region goes with its rows."""
    row = lambda i: "<tr>" + "".join(f"<td>&nbsp;<b>{i}.{k}</b></td>" for k in range(19)) + "</tr>"
    page = "<table><tr>" + "<th>h</th>" * 19 + "</tr>" + row(1) + "<tr><td>short</td></tr>" + row(2) + "</table>"
    got = registry.from_pages(spark.createDataFrame([("III REGION", page), ("I REGION", "")], "region string, html string")).orderBy("id").collect()
    assert [(r.region, r.id, r.rpa, r.cove) for r in got] == [("III REGION", "1.0", "1.1", "1.18"), ("III REGION", "2.0", "2.1", "2.18")]


def test_trip_details(spark):
    page = "<td><strong>Tipo Embarcaci?n :</strong></td><td> Lancha </td><td><strong>N&#250;mero Lances :</strong></td><td>4</td><td><strong>N&#xFA;mero Lances Muestreados:</strong></td><td>9</td><td><STRONG>Especie Objetivo</STRONG></td><td>33 - SARDINA\n COM&Uacute;N</td>"
    got = observers.with_details(spark.createDataFrame([(1, page)], "id int, html string")).first()
    assert (got.tipo_embarcacion, got.numero_lances, got.especie_objetivo) == ("Lancha", "4", "33 - SARDINA COMÚN")


def _raw_files(at, spark):
    """A small world: one seiner that makes a ring off Caldera and lands jack mackerel, and another boat that is no seiner."""
    (at / "vms_daily").mkdir(parents=True)
    head = "Name;Radio Call Sign (RC);Location date;Latitude;Longitude;Heading;Speed (kt)\n"
    lines, t = [], T0
    for lat, lon, heading in [*_track("ring"), *_track("drift")]:
        lines.append(f"KALI (ART);CB-4352;{t:%d/%m/%Y %H:%M:%S};{lat:.5f}°;{lon:.5f}°;{heading:.1f};1.50 kt\n")
        t += timedelta(minutes=5)
    (at / "vms_daily/flota_2023-03-05.csv").write_text(head + "".join(lines), encoding="utf-8")
    (at / "vms_daily/flota_2023-03-06.csv").write_text(head + lines[0].replace("-27.3", "-28.3"), encoding="utf-8")
    other = "Speed;Heading;Longitud;Latitud;Fecha;RC;Nombre\n"  # another order of columns: read apart, but its rows are numbered apart, too
    fast = [f"9.00 kt;90.0;-71.5°;-27.6°;{T0 - timedelta(minutes=5 * (k + 1)):%d/%m/%Y %H:%M:%S};CB-4352;KALI (ART)\n" for k in range(60)]
    (at / "vms_daily/flota_2023-03-04.csv").write_text(other + "".join(fast), encoding="utf-8")
    names = list(registry.HEADERS)
    row = lambda i, rpa, name, plate: ";".join({"Correlativo": i, "Nº RPA": rpa, "Nombre Embarcación": name, "Categoría": "LANCHA", "Fecha Inscripción": "01-02-2020", "Nº Matrícula": plate, "Puerto": "CAL", "Region": "III REGION"}.get(n, "x") for n in names)
    (at / "registry_raw.csv").write_text("\n".join([";".join(names), row("10", "1", "KALI", "M1"), row("2", "2", "ROCIO II", "M2")]) + "\n", encoding="utf-8")
    sheet = lambda call, gear: f"<td>Señal Distintiva</td><td>V</td><td>1</td><td>2</td><td>3</td><td>{call}</td><td>Método de Captura</td><td>Especie</td><td>Fecha</td><td>Tipo</td><td>{gear}</td><td>JUREL</td><td>01-02-2020</td><td>a</td>"
    spark.createDataFrame([("1", sheet("CB-4352", "CERCO")), ("2", sheet("CB-1", "RED"))], "rpa string, html string").write.parquet(str(at / "vessel_sheets.parquet"))
    trips = "lugar,fecha_zarpe,fecha_recalada,cod_barco,puerto_zarpe,puerto_recalada,observador\n"
    (at / "observer_trips_raw.csv").write_text(trips + "Embarcado,04/03/2023 06:30,05/03/2023 06:30,100 - KALI,10 - CALDERA,10 - CALDERA,n\nTierra,04/03/2023 06:30,05/03/2023 06:30,200 - ROCIO II,9 - HUASCO,10 - CALDERA,n\n", encoding="utf-8")
    wide = "AÑO,REGION,COD_BARCO,FECHA_HORA_RECALADA,LATITUD,LONGITUD,JUREL,ANCHOVETA,\n2023,3,69,3/6/2023 6:00,270400,704909,12.5,1,\n2023,3,CD,3/7/2023 6:00,270400,704909,0,3,\n"
    (at / "catch_wide.csv").write_bytes(wide.encode("latin-1"))
    (at / "catch_long.csv").write_bytes("BARCO;FECHA_HORA_RECALADA;PUERTO_DE_RECALADA;REGION;FLOTA;ESPECIE;PESO\n69;06-03-2023 06:00:30;CALDERA;Región de Atacama;ARTESANAL;JUREL;12.5\n".encode("latin-1"))
    (at / "landings.csv").write_bytes("ano;region;tipo_agente;especie;toneladas\n2020;Atacama;x;JUREL;3.5\n2020;Maule;x;JUREL;9\n".encode("latin-1"))
    from pelagia.operators.grid import cells
    from pelagia.plans.run_all import axes

    day = cells(spark, *axes(region("caldera"))).where("i_lat BETWEEN 30 AND 50 AND i_lon BETWEEN 5 AND 25").withColumn("time", F.lit("2023-03-05").cast("timestamp"))
    for name, values in {"sst": {"analysed_sst": 290.0}, "chl": {"CHL": 1.0}, "phy": {"mlotst": 20.0, "so_0m": 34.0}, "bgc": {"o2_min_0_200m": 100.0}, "phy_forecast": {"sst_c": 15.0, "mld_m": 20.0, "sss_psu": 34.0}, "bgc_forecast": {"chl_mg_m3": 1.0, "o2_min_mmol_m3": 100.0}}.items():
        day.withColumns({c: F.lit(v) for c, v in values.items()}).write.parquet(str(at / f"{name}.parquet"))


def test_whole_run(spark, tmp_path):
    data, out = tmp_path / "data", str(tmp_path / "out")
    data.mkdir()
    _raw_files(data, spark)
    made = run(spark, str(data), out, region("caldera"))
    read = lambda name: spark.read.parquet(f"{out}/caldera/run_report") if name == "run_report" else versions.read(spark, f"{out}/caldera/{name}")
    assert [r.id for r in read("registry/register_clean").collect()] == ["2", "10"]  # by number, not by text
    assert [(r.rpa, r.signal_code, r.vessel_code) for r in read("registry/register").collect()] == [("1", "4352", "100")]
    fleet = read("reports_fleet")
    assert fleet.count() == 110 and fleet.select("ord").distinct().count() == 110 and read("landings").count() == 1
    base = "zarpes_2019_2024"
    haul = read(f"{base}/haul_location").collect()
    assert [(r.zarpe_id, r.haul_confidence, r.n_hauls, r.jack_mackerel_tons, r.principal_catch, r.nearest_port) for r in haul] == [(1, "alta", 1, 12.5, True, "Caldera")]
    assert "anchovy_tons" in read(f"{base}_all_species/haul_location").columns and "anchovy_tons" not in haul[0]
    assert read(f"{base}_all_species/trips").count() == 2 and read(f"{base}_backup/trips").count() == 1
    ping = read(f"{base}/pings_behaviour").groupBy("behavior").count().collect()
    counts = {r.behavior: r["count"] for r in ping}
    assert sum(counts.values()) == read(f"{base}/pings").count() and counts["transito"] >= 60
    marked = read(f"{base}/pings_behaviour")
    assert marked.where("speed_kt > 8 and behavior <> 'transito'").count() == 0  # no label crosses from one file to another
    assert {k: v for k, v in counts.items() if k != "transito"} in ({"pesca": 25, "candidato": 25}, {"pesca": 50})
    final = spark.read.csv(f"{out}/caldera/{base}/haul_env_csv", header=True).collect()
    assert [(r.env_status, r.env_time, r.sst_c, r.haul_start) for r in final] == [("ok", "2023-03-05", "16.850000000000023", "2023-03-05 06:00:00")]
    assert read("forecast_grid").count() == 441 and read("forecast_grid").columns[:3] == ["time", "latitude", "longitude"]
    told = read("run_report").collect()
    steps = {}
    for r in told:
        steps.setdefault((r.product, r.place, r.step), {})[r.what] = r.rows
    assert all(n["in"] == n["out"] + sum(v for k, v in n.items() if k not in ("in", "out")) for n in steps.values())
    assert steps["reports_fleet", 0, "one a sign and time"]["in"] == 111 and steps["reports_fleet", 2, "of the fleet"]["out"] == 110
    assert steps[f"{base}/trips", 1, "of interest"] == {"in": 2, "outside the days": 0, "other port": 0, "no catch in scope": 1, "out": 1}
    assert steps["landings", 0, "of the region"]["other region"] == 1 and steps["registry/register_matched", 1, "observed"]["in"] == 2
    assert {p for p, _, _ in steps} >= {"registry/register", f"{base}/pings", f"{base}/haul_model", f"{base}_backup/trips"}
    assert len(made) == len(set(made)) and run(spark, str(data), out, region("caldera"), shared=False) == [p for p in made if "/zarpes_2019" in p]


def test_run_again_makes_only_what_depends_on_a_change(spark, tmp_path):
    data, out = tmp_path / "data", str(tmp_path / "out")
    data.mkdir()
    _raw_files(data, spark)
    trips = (data / "observer_trips_raw.csv").read_text(encoding="utf-8").splitlines()
    (data / "observer_trips_raw.csv").write_text("\n".join([trips[0] + ",id_viaje", *(f"{t},{k}" for k, t in enumerate(trips[1:]))]) + "\n", encoding="utf-8")
    page = "<td><strong>Especie Objetivo :</strong></td><td>26 - JUREL</td><td><strong>N&#250;mero Lances :</strong></td><td>4</td>"
    spark.createDataFrame([("0", page)], "id_viaje string, html string").write.parquet(str(data / "trip_sheets.parquet"))
    where, base = region("caldera"), "zarpes_2019_2024"
    again = lambda: run(spark, str(data), out, where, sources=("bitacora",), scopes=("jurel",))
    read = lambda name: versions.read(spark, f"{out}/caldera/{name}")
    made = [p.removeprefix(f"{out}/caldera/") for p in again()]
    plain = {"forecast_grid_20230305_20230305", "forecast_grid_dictionary", f"{base}/haul_env_csv"}
    state = lambda: {p: versions.manifest(spark, f"{out}/caldera/{p}")["version"] for p in [*made, "grids/sst"] if p not in plain}
    mark = lambda p: (tmp_path / f"out/caldera/{p}/_made_of").stat().st_mtime_ns
    assert plain < set(made)
    assert [r.num_hauls for r in read("observers/trips_clean").orderBy("vessel_code").collect()] == [4, None]
    assert [r.species_id for r in read("observers/species").collect()] == ["26"]
    assert read("observers/ports_unknown").count() == 0 and read("observers/ports_ambiguous").count() == 0
    told = {(r.about, r.measure, r.label): r.value for r in read(f"{base}/summary").collect()}
    length = read(f"{base}/trip_summary").first().duration_h
    assert told["duration_h", "median", ""] == told["duration_h", "p90", ""] == length and told["haul_confidence", "n", "alta"] == 1
    assert told["env_status", "n", "ok"] == 1 and told["sst_c", "mean", ""] == pytest.approx(16.85) and told["sst_c", "n_valid", ""] == 1
    words = {r["column"]: r.comment for r in spark.read.csv(f"{out}/caldera/forecast_grid_dictionary", header=True).collect()}
    assert list(words) == read("forecast_grid").columns and all(words.values())
    assert spark.read.csv(f"{out}/caldera/forecast_grid_20230305_20230305", header=True).first().time == "2023-03-05"
    before, marks = state(), {p: mark(p) for p in plain}
    assert set(before.values()) == {1} and again() and state() == before and {p: mark(p) for p in plain} == marks
    with (data / "landings.csv").open("ab") as f:
        f.write(b"2021;Atacama;x;JUREL;4\n")
    again()
    assert {p for p, n in state().items() if n != before[p]} == {"landings"} and read("landings").count() == 2
    spark.read.parquet(str(data / "sst.parquet")).withColumn("analysed_sst", F.lit(291.0)).write.parquet(str(data / "sst_new.parquet"))
    (data / "sst.parquet").rename(data / "sst_old.parquet")
    (data / "sst_new.parquet").rename(data / "sst.parquet")
    before = state()
    again()
    assert {p for p, n in state().items() if n != before[p]} == {"grids/sst", f"{base}/haul_env", f"{base}/summary"}
    assert spark.read.csv(f"{out}/caldera/{base}/haul_env_csv", header=True).first().sst_c.startswith("17.85") and mark("forecast_grid_dictionary") == marks["forecast_grid_dictionary"]


def test_a_product_that_does_not_balance_is_no_version(spark, tmp_path):
    work = Run(spark, str(tmp_path), str(tmp_path / "out"), region("caldera"))

    def bad(written):
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        work.product("x", lambda _: spark.range(3), check=bad)
    assert versions.manifest(spark, f"{work.out}/x") is None and work.made == []
    with pytest.raises(versions.EmptyProduct):
        work.product("x", lambda _: spark.range(0))
    assert work.product("x", lambda _: spark.range(3)).count() == 3


def _plain(v):
    return f"{round(v, 5) + 0.0:.5f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_driver_query_equals_sql(spark, name):
    df = driver.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(_plain(r[c]) for c in cols) for r in df.collect())
    if name not in driver.oracle_sql():
        assert got
        return
    db = duckdb.connect()
    for t in ("nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = db.execute(driver.oracle_sql()[name])
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    assert got == sorted(tuple(_plain(r[i]) for i in at) for r in cur.fetchall())
