"""Catch logbooks to the trip spine: one row a landing, with its catch by species."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.config import OF_INTEREST, SPECIES
from pelagia.functions import geo, text
from pelagia.operators.nearest import nearest_point
from pelagia.operators.ordered import keep_first, sequence_ids
from pelagia.sources.ledger import Sift, plain

#: The species columns of the wide logbook, and the species of the long one.
WIDE_NAMES = {
    "AGUJILLA;PUNTO FIJO": "NEEDLEFISH", "ANCHOVETA": "ANCHOVY", "BACALADILLO;MOTE": "BLUE_WHITING", "BONITO;MONO": "BONITO",
    "CABALLA": "MACKEREL", "CABINZA": "CABINZA", "CORVINA": "CORVINA", "JIBIA": "SQUID", "JUREL": "JACK_MACKEREL",
    "MACHUELO;TRITRE": "MACHUELO", "MEDUSAS": "JELLYFISH", "PEJERREY DE MAR": "SILVERSIDE", "SARDINA ESPANOLA": "SARDINE",
}
LONG_NAMES = {name.partition(";")[0]: species for name, species in WIDE_NAMES.items()}
#: Region codes by the first part of a name that is found; 0 for others.
REGION_CODES = [
    ("arica", 15), ("tarapac", 1), ("antofagasta", 2), ("atacama", 3), ("coquimbo", 4), ("valpara", 5), ("higgins", 6), ("libertador", 6),
    ("maule", 7), ("nuble", 16), ("biobio", 8), ("bio", 8), ("araucan", 9), ("rios", 14), ("lagos", 10), ("aysen", 11), ("magallanes", 12),
    ("metropol", 13),
]


def clean_wide(raw: DataFrame, points: list[tuple[str, float, float]], sift: Sift = plain) -> DataFrame:
    """YEAR, REGION, vessel_code, COD_BARCO, LANDING_DATETIME, PORT (by the nearest one) and the species.

    Rows whose year, region or place is there but no number are dropped; a place that is not there leaves PORT to fail the filter of ports.
    """
    named = raw.withColumnsRenamed({k: v for k, v in (WIDE_NAMES | {"AÑO": "YEAR"}).items() if k in raw.columns})
    out = named.withColumns(
        {
            "COD_BARCO": F.trim("COD_BARCO"),
            "vessel_code": text.hex_to_code(F.col("COD_BARCO")).cast("string"),
            "LANDING_DATETIME": F.try_to_timestamp("FECHA_HORA_RECALADA", F.lit("M/d/yyyy H:m")),
            "__lat": geo.sexagesimal(F.col("LATITUD")),
            "__lon": geo.sexagesimal(F.col("LONGITUD")),
        }
    )
    number = lambda c, kind: F.col(c).isNull() | F.col(c).try_cast(kind).isNotNull()
    out = sift(
        "logbook rows", out,
        {
            "without a region": F.col("REGION").isNotNull(), "landing time unreadable": F.col("LANDING_DATETIME").isNotNull(),
            "year or region unreadable": number("YEAR", "int") & number("REGION", "int"), "place unreadable": number("LATITUD", "double") & number("LONGITUD", "double"),
        },
    )
    out = out.withColumn("PORT", nearest_point(F.col("__lat"), F.col("__lon"), points, geo.equirectangular)["name"])
    species = [F.col(s).try_cast("double").alias(s) if s in out.columns else F.lit(0.0).alias(s) for s in SPECIES]
    return out.select(F.col("YEAR").try_cast("int").alias("YEAR"), F.col("REGION").try_cast("int").alias("REGION"), "COD_BARCO", "vessel_code", "LANDING_DATETIME", "PORT", *species)


def clean_long(raw: DataFrame, species_of: dict[str, str] = LONG_NAMES, sift: Sift = plain) -> DataFrame:
    """The same columns from one row a landing and species; artisanal fleet only, weights that are no numbers count 0.

    Landing times are cut to the minute, regions become codes.
    """
    keys = ["BARCO", "FECHA_HORA_RECALADA", "PUERTO_DE_RECALADA", "REGION"]
    table = F.create_map(*(F.lit(x) for item in species_of.items() for x in item))
    rows = raw.withColumn("__s", F.try_element_at(table, F.upper(F.trim("ESPECIE"))))
    keyed = {f"without {k}": F.col(k).isNotNull() for k in keys}
    rows = sift("logbook rows", rows, {"other fleet": F.lower(F.trim("FLOTA")) == "artesanal", **keyed, "other species": F.col("__s").isNotNull()})
    rows = rows.withColumn("__w", F.coalesce(F.col("PESO").try_cast("double"), F.lit(0.0)))
    wide = rows.groupBy(*keys).pivot("__s", list(SPECIES)).agg(F.sum("__w")).na.fill(0.0, list(SPECIES))
    when = F.date_trunc("minute", F.try_to_timestamp("FECHA_HORA_RECALADA", F.lit("d-M-yyyy H:m:s")))
    out = wide.withColumns(
        {
            "LANDING_DATETIME": when, "COD_BARCO": F.trim("BARCO"), "vessel_code": text.hex_to_code(F.col("BARCO")).cast("string"),
            "PORT": text.port_title(F.col("PUERTO_DE_RECALADA")), "REGION": text.first_code(F.lower(F.trim("REGION")), REGION_CODES),
        }
    )
    out = sift("landings", out, {"landing time unreadable": F.col("LANDING_DATETIME").isNotNull()}, fresh=True)
    return out.select(F.year("LANDING_DATETIME").alias("YEAR"), "REGION", "COD_BARCO", "vessel_code", "LANDING_DATETIME", "PORT", *SPECIES)


def filter_catch(catch: DataFrame, ports: tuple[str, ...], start: date, end: date, scope: str = "jurel", sift: Sift = plain) -> DataFrame:
    """Landings in the days and ports that have catch in scope.

    PRINCIPAL_CATCH: whether the species of interest equals the most of any, all species compared before any is dropped.
    """
    at = F.col("LANDING_DATETIME")
    most = F.greatest(*SPECIES)
    within = (at >= F.lit(start.isoformat()).cast("timestamp")) & (at < F.lit((end + timedelta(days=1)).isoformat()).cast("timestamp"))
    caught = F.col(OF_INTEREST) > 0 if scope == "jurel" else most > 0
    rows = sift("of interest", catch, {"outside the days": within, "other port": F.col("PORT").isin(*ports), "no catch in scope": caught})
    rows = rows.withColumn("PRINCIPAL_CATCH", F.coalesce(F.col(OF_INTEREST) == most, F.lit(False)))
    if scope == "jurel":
        return rows.drop(*(s for s in SPECIES if s != OF_INTEREST))
    return rows


def trip_spine(catch: DataFrame, vessels: DataFrame) -> DataFrame:
    """Numbered trips in order of landing and vessel, with vessel names and <species>_tons columns, the species of interest first."""
    names = keep_first(vessels.select(F.trim("vessel_code").alias("__v"), "vessel_name"), ["__v"], F.col("vessel_name"))
    out = catch.withColumn("vessel_code", F.trim("vessel_code"))
    out = out.join(names, out["vessel_code"] == F.col("__v"), "left").drop("__v")
    order = [F.col("LANDING_DATETIME").asc_nulls_last(), F.col("vessel_code").asc_nulls_last(), F.col("COD_BARCO"), F.xxhash64(*catch.columns)]
    numbered = sequence_ids(out, "zarpe_id", *order)
    tons = [F.col(s).alias(f"{s.lower()}_tons") for s in sorted(SPECIES, key=lambda s: s != OF_INTEREST) if s in catch.columns]
    return numbered.select(
        "zarpe_id", "vessel_code", "vessel_name", F.col("COD_BARCO").alias("cod_barco"), F.col("LANDING_DATETIME").alias("landing_datetime"),
        F.col("PORT").alias("landing_port"), *tons, F.col("PRINCIPAL_CATCH").alias("principal_catch"),
    )
