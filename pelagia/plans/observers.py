"""Observer trips: cleaning, dimension tables and the trips of a region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.functions import text
from pelagia.operators.html import label_pairs, value_of_kind
from pelagia.operators.match import best_by_variants
from pelagia.operators.ordered import mode_first, sequence_ids

#: The person columns, which never leave this module, and the columns that may be absent.
PERSONAL = ("observador", "rut", "cargo", "estado_match", "score_match")
OPTIONAL = ("tipo_embarcacion", "especie_objetivo", "numero_lances")


def clean_trips(raw: DataFrame) -> DataFrame:
    for c in OPTIONAL:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(""))
    code, name = text.split_code(F.col("cod_barco"))
    out_id, out_name = text.split_code(F.col("puerto_zarpe"))
    in_id, in_name = text.split_code(F.col("puerto_recalada"))
    target_id, target_name = text.split_code(F.col("especie_objetivo"))
    place = text.folded(F.col("lugar"))
    when = lambda c: F.try_to_timestamp(c, F.lit("d/M/yyyy H:m"))
    return raw.drop(*PERSONAL).select(
        F.when(place == "embarcado", True).when(place == "tierra", False).alias("embarked"),
        when("fecha_zarpe").alias("departure_datetime"),
        when("fecha_recalada").alias("arrival_datetime"),
        code.alias("vessel_code"),
        name.alias("vessel_name"),
        text.folded(F.col("tipo_embarcacion")).alias("vessel_type"),
        out_id.alias("departure_port_id"),
        out_name.alias("departure_port_name"),
        in_id.alias("arrival_port_id"),
        in_name.alias("arrival_port_name"),
        target_id.alias("target_species_id"),
        target_name.alias("target_species_name"),
        F.col("numero_lances").try_cast("long").alias("num_hauls"),
    )


#: The fields of a trip's detail sheet, by how their labels begin or what they are.
SHEET_PREFIXES = {"tipo embarcaci": "tipo_embarcacion", "especie objetivo": "especie_objetivo"}
SHEET_EXACT = {"numero lances": "numero_lances"}


def with_details(trips: DataFrame, html: str = "html") -> DataFrame:
    """Trips with the fields of their detail sheets in place of the sheet."""
    kind = lambda label: text.label_kind(F.translate(label, "?:", ""), SHEET_PREFIXES, SHEET_EXACT)
    pairs = trips.withColumn("__pairs", label_pairs(F.col(html)))
    return pairs.withColumns({c: value_of_kind(F.col("__pairs"), c, kind) for c in OPTIONAL}).drop("__pairs", html)


def ports(trips: DataFrame) -> DataFrame:
    both = trips.select("departure_port_id", "departure_port_name").unionAll(trips.select("arrival_port_id", "arrival_port_name"))
    return both.toDF("port_id", "port_name").na.drop(how="any").distinct()


def species(trips: DataFrame) -> DataFrame:
    return trips.select(F.col("target_species_id").alias("species_id"), F.col("target_species_name").alias("species_name")).na.drop(how="any").distinct()


def vessels(trips: DataFrame) -> DataFrame:
    """vessel_code with its most frequent name and its hexadecimal code."""
    named = mode_first(trips.where(F.col("vessel_code").isNotNull()), "vessel_code", "vessel_name")
    return named.withColumn("cod_barco", text.code_to_hex(F.col("vessel_code")))


def trips_table(trips: DataFrame) -> DataFrame:
    cols = ["departure_datetime", "arrival_datetime", "vessel_code", "departure_port_id", "arrival_port_id", "target_species_id", "num_hauls"]
    return trips.select(*cols).na.drop(how="all").distinct()


def in_region(trips: DataFrame, port_table: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Trips that arrive at a port of interest, by folded names, numbered in order of departure."""
    wanted = [F.lit(n) for n in names]
    ids = port_table.where(text.folded(F.col("port_name")).isin(*[text.folded(w) for w in wanted])).select("port_id").distinct()
    found = trips.join(ids, trips["arrival_port_id"] == ids["port_id"], "left_semi")
    return sequence_ids(found, "zarpe_id", F.col("departure_datetime").asc_nulls_last(), F.col("vessel_code"), F.xxhash64(*trips.columns))


def unresolved(port_table: DataFrame, names: DataFrame) -> DataFrame:
    """Names of interest (column port_name) that no known port has."""
    known = port_table.select(text.folded(F.col("port_name")).alias("__k")).distinct()
    return names.join(known, text.folded(F.col("port_name")) == F.col("__k"), "left_anti")


def identified(staff: DataFrame, directory: DataFrame, key: str = "rut", name: str = "observador") -> DataFrame:
    """staff's key, the directory's sampler_id, score and status of each observer's name; the names themselves go no further.

    directory: sampler_id, sampler_name, surnames first.
    """
    return best_by_variants(staff, key, name, directory, "sampler_id", "sampler_name").select(key, "sampler_id", "score", "status")
