"""From registry pages to the exclusive purse-seine fleet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.functions import text
from pelagia.operators.html import cell_after, groups_after, result_table, sheet_cells
from pelagia.operators.match import fuzzy_match
from pelagia.operators.ordered import drop_ambiguous, numbered, sequence_ids
from pelagia.sources.ledger import Sift, plain

#: Columns of the registry's result table, in order.
COLUMNS = (
    "correlative", "rpa", "vessel_name", "category", "registration_date", "registration_number", "port", "registration_end", "type",
    "owner_id", "owner_name", "length", "beam", "depth", "gross_tonnage", "engine_power", "hold_capacity", "office", "cove",
)


#: Headers of the saved registry.
HEADERS = {
    "Correlativo": "id", "Nº RPA": "rpa", "Nombre Embarcación": "vessel_name", "Categoría": "category", "Fecha Inscripción": "registration_date",
    "Nº Matrícula": "registration_number", "Puerto": "port", "Venc. Matríc": "registration_end", "Tipo": "type", "Rut Armador": "owner_id",
    "Nombre Armador": "owner_name", "Eslora": "length", "Manga": "beam", "Puntal": "depth", "T.R.G": "gross_tonnage", "Potencia": "engine_power",
    "Bodega": "hold_capacity", "Oficina": "office", "Caleta": "cove", "Region": "region",
}
#: Fixed value: the gear whose exclusive users are the fleet.
SEINE = "CERCO"


def from_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """The result tables' rows under the registry's column names; pages bring their region along."""
    return result_table(pages, html, list(COLUMNS)).withColumnsRenamed({"correlative": "id"})


def read_sheet(sheets: DataFrame, key: str = "rpa", html: str = "html") -> DataFrame:
    """key, signal_code (digits), status and gears (map of species to gears) of vessels' sheets."""
    cells = sheets.select(key, sheet_cells(F.col(html)).alias("c"))
    c = F.col("c")
    rows = F.filter(groups_after(c, "todo de Captura", contains=True), lambda g: (g[0] != "") & (g[1] != ""))
    pairs = F.transform(rows, lambda g: F.struct(g[1].alias("species"), g[0].alias("gear")))
    species = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["species"])))
    gears = F.map_from_entries(F.transform(species, lambda s: F.struct(s, F.array_sort(F.array_distinct(F.transform(F.filter(pairs, lambda p: p["species"] == s), lambda p: p["gear"]))))))
    signal = text.digits(cell_after(c, "Distintiva", 5, contains=True))
    return cells.select(key, signal.alias("signal_code"), F.coalesce(cell_after(c, "Estado", 4), F.lit("")).alias("status"), gears.alias("gears"))


def fleet(register: DataFrame, sheets: DataFrame, catalogue: DataFrame, sift: Sift = plain) -> DataFrame:
    """The register with call sign digits and packed gears, only vessels with a call sign that fish by seine alone."""
    packed = with_gear_ids(sheets, catalogue)
    book = register.join(sheets.select("rpa", "signal_code"), "rpa", "left").join(packed, "rpa", "left")
    seine = catalogue.where(F.col("fishing_type") == SEINE).select(F.col("fishing_type_id").cast("string")).first()
    if seine is None:
        raise ValueError(f"no sheet names the gear {SEINE}")
    return exclusive(book, seine[0], sift)


def clean_register(raw: DataFrame, ordinal: str = "ord", sift: Sift = plain) -> DataFrame:
    """The latest registration of a hull (number and port), undated ones last; owners' names and ids go no further."""
    dated = raw.withColumn("registration_date", F.try_to_timestamp("registration_date", F.lit("d-M-yyyy")).cast("date"))
    each = numbered(dated, ["registration_number", "port"], F.col("registration_date").desc_nulls_last(), F.col(ordinal))
    last = sift("latest of a hull", each, {"older registration": F.col("__rn") == 1})
    return last.drop("__rn", "owner_id", "owner_name", "registration_end", "type", "office")


def in_scope(register: DataFrame, region_codes: tuple[str, ...], category: str = "LANCHA", sift: Sift = plain) -> DataFrame:
    return sift("in scope", register, {"other region": F.trim("region").isin(*region_codes), "other category": F.upper(F.trim("category")) == category})


def match_observed(register: DataFrame, vessels: DataFrame, cutoff: float = 0.85, sift: Sift = plain) -> DataFrame:
    """The register with vessel_code and cod_barco of the likest observed vessel; a vessel claimed twice is dropped."""
    found = fuzzy_match(register, "rpa", "vessel_name", vessels, "vessel_code", "vessel_name", cutoff).drop("score")
    sure = drop_ambiguous(found, ["vessel_code"])
    codes = vessels.select("vessel_code", "cod_barco").dropDuplicates(["vessel_code"])
    found = register.join(sure.withColumn("__found", F.lit(True)), "rpa", "left")
    return sift("observed", found, {"no observed vessel, or one claimed twice": F.col("__found")}, fresh=True).drop("__found").join(codes, "vessel_code", "left")


def gear_catalogue(sheets: DataFrame, gears: str = "gears") -> DataFrame:
    """fishing_type_id (from 1, by name) and fishing_type of every gear named in the sheets' maps."""
    names = sheets.select(F.explode(text.gear_union(F.col(gears))).alias("fishing_type")).distinct()
    return sequence_ids(names, "fishing_type_id", F.col("fishing_type"))


def with_gear_ids(sheets: DataFrame, catalogue: DataFrame, key: str = "rpa", gears: str = "gears") -> DataFrame:
    """key and species_fishing_types: the maps with ids in place of names, packed as text."""
    rows = sheets.select(key, F.explode(gears).alias("species", "names")).select(key, "species", F.explode("names").alias("fishing_type"))
    ids = rows.join(catalogue, "fishing_type").groupBy(key, "species").agg(F.array_sort(F.collect_set("fishing_type_id")).alias("ids"))
    pair = F.struct("species", F.transform("ids", lambda i: i.cast("string")).alias("ids"))
    packed = ids.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("m"))
    return packed.select(key, text.encode_gears(F.col("m")).alias("species_fishing_types"))


def exclusive(register: DataFrame, gear_id: str, sift: Sift = plain) -> DataFrame:
    """Vessels with a call sign whose only gear is the given one."""
    gears = text.decode_gears(F.col("species_fishing_types"))
    return sift("seiners", register, {"other gear": text.only_gear(gears, gear_id), "without a call sign": F.coalesce(F.trim("signal_code"), F.lit("")) != ""})
