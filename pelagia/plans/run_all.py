"""The whole chain from raw files to the modelling table, for every source and species scope.

    python -m pelagia.plans.run_all --data FOLDER --out FOLDER [--region atacama] [--source bitacora] [--scope jurel]
        [--shared-only | --source-only] [--skip-ocean] [--skip-forecast] [--force]

The data folder holds
    vms_daily/*.csv          position reports, a file a day
    registry_raw.csv         the registry (;), or registry_pages.parquet (region, html)
    vessel_sheets.parquet    rpa, html: the registry's sheet of each vessel
    observer_trips_raw.csv   observer trips (,); with a column id_viaje, trip_sheets.parquet may hold id_viaje and html, each trip's detail sheet
    catch_wide.csv, catch_long.csv, landings.csv
    sst, chl, phy, bgc, phy_forecast, bgc_forecast  gridded fields as Parquet, where the ocean is asked for; instead of one
                             of the first four a folder of the product's overlapping Parquet files on the region's axes, sst_files
                             and so on (the last by name wins a time; axes that differ end the run), or of its NetCDF files, sst_nc

Shared stages (observers, registry, fleet reports, landings, forecast) are written once; each source and scope starts from there.
Products are versions (sources/versions.py; versions.read reads the last one): one is made again only if it is forced, if the files or products that it is made of
have changed, or the region, the days or RULES; what is made of it follows, and nothing else. A reader during a run sees one whole version. A stage without rows ends the run.

Beside the products there are files for people: each scope's final table and the forecast, named by its first and last day, as CSV, with a dictionary of the columns. They follow
their product's version. Each scope has a summary in numbers, and observers/ports_unknown and observers/ports_ambiguous list ports of interest that no trip names and ids with several names.

run_report gets a row for each step and cause of the products that a run makes: product, place, step, what (in, out or why rows were dropped), rows, made_at. Rows that
neither went on nor were dropped for a cause end the run.
"""

from __future__ import annotations

import argparse
import functools
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia import session
from pelagia.config import END, SCOPES, SOURCES, START, Region, range_tag, region, scoped
from pelagia.operators.grid import Axis
from pelagia.operators.ordered import conflicts, keep_first
from pelagia.plans import catch, landings, observers, ocean, registry, summaries, vms
from pelagia.shared import file_system, materialize, release
from pelagia.sources import grid_store, versions
from pelagia.sources.csv_daily import read_named, read_reports, read_tolerant
from pelagia.sources.ledger import Ledger, Sift, plain
from pelagia.sources.products import by_number, described, dictionary, write

STEP = 1 / 24
#: Raised when the rules of a stage change, so that products of the old ones are made again.
RULES = 1
CATCH_FILE = {"bitacora": "catch_wide.csv", "backup": "catch_long.csv"}


def axes(where: Region) -> tuple[Axis, Axis]:
    lat0, lat1, lon0, lon1 = where.bbox
    return Axis.covering(lat0, lat1, STEP), Axis.covering(lon0, lon1, STEP)


def fleet_reports(pings: DataFrame, register: DataFrame, where: Region, sift: Sift = plain) -> DataFrame:
    return vms.to_fleet(vms.clean(vms.consolidate(pings, sift=sift), where.bbox, sift), register, sift)


def spine(source: str, scope: str, raw: DataFrame, vessels: DataFrame, where: Region, sift: Sift = plain) -> DataFrame:
    """The numbered trips of one source and scope. Landings are written before they are numbered, for the numbering reads them twice."""
    cleaned = catch.clean_wide(raw, where.points, sift) if source == "bitacora" else catch.clean_long(raw, sift=sift)
    return catch.trip_spine(materialize(catch.filter_catch(cleaned, where.landed_at, START, END, scope, sift)), vessels)


def tripped(trips: DataFrame, reports: DataFrame, where: Region, sift: Sift = plain) -> DataFrame:
    """The fleet's reports with their trip, ports and steps. Reports need a unique column ord."""
    landed = trips.select("vessel_code", "landing_datetime", "zarpe_id", F.col("zarpe_id").alias("ord")).where(F.col("vessel_code").isNotNull())
    return vms.with_steps(vms.with_ports(vms.assign_trips(reports, landed, sift=sift), where.points))


def haul_table(reports: DataFrame, metrics: DataFrame, trips: DataFrame, where: Region) -> DataFrame:
    """Every trip with reports and its catch by species, with its representative haul."""
    known = reports.select("zarpe_id").distinct()
    located = vms.haul_locations(metrics, known, where.points)
    tons = [c for c in trips.columns if c.endswith("_tons")]
    return located.join(trips.select("zarpe_id", "vessel_code", "vessel_name", *tons, "principal_catch"), "zarpe_id", "left").select(
        "zarpe_id", "vessel_code", "vessel_name", *tons, "principal_catch", *vms.HAUL_COLUMNS
    )


def hauls(trips: DataFrame, reports: DataFrame, where: Region) -> DataFrame:
    """Every located haul of the trips with the trip's catch."""
    mine = tripped(trips, reports, where)
    return vms.model_hauls(haul_table(mine, vms.bout_metrics(vms.bouts(vms.candidates(mine))), trips, where))


class Run:
    """Where a run reads and writes, and what it has made."""

    def __init__(self, spark: SparkSession, data: str, out: str, where: Region, force: bool = False):
        self.spark, self.data, self.out, self.where, self.force = spark, data, f"{out}/{where.key}", where, force
        self.made: list[str] = []
        self.remade: set[str] = set()
        self.counts: list[tuple] = []
        self.grids: dict[str, DataFrame] = {}

    def has(self, name: str) -> bool:
        fs, at = file_system(self.spark, f"{self.data}/{name}")
        return fs.exists(at)

    def read(self, name: str) -> DataFrame:
        return versions.read(self.spark, f"{self.out}/{name}")

    def version(self, name: str, make: Callable[[], DataFrame], raw: tuple[str, ...], of: tuple[str, ...], **options) -> DataFrame:
        """The product of that name, made anew if it is forced or what it is made of has changed: raw files, and other products."""
        inputs = {f"raw {r}": f"{self.data}/{r}" for r in raw} | {p: f"{self.out}/{p}" for p in of}
        settings = {"region": repr(self.where), "days": (START, END), "rules": RULES}
        rows, anew = versions.make(self.spark, f"{self.out}/{name}", make, inputs, settings, self.force, **options)
        if anew:
            self.remade.add(name)
        return rows

    def product(self, name: str, make: Callable[[Sift], DataFrame], raw: tuple[str, ...] = (), of: tuple[str, ...] = (), empty: bool = False, order: tuple = (), check: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """A version whose steps are counted: what they dropped must balance before it can be seen."""
        ledger, cut = Ledger(), []

        def maker() -> DataFrame:
            rows = make(ledger.sift)
            if order and ledger.steps:  # a sort by range works its input out twice, and so would count twice
                rows = materialize(rows)
                cut.append(rows)
            return rows

        def balanced(written: DataFrame) -> None:
            release(*cut)
            if check:
                check(written)
            if ledger.steps:
                self.counts += ledger.settle(name, written.count())

        rows = self.version(name, maker, raw, of, empty=empty, order=order, check=balanced)
        self.made.append(f"{self.out}/{name}")
        return rows

    def for_people(self, name: str, of: str, rows: DataFrame, order: tuple = ()) -> None:
        """rows as one CSV file that follows the version of a product; a mark in the folder tells which one it is of, and is written last."""
        path, mark = f"{self.out}/{name}", f"{self.out}/{name}/_made_of"
        made_of = versions.manifest(self.spark, f"{self.out}/{of}")["folder"]
        fs, at = file_system(self.spark, mark)
        if not fs.exists(at) or versions.text_of(self.spark, mark) != made_of:
            write(rows, path, True, csv=True, order=order)
            versions.put(self.spark, mark, made_of)
        self.made.append(path)

    def report(self) -> None:
        """Adds the counts of this run's products to the run report."""
        if self.counts:
            at = datetime.now(timezone.utc)
            rows = self.spark.createDataFrame([(*c, at) for c in self.counts], "product string, place int, step string, what string, rows long, made_at timestamp")
            rows.coalesce(1).write.mode("append").parquet(f"{self.out}/run_report")
            self.counts = []

    def observed(self) -> DataFrame:
        """Observer trips with their dimensions; returns the vessels."""
        raw = read_named(self.spark, f"{self.data}/observer_trips_raw.csv")
        files = ("observer_trips_raw.csv",)
        if self.has("trip_sheets.parquet") and "id_viaje" in raw.columns:
            sheets = keep_first(self.spark.read.parquet(f"{self.data}/trip_sheets.parquet").select("id_viaje", "html"), ["id_viaje"], F.col("html"))
            raw, files = observers.with_details(raw.drop(*observers.OPTIONAL).join(sheets, "id_viaje", "left")), (*files, "trip_sheets.parquet")
        clean = "observers/trips_clean"
        trips = self.product(clean, lambda _: observers.clean_trips(raw), raw=files)
        ports = self.product("observers/ports", lambda _: observers.ports(trips), of=(clean,), order=(by_number("port_id"), "port_name"))
        wanted = lambda _: observers.unresolved(ports, self.spark.createDataFrame([(n,) for n in self.where.landed_at], "port_name string"))
        self.product("observers/ports_unknown", wanted, of=("observers/ports",), empty=True)
        self.product("observers/ports_ambiguous", lambda _: conflicts(ports, "port_id", "port_name"), of=("observers/ports",), empty=True)
        self.product("observers/species", lambda _: observers.species(trips), of=(clean,), empty=True, order=(by_number("species_id"), "species_name"))
        vessels = self.product("observers/vessels", lambda _: observers.vessels(trips), of=(clean,), order=(by_number("vessel_code"),))
        zarpes = self.product("observers/zarpes", lambda _: observers.trips_table(trips), of=(clean,))
        self.product("observers/zarpes_region", lambda _: observers.in_region(zarpes, ports, self.where.landed_at), of=("observers/zarpes", "observers/ports"), empty=True, order=("zarpe_id",))
        return vessels

    def fleet(self, vessels: DataFrame) -> DataFrame:
        """The exclusive fleet of the region's registry."""
        if self.has("registry_pages.parquet"):
            file, raw = "registry_pages.parquet", registry.from_pages(self.spark.read.parquet(f"{self.data}/registry_pages.parquet"))
        else:
            file, raw = "registry_raw.csv", read_named(self.spark, f"{self.data}/registry_raw.csv", ";").withColumnsRenamed(registry.HEADERS)
        numbered = raw.withColumn("ord", F.monotonically_increasing_id())
        clean = self.product("registry/register_clean", lambda sift: registry.clean_register(numbered, sift=sift), raw=(file,), order=(by_number("id"),))
        matched = self.product("registry/register_matched", lambda sift: registry.match_observed(registry.in_scope(clean, self.where.registry_codes, sift=sift), vessels, sift=sift), of=("registry/register_clean", "observers/vessels"))
        sheets = self.product("registry/sheets", lambda _: registry.read_sheet(self.spark.read.parquet(f"{self.data}/vessel_sheets.parquet").join(matched, "rpa", "left_semi")), raw=("vessel_sheets.parquet",), of=("registry/register_matched",))
        gears = self.product("registry/fishing_types", lambda _: registry.gear_catalogue(sheets), of=("registry/sheets",), order=("fishing_type_id",))
        return self.product("registry/register", lambda sift: registry.fleet(matched, sheets, gears, sift), of=("registry/register_matched", "registry/sheets", "registry/fishing_types"), order=(by_number("id"),))

    def shared(self, forecast: bool) -> None:
        vessels = self.observed()
        register = self.fleet(vessels)
        daily = functools.cache(lambda: read_reports(self.spark, f"{self.data}/vms_daily/*.csv"))  # checks every file, so only for who makes something of it
        self.product("rejected_files", lambda _: daily()[1], raw=("vms_daily/*.csv",), empty=True)
        self.product("reports_fleet", lambda sift: fleet_reports(daily()[0], register, self.where, sift), raw=("vms_daily/*.csv",), of=("registry/register",))
        if self.has("landings.csv"):
            rows = read_named(self.spark, f"{self.data}/landings.csv", ";", "ISO-8859-1").withColumns({"ano": F.col("ano").try_cast("int"), "toneladas": F.col("toneladas").try_cast("double")})
            self.product("landings", lambda sift: landings.filter_landings(rows, self.where.landing_names, START.year, END.year, sift), raw=("landings.csv",), empty=True)
        if forecast:
            files = ("phy_forecast.parquet", "bgc_forecast.parquet")
            layers = lambda: (self.spark.read.parquet(f"{self.data}/{f}") for f in files)
            grid = lambda _: described(ocean.forecast_grid(*layers(), *axes(self.where)).select("time", "latitude", "longitude", *ocean.FORECAST, "coast_filled"), summaries.NOTES)
            made = self.product("forecast_grid", grid, raw=files, order=("time", "latitude", "longitude"))
            first, last = made.agg(F.to_date(F.min("time")), F.to_date(F.max("time"))).first()
            self.for_people(f"forecast_grid_{range_tag(first, last, days=True)}", "forecast_grid", made.withColumn("time", F.to_date("time")), ("time", "latitude", "longitude"))
            self.for_people("forecast_grid_dictionary", "forecast_grid", dictionary(made), ("place",))

    def grid_of(self, name: str) -> tuple[str, str]:
        """Which raw files a grid comes from, and its name among the products: none for a prepared grid that is kept by day itself, and read where it is."""
        kinds = [f"{name}.parquet", f"{name}_files", f"{name}_nc"]
        file = next((k for k in kinds if self.has(k)), kinds[0])
        in_place = file == kinds[0] and self.has(file) and grid_store.DAY in self.spark.read.parquet(f"{self.data}/{file}").columns
        return file, "" if in_place else f"grids/{name}"

    def grid(self, name: str) -> DataFrame:
        """The store by day of a prepared grid, of a folder of overlapping files, or of the product's NetCDF files."""
        if name not in self.grids:
            file, product = self.grid_of(name)
            at, axes_ = f"{self.data}/{file}", axes(self.where)

            def make() -> DataFrame:
                if file.endswith("_nc"):
                    return grid_store.by_day(ocean.raw_grid(self.spark, at, ocean.RAW[name], *axes_, str(START), str(END)))
                if file.endswith("_files"):
                    return grid_store.by_day(grid_store.merged(grid_store.read_files(self.spark, at), *axes_))
                return grid_store.by_day(self.spark.read.parquet(at))

            self.grids[name] = self.version(product, make, (file,), (), partition_by=(grid_store.DAY,), empty=False) if product else self.spark.read.parquet(at)
        return self.grids[name]

    def of_source(self, source: str, scope: str, with_ocean: bool) -> None:
        base = scoped(f"zarpes_{range_tag()}", source, scope)
        file = CATCH_FILE[source]
        raw = read_named(self.spark, f"{self.data}/{file}", ",", "ISO-8859-1") if source == "bitacora" else read_tolerant(self.spark, f"{self.data}/{file}")
        vessels, reports = self.read("observers/vessels"), self.read("reports_fleet")
        at = lambda *names: tuple(f"{base}/{n}" for n in names)
        trips = self.product(f"{base}/trips", lambda sift: spine(source, scope, raw, vessels, self.where, sift), raw=(file,), of=("observers/vessels",), order=("zarpe_id",))
        mine = self.product(f"{base}/pings", lambda sift: tripped(trips, reports, self.where, sift), of=(*at("trips"), "reports_fleet"))
        self.product(f"{base}/pings_trip", lambda _: vms.rounded(mine, {"dist_port_km": 3}).select(*vms.PING_COLUMNS), of=at("pings"))
        summary = lambda: vms.trip_summary(mine, carried=("rpa", "vessel_code", "vessel_name"))
        lengths = self.product(f"{base}/trip_summary", lambda _: vms.rounded(summary(), vms.TRIP_DECIMALS).select(*vms.TRIP_COLUMNS), of=at("pings"))
        bouts = vms.bouts(vms.candidates(mine))
        metrics = self.product(f"{base}/bouts", lambda _: vms.bout_metrics(bouts), of=at("pings"), empty=True)
        labelled = lambda: vms.rounded(vms.label_pings(mine, bouts, metrics, ["ord"]), {"dist_port_km": 3, "turn_deg": 1})

        def one_each(marked: DataFrame) -> None:
            if marked.count() != mine.count():
                raise ValueError(f"{base}/pings_behaviour: labels are not one a report")

        self.product(f"{base}/pings_behaviour", lambda _: labelled().select(*vms.PING_COLUMNS, "turn_deg", "behavior", "is_haul", "haul_index"), of=at("pings", "bouts"), check=one_each)
        located = self.product(f"{base}/haul_location", lambda _: vms.rounded(haul_table(mine, metrics, trips, self.where), vms.HAUL_DECIMALS), of=at("pings", "bouts", "trips"))
        model = self.product(f"{base}/haul_model", lambda sift: vms.model_hauls(located, sift), of=at("haul_location"))
        final = None
        if with_ocean:
            grids = {g: self.grid(g) for g in sorted({s.grid for s in ocean.SAMPLERS})}
            sources = [self.grid_of(g) for g in grids]
            covered = lambda _: described(ocean.haul_environment(model, grids, *axes(self.where)), {c: n for c, n in summaries.NOTES.items() if c not in model.columns})
            final = self.product(f"{base}/haul_env", covered, raw=tuple(f for f, kept in sources if not kept), of=(*at("haul_model"), *(kept for _, kept in sources if kept)), order=("zarpe_id",))
            self.for_people(f"{base}/haul_env_csv", f"{base}/haul_env", final.withColumn("env_time", F.to_date("env_time")), ("zarpe_id",))
        told = at("trip_summary", "haul_location", "haul_env") if with_ocean else at("trip_summary", "haul_location")
        self.product(f"{base}/summary", lambda _: summaries.summary(lengths, located, final), of=told)


def run(spark: SparkSession, data: str, out: str, where: Region, sources: tuple[str, ...] = SOURCES, scopes: tuple[str, ...] = SCOPES, force: bool = False, with_ocean: bool = True, forecast: bool = True, shared: bool = True, by_source: bool = True) -> list[str]:
    """Runs the stages asked for; the paths of their products."""
    work = Run(spark, data, out, where, force)
    try:
        if shared:
            work.shared(forecast)
        if by_source:
            for source in sources:
                for scope in scopes:
                    work.of_source(source, scope, with_ocean)
    finally:
        work.report()
    return work.made


def main() -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--data", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--region", default="atacama")
    p.add_argument("--source", choices=SOURCES)
    p.add_argument("--scope", choices=SCOPES)
    only = p.add_mutually_exclusive_group()
    only.add_argument("--shared-only", action="store_true")
    only.add_argument("--source-only", action="store_true")
    p.add_argument("--skip-ocean", action="store_true")
    p.add_argument("--skip-forecast", action="store_true")
    p.add_argument("--force", action="store_true")
    a = p.parse_args()
    spark = session.build("pelagia run_all")
    session.ship(spark)
    sources, scopes = (a.source,) if a.source else SOURCES, (a.scope,) if a.scope else SCOPES
    for path in run(spark, a.data, a.out, region(a.region), sources, scopes, a.force, not a.skip_ocean, not a.skip_forecast, not a.source_only, not a.shared_only):
        print(path)


if __name__ == "__main__":
    main()
