"""From position reports to fishing trips and hauls.

Reports: vessel_name, radio_call_sign, location_datetime, latitude, longitude, heading, speed_kt (all text as scanned).
Everything up to the haul table is one lazy plan: one shuffle by vessel for the trips, then by trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pelagia.functions import geo, text
from pelagia.operators.nearest import nearest_point
from pelagia.operators.ordered import asof_forward, first_not_null, keep_first, last_not_null, lookup_priority, numbered, sessionize
from pelagia.sources.ledger import Sift, plain

MAX_TRIP_SECONDS = 5 * 86_400
PORT_KM = 8.0
SLOW, FAST = 0.3, 4.0
GAP_SECONDS = 20 * 60
MIN_PINGS = 3
RING, TURN, TURN_RING = 1.6, 160.0, 1.2
MIN_SPAN_KM = 0.05
#: A located haul's weight in a model, by confidence.
WEIGHTS = {"alta": 1.0, "baja": 0.5}
#: What a report is part of, and the confidence of a trip without any bout.
FISHING, CANDIDATE, TRANSIT, NO_FISHING = "pesca", "candidato", "transito", "sin_pesca"
#: Decimals of the written products.
TRIP_DECIMALS = {
    "duration_h": 2, "max_dist_km": 3, "track_km": 3, "mean_speed_kt": 2, "max_speed_kt": 2, "centroid_lat": 5, "centroid_lon": 5,
    "start_dist_km": 3, "end_dist_km": 3,
}
HAUL_DECIMALS = {
    "haul_lat": 5, "haul_lon": 5, "haul_duration_h": 2, "haul_mean_speed_kt": 2, "haul_net_turn_deg": 1, "haul_compactness": 2,
    "haul_dist_port_km": 3,
}
#: Columns of the written products, in order.
PING_COLUMNS = (
    "zarpe_id", "rpa", "vessel_code", "vessel_name", "radio_call_sign", "location_datetime", "latitude", "longitude", "heading", "speed_kt",
    "dist_port_km", "nearest_port",
)
TRIP_COLUMNS = (
    "zarpe_id", "rpa", "vessel_code", "vessel_name", "start_datetime", "end_datetime", "duration_h", "n_pings", "max_dist_km", "track_km",
    "mean_speed_kt", "max_speed_kt", "centroid_lat", "centroid_lon", "start_port", "start_dist_km", "end_port", "end_dist_km",
)
HAUL_COLUMNS = (
    "n_hauls", "haul_confidence", "haul_lat", "haul_lon", "haul_start", "haul_end", "haul_duration_h", "haul_n_pings",
    "haul_mean_speed_kt", "haul_net_turn_deg", "haul_compactness", "haul_dist_port_km", "nearest_port",
)


def consolidate(pings: DataFrame, file: str = "file", ordinal: str = "ord", sift: Sift = plain) -> DataFrame:
    """One report a call sign and time: the first file's, and its first row. A null key equals an empty one."""
    keyed = pings.withColumns({"__c": F.coalesce("radio_call_sign", F.lit("")), "__d": F.coalesce("location_datetime", F.lit(""))})
    return sift("one a sign and time", numbered(keyed, ["__c", "__d"], F.col(file), F.col(ordinal)), {"reported before": F.col("__rn") == 1}).drop("__c", "__d", "__rn")


def clean(pings: DataFrame, bbox: tuple[float, float, float, float], sift: Sift = plain) -> DataFrame:
    """Typed reports inside the box; reports without a place are dropped, unreadable numbers and times become null."""
    typed = pings.withColumns(
        {
            "location_datetime": F.try_to_timestamp("location_datetime", F.lit("d/M/yyyy H:m:s")),
            "latitude": text.number_with_unit(F.col("latitude"), "°"),
            "longitude": text.number_with_unit(F.col("longitude"), "°"),
            "heading": text.number_with_unit(F.col("heading"), "°"),
            "speed_kt": text.number_with_unit(F.col("speed_kt"), "kt"),
        }
    )
    lat, lon = F.col("latitude"), F.col("longitude")
    return sift("in the box", typed, {"without a place": lat.isNotNull() & lon.isNotNull(), "outside the box": geo.in_box(lat, lon, bbox)})


def to_fleet(pings: DataFrame, register: DataFrame, sift: Sift = plain) -> DataFrame:
    """Reports of the register's vessels with rpa and vessel_code: by call sign digits, else by name, each on its own.

    register: rpa, vessel_code, signal_code, vessel_name, ord. A report without any rpa is dropped.
    """
    keyed = pings.withColumns({"__sign": text.digits(F.col("radio_call_sign")), "__name": text.name_key(F.col("vessel_name"))})
    book = register.select("rpa", "vessel_code", "ord", text.digits(F.col("signal_code")).alias("sign_key"), text.name_key(F.col("vessel_name")).alias("name_key"))
    found = lookup_priority(keyed, [("__sign", book, "sign_key"), ("__name", book, "name_key")], ["rpa", "vessel_code"], "ord")
    return sift("of the fleet", found, {"vessel not in the register": F.col("rpa").isNotNull()}).drop("__sign", "__name")


def assign_trips(pings: DataFrame, landings: DataFrame, key: str = "vessel_code", at: str = "location_datetime", landed: str = "landing_datetime", trip: str = "zarpe_id", order: str = "ord", max_seconds: int = MAX_TRIP_SECONDS, sift: Sift = plain) -> DataFrame:
    """Reports with the trip of the next landing of their vessel; reports of no trip are dropped."""
    found = asof_forward(pings, landings, key, at, landed, [trip], max_seconds, order)
    told = F.col(key).isNotNull() & F.col(at).isNotNull()
    return sift("on a trip", found, {"without a vessel code or time": told, "no landing ahead": F.col(trip).isNotNull()})


def with_ports(pings: DataFrame, points: list[tuple[str, float, float]]) -> DataFrame:
    near = nearest_point(F.col("latitude"), F.col("longitude"), points)
    return pings.withColumn("__p", near).withColumns({"dist_port_km": F.col("__p.dist"), "nearest_port": F.col("__p.name")}).drop("__p")


def with_steps(pings: DataFrame, trip: str = "zarpe_id", at: str = "location_datetime", order: str = "ord") -> DataFrame:
    """Adds step_km and turn_deg against the trip's report before; 0 on the first."""
    w = Window.partitionBy(trip).orderBy(at, order)
    step = geo.haversine_km(F.lag("latitude").over(w), F.lag("longitude").over(w), F.col("latitude"), F.col("longitude"))
    turn = geo.circular_delta(F.col("heading"), F.lag("heading").over(w))
    return pings.withColumns({"step_km": F.coalesce(step, F.lit(0.0)), "turn_deg": F.coalesce(turn, F.lit(0.0))})


def trip_summary(pings: DataFrame, trip: str = "zarpe_id", at: str = "location_datetime", order: str = "ord", carried: tuple[str, ...] = ()) -> DataFrame:
    """One row a trip: start and end, duration, reports, distances, speeds, centroid, ports at both ends.

    First and last skip nulls. Wants columns of with_ports and with_steps.
    """
    when = F.struct(at, order)
    return pings.groupBy(trip).agg(
        *(first_not_null(c, when).alias(c) for c in carried),
        F.min(at).alias("start_datetime"),
        F.max(at).alias("end_datetime"),
        geo.hours_between(F.min(at), F.max(at)).alias("duration_h"),
        F.count("*").alias("n_pings"),
        F.max("dist_port_km").alias("max_dist_km"),
        F.coalesce(F.sum("step_km"), F.lit(0.0)).alias("track_km"),
        F.avg("speed_kt").alias("mean_speed_kt"),
        F.max("speed_kt").alias("max_speed_kt"),
        F.avg("latitude").alias("centroid_lat"),
        F.avg("longitude").alias("centroid_lon"),
        first_not_null("nearest_port", when).alias("start_port"),
        first_not_null("dist_port_km", when).alias("start_dist_km"),
        last_not_null("nearest_port", when).alias("end_port"),
        last_not_null("dist_port_km", when).alias("end_dist_km"),
    )


def candidates(pings: DataFrame, port_km: float = PORT_KM, slow: float = SLOW, fast: float = FAST) -> DataFrame:
    """Reports that may belong to a haul: away from port and slow; a null never does."""
    return pings.where((F.col("dist_port_km") >= port_km) & F.col("speed_kt").between(slow, fast))


def bouts(pings: DataFrame, trip: str = "zarpe_id", at: str = "location_datetime", order: str = "ord", gap_seconds: float = GAP_SECONDS) -> DataFrame:
    """Candidate reports with their bout and the steps and turns restarted inside it."""
    numbered = sessionize(pings, [trip], at, gap_seconds, "bout", order)
    w = Window.partitionBy(trip, "bout").orderBy(at, order)
    step = geo.haversine_km(F.lag("latitude").over(w), F.lag("longitude").over(w), F.col("latitude"), F.col("longitude"))
    turn = geo.circular_delta(F.col("heading"), F.lag("heading").over(w))
    return numbered.withColumns({"bout_km": F.coalesce(step, F.lit(0.0)), "bout_turn": F.coalesce(turn, F.lit(0.0))})


def bout_metrics(rows: DataFrame, trip: str = "zarpe_id", at: str = "location_datetime", order: str = "ord", min_pings: int = MIN_PINGS) -> DataFrame:
    """One row a bout of enough reports: turns, path, compactness, is_set, time and centre."""
    span = geo.haversine_km(F.min("latitude"), F.min("longitude"), F.max("latitude"), F.max("longitude"))
    out = rows.groupBy(trip, "bout").agg(
        F.abs(F.sum("bout_turn")).alias("net_turn"),
        F.sum(F.abs("bout_turn")).alias("total_turn"),
        F.sum("bout_km").alias("path_km"),
        span.alias("span_km"),
        F.count("*").alias("n_pings"),
        F.min(at).alias("haul_start"),
        F.max(at).alias("haul_end"),
        F.avg("latitude").alias("haul_lat"),
        F.avg("longitude").alias("haul_lon"),
        F.avg("speed_kt").alias("haul_mean_speed_kt"),
    )
    out = out.where(F.col("n_pings") >= min_pings)
    out = out.withColumn("compactness", F.col("path_km") / F.greatest(F.col("span_km"), F.lit(MIN_SPAN_KM)))
    ring = (F.col("compactness") >= RING) | ((F.col("net_turn") >= TURN) & (F.col("compactness") >= TURN_RING))
    return out.withColumn("is_set", ring)


def haul_index(metrics: DataFrame, trip: str = "zarpe_id") -> DataFrame:
    """Numbers a trip's sets from 1 in order of time."""
    w = Window.partitionBy(trip).orderBy("haul_start", "bout")
    return metrics.where("is_set").withColumn("haul_index", F.row_number().over(w))


def representative(metrics: DataFrame, trip: str = "zarpe_id") -> DataFrame:
    """A trip's best bout: sets first, then compactness, net turn, reports, and the earlier start."""
    order = [F.col(c).desc() for c in ("is_set", "compactness", "net_turn", "n_pings")]
    return keep_first(metrics, [trip], *order, F.col("haul_start"), F.col("bout"))


def haul_locations(metrics: DataFrame, trips: DataFrame, points: list[tuple[str, float, float]], trip: str = "zarpe_id") -> DataFrame:
    """Every trip with its representative haul: confidence alta for a set, baja for another bout, sin_pesca without any.

    The port is the one nearest to the haul's centre.
    """
    best = representative(metrics, trip)
    sets = metrics.groupBy(trip).agg(F.count_if("is_set").alias("n_hauls"))
    out = trips.join(best, trip, "left").join(sets, trip, "left")
    confidence = F.when(F.col("is_set"), "alta").when(F.col("is_set").isNotNull(), "baja").otherwise(NO_FISHING)
    near = nearest_point(F.col("haul_lat"), F.col("haul_lon"), points)
    out = out.withColumns(
        {
            "n_hauls": F.coalesce("n_hauls", F.lit(0)), "haul_confidence": confidence, "haul_duration_h": geo.hours_between(F.col("haul_start"), F.col("haul_end")),
            "haul_n_pings": F.coalesce("n_pings", F.lit(0)), "haul_dist_port_km": near["dist"], "nearest_port": near["name"],
        }
    )
    return out.drop("bout", "n_pings", "is_set").withColumnsRenamed({"net_turn": "haul_net_turn_deg", "compactness": "haul_compactness"})


def model_hauls(hauls: DataFrame, sift: Sift = plain) -> DataFrame:
    """Located hauls with their weight, and whether the trip had just one set."""
    weight = F.create_map(*(F.lit(x) for item in WEIGHTS.items() for x in item))
    out = sift("hauls", hauls, {"trip without a bout": F.col("haul_confidence").isin(*WEIGHTS)})
    return out.withColumns({"sample_weight": F.element_at(weight, F.col("haul_confidence")), "is_single_haul": F.col("n_hauls") == 1})


def label_pings(pings: DataFrame, rows: DataFrame, metrics: DataFrame, keys: list[str], trip: str = "zarpe_id") -> DataFrame:
    """All reports with behavior (pesca, candidato, transito), is_haul and haul_index of the set they belong to."""
    numbered = haul_index(metrics, trip).select(trip, "bout", "haul_index")
    marked = rows.select(*keys, trip, "bout").join(numbered, [trip, "bout"], "left").drop("bout", trip)
    out = pings.join(marked.withColumn("__c", F.lit(True)), keys, "left")
    behavior = F.when(F.col("haul_index").isNotNull(), FISHING).when(F.col("__c"), CANDIDATE).otherwise(TRANSIT)
    return out.withColumns({"behavior": behavior, "is_haul": F.col("haul_index").isNotNull().cast("int")}).drop("__c")


def rounded(df: DataFrame, decimals: dict[str, int]) -> DataFrame:
    """df as it is written: the columns that have one at their number of decimals."""
    return df.withColumns({c: geo.scaled_round(F.col(c), n) for c, n in decimals.items() if c in df.columns})
