"""Regions, species, scopes and dates the plans are run for."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

#: Species of the catch tables, in column order.
SPECIES = (
    "NEEDLEFISH", "ANCHOVY", "BLUE_WHITING", "BONITO", "MACKEREL", "CABINZA", "CORVINA",
    "SQUID", "JACK_MACKEREL", "MACHUELO", "JELLYFISH", "SILVERSIDE", "SARDINE",
)
#: The species a trip is about.
OF_INTEREST = "JACK_MACKEREL"
START, END = date(2019, 3, 3), date(2024, 12, 31)
SOURCES, SCOPES = ("bitacora", "backup"), ("jurel", "all")
SUFFIX = {"bitacora": "", "backup": "_backup", "jurel": "", "all": "_all_species"}
DEFAULT_REGION = "atacama"


@dataclass(frozen=True)
class Port:
    name: str
    latitude: float | None = None
    longitude: float | None = None


@dataclass(frozen=True)
class Region:
    key: str
    bbox: tuple[float, float, float, float]
    ports: tuple[Port, ...]
    landing_names: tuple[str, ...]
    registry_codes: tuple[str, ...]
    landed_at: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.landed_at:
            object.__setattr__(self, "landed_at", tuple(p.name for p in self.ports))

    @property
    def points(self) -> list[tuple[str, float, float]]:
        """The ports that can be the nearest one."""
        return [(p.name, p.latitude, p.longitude) for p in self.ports if p.latitude is not None]


#: Key; latitude and longitude bounds; ports of landing (one without coordinates may be landed at but is
#: never the nearest one); landing statistics name; registry code; where landings count, if at fewer ports than listed.
_SINGLE = (
    Region("arica", (-19.3, -17.5, -71.5, -69.8), (Port("Arica", -18.476, -70.323),), ("Arica y Parinacota",), ("XV REGION",)),
    Region("tarapaca", (-21.7, -18.9, -71.5, -69.5), (Port("Iquique", -20.214, -70.152), Port("Pisagua", -19.597, -70.213),), ("Tarapacá",), ("I REGION",)),
    Region("antofagasta", (-26.1, -20.9, -71.8, -69.5), (Port("Antofagasta", -23.65, -70.398), Port("Mejillones", -23.099, -70.449), Port("Tocopilla", -22.092, -70.199), Port("Taltal", -25.407, -70.484),), ("Antofagasta",), ("II REGION",)),
    Region("atacama", (-29.0, -25.0, -72.0, -70.0), (Port("Caldera", -27.0667, -70.8194), Port("Chañaral", -26.35, -70.6233), Port("Huasco", -28.4714, -71.2214), Port("Carrizal Bajo", -28.0797, -71.1294), Port("Chañaral de Aceituno"),), ("Atacama",), ("III REGION",), landed_at=("Caldera",)),
    Region("coquimbo", (-32.3, -29.0, -72.5, -70.8), (Port("Coquimbo", -29.953, -71.339), Port("Tongoy", -30.255, -71.496), Port("Los Vilos", -31.911, -71.51),), ("Coquimbo",), ("IV REGION",)),
    Region("valparaiso", (-33.7, -32.0, -72.5, -71.2), (Port("San Antonio", -33.593, -71.621), Port("Valparaíso", -33.036, -71.629), Port("Quintero", -32.783, -71.527),), ("Valparaíso",), ("V REGION",)),
    Region("ohiggins", (-34.6, -33.8, -72.5, -71.6), (Port("Pichilemu", -34.388, -72.003),), ("O'Higgins",), ("VI REGION",)),
    Region("maule", (-36.2, -34.6, -73.0, -72.0), (Port("Constitución", -35.333, -72.411), Port("Pelluhue", -35.821, -72.581),), ("Maule",), ("VII REGION",)),
    Region("nuble", (-36.7, -36.0, -73.2, -72.4), (Port("Cobquecura", -36.133, -72.794),), ("Ñuble",), ("XVI REGION",)),
    Region("biobio", (-38.6, -36.5, -74.0, -72.6), (Port("Talcahuano", -36.724, -73.116), Port("San Vicente", -36.733, -73.166), Port("Coronel", -37.028, -73.158), Port("Lota", -37.09, -73.157), Port("Lebu", -37.609, -73.652),), ("Bio-bío",), ("VIII REGION",)),
    Region("araucania", (-39.7, -37.8, -74.0, -73.0), (Port("Puerto Saavedra", -38.787, -73.389), Port("Queule", -39.378, -73.219),), ("La Araucanía",), ("IX REGION",)),
    Region("los_rios", (-40.5, -39.2, -74.2, -73.0), (Port("Corral", -39.887, -73.429), Port("Niebla", -39.869, -73.398),), ("Los Ríos",), ("XIV REGION",)),
    Region("los_lagos", (-44.2, -40.2, -75.0, -72.0), (Port("Puerto Montt", -41.469, -72.942), Port("Calbuco", -41.773, -73.135), Port("Ancud", -41.866, -73.83), Port("Quellón", -43.119, -73.621),), ("Los Lagos",), ("X REGION",)),
    Region("aysen", (-49.5, -43.7, -76.0, -72.0), (Port("Puerto Aysén", -45.403, -72.691), Port("Puerto Chacabuco", -45.464, -72.828), Port("Melinka", -43.896, -73.745),), ("Aysén",), ("XI REGION",)),
    Region("magallanes", (-56.6, -48.5, -76.5, -66.0), (Port("Punta Arenas", -53.163, -70.917), Port("Puerto Natales", -51.728, -72.507),), ("Magallanes",), ("XII REGION",)),
    Region("caldera", (-29.0, -25.0, -72.0, -70.0), (Port("Caldera", -27.0667, -70.8194),), ("Atacama",), ("III REGION",)),
)
#: Larger zones by their members, north to south.
_JOINED = {
    "norte_grande": "arica tarapaca antofagasta",
    "norte_chico": "atacama coquimbo",
    "norte": "arica tarapaca antofagasta atacama coquimbo",
    "centro": "valparaiso ohiggins maule",
    "centro_sur": "nuble biobio",
    "sur": "araucania los_rios los_lagos",
    "austral": "aysen magallanes",
    "chile": "arica tarapaca antofagasta atacama coquimbo valparaiso ohiggins maule nuble biobio araucania los_rios los_lagos aysen magallanes",
}


def _zone(key: str, members: list[Region]) -> Region:
    """The members' common envelope, and their lists one after the other without repeats."""
    lat0, lat1, lon0, lon1 = zip(*(m.bbox for m in members))
    ports = {p.name: p for m in reversed(members) for p in reversed(m.ports)}
    names = dict.fromkeys(p.name for m in members for p in m.ports)
    each = lambda get: tuple(dict.fromkeys(x for m in members for x in get(m)))
    return Region(
        key, (min(lat0), max(lat1), min(lon0), max(lon1)), tuple(ports[n] for n in names),
        each(lambda m: m.landing_names), each(lambda m: m.registry_codes), each(lambda m: m.landed_at),
    )


def _regions() -> dict[str, Region]:
    out = {r.key: r for r in _SINGLE}
    return out | {key: _zone(key, [out[m] for m in members.split()]) for key, members in _JOINED.items()}


REGIONS = _regions()


def region(key: str = DEFAULT_REGION) -> Region:
    if key not in REGIONS:
        raise ValueError(f"unknown region {key!r}; known: {', '.join(REGIONS)}")
    return REGIONS[key]


def scoped(base: str, source: str = "bitacora", scope: str = "jurel") -> str:
    """The name of a product for a source and a species scope."""
    if source not in SOURCES or scope not in SCOPES:
        raise ValueError(f"unknown source or scope: {source!r}, {scope!r}")
    return f"{base}{SUFFIX[source]}{SUFFIX[scope]}"


def range_tag(start: date = START, end: date = END, days: bool = False) -> str:
    """The years of a product's name, or its first and last day."""
    if days:
        return f"{start:%Y%m%d}_{end:%Y%m%d}"
    return str(start.year) if start.year == end.year else f"{start.year}_{end.year}"


def overlap(a: tuple[date, date], b: tuple[date, date]) -> tuple[date, date] | None:
    """The days two inclusive ranges share."""
    start, end = max(a[0], b[0]), min(a[1], b[1])
    return (start, end) if start <= end else None
