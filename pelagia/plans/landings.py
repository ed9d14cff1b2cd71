"""Landing statistics of a region and years."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.functions.text import skeleton
from pelagia.sources.ledger import Sift, plain


def filter_landings(landings: DataFrame, region_names: tuple[str, ...], first_year: int, last_year: int, sift: Sift = plain) -> DataFrame:
    """Rows of the region whatever became of its accents."""
    names = [skeleton(F.lit(n)) for n in region_names]
    return sift("of the region", landings, {"outside the years": F.col("ano").between(first_year, last_year), "other region": skeleton(F.col("region")).isin(*names)})


def total(landings: DataFrame) -> DataFrame:
    return landings.agg(F.sum("toneladas").alias("toneladas"))
