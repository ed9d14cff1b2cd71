"""JSON records: directories to look people up in, and the marks a run leaves of how far it got."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.functions.text import folded

#: Fixed value: this word in place of a wanted value lets every value pass.
ANY = "todas"


def read_directory(spark: SparkSession, path: str, wanted: dict[str, str], columns: tuple[str, ...]) -> DataFrame:
    """The records of JSON arrays or lines whose fields equal the wanted values, accents and case apart; text columns, trimmed.

    A record that lacks a field has it empty.
    """
    fields = dict.fromkeys([*columns, *wanted])
    rows = spark.read.schema(", ".join(f"`{c}` string" for c in fields)).json(path, multiLine=True)
    rows = rows.select(*(F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in fields))
    for field, value in wanted.items():
        rows = rows.where((folded(F.lit(value)) == ANY) | (folded(F.col(field)) == folded(F.lit(value))))
    return rows.select(*columns)


def progress_to_json(progress: DataFrame) -> DataFrame:
    """One text column `value`, a JSON record a row, for a run's manifest."""
    return progress.select(F.to_json(F.struct(*progress.columns), {"ignoreNullFields": "false"}).alias("value"))


def progress_from_json(lines: DataFrame, schema: str) -> DataFrame:
    """The records of a manifest; lines that are no record are left out."""
    parsed = lines.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"), "value").where(F.try_parse_json("value").isNotNull())
    return parsed.select("r.*")
