"""Daily CSV files whose headers differ in names and order."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.shared import file_system

#: The canonical report columns and the headers they are known by.
REPORT_COLUMNS = {
    "vessel_name": ("Name", "Vessel Name", "Nombre"),
    "radio_call_sign": ("Radio Call Sign (RC)", "Radio Call Sign", "Señal de llamada", "RC"),
    "location_datetime": ("Location date", "Date", "Fecha"),
    "latitude": ("Latitude", "Latitud"),
    "longitude": ("Longitude", "Longitud"),
    "heading": ("Heading", "Rumbo"),
    "speed_kt": ("Speed (kt)", "Speed", "Velocidad"),
}


def headers(spark: SparkSession, pattern: str) -> DataFrame:
    """path and header (null unless the file is UTF-8) of every file, of any size.

    A scan lists no files without bytes. Files are checked line by line in splits: no letter holds a line break, so a file is UTF-8 if its lines are. Only a line a split and file is kept on the way.
    """
    line = F.col("value")
    place = F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    lines = spark.read.text(pattern).select(F.col("_metadata.file_path").alias("at"), line, place.alias("place"))
    # with a set among them, the aggregates stay hashed by file, where a text alone would have all lines sorted
    told = lines.groupBy("at").agg(F.min_by("value", "place").alias("first"), F.collect_set(F.when(~F.is_valid_utf8("value"), True)).alias("bad"))
    files = spark.read.format("binaryFile").load(pattern).select("path", F.col("_metadata.file_path").alias("at"))  # names alone, no bytes
    header = F.regexp_replace(F.coalesce("first", F.lit("")), "^\ufeff|\r$", "")
    return files.join(told, "at", "left").select("path", F.when(F.coalesce(F.size("bad"), F.lit(0)) <= 0, header).alias("header"))


def plan_columns(header: str, columns: dict[str, tuple[str, ...]], sep: str = ";") -> list[tuple[str, str]] | None:
    """(header name, canonical name) for every canonical column, or None if one is missing."""
    known = {a.lower(): c for c, names in columns.items() for a in names}
    found = {}
    for name in header.split(sep):
        canonical = known.get(name.strip().strip('"').lower())
        if canonical and canonical not in found:
            found[canonical] = name.strip().strip('"')
    return [(found[c], c) for c in columns] if set(found) == set(columns) else None


def read_reports(spark: SparkSession, pattern: str, columns: dict[str, tuple[str, ...]] = REPORT_COLUMNS, sep: str = ";") -> tuple[DataFrame, DataFrame]:
    """(reports, rejects): canonical text columns with file and ord, and the files left out with the reason.

    Files are read by group of equal headers, since one read binds columns by a single header. ord grows with
    the row's place in its file and is unique: row numbers begin anew in each group, so the group is a part of it. A file that is not UTF-8, lacks a column or has no bytes is rejected whole.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    rejects = []
    for row in headers(spark, pattern).toLocalIterator():  # one short line a file
        plan = plan_columns(row["header"], columns, sep) if row["header"] is not None else None
        if plan is None:
            rejects.append((row["path"], "not utf-8" if row["header"] is None else "columns missing"))
        else:
            groups[row["header"]].append(row["path"])
    fs, at = file_system(spark, pattern)
    rejects += [(f.getPath().toString(), "empty") for f in fs.globStatus(at) or [] if f.isFile() and f.getLen() == 0]
    parts = []
    for group, (header, paths) in enumerate(sorted(groups.items())):
        names = [n.strip().strip('"') for n in header.split(sep)]
        unique = [n if n and names.index(n) == i else f"__{i}" for i, n in enumerate(names)]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in unique])
        raw = spark.read.csv(paths, schema=schema, sep=sep, header=True, encoding="UTF-8", enforceSchema=True)
        place = F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"), F.lit(group).alias("g"))
        parts.append(raw.select(*(F.col(f"`{h}`").alias(c) for h, c in plan_columns(header, columns, sep)), F.col("_metadata.file_name").alias("file"), place.alias("ord")))
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns) + ", file string, ord struct<b:bigint,i:bigint,g:int>")
    out = parts[0] if parts else empty
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, spark.createDataFrame(rejects, "path string, reason string")


def read_tolerant(spark: SparkSession, path: str, sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """Unquoted text columns; rows with too many fields are skipped, missing fields are null.

    The first line of a file is its header, and that line alone. Broken letters of known headers are repaired and columns without a
    name dropped.
    """
    whole = lambda header: spark.read.option("encoding", encoding).csv(path, schema="line string", sep="\u0001", quote="", escape="", header=header)
    head = whole(False).first()
    names = [repair_header(n) for n in head[0].lstrip("﻿").removeprefix("ï»¿").split(sep)] if head else []
    parts = F.split("line", sep.replace("|", r"\|"), -1)
    rows = whole(True).withColumn("__p", parts).where(F.size("__p") <= len(names))
    return rows.select(*(F.get("__p", F.lit(i)).alias(n) for i, n in enumerate(names) if n))


def read_named(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """A quoted table of text columns, its headers repaired and columns without a name dropped."""
    raw = spark.read.csv(path, sep=sep, header=True, encoding=encoding)
    names = [repair_header(n) for n in raw.columns]
    return raw.toDF(*(n or f"__{i}" for i, n in enumerate(names))).select(*(f"`{n}`" for n in names if n))


def read_latin(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """A Latin-1 table under a declared schema, its headers repaired and columns without a name dropped."""
    raw = spark.read.csv(path, schema=schema, sep=sep, header=True, encoding="ISO-8859-1", enforceSchema=True)
    names = [repair_header(n) for n in raw.columns]
    return raw.toDF(*(n or f"__{i}" for i, n in enumerate(names))).select(*(f"`{n}`" for n in names if n))


def repair_header(name: str) -> str:
    """A header with its Ñ put back; '' for a column that has no name of its own."""
    name = name.strip().strip('"')
    for broken in ("Ã\x91", "Ã‘", "ï¿½", "�"):
        name = name.replace(broken, "Ñ")
    return "" if name.startswith(("Unnamed", "_c")) else name


def date_urls(spark: SparkSession, start: str, end: str, template: str) -> DataFrame:
    """day and url for every day of an inclusive range; {day} in the template is the ISO date."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    return days.select("day", F.replace(F.lit(template), F.lit("{day}"), F.col("day").cast("string")).alias("url"))


def candidate_urls(days: DataFrame, newer: str, older: str, backfill: str, since: str, sweep: int = 60) -> DataFrame:
    """day and urls for every day of days: the places to try in turn.

    From the day `since` on, files lie in the folder of their month or in that of one later upload (backfill, as yyyy/MM); newer has {month} and
    {day} (yyyyMMdd). Earlier ones carry the second of their upload, so each second is a candidate; older has {day} (ISO) and {second}.
    """
    day = F.col("day")
    fill = lambda t, **by: reduce(lambda out, k: F.replace(out, F.lit("{" + k + "}"), by[k]), by, F.lit(t))
    month = F.date_format(day, "yyyy/MM")
    new = F.transform(F.array_distinct(F.array(month, F.lit(backfill))), lambda m: fill(newer, month=m, day=F.date_format(day, "yyyyMMdd")))
    old = F.transform(F.sequence(F.lit(0), F.lit(sweep - 1)), lambda s: fill(older, day=day.cast("string"), second=F.lpad(s.cast("string"), 2, "0")))
    return days.select("day", F.when(day >= F.lit(since).cast("date"), new).otherwise(old).alias("urls"))
