"""Writing products: committed whole, skipped when they are there already, with a report."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.shared import file_system


class EmptyProduct(ValueError):
    """A stage made no rows, so what builds on it would be empty without a word."""


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished product is there: Spark's success mark is written last."""
    fs, at = file_system(spark, f"{path.rstrip('/')}/_SUCCESS")
    return fs.exists(at)


def write(df: DataFrame, path: str, force: bool = False, partition_by: tuple[str, ...] = (), csv: bool = False, sep: str = ",", order: tuple[Column | str, ...] = (), empty: bool = True) -> bool:
    """Writes df unless the product exists; true if written. A CSV product is one file, for people, its times in ISO form.

    The rows go to a new folder that takes the old one's place only when it is whole. With an order, the files in turn are in it.
    Unless empty products are allowed, one without rows raises EmptyProduct and leaves the old one alone.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if exists(spark, path) and not force:
        return False
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    rows = df.orderBy(*order) if order else df
    rows = iso_times(rows).coalesce(1) if csv else rows
    writer = rows.write.partitionBy(*partition_by)
    writer.csv(fresh, header=True, sep=sep) if csv else writer.parquet(fresh)
    fs, at = file_system(spark, path)
    if not empty and (spark.read.csv(fresh, header=True) if csv else spark.read.parquet(fresh)).isEmpty():
        fs.delete(file_system(spark, fresh)[1], True)
        raise EmptyProduct(path)
    if fs.exists(at):
        fs.rename(at, file_system(spark, old)[1])
    if not fs.rename(file_system(spark, fresh)[1], at):
        raise OSError(f"{fresh} could not take the place of {path}")
    fs.delete(file_system(spark, old)[1], True)
    return True


def iso_times(df: DataFrame) -> DataFrame:
    """Times and days as ISO text, for sinks that only hold text."""
    form = {"timestamp": "yyyy-MM-dd HH:mm:ss", "date": "yyyy-MM-dd"}
    return df.withColumns({c: F.date_format(c, form[kind]) for c, kind in df.dtypes if kind in form})


def by_number(column: str) -> Column:
    """An order by a text's number, texts that are none last."""
    return F.col(column).try_cast("long").asc_nulls_last()


def report(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n, n_valid, low, high, mean for numeric columns, in one pass."""
    one = df.agg(F.count("*").alias("n"), *(f(c).alias(f"{c}__{name}") for c in columns for name, f in (("n_valid", F.count), ("low", F.min), ("high", F.max), ("mean", F.avg))))
    rows = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"), F.col("n"), F.col(f"{c}__n_valid").alias("n_valid"),
                *(F.col(f"{c}__{k}").cast("double").alias(k) for k in ("low", "high", "mean")),
            )
            for c in columns
        )
    )
    return one.select(F.inline(rows))


def described(df: DataFrame, notes: dict[str, str]) -> DataFrame:
    """df with column comments, which Parquet tables and the catalog keep."""
    return df.select(*(F.col(c).alias(c, metadata={"comment": notes[c]}) if c in notes else F.col(c) for c in df.columns))


def dictionary(df: DataFrame) -> DataFrame:
    """place, column, type and comment of each column of a described table."""
    rows = [(i, f.name, f.dataType.simpleString(), f.metadata.get("comment")) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "place int, column string, type string, comment string")
