"""Position reports as a stream of daily files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pelagia.operators.ordered import keep_first

REPORT_SCHEMA = "vessel_name string, radio_call_sign string, location_datetime timestamp, latitude double, longitude double, heading double, speed_kt double"


def report_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Cleaned Parquet reports file by file, with the file's name."""
    stream = spark.readStream.schema(REPORT_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return stream.withColumn("file", F.col("_metadata.file_name"))


def deduplicated(reports: DataFrame, late: str = "2 days") -> DataFrame:
    """One report a call sign and time. A day's file repeats reports of the day before, so state is kept for two days."""
    return reports.withWatermark("location_datetime", late).dropDuplicatesWithinWatermark(["radio_call_sign", "location_datetime"])


def consolidate_to(reports: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Exact keep-first over all files: each batch keeps its first rows and drops keys the target has.

    A batch writes a folder of its own by day, replaced if the batch is run again, and looks only at the days it has reports of;
    the trigger ends when all files are read.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark, keys = batch.sparkSession, ["radio_call_sign", "location_datetime"]
        first = keep_first(batch, keys, F.col("file"), F.xxhash64(*batch.columns)).withColumn("day", F.to_date("location_datetime"))
        if number:
            days = batch.agg(F.to_date(F.min("location_datetime")).alias("low"), F.to_date(F.max("location_datetime")).alias("high")).first()
            mine = F.col("day").isNull() | F.col("day").between(F.lit(days["low"]), F.lit(days["high"]))
            schema = batch.schema.add("batch", "long").add("day", "date")
            done = spark.read.schema(schema).parquet(target).where((F.col("batch") < number) & mine).select(*(F.col(k).alias(f"__{k}") for k in keys))
            same = F.col(keys[0]).eqNullSafe(F.col(f"__{keys[0]}")) & F.col(keys[1]).eqNullSafe(F.col(f"__{keys[1]}"))
            first = first.join(done, same, "left_anti")
        first.write.mode("overwrite").partitionBy("day").parquet(f"{target}/batch={number}")

    return reports.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def live_sessions(reports: DataFrame, gap: str = "20 minutes", late: str = "2 days") -> DataFrame:
    """Sessions of slow reports by vessel, closed by the gap: the streaming form of a bout's size and span."""
    slow = reports.where(F.col("speed_kt").between(0.3, 4.0)).withWatermark("location_datetime", late)
    grouped = slow.groupBy("radio_call_sign", F.session_window("location_datetime", gap).alias("s"))
    return grouped.agg(F.count("*").alias("n_pings"), F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")).select("radio_call_sign", "s.start", "s.end", "n_pings", "latitude", "longitude")
