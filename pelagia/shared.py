"""Tables in the folder that the driver and all executors share: where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_OWN: set[str] = set()
#: Where each table that materialize() returned lies.
_PATHS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it wants it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def scratch(spark: SparkSession) -> str:
    """A new path in the folder all executors share (spark.checkpoint.dir), in a folder of this application that goes when it ends.

    Only where that setting is missing in a local session, as in tests, is a folder made and the setting filled in.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master  # the executors of local-cluster share no folder by themselves
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="pelagia-")
        spark.conf.set("spark.checkpoint.dir", root)
    own = f"{root.rstrip('/')}/pelagia-{spark.sparkContext.applicationId}"
    if own not in _OWN:
        fs, path = file_system(spark, own)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _OWN.add(own)
    return f"{own}/{uuid.uuid4().hex}"


def materialize(df: DataFrame, *partition_by: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there, and lost executors lose nothing. options: more ones of the writer."""
    path = scratch(df.sparkSession)
    writer = df.write.options(**{"compression": "zstd"} | (options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of materialize() from the shared folder. Nothing that is still to be computed may read them."""
    for table in tables:
        path = _PATHS.pop(table, None)
        if path:
            fs, at = file_system(table.sparkSession, path)
            fs.delete(at, True)
