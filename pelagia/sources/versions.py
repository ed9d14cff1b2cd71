"""Versioned products: numbered manifests over whole data folders, and fingerprints that tell when a product is out of date.

A product's folder holds data-<uuid> folders and _versions/<number>.json. A version is there when its manifest is, and that appears by one rename to a name nobody
had before, so a reader always sees one whole version and a crash leaves only a data folder that nothing names. Two writers of the same number: the rename of the
second fails, and it takes the next. The last `keep` versions stay for readers that began with them; older ones go, and so do data folders
without a manifest once they are a day old.

A fingerprint is the sha256 of the settings and of the inputs: for files their names, sizes and times, for products their own fingerprints. A product is made again if
its fingerprint has changed, and then what is made of it, and nothing else.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from pelagia.shared import file_system
from pelagia.sources.products import EmptyProduct

ORPHAN_SECONDS = 86_400


def text_of(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def put(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file beside its name and gives it the name, if that is free."""
    fs, at = file_system(spark, path)
    fresh = file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")[1]
    out = fs.create(fresh)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.exists(at) and fs.rename(fresh, at):
        return True
    fs.delete(fresh, False)
    return False


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions that are there, from the oldest."""
    fs, at = file_system(spark, f"{path}/_versions")
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def manifest(spark: SparkSession, path: str, number: int | None = None) -> dict | None:
    """A version's manifest, the last one's if no number is given; None if there is none."""
    have = numbers(spark, path)
    if not have or (number is not None and number not in have):
        return None
    return json.loads(text_of(spark, f"{path}/_versions/{number or have[-1]:010d}.json"))


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of a product's last version, or of one that is still kept."""
    found = manifest(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"{path}: no version {number or ''}")
    return spark.read.parquet(f"{path}/{found['folder']}")


def files(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and times of a file, or of all files below a folder or pattern; their bytes are not read."""
    fs, at = file_system(spark, path)
    seen, todo = [], list(fs.globStatus(at) or [])
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += list(fs.listStatus(status.getPath()))
        elif not status.getPath().getName().startswith((".", "_")):
            seen.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return hashlib.sha256(json.dumps(sorted(seen)).encode()).hexdigest()


def fingerprint(spark: SparkSession, inputs: dict[str, str], settings: dict) -> str:
    """inputs: name -> path of a versioned product, or of files."""
    each = {}
    for name, path in inputs.items():
        made = manifest(spark, path)
        each[name] = made["fingerprint"] if made else files(spark, path)
    return hashlib.sha256(json.dumps([each, settings], sort_keys=True, default=str).encode()).hexdigest()


def make(spark: SparkSession, path: str, maker: Callable[[], DataFrame], inputs: dict[str, str], settings: dict | None = None, force: bool = False, keep: int = 2, empty: bool = True, partition_by: tuple[str, ...] = (), order: tuple[Column | str, ...] = (), check: Callable[[DataFrame], None] | None = None) -> tuple[DataFrame, bool]:
    """The product and whether it was made: only if it is not there, its inputs or settings have changed, or it is forced.

    check sees the rows as written, before they are a version; what it raises leaves the version before in place.
    """
    path, print_ = path.rstrip("/"), fingerprint(spark, inputs, settings or {})
    last = manifest(spark, path)
    if last and last["fingerprint"] == print_ and not force:
        return read(spark, path, last["version"]), False
    folder = f"data-{uuid.uuid4().hex}"
    rows = maker()
    (rows.orderBy(*order) if order else rows).write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    written = spark.read.schema(rows.schema).parquet(f"{path}/{folder}")
    try:
        if not empty and written.isEmpty():
            raise EmptyProduct(path)
        if check:
            check(written)
    except Exception:
        fs, at = file_system(spark, f"{path}/{folder}")
        fs.delete(at, True)
        raise
    number = max(numbers(spark, path), default=0)
    while True:
        number += 1
        told = {"version": number, "folder": folder, "fingerprint": print_, "inputs": inputs, "settings": settings or {}, "made": time.time()}
        if put(spark, f"{path}/_versions/{number:010d}.json", json.dumps(told, default=str)):
            break
    tidy(spark, path, keep)
    return written, True


def tidy(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes versions before the last `keep`, manifest first, and data folders that no version names and that are a day old."""
    have = numbers(spark, path)
    for number in have[: max(0, len(have) - keep)]:
        old = manifest(spark, path, number)
        for gone in (f"_versions/{number:010d}.json", old["folder"]):
            fs, at = file_system(spark, f"{path}/{gone}")
            fs.delete(at, True)
    named = {manifest(spark, path, n)["folder"] for n in numbers(spark, path)}
    fs, at = file_system(spark, path)
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if name.startswith("data-") and name not in named and status.getModificationTime() < (time.time() - ORPHAN_SECONDS) * 1000:
            fs.delete(status.getPath(), True)
