"""Classic NetCDF files (CDF-1, CDF-2, CDF-5) as a Spark data source: the header is read, values are taken by range.

format("netcdf3") with the options path (a file, a folder or several separated by commas) and variables (names separated by commas). A partition is a block of times of one
file. Filters on time, depth, latitude and longitude are pushed: blocks without a wanted time are no partition, and of the others only the box is
made into rows, from the one contiguous read that each time of a variable is. Packed values are unpacked (scale_factor, add_offset); _FillValue, missing_value and NaN become
null. With the option merge the files are one product: their axes must be the same to the last bit, and a time comes whole from the last
file that has it, which is settled while blocks are planned. Paths may be URIs that pyarrow's file systems open. Files without times give no rows.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from pelagia.operators.grid import Axis

#: The format's tags, type codes and the names that axes go by.
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12
TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
AXES = {"time": ("time",), "depth": ("depth", "deptht", "lev"), "latitude": ("latitude", "lat"), "longitude": ("longitude", "lon")}
UNITS = {"day": 86_400_000_000, "hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000}
CALENDARS = ("standard", "gregorian", "proleptic_gregorian")
#: Times of a partition.
BLOCK = 60


@dataclass
class Variable:
    name: str
    dims: list[str]
    shape: list[int]
    attributes: dict
    dtype: np.dtype
    begin: int
    record: bool


@dataclass
class Header:
    variables: dict[str, Variable] = field(default_factory=dict)
    record_size: int = 0


def _open(path: str):
    if "://" in path or path.startswith("file:"):
        fs, inner = pafs.FileSystem.from_uri(path)
        return fs.open_input_file(inner)
    return pafs.LocalFileSystem().open_input_file(path)


def read_header(f) -> Header:
    """The variables of an open file and where they lie."""
    magic = f.read(4)
    if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
        raise ValueError("not a classic NetCDF file")
    wide, long_offset = magic[3] == 5, magic[3] != 1

    def number(size: int) -> int:
        return struct.unpack(">q" if size == 8 else ">i", f.read(size))[0]

    count = lambda: number(8 if wide else 4)

    def padded(n: int) -> bytes:
        raw = f.read(n)
        f.read(-n % 4)
        return raw

    name = lambda: padded(count()).decode()

    def listed(tag: int) -> int:
        seen, n = number(4), count()
        if seen not in (tag, 0) or (seen == 0 and n):
            raise ValueError("broken NetCDF header")
        return n

    def attributes() -> dict:
        out = {}
        for _ in range(listed(ATTRIBUTE)):
            key, kind, n = name(), number(4), count()
            raw = padded(n * np.dtype(TYPES[kind]).itemsize)
            out[key] = raw.decode() if kind == 2 else np.frombuffer(raw, TYPES[kind])
        return out

    records = count()
    dims = [(name(), count()) for _ in range(listed(DIMENSION))]
    attributes()
    head, widths = Header(), []
    for _ in range(listed(VARIABLE)):
        key = name()
        ids = [count() for _ in range(count())]
        own, kind, _ = attributes(), number(4), count()
        begin = number(8 if long_offset else 4)
        record = bool(ids) and dims[ids[0]][1] == 0
        shape = [records if dims[i][1] == 0 else dims[i][1] for i in ids]
        v = Variable(key, [dims[i][0] for i in ids], shape, own, np.dtype(TYPES[kind]), begin, record)
        head.variables[key] = v
        if record:
            widths.append(math.prod(shape[1:]) * v.dtype.itemsize)
    head.record_size = widths[0] if len(widths) == 1 else sum(w + -w % 4 for w in widths)
    return head


def read_values(f, head: Header, v: Variable, first: int = 0, last: int | None = None) -> np.ndarray:
    """Places first to last (excluded) of a variable's first axis, as they are stored."""
    last = v.shape[0] if last is None else last
    one = math.prod(v.shape[1:]) * v.dtype.itemsize
    step = head.record_size if v.record else one
    if step == one:
        f.seek(v.begin + first * step)
        raw = f.read((last - first) * one)
    else:
        parts = []
        for i in range(first, last):
            f.seek(v.begin + i * step)
            parts.append(f.read(one))
        raw = b"".join(parts)
    return np.frombuffer(raw, v.dtype).reshape([last - first, *v.shape[1:]])


def unpacked(raw: np.ndarray, attributes: dict) -> np.ndarray:
    """Doubles, NaN where there is no value."""
    gone = np.isnan(raw) if raw.dtype.kind == "f" else np.zeros(raw.shape, bool)
    for key in ("_FillValue", "missing_value"):
        if key in attributes:
            gone |= raw == attributes[key][0]
    out = raw.astype(np.float64) * float(attributes.get("scale_factor", [1.0])[0]) + float(attributes.get("add_offset", [0.0])[0])
    out[gone] = np.nan
    return out


def micros(raw: np.ndarray, attributes: dict) -> np.ndarray:
    """Times in microseconds since 1970 by their units (<unit>s since <date>)."""
    if attributes.get("calendar", "standard").strip().lower() not in CALENDARS:
        raise ValueError(f"calendar {attributes['calendar']}")
    unit, _, since = attributes["units"].strip().partition(" since ")
    at = datetime.fromisoformat(since.strip().removesuffix("UTC").strip())
    at = at.replace(tzinfo=at.tzinfo or timezone.utc)
    epoch = round(at.timestamp() * 1_000_000)
    scale = UNITS[unit.strip().lower().removesuffix("s")]
    return epoch + (raw.astype(np.int64) * scale if raw.dtype.kind in "iu" else np.round(raw * scale).astype(np.int64))


def _axis(head: Header, axis: str) -> Variable | None:
    return next((head.variables[n] for n in AXES[axis] if n in head.variables), None)


@dataclass
class Limits:
    """Inclusive or open bounds by axis: (value, whether it may be equal)."""

    low: dict = field(default_factory=dict)
    high: dict = field(default_factory=dict)

    def mask(self, axis: str, x: np.ndarray) -> np.ndarray:
        keep = np.ones(len(x), bool)
        for value, equal in self.low.get(axis, []):
            keep &= (x >= value) if equal else (x > value)
        for value, equal in self.high.get(axis, []):
            keep &= (x <= value) if equal else (x < value)
        return keep


class Block(InputPartition):
    """Places first to last (excluded) of a file's times; those not in `wanted` are left out."""

    def __init__(self, path: str, first: int, last: int, wanted: tuple[int, ...] = ()):
        self.path, self.first, self.last, self.wanted = path, first, last, wanted


class Reader(DataSourceReader):
    def __init__(self, options, schema):
        self.paths, self.names = _files(options["path"]), [v.strip() for v in options["variables"].split(",")]
        self.deep, self.merge = "depth" in schema.fieldNames(), options.get("merge", "false") == "true"
        self.limits = Limits()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of an axis with a number or a time; what is left goes back to Spark."""
        bounds = {GreaterThan: ("low", False), GreaterThanOrEqual: ("low", True), LessThan: ("high", False), LessThanOrEqual: ("high", True)}
        for f in filters:
            axis = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if axis not in AXES or isinstance(f, IsNotNull) or not isinstance(f, (EqualTo, *bounds)):
                if not (isinstance(f, IsNotNull) and axis in AXES):  # an axis has no nulls
                    yield f
                continue
            value = f.value
            if isinstance(value, datetime):
                value = round((value if value.tzinfo else value.replace(tzinfo=timezone.utc)).timestamp() * 1_000_000)
            elif not isinstance(value, (int, float)):
                yield f
                continue
            sides = ("low", "high") if isinstance(f, EqualTo) else (bounds[type(f)][0],)
            for side in sides:
                getattr(self.limits, side).setdefault(axis, []).append((value, isinstance(f, EqualTo) or bounds[type(f)][1]))

    def partitions(self) -> list[Block]:
        out, taken, axes = [], np.zeros(0, np.int64), None
        for path in reversed(self.paths):
            with _open(path) as f:
                head = read_header(f)
                time = _axis(head, "time")
                times = micros(read_values(f, head, time), time.attributes)
                here = [read_values(f, head, _axis(head, a)).tobytes() for a in ("latitude", "longitude")] if self.merge else None
            if axes not in (None, here):
                raise ValueError("files of one product have different axes")
            wanted = self.limits.mask("time", times)
            if self.merge:
                axes = here
                wanted &= ~np.isin(times, taken)
                taken = np.union1d(taken, times)
            for i in range(0, len(times), BLOCK):
                some = np.flatnonzero(wanted[i : i + BLOCK])
                if len(some):
                    out.append(Block(path, i, min(i + BLOCK, len(times)), tuple(int(k) for k in some)))
        return out[::-1] or [Block("", 0, 0)]

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        """A batch for each wanted time and depth, its cells as columns."""
        if partition.first == partition.last:
            return
        with _open(partition.path) as f:
            head = read_header(f)
            axes = {a: _axis(head, a) for a in AXES}
            times = micros(read_values(f, head, axes["time"], partition.first, partition.last), axes["time"].attributes)
            lat, lon = (read_values(f, head, axes[a]).astype(float) for a in ("latitude", "longitude"))
            depth = read_values(f, head, axes["depth"]).astype(float) if axes["depth"] is not None else np.zeros(1)
            i, j = (np.flatnonzero(self.limits.mask(a, x)) for a, x in (("latitude", lat), ("longitude", lon)))
            levels = np.flatnonzero(self.limits.mask("depth", depth)) if self.deep else np.arange(1)
            ii, jj = (x.ravel().astype(np.int32) for x in np.meshgrid(i, j, indexing="ij"))
            for k in partition.wanted:
                at = partition.first + k
                fields = {n: unpacked(read_values(f, head, v, at, at + 1)[0], v.attributes) for n, v in ((n, head.variables[n]) for n in self.names)}
                for level in levels:
                    columns = {"time": pa.array(np.full(len(ii), times[k]), pa.timestamp("us", "UTC"))}
                    if self.deep:
                        columns["depth"] = pa.array(np.full(len(ii), depth[level]))
                    columns |= {"i_lat": pa.array(ii), "i_lon": pa.array(jj), "latitude": pa.array(lat[ii]), "longitude": pa.array(lon[jj])}
                    for n, x in fields.items():
                        cell = (x[level] if x.ndim == 3 else x)[ii, jj]
                        columns[n] = pa.array(cell, mask=np.isnan(cell))
                    yield pa.record_batch(list(columns.values()), names=list(columns))


def _files(path: str) -> list[str]:
    """The files of a path, or of several; a folder stands for its .nc files in the order of their names."""
    out = []
    for p in (p.strip() for p in path.split(",")):
        fs, inner = pafs.FileSystem.from_uri(p) if "://" in p or p.startswith("file:") else (pafs.LocalFileSystem(), p)
        if fs.get_file_info(inner).type == pafs.FileType.Directory:
            head = p[: len(p) - len(inner)] if p.endswith(inner) else ""
            out += sorted(head + x.path for x in fs.get_file_info(pafs.FileSelector(inner)) if x.path.endswith(".nc"))
        else:
            out.append(p)
    return out


class NetCdf3Source(DataSource):
    @classmethod
    def name(cls) -> str:
        return "netcdf3"

    def schema(self) -> str:
        names = [v.strip() for v in self.options["variables"].split(",")]
        with _open(_files(self.options["path"])[0]) as f:
            head = read_header(f)
        deep = any(d in AXES["depth"] for n in names for d in head.variables[n].dims)
        return "time timestamp, " + ("depth double, " if deep else "") + "i_lat int, i_lon int, latitude double, longitude double, " + ", ".join(f"`{n}` double" for n in names)

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.options, schema)


def read(spark: SparkSession, path: str, variables: list[str], start: str | None = None, end: str | None = None, bbox: tuple[float, float, float, float] | None = None, max_depth: float | None = None, merge: bool = False) -> DataFrame:
    """A product's rows in a range of days, a box (south, north, west, east) and depths; all of it reaches the files."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(NetCdf3Source)
    grid = spark.read.format("netcdf3").option("variables", ",".join(variables)).option("merge", str(merge).lower()).load(path)
    if start:
        grid = grid.where(F.col("time") >= F.lit(start).cast("timestamp"))
    if end:
        grid = grid.where(F.col("time") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    if bbox:
        grid = grid.where(F.col("latitude").between(bbox[0], bbox[1]) & F.col("longitude").between(bbox[2], bbox[3]))
    if max_depth is not None and "depth" in grid.columns:
        grid = grid.where(F.col("depth") <= max_depth)
    return grid


def axes(path: str) -> tuple[Axis, Axis]:
    """The latitudes and longitudes of a product, by its first file, as regular axes."""
    out = []
    with _open(_files(path)[0]) as f:
        head = read_header(f)
        for a in ("latitude", "longitude"):
            x = read_values(f, head, _axis(head, a)).astype(float)
            step = float(x[-1] - x[0]) / max(len(x) - 1, 1)
            if len(x) > 1 and np.abs(np.diff(x) - step).max() > 1e-3 * abs(step):
                raise ValueError(f"{a} is not regular")
            out.append(Axis(float(x[0]), step or 1.0, len(x)))
    return out[0], out[1]
