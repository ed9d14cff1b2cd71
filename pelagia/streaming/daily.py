"""A folder of one file a day as a stream that moves only over days that are settled.

format("daily"), options: path (the folder), start (the first day, ISO), pattern (a file's name, {day} is the ISO date), manifest (a JSON-lines file of days that will
never come, {"day": ..., "reason": ...}; optional), seconds (how long this run may go on taking new days; optional). A batch ends at the frontier: the last
day before the first one that neither has a file nor is in the manifest. The offset is that day alone, so a stream that was killed goes on from its
checkpoint with each line once, and a file that comes late is read in its turn. A day's file is one partition; rows are day, file, line_no (from 0) and line, read
in batches. Bytes that are not UTF-8 are replaced, empty lines left out, a final line may lack its end.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes read at once.
CHUNK = 1 << 20


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def frontier(start: date, have: set[date], missing: set[date]) -> date:
    """The last day of the unbroken run of settled days from start on; the day before start if there is none."""
    day = start
    while day in have or day in missing:
        day += timedelta(days=1)
    return day - timedelta(days=1)


def lines(f) -> Iterator[list[str]]:
    """Lists of whole lines of an open binary file, a chunk at a time."""
    rest = b""
    while chunk := f.read(CHUNK):
        *whole, rest = (rest + chunk).split(b"\n")
        yield [w.removesuffix(b"\r").decode("utf-8", "replace") for w in whole]
    if rest:
        yield [rest.removesuffix(b"\r").decode("utf-8", "replace")]


class Day(InputPartition):
    def __init__(self, day: date, file: str):
        self.day, self.file = day, file


class DailyReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.start = options["path"].rstrip("/"), date.fromisoformat(options["start"])
        self.before, self.after = options["pattern"].split("{day}")
        self.manifest, self.seconds = options.get("manifest"), float(options.get("seconds", "inf"))
        self.began, self.last = time.monotonic(), None

    def initialOffset(self) -> dict:
        return {"day": (self.start - timedelta(days=1)).isoformat()}

    def _days(self) -> dict[date, str]:
        fs, inner = _file_system(self.path)
        out = {}
        for info in fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True)):
            name = info.base_name
            if info.type == pafs.FileType.File and name.startswith(self.before) and name.endswith(self.after):
                try:
                    out[date.fromisoformat(name[len(self.before) : len(name) - len(self.after)])] = name
                except ValueError:
                    continue  # another file
        return out

    def _missing(self) -> set[date]:
        if not self.manifest:
            return set()
        fs, inner = _file_system(self.manifest)
        if fs.get_file_info(inner).type != pafs.FileType.File:
            return set()
        with fs.open_input_file(inner) as f:
            return {date.fromisoformat(json.loads(x)["day"]) for part in lines(f) for x in part if x.strip()}

    def latestOffset(self) -> dict:
        if self.last is None or time.monotonic() - self.began < self.seconds:
            self.last = frontier(self.start, set(self._days()), self._missing())
        return {"day": self.last.isoformat()}

    def partitions(self, start: dict, end: dict) -> list[Day]:
        low, high = date.fromisoformat(start["day"]), date.fromisoformat(end["day"])
        return [Day(d, name) for d, name in sorted(self._days().items()) if low < d <= high] or [Day(low, "")]

    def read(self, partition: Day) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, inner = _file_system(f"{self.path}/{partition.file}")
        number = 0
        with fs.open_input_stream(inner) as f:
            for part in lines(f):
                places = [number + k for k, x in enumerate(part) if x]
                text = [x for x in part if x]
                number += len(part)
                if text:
                    n = len(text)
                    yield pa.record_batch([pa.array([partition.day] * n, pa.date32()), pa.array([partition.file] * n), pa.array(places, pa.int64()), pa.array(text)], names=["day", "file", "line_no", "line"])

    def commit(self, end: dict) -> None:
        """Nothing to let go of: the files stay."""


class DailySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "daily"

    def schema(self) -> str:
        return "day date, file string, line_no long, line string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return DailyReader(self.options)


def missing_days(days, path: str, reason: str) -> int:
    """Adds days (dates) to a manifest; those it has already are left out. Returns how many were added."""
    fs, inner = _file_system(path)
    old = ""
    if fs.get_file_info(inner).type == pafs.FileType.File:
        with fs.open_input_file(inner) as f:
            old = f.read().decode()
    have = {json.loads(x)["day"] for x in old.splitlines() if x.strip()}
    new = [json.dumps({"day": d.isoformat(), "reason": reason}) for d in sorted(set(days)) if d.isoformat() not in have]
    if new:
        fresh = f"{inner}.new"
        with fs.open_output_stream(fresh) as f:
            f.write(("\n".join([*old.splitlines(), *new]) + "\n").encode())
        fs.move(fresh, inner)
    return len(new)
