"""Versioned products: one whole version at any time, remade only where inputs changed."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from pelagia.sources import products, versions


def chain(spark, at, log, settings=None):
    """raw files -> a -> b, and raw -> c beside them."""
    raw, paths = str(at / "raw"), {k: str(at / k) for k in "abc"}
    out = {}

    def maker(name, source, add):
        def run():
            log.append(name)
            return source().withColumn("x", F.col("x") + add)

        return run

    read_raw = lambda: spark.read.parquet(raw)
    out["a"] = versions.make(spark, paths["a"], maker("a", read_raw, 1), {"raw": raw}, settings)[0]
    out["b"] = versions.make(spark, paths["b"], maker("b", lambda: versions.read(spark, paths["a"]), 10), {"a": paths["a"]})[0]
    out["c"] = versions.make(spark, paths["c"], maker("c", lambda: spark.read.parquet(str(at / "other")), 5), {"other": str(at / "other")})[0]
    return {k: sorted(r.x for r in v.collect()) for k, v in out.items()}


def test_only_what_depends_on_a_change_is_made_again(spark, tmp_path):
    for name in ("raw", "other"):
        spark.range(3).withColumn("x", F.col("id")).write.parquet(str(tmp_path / name))
    log = []
    assert chain(spark, tmp_path, log) == {"a": [1, 2, 3], "b": [11, 12, 13], "c": [5, 6, 7]} and log == ["a", "b", "c"]
    chain(spark, tmp_path, log)
    assert log == ["a", "b", "c"]  # nothing has changed
    spark.range(1).withColumn("x", F.lit(100).cast("long")).write.mode("append").parquet(str(tmp_path / "raw"))
    assert chain(spark, tmp_path, log)["b"] == [11, 12, 13, 111] and log[3:] == ["a", "b"]
    chain(spark, tmp_path, log, {"scope": "x"})
    assert log[5:] == ["a", "b"]
    assert versions.numbers(spark, str(tmp_path / "a")) == [2, 3] and versions.read(spark, str(tmp_path / "a"), 2).count() == 4
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(tmp_path / "a"), 1)


def test_a_failed_or_empty_make_leaves_the_last_version(spark, tmp_path):
    at, raw = str(tmp_path / "p"), str(tmp_path / "raw.txt")
    (tmp_path / "raw.txt").write_text("1")
    versions.make(spark, at, lambda: spark.range(4), {"raw": raw})
    (tmp_path / "raw.txt").write_text("22")
    with pytest.raises(products.EmptyProduct):
        versions.make(spark, at, lambda: spark.range(0), {"raw": raw}, empty=False)
    with pytest.raises(Exception, match="boom"):
        versions.make(spark, at, lambda: spark.range(9).withColumn("x", F.raise_error(F.lit("boom")).cast("string")), {"raw": raw})
    assert versions.read(spark, at).count() == 4
    old = [p for p in os.listdir(at) if p.startswith("data-")]
    for name in old:
        os.utime(f"{at}/{name}", (0, 0))
    versions.make(spark, at, lambda: spark.range(5), {"raw": raw})
    assert versions.read(spark, at).count() == 5 and len([p for p in os.listdir(at) if p.startswith("data-")]) == 2


def test_readers_see_whole_versions_while_writers_race(spark, tmp_path):
    at = str(tmp_path / "p")
    versions.make(spark, at, lambda: spark.range(100).withColumn("v", F.lit(0)), {}, {"v": 0}, keep=100)
    writers = [threading.Thread(target=lambda k=k: [versions.make(spark, at, lambda: spark.range(100).withColumn("v", F.lit(k * 10 + i)), {}, {"v": k * 10 + i}, keep=100) for i in range(3)]) for k in (1, 2)]
    for w in writers:
        w.start()
    seen, began = set(), time.time()
    while any(w.is_alive() for w in writers) and time.time() - began < 60:
        rows = versions.read(spark, at).groupBy("v").count().collect()
        assert len(rows) == 1 and rows[0]["count"] == 100
        seen.add(rows[0].v)
    for w in writers:
        w.join()
    assert versions.numbers(spark, at) == list(range(1, 8)) and len(seen) > 1
