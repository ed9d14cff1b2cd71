"""Live bouts over shuffled files against the batch plan."""

import math
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pelagia.plans import vms
from pelagia.streaming import bouts

T0 = datetime(2023, 3, 5, 6)


def candidates(r):
    rows = []
    for trip in (1, 2, 3):
        t = T0 + timedelta(minutes=trip)
        for leg in range(4):
            for k in range(r.choice([2, 9, 25])):
                a = 2 * math.pi * k / 12 if leg % 2 else k / 40
                rows.append((trip, len(rows), t, -27.3 + 0.01 * math.sin(a), -71.4 + 0.01 * math.cos(a), math.degrees(-a) % 360, 1.5))
                t += timedelta(minutes=r.choice([0, 3, 5, 19]))
            t += timedelta(hours=r.choice([1, 5]))
    return rows


def run(spark, at, files):
    for k, part in enumerate(files):
        spark.createDataFrame(part, bouts._ROWS).coalesce(1).write.mode("append").parquet(str(at / "in"))
        stream = spark.readStream.schema(bouts._ROWS).option("maxFilesPerTrigger", 1).parquet(str(at / "in"))
        bouts.judge_to(stream, str(at / "out"), str(at / "ck"), late="12 hours").awaitTermination(120)  # started again for every file
    return spark.read.parquet(str(at / "out/bouts")), spark.read.parquet(str(at / "out/open"))


def test_stream_over_shuffled_files_equals_the_batch(spark, tmp_path):
    r = random.Random(3)
    rows = candidates(r)
    assert max(x[2] for x in rows) - T0 < timedelta(hours=36)
    parts = [[x for x in rows if x[2] < T0 + timedelta(hours=9)], [x for x in rows if x[2] >= T0 + timedelta(hours=9)]]
    files = []
    for part in parts:
        part = r.sample(part, len(part))
        files += [p for p in (part[::2], part[1::2]) if p]
    end = [(99, 10**6, T0 + timedelta(days=30), -27.0, -71.0, 0.0, 1.0)]  # moves the watermark past everything
    got, seen = run(spark, tmp_path, [*files, end])
    batch = vms.bout_metrics(vms.bouts(spark.createDataFrame(rows, bouts._ROWS)))
    key = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in x) for x in df.select("zarpe_id", "bout", "n_pings", "haul_start", "haul_end", "net_turn", "total_turn", "path_km", "compactness", "haul_lat", "is_set").collect())
    assert key(got) == key(batch) and got.where("is_set").count() > 0
    assert seen.where("zarpe_id <> 99").select("ord").distinct().count() > len(rows) / 3 and {x.behavior for x in seen.select("behavior").distinct().collect()} == {"candidato"}
    assert seen.groupBy("ord").count().agg(F.max("count")).first()[0] == 1


def test_one_open_bout_stays_open(spark, tmp_path):
    rows = [(1, k, T0 + timedelta(minutes=5 * k), -27.3, -71.4, 0.0, 1.0) for k in range(6)]
    got, seen = run(spark, tmp_path, [rows[:3], rows[3:]])
    assert got.count() == 0 and seen.count() == 6
