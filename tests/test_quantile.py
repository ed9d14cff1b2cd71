import random

import pytest
from pyspark.sql import functions as F

from pelagia.operators.quantile import exact_quantiles, value_counts

ASK = {"p0": 0.0, "p10": 0.1, "median": 0.5, "p95": 0.95, "p100": 1.0}


def test_equals_percentile_on_skewed_groups(spark):
    r = random.Random(2)
    rows = [("hot", round(r.gauss(0, 3), 1)) for _ in range(4000)] + [("hot", 1.5)] * 2000 + [(r.choice("ab"), r.random()) for _ in range(301)]
    rows += [("one", 7.0), (None, 2.0), (None, 4.0), ("none", None), ("nan", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {x.k: [x[c] for c in ASK] for x in exact_quantiles(df, ["k"], "v", ASK).collect()}
    clean = df.where("v is not null and not isnan(v)")
    want = {x.k: [x[c] for c in ASK] for x in clean.groupBy("k").agg(*(F.percentile("v", F.lit(p)).alias(c) for c, p in ASK.items())).collect()}
    assert got.keys() == want.keys() == {"hot", "a", "b", "one", None}
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_no_groups_no_rows_and_clashing_names(spark):
    df = spark.range(101).select((F.col("id") * 2).alias("__v"), F.lit("x").alias("__n"))
    assert [tuple(x) for x in exact_quantiles(df, [], "__v", {"m": 0.5}).collect()] == [(100.0,)]
    assert [tuple(x) for x in exact_quantiles(df, ["__n"], "__v", {"m": 0.25}).collect()] == [("x", 50.0)]
    assert exact_quantiles(df.limit(0), ["__n"], "__v", {"m": 0.5}).count() == 0 and exact_quantiles(df.limit(0), [], "__v", {"m": 0.5}).count() == 0
    with pytest.raises(ValueError):
        exact_quantiles(df, [], "__v", {"m": 1.5})
    assert {tuple(x) for x in value_counts(spark.createDataFrame([("a",), (None,), ("a",)], "k string"), "k").collect()} == {("a", 2), (None, 1)}
