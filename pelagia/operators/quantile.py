"""Exact quantiles of groups of any size, and counts of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagia.shared import materialize


def exact_quantiles(df: DataFrame, groups: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """groups and a column for each probability: the value at p * (n - 1) in ascending order, between two values the line between them.

    Equal values are counted first, so a value that a third of the rows share is one row. Distinct values are dealt by ranges of (group, value) and counted through, task by
    task, what earlier tasks hold of a group being one number; only the values around each wanted place are gathered. No group has to fit a task. Nulls and
    NaN do not count; a group without values has no row. Without groups there is one row, or none.
    """
    for p in probabilities.values():
        if not 0 <= p <= 1:
            raise ValueError(f"not a probability: {p}")
    g = [f"__g{i}" for i in range(len(groups))]
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*(F.col(c).alias(k) for c, k in zip(groups, g)), v.alias("__v"))
    counted = rows.groupBy(*g, "__v").agg(F.count("*").alias("__n"))
    keys = [F.col(c).asc_nulls_first() for c in (*g, "__v")]
    placed = materialize(counted.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__part", F.spark_partition_id()))
    per = placed.groupBy(*g, "__part").agg(F.sum("__n").alias("__sum"))
    whole = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({"__before": F.coalesce(F.sum("__sum").over(earlier), F.lit(0)), "__total": F.sum("__sum").over(whole)}).drop("__sum")
    per = per.select(*(F.col(c).alias(f"_{c}") for c in g), F.col("__part").alias("__p"), "__before", "__total")
    on = F.col("__part") == F.col("__p")
    for c in g:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    inside = Window.partitionBy(*g, "__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("__low", F.coalesce(F.sum("__n").over(inside), F.lit(0))).join(per, on)
    first = F.col("__low") + F.col("__before")

    def at(place: Column) -> Column:
        return F.max(F.when((first <= place) & (place < first + F.col("__n")), F.col("__v")))

    names = list(probabilities)
    spots = {k: (F.col("__total") - 1) * F.lit(float(p)) for k, p in probabilities.items()}
    found = ranked.groupBy(*g).agg(F.max("__total").alias("__total"), *(x for i, k in enumerate(names) for x in (at(F.floor(spots[k])).alias(f"__a{i}"), at(F.ceil(spots[k])).alias(f"__b{i}"))))
    found = found.where("__total IS NOT NULL")
    line = lambda i, k: F.col(f"__a{i}") + (F.col(f"__b{i}") - F.col(f"__a{i}")) * (spots[k] - F.floor(spots[k]))
    return found.select(*(F.col(k).alias(c) for c, k in zip(groups, g)), *(line(i, k).alias(k) for i, k in enumerate(names)))


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Each value of a column, null included, and how often it occurs."""
    return df.groupBy(column).agg(F.count("*").alias(name))
