"""Operators that depend on order: first and last rows, as-of joins, sessions, ranks, sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagia.shared import materialize


def keep_first(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a key, the first in the order. The order should end in something unique."""
    return numbered(df, keys, *order).where("__rn = 1").drop("__rn")


def numbered(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """All rows with their place in their key as __rn."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def drop_ambiguous(df: DataFrame, keys: list[str]) -> DataFrame:
    """Only the rows whose key occurs once. Counted apart, so a hot key costs a count and not a window."""
    single = df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n = 1").drop("__n")
    same = None
    for k in keys:
        test = df[k].eqNullSafe(single[k])
        same = test if same is None else same & test
    return df.join(single, same, "left_semi")


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("n_values")).where("n_values > 1")


def mode_first(df: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent value of each key, the smallest on a tie; keys without a value get null."""
    return df.groupBy(key).agg(F.mode(value, deterministic=True).alias(value))


def sequence_ids(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """1 to N in the order. Rows are sorted by range over many tasks; each adds the row count of those before it.

    The sorted rows are written to the shared folder once, with their task and their place in it: ranges are drawn from
    a sample, so a second evaluation could cut them elsewhere.
    """
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialize(ranged.withColumn("__part", F.shiftright(place, 33)).withColumn("__at", place.bitwiseAND(F.lit((1 << 33) - 1))))
    counts = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return ranged.join(F.broadcast(offsets), "__part").withColumn(name, (F.col("__off") + F.col("__at") + 1).cast("long")).drop("__part", "__at", "__off")


def asof_forward(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, payload: list[str], max_gap_seconds: int, order: str) -> DataFrame:
    """Each left row with the nearest right row of its key at its time or later.

    The right row counts if it is at most max_gap_seconds away and the key's right row before it is strictly
    earlier than the left row; else the payload is null. `order`, of any type that sorts, breaks ties of right times: the first wins.

    Time is cut into spans of max_gap_seconds. A right row in reach lies in the left row's span or the next, so each right
    row stands in its own span and the one before, and one shuffle by key and span brings both sides together: a key's history is never in
    one task. Rows are walked from the latest, so the row ahead is the last one seen. Rows without key or time skip all that.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    span = lambda c: F.floor(micros(c) / F.lit(max_gap_seconds * 1_000_000)).cast("long")
    w = Window.partitionBy(key).orderBy(right_time, order)
    r = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).withColumn("__prev", F.lag(right_time).over(w))
    hit = F.struct(F.col(right_time).alias("at"), F.col("__prev").alias("prev"), F.struct(*payload).alias("row"))
    r = r.withColumn("__span", F.explode(F.array(span(right_time), span(right_time) - 1)))
    r = r.select(F.col(key).alias("__key"), "__span", F.col(right_time).alias("__t"), F.lit(1).alias("__side"), F.col(order).alias("__ord"), hit.alias("__hit"))
    can = F.col(key).isNotNull() & F.col(left_time).isNotNull()
    l = left.where(can).select(F.col(key).alias("__key"), span(left_time).alias("__span"), F.col(left_time).alias("__t"), F.lit(0).alias("__side"), F.struct(*left.columns).alias("__row"))
    stacked = l.unionByName(r, allowMissingColumns=True)
    ahead = Window.partitionBy("__key", "__span").orderBy(F.desc("__t"), F.desc("__side"), F.desc("__ord")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = stacked.withColumn("__next", F.last("__hit", ignorenulls=True).over(ahead)).where("__side = 0")
    near = micros("__next.at") - micros("__t") <= max_gap_seconds * 1_000_000
    fits = near & (F.col("__next.prev").isNull() | (F.col("__t") > F.col("__next.prev")))
    picked = F.when(fits, F.col("__next.row"))
    found = out.select("__row.*", *(picked[c].alias(c) for c in payload))
    none = left.where(~can).select("*", *(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in payload))
    return found.unionByName(none)


def sessionize(df: DataFrame, keys: list[str], ts: str, gap_seconds: float, name: str, order: str) -> DataFrame:
    """Numbers sessions from 0 within the keys: a new one where rows are more than the gap apart."""
    w = Window.partitionBy(*keys).orderBy(ts, order)
    apart = (F.unix_micros(F.col(ts).cast("timestamp")) - F.lag(F.unix_micros(F.col(ts).cast("timestamp"))).over(w)) > gap_seconds * 1_000_000
    flagged = df.withColumn("__cut", F.coalesce(apart, F.lit(False)).cast("int"))
    return flagged.withColumn(name, F.sum("__cut").over(w)).drop("__cut")


def first_not_null(value: str, order: Column) -> Column:
    return F.min_by(value, F.when(F.col(value).isNotNull(), order))


def last_not_null(value: str, order: Column) -> Column:
    return F.max_by(value, F.when(F.col(value).isNotNull(), order))


def frontier(days: DataFrame, day: str, resolved: str) -> DataFrame:
    """One row: the last day before the first unresolved one (null if the very first is unresolved)."""
    open_ = F.min(F.when(~F.col(resolved), F.col(day)))
    found = days.agg(open_.alias("open"), F.min(day).alias("first"), F.max(day).alias("last"))
    return found.select(F.when(F.col("open").isNull(), F.col("last")).when(F.col("open") > F.col("first"), F.date_sub("open", 1)).alias("frontier"))


def lookup_priority(left: DataFrame, tables: list[tuple[str, DataFrame, str]], values: list[str], order: str) -> DataFrame:
    """Looks every left row up in several keyed tables; each value comes from the first table that has it.

    tables: (left key, table, its key). A key that occurs twice keeps its last row by order; '' never matches.
    """
    out, found = left, {v: [] for v in values}
    for i, (left_key, table, key) in enumerate(tables):
        last = table.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(F.col(key).alias(f"__k{i}")).agg(*(F.max_by(v, order).alias(f"__{v}{i}") for v in values))
        out = out.join(last, out[left_key] == F.col(f"__k{i}"), "left")
        for v in values:
            found[v].append(F.col(f"__{v}{i}"))
    return out.select(*left.columns, *(F.coalesce(*found[v]).alias(v) for v in values))
