"""Helpers the text operators share: tables, scratch tables, bounded-side joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.shared import materialize, release, scratch  # noqa: F401  what the operators use

#: White space between words, as a regular expression class (space, tab to carriage return).
SPACE = r"[ \t-\r]"
#: A word: a run of anything else.
WORD = r"[^ \t-\r]+"

#: A side of a join is broadcast only if it was counted and has no more rows than this.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def dimension_join(left: DataFrame, dim: DataFrame, key: str, how: str = "left", salts: int = 32, by: str | None = None) -> DataFrame:
    """Join a table on a key that may be hot with a dimension that has one row a key.

    The dimension is counted first. A small one is broadcast; a larger one is repeated once for each
    salt and the left rows are spread over the salts by the column `by`, so that no key meets in one task.
    Null keys match null keys.
    """
    key_r = F.col(f"__{key}")
    dim = dim.withColumnRenamed(key, f"__{key}")
    if dim.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(dim), left[key].eqNullSafe(key_r), how).drop(f"__{key}")
    left = left.withColumn("__salt", F.pmod(F.xxhash64(by or left.columns[0]), F.lit(salts)))
    dim = dim.withColumn("__salt_r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    on = left[key].eqNullSafe(key_r) & (F.col("__salt") == F.col("__salt_r"))
    return left.join(dim, on, how).drop(f"__{key}", "__salt", "__salt_r")


#: No more keys than this are sent to every task as hot ones.
HOT_KEYS = 20_000


def spread_join(rows: DataFrame, known: DataFrame, keys: list[str], n: str, spread: list[str], how: str = "inner") -> DataFrame:
    """Join rows with `known`, which has one row a key and says in column n how many of the rows have it.

    Keys with over a HOT_KEYS-th of all those rows are hot: there are fewer than HOT_KEYS of them, so they are broadcast,
    and their rows are dealt by the columns `spread` in the one shuffle that joins all others. The columns of known but its keys
    and n are added; known should be a written table, for it is read three times. Keys are not null.
    """
    total = known.agg(F.sum(n)).first()[0] or 0
    added = [c for c in known.columns if c not in keys and c != n]
    bar = max(1000, total // HOT_KEYS)
    renamed = [F.col(k).alias(f"__k_{k}") for k in keys]
    value = F.struct(F.lit(True).alias("__found"), *added).alias("__value")
    hot = known.where(F.col(n) > bar).select(*(F.col(k).alias(f"__h_{k}") for k in keys), value).withColumnRenamed("__value", "__hot")
    cold = known.where(F.col(n) <= bar).select(*renamed, F.lit(0).alias("__k_"), value)
    out = rows.join(F.broadcast(hot), [rows[k] == hot[f"__h_{k}"] for k in keys], "left")
    is_hot = F.col("__hot").isNotNull()
    dealt = F.xxhash64(*spread)
    out = out.withColumn("__side", is_hot.cast("int"))
    for k in keys:
        out = out.withColumn(f"__j_{k}", F.when(is_hot, dealt).otherwise(F.col(k)))
    out = out.join(cold, [F.col(f"__j_{k}") == F.col(f"__k_{k}") for k in keys] + [F.col("__side") == F.col("__k_")], "left")
    found = F.coalesce("__hot", "__value")
    out = out.withColumn("__got", found)
    if how == "inner":
        out = out.where(F.col("__got").isNotNull())
    return out.select(*rows.columns, *(F.col("__got")[c].alias(c) for c in added))
