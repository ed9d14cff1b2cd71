"""Mixing sources to target weights by balanced sampling with the cube method.

Each source gets a share of all words by its weight, at most `cap` times its own size; what a capped source
leaves is shared again. A document then takes part target/size times: the whole part as copies, the rest as
an inclusion probability. The cube method rounds those probabilities within each source: it moves them along
the null space of two constraints (words, documents) until they are 0 or 1, so both totals stay where they were.
The flight runs on blocks of a few hundred documents; the two or so that each block leaves open meet in further
rounds of blocks, and the last dozen of a source land by the rounding of all of them that moves the fewest words.

Edge cases: a null or blank text has size 0 and takes 0 words; a null source is a source of its own, the last;
rows alike in id, source and size are one unit, whose copies they share evenly; an empty table gives an empty result. Draws depend on the source, the
document ids and the seed alone, so reruns agree.
"""

from __future__ import annotations

import zlib
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pelagia.llm.common import WORD, dimension_join, materialize, release

CAP = 3.0
#: Weights by a source's place in code point order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
BLOCK = 512
#: Units of a source that the flight leaves to the landing; all their roundings are tried.
LANDING = 12
_OPEN = 1e-9


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row a source: source, source_size, target. Wants columns source and size.

    Sources are ranked by a range partitioning and the row counts of its partitions, so even very many
    sources never meet in one task; the level of the targets is found by a few sums.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    parts = per.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    mid = F.monotonically_increasing_id()
    ranked = materialize(parts.withColumns({"__part": F.shiftright(mid, 33), "__at": mid.bitwiseAND(F.lit((1 << 33) - 1))}))
    counts = {r[0]: r[1] for r in ranked.groupBy("__part").count().collect()}  # a row for each partition
    before, seen = {}, 0
    for part in sorted(counts):
        before[part] = seen
        seen += counts[part]
    if not seen:
        return per.withColumn("target", F.lit(0.0))
    offset = F.element_at(F.create_map(*(F.lit(x) for p in before.items() for x in p)), F.col("__part"))
    turn = F.pmod(offset + F.col("__at"), F.lit(len(weights))).cast("int")
    ranked = ranked.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn))

    most = F.col("source_size") * F.lit(cap)
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, full = None, -1
    while True:
        capped = F.lit(False) if level is None else most <= F.col("weight") * F.lit(level)
        r = ranked.agg(
            F.count_if(capped).alias("n"),
            F.coalesce(F.sum(F.when(capped, most)), F.lit(0.0)).alias("used"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if r["n"] == full or not r["open"]:
            break
        full, level = r["n"], (total - r["used"]) / r["open"]
    target = F.least(most, F.col("weight") * F.lit(level or 0.0)).cast("double")
    return ranked.select("source", "source_size", target.alias("target"))


def _flight(size: np.ndarray, pi: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Moves pi to 0 or 1 with sum(pi) and sum(pi * size) held; at most two stay open, or with land a dozen, which land.

    Each step takes the first open unit, projects its direction on the null space of both constraints over all
    open units, and goes to the wall on one side or the other with the odds that keep every expectation. With the
    largest unit first, the many small ones absorb its move, and what stays open at the end is small.
    """
    pi = pi.astype(float).copy()
    scaled = size / max(1.0, float(size.max(initial=0)))
    open_ = np.flatnonzero((pi > _OPEN) & (pi < 1 - _OPEN))

    def move(units: np.ndarray, u: np.ndarray) -> None:
        go = np.abs(u) > 1e-12
        at, d = units[go], u[go]
        up = float(np.min(np.where(d > 0, 1 - pi[at], pi[at]) / np.abs(d)))
        down = float(np.min(np.where(d > 0, pi[at], 1 - pi[at]) / np.abs(d)))
        pi[at] += (up if rng.random() * (up + down) < down else -down) * d
        pi[at] = np.where(pi[at] < _OPEN, 0.0, np.where(pi[at] > 1 - _OPEN, 1.0, pi[at]))

    def direction(basis: list[np.ndarray], n: int) -> np.ndarray | None:
        for k in range(n):
            u = -sum(q * q[k] for q in basis) if basis else np.zeros(n)
            u[k] += 1
            if u[k] > 1e-7:  # the square of its length, as for every projection of an axis
                return u
        return None

    def basis(s: np.ndarray) -> list[np.ndarray]:
        """Orthonormal columns of both constraints."""
        n = len(s)
        rest = s - s.mean()
        length = float(np.sqrt(rest @ rest))
        return [np.full(n, n**-0.5)] + ([rest / length] if length > 1e-9 * n else [])

    while len(open_) > (LANDING if land else 0):
        u = direction(basis(scaled[open_]), len(open_))
        if u is None:
            break
        move(open_, u)
        open_ = open_[(pi[open_] > 0) & (pi[open_] < 1)]
    if land and len(open_):
        pi[open_] = _landing(size[open_], pi[open_], rng)
    return pi


def _landing(size: np.ndarray, pi: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The rounding of a few units that moves the fewest words; documents beyond the nearest count weigh, ties go by chance."""
    tries = (np.arange(1 << len(pi))[:, None] >> np.arange(len(pi))) & 1
    words, documents = np.abs(tries @ size - pi @ size), np.abs(tries.sum(axis=1) - pi.sum())
    words = words + np.maximum(0, documents - 1) * size.mean() / 4
    return tries[np.lexsort((rng.random(len(tries)), words))[0]].astype(float)


def _fly(pdf: pd.DataFrame, level: int, seed: int, land: bool) -> pd.DataFrame:
    # large documents first: the two left open at the end are then small, and so is the landing's error
    pdf = pdf.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable", ignore_index=True)
    name = pdf["source"].iloc[0]
    key = f"{seed}|{level}|{int(pdf['block'].iloc[0])}|{name if isinstance(name, str) else ''}|{isinstance(name, str)}"
    rng = np.random.default_rng(zlib.crc32(key.encode()))
    pdf["pi"] = _flight(pdf["size"].to_numpy(float), pdf["pi"].to_numpy(float), rng, land)
    return pdf


def _plan(docs: DataFrame, text: str, source: str, key: str, seed: int, weights: tuple[float, ...], cap: float) -> DataFrame:
    """doc_id, source, size, rows, source_size, target, total: rows alike in all three are one unit, and total the copies it gets."""
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), size.alias("size"))
    sized = materialize(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")))
    targets = materialize(source_targets(sized.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, cap))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)) * F.col("rows")
    near = F.round(ratio)
    units = dimension_join(sized, targets, "source", by="doc_id").withColumn("__r", F.when(F.abs(ratio - near) < _OPEN, near).otherwise(ratio))
    units = units.withColumns({"whole": F.floor("__r").cast("long"), "pi": F.col("__r") - F.floor("__r")}).drop("__r")

    done, scratch = [units.where(F.col("pi") <= 0)], [sized, targets]
    left, level = units.where(F.col("pi") > 0), 0
    width = F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(BLOCK)))
    while True:
        per = materialize(left.groupBy("source").agg(F.count("*").alias("__n")))
        most = per.agg(F.max("__n")).first()[0] or 0
        last = most <= BLOCK
        block = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed + level)), width).cast("long")
        keyed = dimension_join(left, per, "source", by="doc_id").withColumn("block", block).drop("__n")
        run = partial(_fly, level=level, seed=seed, land=last)
        kept = materialize(keyed.groupBy("source", "block").applyInPandas(run, keyed.schema))
        scratch += [per, kept]
        flown = kept.drop("block")
        done.append(flown.where((F.col("pi") <= 0) | (F.col("pi") >= 1)))
        if last:
            break
        left, level = flown.where((F.col("pi") > 0) & (F.col("pi") < 1)), level + 1
    total = F.col("whole") + F.col("pi").cast("long")
    columns = ["doc_id", "source", "size", "rows", "source_size", "target"]
    out = materialize(reduce(DataFrame.unionByName, done).select(*columns, total.alias("total")))
    release(*scratch)
    return out


def mix(docs: DataFrame, text: str = "text", source: str = "source", seed: int = 7, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row of docs."""
    plan = _plan(docs, text, source, "doc_id", seed, weights, cap)
    each = plan.withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    copies = F.floor(F.col("total") / F.col("rows")) + (F.col("__k") <= F.col("total") % F.col("rows")).cast("long")
    out = each.withColumn("copies", copies.cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def sample(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = 7, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The rows of docs, each as often as the mix takes it.

    Rows alike in key, source and size are interchangeable to the draw, so their copies are dealt out in the order of
    their texts' hashes. The plan grows with the documents, so it is never broadcast: at every size both sides are sorted by key and merged.
    """
    plan = _plan(docs, text, source, key, seed, weights, cap)
    sums = plan.agg(F.sum("rows").alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    taken = plan.where("total > 0").select(F.col("doc_id").alias("__id"), F.col("size").alias("__size"), F.col("source").alias("__source"), F.col("rows").alias("__rows"), F.col("total").alias("__total"))
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")  # whatever the columns are called
    inner = docs.select(own, F.col(key).alias("__key"), F.col(source).alias("__from"), F.col(text).alias("__text"))
    if sums["rows"] == sums["ids"]:
        rows = inner.select("__row", "__key").join(taken.select("__id", "__total").hint("merge"), F.col("__key") == F.col("__id")).withColumn("__copies", F.col("__total"))
    else:
        counted = inner.withColumn("__words", F.regexp_count(F.coalesce("__text", F.lit("")), F.lit(WORD)).cast("long"))
        on = F.col("__key").eqNullSafe(F.col("__id")) & (F.col("__words") == F.col("__size")) & F.col("__from").eqNullSafe(F.col("__source"))
        place = F.row_number().over(Window.partitionBy("__key", "__words", "__from").orderBy(F.xxhash64("__text")))
        rows = counted.join(taken.hint("merge"), on).withColumn("__k", place)
        share = F.floor(F.col("__total") / F.col("__rows")) + (F.col("__k") <= F.col("__total") % F.col("__rows")).cast("long")
        rows = rows.withColumn("__copies", share.cast("long")).where("__copies > 0")
    return rows.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select("__row.*")
