"""Fuzzy name matching: candidates by letters or beginnings in common on Spark, ratios in Arrow batches."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.functions.text import folded, search_variants, split_person, suffixes_agree, vessel_name
from pelagia.shared import materialize, release


#: Letters whose frequency is known to the order; others count as the rarest.
LETTERS = 2_000


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib's ratio of b against a; the second sequence is the one that is indexed."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])


def _letters(name: Column) -> Column:
    """A name's letters, each with its number among equals: a set that stands for the multiset."""
    chars = F.split(name, "")
    return F.transform(chars, lambda c, i: F.concat(c, F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda x: x == c)).cast("string")))


def _keys(letters: Column, n: Column, seen: Column, cutoff: float) -> Column:
    """Pairs of a name's rarest letters; names whose ratio may reach the cutoff have a pair in common.

    A ratio of c asks for c * (a + b) / 2 common letters, so for at least c / (2 - c) of either name's. By the prefix filter, two of them
    are among the first n - that + 2 of each name in any order common to all.
    """
    ranked = F.array_sort(F.transform(letters, lambda x: F.struct(F.coalesce(F.try_element_at(seen, x), F.lit(0)).alias("n"), x.alias("x"))))
    size = n - F.ceil(n * cutoff / (2 - cutoff) - 1e-9).cast("int") + 2
    head = F.transform(F.slice(ranked, F.lit(1), F.least(n, size)), lambda r: r["x"])
    return F.flatten(F.transform(head, lambda x, i: F.transform(F.slice(head, i + 2, n), lambda y: F.concat(x, F.lit(" "), y))))


def fuzzy_match(left: DataFrame, left_key: str, left_name: str, right: DataFrame, right_key: str, right_name: str, cutoff: float = 0.85, top: int = 5) -> DataFrame:
    """left_key, right_key, score: of a name's five likest catalogue names at or above the cutoff, the first whose ordinal agrees.

    Equal names are taken at once (score 1) and never reach Python. Of the others, names meet through pairs of their rarest letters,
    and only those with enough letters in common are compared; both bounds are exact. On equal scores the larger name comes first.
    A cutoff must be above two thirds.
    """
    if cutoff <= 2 / 3:
        raise ValueError("a cutoff of two thirds or less can't be blocked on pairs of letters")
    # Names as they are written are told apart first: they are folded and compared once each, however many rows have them. Empty ones go after
    # that is written, since Spark would move the filter, and the folding with it, down to the rows.
    spelt = materialize(left.select(F.col(left_name).alias("__raw")).distinct().withColumn("__ln", vessel_name(F.col("__raw"))))
    offered = right.groupBy(F.col(right_name).alias("__raw")).agg(F.min(right_key).alias("__rk")).select(vessel_name(F.col("__raw")).alias("__rn"), "__rk")
    offered = materialize(offered.groupBy("__rn").agg(F.min("__rk").alias("__rk")))
    asked, r = spelt.where("__ln <> ''"), offered.where("__rn <> ''")
    names = asked.select("__ln").distinct()
    exact = names.join(r, F.col("__ln") == F.col("__rn")).select("__ln", "__rk", F.lit(1.0).alias("score"))
    names = names.join(r, F.col("__ln") == F.col("__rn"), "left_anti")
    counts = r.select(F.explode(_letters(F.col("__rn"))).alias("x")).groupBy("x").count().orderBy(F.desc("count"), "x").limit(LETTERS).collect()  # a bounded list
    seen = F.map_from_arrays(F.array(*(F.lit(c["x"]) for c in counts)), F.array(*(F.lit(i) for i in range(len(counts), 0, -1)))) if counts else F.create_map().cast("map<string,int>")
    keyed = lambda df, name: df.select(name, F.explode(_keys(_letters(F.col(name)), F.length(name), seen, cutoff)).alias("__key"))
    a, b = F.length("__ln"), F.length("__rn")
    near = 2 * F.least(a, b) >= cutoff * (a + b) - 1e-9
    # names alone meet and are told apart; their letters are worked out again for each pair that is left
    pairs = keyed(names, "__ln").join(keyed(r.select("__rn"), "__rn"), "__key").where(near).select("__ln", "__rn").distinct()
    enough = 2 * F.size(F.array_intersect(_letters(F.col("__ln")), _letters(F.col("__rn")))) >= cutoff * (a + b) - 1e-9
    pairs = pairs.where(enough).withColumn("score", sequence_ratio(F.col("__rn"), F.col("__ln"))).where(F.col("score") >= cutoff)
    order = Window.partitionBy("__ln").orderBy(F.desc("score"), F.desc("__rn"))
    best = pairs.withColumn("__p", F.row_number().over(order)).where(F.col("__p") <= top).where(suffixes_agree(F.col("__ln"), F.col("__rn")))
    picked = best.groupBy("__ln").agg(F.min_by(F.struct("__rn", "score"), "__p").alias("b")).select("__ln", "b.__rn", "b.score")
    told = exact.unionByName(picked.join(r, "__rn").select("__ln", "__rk", "score"))
    told = materialize(asked.join(told, "__ln").select("__raw", "__ln", "__rk", "score"))
    release(spelt, offered)
    out = left.select(F.col(left_key).alias("__lk"), F.col(left_name).alias("__raw")).join(told, "__raw").select("__lk", "__ln", "__rk", "score").distinct()
    return out.select(F.col("__lk").alias(left_key), F.col("__rk").alias(right_key), "score")


def best_match(pairs: DataFrame, key: str, wanted: str, offered: str, sure: float = 0.8) -> DataFrame:
    """The likest offered text for each key, labelled match or match_dudoso (below `sure`)."""
    scored = pairs.where(F.col(wanted).isNotNull() & F.col(offered).isNotNull()).withColumn("score", sequence_ratio(F.upper(wanted), F.upper(offered)))
    top = scored.groupBy(key).agg(F.max_by(F.struct(offered, "score"), F.struct("score", offered)).alias("b")).select(key, f"b.{offered}", "b.score")
    return top.withColumn("status", F.when(F.col("score") >= sure, "match").otherwise("match_dudoso"))


#: The most variants search_variants() gives.
VARIANTS = 4


def _person(name: Column) -> tuple[Column, Column]:
    """A name's first surname, and the whole folded with its parts one space apart."""
    parts = split_person(name)
    whole = F.array_join(F.filter(F.array(*(parts[c] for c in ("first_surname", "second_surname", "given"))), lambda x: x != ""), " ")
    return parts["first_surname"], folded(whole)


def _likeness(a: Column, b: Column, n: Column, m: Column) -> Column:
    """The ratio that two texts of n and m letters can reach at most: by the letters in common."""
    return F.when(n + m == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / (n + m))


def _round(open_: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """wanted, and the best of those that its k-th variant finds: query, n_found, name, score.

    The likeliest by letters is compared first; of the others only those that could be as like are. Both passes leave a row a wanted name and task
    before anything moves.
    """
    asked = open_.withColumn("query", F.get("variants", F.lit(k))).where(F.col("query").isNotNull())
    pairs = asked.join(index, "query").withColumn("most", _likeness(F.col("letters"), F.col("offered_letters"), F.length("wanted"), F.length("offered")))
    pairs = pairs.select("surname", "wanted", "query", "offered", "most")
    who = ["surname", "wanted"]
    first = pairs.groupBy(*who).agg(F.count("*").alias("n_found"), F.max_by("offered", F.struct("most", "offered")).alias("__first"))
    first = materialize(first.withColumn("__floor", sequence_ratio(F.col("wanted"), F.col("__first"))).drop("__first"))
    left = pairs.join(first, who).where(F.col("most") >= F.col("__floor") - 1e-9).withColumn("score", sequence_ratio(F.col("wanted"), F.col("offered")))
    best = F.max(F.struct("score", F.lit(-k).alias("earlier"), F.col("offered").alias("name"), "query", "n_found")).alias("best")
    return left.groupBy(*who).agg(best)


def best_by_variants(people: DataFrame, key: str, name: str, catalogue: DataFrame, offered_key: str, offered_name: str, sure: float = 0.8) -> DataFrame:
    """key, query, n_found, offered_key, offered_name (folded), score, status: whom a catalogue of names most likely means by each name, surnames first.

    Variants of the first surname, most specific first, find the entries whose first surname, as written or folded, begins with them. The first variant that finds a name of
    ratio `sure` or more ends the search (match); if none does, the likest of all found is given (match_dudoso), of equal ones the one of the earlier
    variant, then the larger name; sin_match if nothing was found. n_found counts the distinct names that the variant found. Of several entries of one name the smallest key is
    given. Null and empty names find nothing; rows alike are all kept.

    Names are searched once each, however many rows have them. An entry stands in an index under each of its beginnings; only names whose variants so far were not sure go on to
    the next, wider one. Frequent beginnings are spread by skew joins, and no group is ever gathered.
    """
    surname, whole = _person(F.col("raw"))
    # told apart as they are written, so that they are folded once each; a filter here would be moved down to the rows, and the folding with it
    said = materialize(people.select(F.col(name).alias("raw")).distinct().select("raw", surname.alias("surname"), whole.alias("wanted")))
    distinct = said.where("wanted <> ''").select("surname", "wanted").distinct()
    open_ = materialize(distinct.withColumn("variants", search_variants(F.col("surname"))).withColumn("letters", _letters(F.col("wanted"))))
    written = catalogue.groupBy(F.col(offered_name).alias("raw")).agg(F.min(offered_key).alias("offered_key"))
    written = materialize(written.select("offered_key", surname.alias("surname"), whole.alias("offered")))
    entries = written.where("offered <> ''")
    starts = lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: F.substring(s, F.lit(1), i))
    begins = F.array_distinct(F.concat(starts(F.col("surname")), starts(folded(F.col("surname")))))
    index = entries.select("surname", "offered").distinct().select("offered", F.explode(begins).alias("query")).where(F.length("query") >= 3).distinct()
    index = materialize(index.withColumn("offered_letters", _letters(F.col("offered"))))
    found, scratch = None, [said, written, open_, index]
    for k in range(VARIANTS):
        got = materialize(_round(open_, index, k))
        scratch.append(got)
        found = got if found is None else found.unionByName(got)
        certain = got.where(F.col("best.score") >= sure).select("surname", "wanted")
        open_ = materialize(open_.join(certain, ["surname", "wanted"], "left_anti"))
        scratch.append(open_)
    best = found.groupBy("surname", "wanted").agg(F.max("best").alias("best")).select("surname", "wanted", "best.*")
    keys = entries.groupBy(F.col("offered").alias("name")).agg(F.min("offered_key").alias("offered_key"))
    told = materialize(best.join(keys, "name").join(said, ["surname", "wanted"]).select("raw", "query", "n_found", "offered_key", "name", "score"))
    release(*scratch)
    out = people.select(F.col(key).alias("key"), F.col(name).alias("raw")).join(told, "raw", "left")
    status = F.when(F.col("score") >= sure, "match").when(F.col("score").isNotNull(), "match_dudoso").otherwise("sin_match")
    return out.select(F.col("key").alias(key), "query", F.coalesce("n_found", F.lit(0)).alias("n_found"), F.col("offered_key").alias(offered_key), F.col("name").alias(offered_name), "score", status.alias("status"))
