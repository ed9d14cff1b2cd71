"""Rule-based text quality with host-level verdicts, in DataFrame functions only.

Every text gets a few counts and a base verdict. Failures are then summed by host, each host's failure
rate is shrunk towards all hosts' rates with a beta prior fitted by moments, and hosts whose shrunk rate is
too high take their documents with them. The prior alone guards hosts with few documents.

Edge cases: a null or blank text has no words and fails (too few words); a null host is never judged;
repeated rows are judged one by one; an empty table gives an empty result. Other columns are kept; measure() and judge() put
their results in place of input columns of the same names, keep() returns the input's columns as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import SPACE, dimension_join, materialize, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_HOST_RATE = 0.5


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _window_hashes(ws: Column, width: int) -> Column:
    """One hash for each window of words, in order; none when there is only one window or less."""
    at = lambda i: F.xxhash64(*(F.get(ws, i + F.lit(k)) for k in range(width)))
    return F.when(F.size(ws) > width, F.transform(F.sequence(F.lit(0), F.size(ws) - F.lit(width)), at)).otherwise(F.array().cast("array<bigint>"))


def _covered(grams: Column, width: int) -> Column:
    """Words lying in windows whose hash occurs more than once."""

    def sized(s: Column) -> Column:
        n = F.size(s)
        same = lambda k, j: F.get(s, k)["g"] == F.get(s, j)["g"]
        twice = F.filter(
            F.sequence(F.lit(0), n - F.lit(1)),
            lambda k: F.coalesce(F.when(k > 0, same(k, k - F.lit(1))), F.lit(False)) | F.coalesce(same(k, k + F.lit(1)), F.lit(False)),
        )
        starts = F.sort_array(F.transform(twice, lambda k: F.get(s, k)["i"]))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
        step = lambda a, p: F.struct(
            (p + F.lit(width)).alias("end"),
            (a["total"] + p + F.lit(width) - F.greatest(p, a["end"])).cast("long").alias("total"),
        )
        return F.aggregate(starts, zero, step, lambda a: a["total"])

    ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), _let(ordered, sized)).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, text: str = "text", width: int = 5) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed to every row."""
    safe = F.coalesce(F.col(text), F.lit(""))
    plain = F.translate(safe, " \t\n\x0b\f\r", "")
    lines = F.filter(F.split(safe, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))

    def counted(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        repeated = lambda r: F.struct(n.alias("n_words"), r.alias("n_repeat_words"), ((n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)).alias("base_failed"))
        return _let(_let(_window_hashes(ws, width), lambda g: _covered(g, width)), repeated)

    # each list is bound once: a filter on a count, pushed down to the scan, then still splits a text once
    out = docs.withColumn("__c", _let(words(F.col(text)), counted))
    return out.withColumns(
        {
            "n_words": F.col("__c.n_words"),
            "word_chars": F.length(plain).cast("long"),
            "n_symbols": (F.length(safe) - F.length(F.translate(safe, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
            "n_repeat_words": F.col("__c.n_repeat_words"),
            "base_failed": F.col("__c.base_failed"),
        }
    ).drop("__c")


def host_of(source: Column) -> Column:
    """The host of a URL, or the lower-cased source name itself; null stays null."""
    host = F.regexp_extract(F.lower(source), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]+)", 1)
    return F.when(source.isNotNull(), F.when(host != "", host).otherwise(F.lower(source)))


def host_verdicts(measured: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row a host: n_docs, n_failed, shrunk_rate, host_ok. Wants columns host and base_failed.

    Partial sums are made before the shuffle, so a hot host costs one row a task.
    """
    hosts = materialize(
        measured.where(F.col("host").isNotNull()).groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if("base_failed").alias("n_failed"))
    )
    rate = F.col("n_failed") / F.col("n_docs")
    m = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("var"), F.avg(1 / F.col("n_docs")).alias("inv")).first()
    alpha, beta = _beta_prior(m["mean"], m["var"], m["inv"])
    shrunk = (F.col("n_failed") + F.lit(alpha)) / (F.col("n_docs") + F.lit(alpha + beta))
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("host_ok", F.col("shrunk_rate") <= max_rate)


def _beta_prior(mean: float | None, var: float | None, inv_n: float | None) -> tuple[float, float]:
    """Moments of the hosts' rates less the sampling variance give the prior's weight, held to 1 to 10,000 documents."""
    if mean is None or not 0 < mean < 1:
        return (1.0, 1.0) if mean is None else (mean + 0.01, 1.01 - mean)
    spread = mean * (1 - mean)
    between = max((var or 0.0) - spread * (inv_n or 0.0), spread / 10_001)
    weight = min(max(spread / between - 1, 1.0), 10_000.0)
    return mean * weight, (1 - mean) * weight


def judge(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """The measured rows of docs without their text, with host, shrunk_rate and kept.

    Texts are read once: the narrow counts are written to the shared folder and both the host sums and
    the verdicts start from there.
    """
    slim = materialize(measure(docs.withColumn("host", host_of(F.col(source))), text).drop(text, "shrunk_rate", "host_failed", "kept"))
    verdicts = host_verdicts(slim)
    bad = verdicts.where(~F.col("host_ok")).select("host", "shrunk_rate", F.lit(True).alias("host_failed"))
    out = dimension_join(slim, bad, "host", by="doc_id" if "doc_id" in slim.columns else None)
    return out.withColumn("host_failed", F.coalesce("host_failed", F.lit(False))).withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


def keep(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """The rows of docs that pass, with their own columns. Texts are measured twice rather than shuffled."""
    narrow = docs.select(host_of(F.col(source)).alias("host"), F.col(text).alias("__text"))
    verdicts = host_verdicts(measure(narrow, "__text").select("host", "base_failed"))
    bad = verdicts.where(~F.col("host_ok")).select(F.col("host").alias("__host"), F.lit(True).alias("__host_failed"))
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    inner = docs.select(own, F.col(text).alias("__text"), host_of(F.col(source)).alias("__host"), F.xxhash64(F.col(text)).alias("__by"))
    passed = measure(inner, "__text").where(~F.col("base_failed"))
    return dimension_join(passed, bad, "__host", by="__by").where(F.col("__host_failed").isNull()).select("__row.*")
