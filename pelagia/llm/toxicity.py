"""Toxicity scores by weak supervision.

Voters are lexicon terms (whole words and word beginnings that mark the training labels' toxic texts) and patterns
over a text's finds. They vote on every distinct text of the corpus, labelled or not. A generative label model estimates each
voter's accuracy and coverage from these votes by expectation maximisation and, from what voters share beyond the label,
their correlations; a voter's evidence is divided by its correlated company. Each round is a Spark job over the
distinct vote patterns and their numbers of texts; only sums of fixed size reach the driver. A linear classifier learns the posterior
labels of a bounded sample, and its weights score every text with DataFrame functions alone.

Labels find the terms and their share is the label model's prior; nothing else learns from them. They are taken from a bounded
sample (the hash order's first MAX_LABELS ids that the caller allows). Edge cases: null, empty and blank texts have no finds and get the score of a text
without finds; without any toxic or any clean label the score is the label share, or 0; repeated label rows count once,
toxic if any is; repeated rows keep their rows; very long texts are read whole; an empty table gives an empty result; the results'
columns score and n_finds take the place of input columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import materialize, release

#: The labelled rows a model learns from, at most.
MAX_LABELS = 12_000
MAX_TERMS = 400
#: Lexicon voters that take part in the label model on their own; the rest votes as one.
MAX_VOTERS = 60
ROUNDS = 10
#: Correlations beyond this many standard errors of no correlation are company.
SURE = 5.0
#: Lengths of word beginnings tried beside whole words.
STEMS = (4, 5)
MIN_PRECISION = 0.9


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _term_names(t: Column) -> list[Column]:
    return [F.concat(F.lit("w:"), t), *(F.when(F.length(t) >= k, F.concat(F.lit(f"{k}:"), t.substr(1, k))) for k in STEMS)]


def mine_terms(train: DataFrame) -> list[str]:
    """Terms that toxic training texts hold and clean ones hardly do, by gain. Wants columns text and toxic (0 or 1).

    Texts that are equal count once, so a copied text makes no terms. A term's gain in likelihood must beat
    what the best of as many chance terms would reach, 2 log(number of terms tried).
    """
    once = train.groupBy("text").agg(F.max("toxic").alias("toxic"))
    sums = once.agg(F.sum("toxic"), F.count("*")).first()
    positives, total = int(sums[0] or 0), int(sums[1])
    if not 0 < positives < total:
        return []
    names = F.array_compact(F.array_distinct(F.flatten(F.transform(F.array_distinct(tokens(F.col("text"))), lambda t: F.array(*_term_names(t))))))
    counts = once.select("toxic", F.explode(names).alias("term")).groupBy("term").agg(F.sum("toxic").alias("p"), F.count("*").alias("n"))
    counts = materialize(counts.where(F.col("p") >= 3))
    tests = max(2, counts.count())
    counts = counts.where(F.col("p") >= MIN_PRECISION * F.col("n"))
    # likelihood gain of the term's toxic share over the table's
    share = F.col("p") / F.col("n")
    clean = F.when(share < 1, (F.col("n") - F.col("p")) * F.log((1 - share) / F.lit(1 - positives / total))).otherwise(F.lit(0.0))
    gain = 2 * (F.col("p") * F.log(share / F.lit(positives / total)) + clean)
    best = counts.withColumn("gain", gain).where(F.col("gain") >= float(2 * np.log(tests) + 2)).orderBy(F.desc("gain"), "term").limit(MAX_TERMS)
    return [r["term"] for r in best.collect()]


def finds(text: Column, terms: list[str]) -> Column:
    """struct(n_words, n_finds, terms): a text's words, how many of them are finds, and the distinct terms found."""
    by_kind = {kind: [t[2:] for t in terms if t.startswith(f"{kind}:")] for kind in ("w", *map(str, STEMS))}

    def named(t: Column) -> Column:
        whole = F.when(t.isin(by_kind["w"]), F.concat(F.lit("w:"), t)) if by_kind["w"] else F.lit(None).cast("string")
        stems = [F.when(t.substr(1, k).isin(by_kind[str(k)]), F.concat(F.lit(f"{k}:"), t.substr(1, k))) for k in STEMS if by_kind[str(k)]]
        return F.array_compact(F.array(whole, *stems))

    def known(t: Column) -> Column:
        tests = [t.isin(by_kind["w"])] if by_kind["w"] else []
        tests += [t.substr(1, k).isin(by_kind[str(k)]) for k in STEMS if by_kind[str(k)]]
        out = F.lit(False)
        for test in tests:
            out = out | test
        return out

    words = tokens(text)
    split = lambda ws: F.struct(F.size(ws).alias("n_words"), F.filter(ws, known).alias("hit"))
    both = F.element_at(F.transform(F.array(words), split), 1)
    shape = lambda x: F.struct(x["n_words"].alias("n_words"), F.size(x["hit"]).alias("n_finds"), F.array_sort(F.array_distinct(F.flatten(F.transform(x["hit"], named)))).alias("terms"))
    return F.element_at(F.transform(F.array(both), shape), 1)


@dataclass
class Model:
    terms: list[str]
    weights: dict[str, float] = field(default_factory=dict)
    per_find: float = 0.0
    bias: float = -20.0
    accuracies: dict[str, float] = field(default_factory=dict)
    company: dict[str, float] = field(default_factory=dict)


@dataclass
class LabelModel:
    """Chances of a vote (no, none, yes) by label and voter, and each voter's company (1: independent)."""

    prior: float
    rate: np.ndarray | None = None
    company: np.ndarray | None = None

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The chance of label 1 for rows of votes in {-1, 0, 1}; before any round, what most voters say."""
        if self.rate is None:
            lean = votes.sum(axis=1)
            return np.where(lean > 0, 0.95, np.where(lean < 0, 0.05, self.prior))
        yes, no = (votes == 1).astype(float), (votes == -1).astype(float)
        evidence = np.log(self.rate[1] / self.rate[0]) / self.company
        z = np.log(self.prior / (1 - self.prior)) + no @ evidence[0] + (1 - yes - no) @ evidence[1] + yes @ evidence[2]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def sums(self, votes: np.ndarray, times: np.ndarray) -> np.ndarray:
        """What a round needs of some rows, each counted so many times: masses, noes, yeses and products of votes by label."""
        post = self.posterior(votes)
        out = []
        for weight in (times * (1 - post), times * post):
            v = votes.astype(float)
            out += [[weight.sum()], weight @ (v == -1), weight @ (v == 1), ((weight[:, None] * v).T @ v).ravel()]
        return np.concatenate(out)

    def updated(self, sums: np.ndarray) -> LabelModel:
        """The model after a round.

        Voters vote, abstain or err independently given the label, but for pairs whose votes go together within
        the labels: the squares of those correlations count as company, by which evidence is divided.
        """
        m = int(round(np.sqrt(len(sums) / 2))) - 1  # 1 + 2 m + m * m numbers for each label
        parts, rate, cov = sums.reshape(2, -1), np.empty((2, 3, m)), 0.0
        for k, part in enumerate(parts):
            mass, no, yes, both = part[0], part[1 : m + 1], part[m + 1 : 2 * m + 1], part[2 * m + 1 :].reshape(m, m)
            rate[k] = np.stack([no + 0.1, np.maximum(mass - no - yes, 0) + 0.1, yes + 0.1]) / (mass + 0.3)
            mean = (yes - no) / max(mass, 1e-9)
            cov = cov + both - mass * np.outer(mean, mean)
        n = max(1.0, float(parts[:, 0].sum()))
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        corr = cov / np.outer(scale, scale)
        np.fill_diagonal(corr, 0.0)
        return LabelModel(self.prior, rate, 1 + np.where(np.abs(corr) > SURE * n**-0.5, corr**2, 0).sum(axis=1))

    def accuracies(self) -> np.ndarray:
        """How often each voter is right when it votes."""
        share = np.array([1 - self.prior, self.prior])[:, None]
        said = (share * (self.rate[:, 0] + self.rate[:, 2])).sum(axis=0)
        return (share[0] * self.rate[0, 0] + share[1] * self.rate[1, 2]) / np.maximum(1e-9, said)


def _read_votes(patterns) -> np.ndarray:
    """Rows of votes from texts of n, . and y."""
    flat = np.frombuffer("".join(patterns).encode(), np.uint8).reshape(len(patterns), -1)
    return (flat == ord("y")).astype(np.int8) - (flat == ord("n")).astype(np.int8)


def label_model(patterns: DataFrame, prior: float, rounds: int = ROUNDS) -> LabelModel:
    """Fitted to patterns (votes as a text of n, . and y, and times), a job a round."""
    model = LabelModel(prior)
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], model: LabelModel = model) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                if batch.num_rows:
                    total = total + model.sums(_read_votes(batch.column(0).to_pylist()), batch.column(1).to_numpy().astype(float))
            if not np.isscalar(total):
                yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "value"])

        rows = patterns.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()  # a fixed number
        if not rows:
            break
        sums = np.zeros(len(rows))
        sums[[r["place"] for r in rows]] = [r["value"] for r in rows]
        model = model.updated(sums)
    return model


def _votes(found: Column, text: Column, solo: list[str]) -> Column:
    """The voters' votes on a text as letters: y, n or . for none; lexicon voters first, then the patterns."""
    says = lambda yes, no=None: F.when(yes, "y").when(no, "n").otherwise(".") if no is not None else F.when(yes, "y").otherwise(".")
    terms, none = found["terms"], found["n_finds"] == 0
    dense = found["n_finds"] > 0.02 * F.greatest(found["n_words"], F.lit(1))
    each = F.array_join(F.transform(F.array(*map(F.lit, solo)), lambda t: says(F.array_contains(terms, t))), "")
    own = F.when(none, "." * len(solo)).otherwise(each)
    return F.concat(
        own,
        says(F.size(F.array_except(terms, F.array(*map(F.lit, solo)))) > 0),
        F.when(none, "n").otherwise("."),
        says(F.size(terms) >= 3),
        says(dense, none),
        says(F.regexp_count(text, F.lit(r"\p{Lu}{4,}!")) > 2),
        says(text.rlike(r"\p{L}\*+\p{L}")),
    )


PATTERN_VOTERS = ("other terms", "no find", "several terms", "dense", "shouting", "masked word")


def linear_model(x: np.ndarray, target: np.ndarray, steps: int = 1500, shrink: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes weighing alike, by accelerated gradient steps."""
    w, b = np.zeros(x.shape[1]), 0.0
    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    each = (target / share + (1 - target) / (1 - share)) / 2
    rate = 4.0 / (np.square(x).sum(axis=1).max(initial=1.0) + 1)
    vw, vb = np.zeros_like(w), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ (w + 0.9 * vw) + b + 0.9 * vb, -30, 30)))
        g = each * (p - target) / len(x)
        vw = 0.9 * vw - rate * (x.T @ g + shrink * w)
        vb = 0.9 * vb - rate * g.sum()
        w, b = w + vw, b + vb
    return w, b


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Model:
    """Learns from docs (doc_id, text) and labels (doc_id, toxic); the caller leaves out the labels to be held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = materialize(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))
    rows = docs.join(F.broadcast(sample), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))
    train = materialize(rows)
    terms = mine_terms(train)
    share = train.agg(F.avg("toxic")).first()[0] or 0.0
    if not terms:
        release(sample, train)
        return Model([], bias=float(np.log(share / (1 - share))) if 0 < share < 1 else (20.0 if share else -20.0))
    solo = terms[:MAX_VOTERS]
    voted = lambda df: df.select(F.coalesce("text", F.lit("")).alias("t")).withColumn("f", finds(F.col("t"), terms)).select("t", "f", _votes(F.col("f"), F.col("t"), solo).alias("votes"))
    distinct = voted(docs).select("votes", F.xxhash64("t").alias("h")).distinct()  # a text that is copied often votes once
    patterns = materialize(distinct.groupBy("votes").agg(F.count("*").alias("times")))
    model = label_model(patterns, float(np.clip(share, 0.01, 0.99)))
    order = [F.xxhash64("t"), F.col("votes")]
    rows = voted(train).orderBy(*order).limit(2 * max_labels).select("votes", "f.terms", "f.n_finds").collect()  # a few finds for each of the bounded sample's rows
    index = {t: i for i, t in enumerate(terms)}
    x = np.zeros((len(rows), len(terms) + 1))
    for i, r in enumerate(rows):
        x[i, [index[t] for t in r["terms"]]] = 1
        x[i, -1] = np.log1p(r["n_finds"])
    w, b = linear_model(x, model.posterior(_read_votes([r["votes"] for r in rows])))
    names = [*solo, *PATTERN_VOTERS]
    release(sample, train, patterns)
    return Model(terms, dict(zip(terms, w[:-1].tolist())), float(w[-1]), float(b), dict(zip(names, model.accuracies().tolist())), dict(zip(names, model.company.tolist())))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) and n_finds."""
    out = docs.withColumn("__f", finds(F.col(text), model.terms))
    if model.weights:
        weight = F.create_map(*(F.lit(x) for item in model.weights.items() for x in item))
        total = F.aggregate("__f.terms", F.lit(0.0), lambda a, t: a + F.element_at(weight, t))
        z = F.when(F.col("__f.n_finds") > 0, total + F.lit(model.per_find) * F.log1p("__f.n_finds")).otherwise(F.lit(0.0)) + F.lit(model.bias)
    else:
        z = F.lit(model.bias)
    return out.withColumn("score", 1 / (1 + F.exp(-z))).withColumn("n_finds", F.col("__f.n_finds").cast("long")).drop("__f")
