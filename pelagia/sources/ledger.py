"""Rows in, rows out and rows dropped by cause, counted while a product is written and not by another pass.

A plan drops rows through a sift: a function of a step's name, a table and, for each cause, the condition that a row must meet. plain() only filters. A Ledger's
sift also observes how many rows came, how many went on, and how many each cause took; a row that fails several conditions counts for the first.

Observed counts are sums over tasks. A task that ran again after an executor was lost, or a plan that was worked out twice (a range sort
samples its input first), counts twice, so the ledger believes them only if they balance: what one step lets through the next one gets, and the last step's rows are those in the
written product. Otherwise, or if a step was never reached, the steps are counted by a plain aggregate; if those don't balance either, rows were lost or doubled and
Unbalanced is raised.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Sift = Callable[..., DataFrame]
#: Seconds that an observation may take to arrive after the write that made it.
ARRIVAL = 10.0


class Unbalanced(ValueError):
    """Rows in are not rows out and rows dropped."""


def plain(step: str, df: DataFrame, conditions: dict[str, Column], fresh: bool = False) -> DataFrame:
    """The rows that meet all conditions; null is no."""
    for keep in conditions.values():
        df = df.where(keep)
    return df


@dataclass
class Step:
    name: str
    causes: list[str]
    fresh: bool
    marked: DataFrame
    observation: Observation = field(default_factory=Observation)

    def sums(self) -> list[Column]:
        taken = (F.count_if(F.col("__cause") == i).alias(f"n{i}") for i in range(len(self.causes)))
        return [F.count(F.lit(1)).alias("came"), F.count_if(F.col("__cause").isNull()).alias("went"), *taken]

    def observed(self) -> dict[str, int] | None:
        """What was observed; None if nothing arrives, as for a step whose plan was never run."""
        got: dict[str, int] = {}
        asking = threading.Thread(target=lambda: got.update(self.observation.get), daemon=True)  # get waits for ever
        asking.start()
        asking.join(ARRIVAL)
        return dict(got) if "came" in got else None

    def counted(self) -> dict[str, int]:
        return self.marked.agg(*self.sums()).first().asDict()


class Ledger:
    """The steps of one product."""

    def __init__(self) -> None:
        self.steps: list[Step] = []

    def sift(self, step: str, df: DataFrame, conditions: dict[str, Column], fresh: bool = False) -> DataFrame:
        """plain(), observed. A fresh step does not get the rows of the step before one by one, for they were grouped or joined in between."""
        cause = F.coalesce(*(F.when(~F.coalesce(keep, F.lit(False)), F.lit(i)) for i, keep in enumerate(conditions.values())), F.lit(None))
        s = Step(step, list(conditions), fresh or not self.steps, df.withColumn("__cause", cause))
        self.steps.append(s)
        return s.marked.observe(s.observation, *s.sums()).where("__cause IS NULL").drop("__cause")

    def _balanced(self, sums: list[dict[str, int] | None], rows: int | None) -> bool:
        if None in sums:
            return False
        goes = [s["went"] for s in sums[:-1]]
        chained = all(s.fresh or before == n["came"] for s, n, before in zip(self.steps[1:], sums[1:], goes))
        whole = all(n["came"] == n["went"] + sum(n[f"n{i}"] for i in range(len(s.causes))) for s, n in zip(self.steps, sums))
        return chained and whole and (rows is None or sums[-1]["went"] == rows)

    def settle(self, product: str, rows: int | None) -> list[tuple[str, int, str, str, int]]:
        """(product, place, step, what, rows) once the product is written; what is in, out or a cause. rows: those of the product, None if they are no longer
        those of the last step."""
        if not self.steps:
            return []
        sums = [s.observed() for s in self.steps]
        if not self._balanced(sums, rows):
            sums = [s.counted() for s in self.steps]
            if not self._balanced(sums, rows):
                told = "; ".join(f"{s.name}: {n}" for s, n in zip(self.steps, sums))
                raise Unbalanced(f"{product} has {rows} rows, but {told}")
        out = []
        for k, (s, n) in enumerate(zip(self.steps, sums)):
            each = [("in", n["came"]), *((c, n[f"n{i}"]) for i, c in enumerate(s.causes)), ("out", n["went"])]
            out += [(product, k, s.name, what, count) for what, count in each]
        return out
