"""Conversations as training windows under a token budget, in DataFrame functions only.

Turns are ordered by their number; prefix sums of their tokens (a turn counts for one at least) cut the conversation into spans that begin and end
at turns. A window is the conversation's first system turn, the turns before the span that fit the history's tokens, and the
span. A prompt and the assistant's answer to it are parted only where both together exceed the room; the prompt is then repeated before
the answer, whatever its size, so no target stands without its prompt (such windows alone may exceed the budget). The loss falls on assistant texts of the span alone: repeated turns are context and masked, so each target
counts once. A turn that is larger than the budget makes a window of its own.

Every turn is written as <s>[INST] role [/INST]text</s>. Control strings inside a role or text are broken with a
backslash after their first character, and those already broken get one more, so unescaping returns every text.

Prefix sums run over many tasks: turns are dealt by ranges of their order, each task sums its own, and what came before is one number a task.
A conversation is handled in stretches of ROOMS windows' tokens, each with the history that reaches into it, so a very long one is spread; only there is
a span cut that could have gone on. Edge cases: a null text or
role is empty; a null turn number comes first; repeated turn numbers go by role and text, repeated rows are
turns of their own; gaps between turn numbers mean nothing; a null conv_id is a conversation like others; an empty table gives none; other columns
play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagia.llm.common import materialize

BUDGET = 1024
HISTORY = 128
#: Windows' tokens that one task handles together.
ROOMS = 16
#: What follows the first character of a control string: <s> </s> <<SYS>> <</SYS>> [INST] [/INST]
_REST = r"(?=/?s>|</?SYS>>|/?INST\])"
_FIRST = r"([<\[])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _FIRST + r"(\\*)" + _REST, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _FIRST + r"\\(\\*)" + _REST, r"$1$2")


def tokens(text: Column) -> Column:
    """A count that needs no vocabulary: runs of letters and digits, and every other visible character."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")).cast("long")


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _written(t: Column) -> Column:
    return F.concat(F.lit("<s>[INST] "), escape(t["role"]), F.lit(" [/INST]"), escape(t["text"]), F.lit("</s>"))


def summed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n (tokens, one at least) and c, the conversation's tokens before the turn; written once, in order."""
    keys = [F.col(k).asc_nulls_first() for k in ("conv_id", "turn", "role", "text", "nth")]
    base = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("nth"))
    base = base.withColumn("n", F.greatest(tokens(F.col("text")), F.lit(1).cast("long")))
    place = F.monotonically_increasing_id()
    rows = base.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.shiftright(place, 33)).withColumn("at", place.bitwiseAND(F.lit((1 << 33) - 1)))
    rows = materialize(rows.drop("nth"))
    each = rows.groupBy("conv_id", "part").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = each.withColumn("before", F.sum("n").over(earlier)).where("before > 0")  # at most one conversation a task goes on from an earlier one
    before = F.broadcast(before.select(F.col("conv_id").alias("__c"), F.col("part").alias("__p"), "before"))
    inside = Window.partitionBy("conv_id", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("c", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    out = out.join(before, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("part") == F.col("__p")), "left")
    return out.select("conv_id", "turn", "role", "text", "n", (F.col("c") + F.coalesce("before", F.lit(0))).alias("c"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row a window: conv_id, stretch, start (the conversation's tokens before its span), text, n_context, spans (start, size in characters), n_tokens.

    Windows of a conversation are in order of start; the first n_context turns of the text are repeated.
    """
    base = summed(turns)
    first = F.min(F.struct("c", "text", "n")).alias("sys")
    system = base.where(F.col("role") == "system").groupBy(F.col("conv_id").alias("sys_of")).agg(first)

    wide = ROOMS * max(1, budget - history)
    end = F.col("c") + F.col("n")
    home = F.floor(F.col("c") / wide)
    reaches = F.when(end + history > (home + 1) * wide, home + 1)
    last = F.when(F.floor(end / wide) > home, F.floor(end / wide))  # nothing of its stretch comes after it
    places = F.array_compact(F.array_distinct(F.array(home, reaches, last)))
    placed = base.withColumn("s", F.explode(places)).select("conv_id", F.col("s").alias("stretch"), F.struct("c", (F.col("s") == home).cast("int").alias("own"), "role", "text", "n").alias("t"))
    lists = placed.groupBy("conv_id", "stretch").agg(F.sort_array(F.collect_list("t")).alias("ts")).where(F.exists("ts", lambda t: t["own"] == 1))
    lists = lists.join(system, F.col("conv_id").eqNullSafe(F.col("sys_of")), "left").drop("sys_of")

    room = F.greatest(F.lit(1), F.lit(budget - history) - F.coalesce("sys.n", F.lit(0)))
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("cuts"))

    def step(s: Column, t: Column) -> Column:
        begin = (t["own"] == 1) & ((F.size(s["cuts"]) == 0) | (s["used"] + t["need"] > room))
        used = F.when(begin, t["n"]).when(t["own"] == 1, s["used"] + t["n"]).otherwise(s["used"])
        return F.struct((s["i"] + 1).alias("i"), used.alias("used"), F.when(begin, F.array_append(s["cuts"], s["i"])).otherwise(s["cuts"]).alias("cuts"))

    answered = lambda t, i: (t["role"] != "assistant") & (F.coalesce(F.get("ts", i + 1)["role"], F.lit("")) == "assistant")
    needs = F.transform("ts", lambda t, i: F.struct(t["own"].alias("own"), t["n"].alias("n"), (t["n"] + F.when(answered(t, i), F.get("ts", i + 1)["n"]).otherwise(0)).alias("need")))
    cut = lists.withColumn("cuts", F.aggregate(needs, zero, step, lambda s: s["cuts"]))
    spans = F.transform("cuts", lambda a, k: F.struct(a.alias("a"), F.coalesce(F.get("cuts", k + 1), F.size("ts")).alias("b")))
    cut = cut.withColumn("w", F.explode(spans)).select("conv_id", "stretch", "ts", "sys", F.col("w.a").alias("a"), F.col("w.b").alias("b"))

    at = F.get("ts", F.col("a"))
    back = F.slice("ts", F.greatest(F.lit(1), F.col("a") - history + 1), F.least(F.lit(history), F.col("a")))  # turns have a token each
    fits = F.size(F.filter(back, lambda t: t["c"] >= at["c"] - history))
    cut = cut.withColumn("k", F.when(F.col("a") > 0, F.greatest(fits, ((at["role"] == "assistant") & (F.get("ts", F.col("a") - 1)["role"] != "assistant")).cast("int"))).otherwise(F.lit(0)))
    cut = cut.withColumn("past", F.slice("ts", F.col("a") - F.col("k") + 1, F.col("k"))).withColumn("span", F.slice("ts", F.col("a") + 1, F.col("b") - F.col("a")))
    is_system = lambda t: t["c"] == F.col("sys.c")
    shown = F.exists(F.concat("past", "span"), is_system)
    plain = lambda ts, new: F.transform(ts, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["n"].alias("n"), F.lit(new).alias("new")))
    head = F.array(F.struct(F.lit("system").alias("role"), F.col("sys.text").alias("text"), F.col("sys.n").alias("n"), F.lit(False).alias("new")))
    head = F.when(F.col("sys").isNotNull() & ~shown, head).otherwise(F.slice(head, 1, 0))
    cut = cut.withColumn("all", F.concat(head, plain("past", False), plain("span", True)))
    cut = cut.withColumn("out", F.transform("all", lambda t: F.struct(_written(t).alias("text"), F.length(escape(t["role"])).alias("r"), F.length(escape(t["text"])).alias("size"), (t["new"] & (t["role"] == "assistant")).alias("loss"))))
    lead, tail = len("<s>[INST] ") + len(" [/INST]"), len("</s>")
    mark = F.aggregate(
        "out",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,size:int>>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + t["r"] + t["size"] + (lead + tail)).alias("at"),
            F.when(t["loss"], F.array_append(s["spans"], F.struct((s["at"] + t["r"] + lead).alias("start"), t["size"].alias("size")))).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return cut.select(
        "conv_id",
        "stretch",
        F.get("span", F.lit(0))["c"].alias("start"),
        F.array_join("out.text", "").alias("text"),
        F.size(F.filter("all", lambda t: ~t["new"])).alias("n_context"),
        mark.alias("spans"),
        F.aggregate("all", F.lit(0).cast("long"), lambda s, t: s + t["n"]).alias("n_tokens"),
    )


def read_turns(text: Column) -> Column:
    """array of struct(role, text) out of a window's text."""
    turn = r"(?s)<s>\[INST\] (.*?) \[/INST\](.*?)</s>"
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(turn), F.lit(1)).alias("role"), F.regexp_extract_all(text, F.lit(turn), F.lit(2)).alias("text"))
    return F.transform(both, lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")))


def digests(formatted: DataFrame) -> DataFrame:
    """One row a conversation, read back from its windows: what they say and what the loss covers."""
    new = _let(read_turns(F.col("text")), lambda ts: F.slice(ts, F.col("n_context") + 1, F.size(ts)))
    said = F.transform("new", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.transform("spans", lambda s: unescape(F.col("text").substr(s["start"] + 1, s["size"])))
    part = F.struct("stretch", "start", F.array_join(said, "").alias("said"), F.array_join(loss, "").alias("loss"), F.size("new").alias("n"), F.length("text").alias("chars"))
    per = formatted.withColumn("new", new).groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("w"))
    total = lambda field: F.aggregate("w", F.lit(0).cast("long"), lambda s, x: s + x[field])
    per = per.withColumn("loss", F.array_join("w.loss", ""))
    return per.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(F.array_join("w.said", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
        F.size("w").cast("long").alias("n_windows"),
    )
