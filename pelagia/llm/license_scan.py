"""Licence notices found by a trained paragraph classifier and confirmed against templates.

Features are the word 1- to 3-grams of a line that hold at least one licence word; a multinomial logistic
regression over them, trained here on altered copies of public notices and, as the unknown class, on a bounded
sample of the corpus' own lines, names the family. A line without any licence word has no feature and is unknown by
construction, so one regular expression is an exact gate. The temperature is fitted on held-out copies, and a
prediction stands only if its calibrated probability is high and the line shares enough word pairs with
one of the family's templates. Training is a small driver task on constant data; scanning is DataFrame
functions only, and only gated lines are ever shuffled.

Units are lines and, for notices that are wrapped, paragraphs of several lines: blocks between blank lines, with comment
marks stripped and lines joined. An SPDX id adds its beginnings (gpl, gpl-2.0, ...) to the features and pairs of its line, so such lines are
classified, calibrated and confirmed like others, and ids of other licences are part of the unknown class.

Edge cases: a null, empty or blank text has no notices; very long lines are one paragraph like others; equal lines of
a text are found one by one; repeated rows keep their rows; a tie goes to a family first by name; an empty table
gives an empty result; other columns play no part.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.llm.common import materialize

#: Short public notices by SPDX family.
NOTICES = {
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License.",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "GPL": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
#: Lines with licence words that are no notice.
OTHERS = [
    "The driver showed a licence at the checkpoint and drove on.",
    "All rights reserved by the hotel for late arrivals.",
    "The museum asked for permission to copy the painting for free.",
    "General public opinion turned against the version of the work shown in public.",
    "A fishing license is needed under the terms of the treaty.",
    "The foundation is free to publish the library's software catalogue.",
    "Students of MIT built a software library for the apache helicopter museum.",
    "Use of the source is permitted with or without charge, subject to conditions.",
]
UNKNOWN = "unknown"
MIN_PROBABILITY = 0.8
MIN_OVERLAP = 0.5
#: The corpus lines the unknown class is trained on, at most.
SAMPLE_LINES = 2000
#: What stands before and after a line's text in a comment.
_MARKS = r"(?m)^[ \t]*(?:/\*+|\*+/|\*+|//+!?|#+|--+|;+|%+|<!--|-->)?[ \t]*|[ \t]*(?:\*+/|-->)?[ \t]*$"
#: In joined lines, word pairs of a short template meet by chance: templates of fewer pairs than the first count only if nearly whole in
#: paragraphs of at most so many words, or with all their words in a row.
LONG_TEMPLATE, SHORT_PARAGRAPH, NEARLY_WHOLE = 12, 40, 0.75
SPDX = "spdx-license-identifier"
#: Public SPDX ids by family, and ids of licences that are none of these families.
SPDX_IDS = {
    "AGPL-3.0": "AGPL-1.0-only AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later",
    "Apache-2.0": "Apache-2.0",
    "BSD": "0BSD BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSD-4-Clause-UC",
    "CC-BY": "CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0",
    "CC-BY-NC": "CC-BY-NC-2.0 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0",
    "CC-BY-SA": "CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0",
    "CC0": "CC0-1.0",
    "GPL": "GPL-1.0-only GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later",
    "ISC": "ISC",
    "LGPL": "LGPL-2.0-only LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later",
    "MIT": "MIT MIT-0",
    "MPL-2.0": "MPL-2.0",
}
OTHER_IDS = "Apache-1.0 Apache-1.1 Artistic-2.0 BSL-1.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CDDL-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 MPL-1.0 MPL-1.1 NCSA OFL-1.1 OpenSSL PostgreSQL Python-2.0 Unlicense Zlib"
#: The beginnings of ids that confirm a family.
SPDX_STEMS = {
    "AGPL-3.0": "agpl", "Apache-2.0": "apache-2.0", "BSD": "bsd 0bsd", "CC-BY": "cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0", "CC-BY-NC": "cc-by-nc",
    "CC-BY-SA": "cc-by-sa", "CC0": "cc0", "GPL": "gpl", "ISC": "isc", "LGPL": "lgpl", "MIT": "mit", "MPL-2.0": "mpl-2.0",
}
_TOKEN = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
#: Words of notices that ordinary prose seldom has.
LICENCE_WORDS = (
    "licensed license licence licenses copyright spdx-license-identifier apache mit gnu gpl lgpl agpl affero lesser bsd bsd-style "
    "redistribution redistribute mozilla mpl-2.0 mpl creative commons cc cc0 by-nc by-sa attribution noncommercial attribution-noncommercial "
    "attribution-sharealike sharealike permission hereby granted isc waived"
).split()


def line_tokens(line: str) -> list[str]:
    return re.findall(_TOKEN, line.lower())


def id_grams(tokens: list[str]) -> set[str]:
    """The SPDX mark with each beginning, up to a hyphen, of the id behind it: what ids of a family share."""
    at = tokens.index(SPDX) + 1 if SPDX in tokens else len(tokens)
    parts = tokens[at].split("-") if at < len(tokens) else []
    return {f"{SPDX} {'-'.join(parts[: i + 1])}" for i in range(len(parts))}


def line_grams(tokens: list[str]) -> set[str]:
    """1- to 3-grams with a licence word, and an SPDX id's beginnings."""
    words = set(LICENCE_WORDS)
    runs = (tokens[i : i + n] for n in (1, 2, 3) for i in range(len(tokens) - n + 1))
    return {" ".join(r) for r in runs if words & set(r)} | id_grams(tokens)


@dataclass
class Model:
    grams: dict[str, int]
    families: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _altered(line: str, rng: np.random.Generator) -> list[str]:
    """A notice as it is met: whole, cut short, with words lost, or inside other words."""
    tokens = line_tokens(line)
    out = [tokens]
    for _ in range(12):
        kept = [t for t in tokens if rng.random() > 0.15]
        a, b = sorted(rng.integers(0, len(tokens) + 1, 2))
        filler = [f"w{rng.integers(1000)}" for _ in range(int(rng.integers(0, 12)))]
        out.append(filler + kept if rng.random() < 0.5 else kept + filler)
        if b - a >= max(3, len(tokens) // 2):
            out.append(tokens[a:b])
    return [" ".join(t) for t in out if t]


def _id_lines(ids: str, rng: np.random.Generator) -> list[str]:
    """Each id behind the mark: alone, beside other words, and as the first of two; ids that share no beginning with others twice as often."""
    every = " ".join([*SPDX_IDS.values(), OTHER_IDS]).split()
    filler = lambda: " ".join(f"w{rng.integers(1000)}" for _ in range(int(rng.integers(1, 8))))
    second = lambda: f"{rng.choice(['or', 'and'])} {rng.choice(every)}"
    out = []
    for i in ids.split():
        alone = sum(x.split("-")[0] == i.split("-")[0] for x in every) == 1
        for _ in range(4 if alone else 2):
            out += [f"{SPDX} {i}", f"{SPDX} {i} {filler()}", f"{filler()} {SPDX} {i}", f"{SPDX} {i} {second()}"]
    return out


def _probabilities(x: np.ndarray, w: np.ndarray, b: np.ndarray, t: float = 1.0) -> np.ndarray:
    z = (x @ w + b) / t
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(corpus_lines: list[str] = (), seed: int = 3) -> Model:
    """Full-batch gradient steps with shrinkage on a few thousand short lines; the temperature on every fourth line."""
    rng = np.random.default_rng(seed)
    families = [*sorted(NOTICES), UNKNOWN]
    lines = [(a, families.index(f)) for f, notices in sorted(NOTICES.items()) for n in notices for a in _altered(n, rng)]
    lines += [(a, families.index(f)) for f, ids in sorted(SPDX_IDS.items()) for a in _id_lines(ids, rng)]
    lines += [(a, len(families) - 1) for a in _id_lines(OTHER_IDS, rng)]
    lines += [(a, len(families) - 1) for n in OTHERS for a in _altered(n, rng)]
    lines += [(n, len(families) - 1) for n in corpus_lines]
    grams = [line_grams(line_tokens(line)) for line, _ in lines]
    counts: dict[str, int] = {}
    for g in grams:
        for x in g:
            counts[x] = counts.get(x, 0) + 1
    index = {g: i for i, g in enumerate(sorted(g for g, n in counts.items() if n >= 2))}
    x = np.zeros((len(lines), len(index)), np.float32)
    for i, g in enumerate(grams):
        x[i, [index[k] for k in g if k in index]] = 1
    y = np.array([k for _, k in lines])
    # a line whose features are all gone says nothing about its family
    y[x.sum(axis=1) == 0] = len(families) - 1
    hold = np.arange(len(y)) % 4 == 3
    target = np.eye(len(families), dtype=np.float32)[y]
    w, b = np.zeros((len(index), len(families)), np.float32), np.zeros(len(families), np.float32)
    size = 1 / np.bincount(y, minlength=len(families)).clip(1)
    each = (size[y] / size[y].mean())[:, None].astype(np.float32)

    def fit(rows: np.ndarray, steps: int = 400, rate: float = 2.0, shrink: float = 1e-4) -> None:
        for _ in range(steps):
            gap = each[rows] * (_probabilities(x[rows], w, b) - target[rows]) / len(rows)
            w[:] -= rate * (x[rows].T @ gap + shrink * w)
            b[:] -= rate * gap.sum(axis=0)

    fit(np.flatnonzero(~hold))
    at = np.flatnonzero(hold)
    loss = lambda t: -np.log(_probabilities(x[at], w, b, t)[np.arange(len(at)), y[at]] + 1e-9).mean()
    return Model(index, families, w, b, float(min(np.geomspace(0.2, 5, 33), key=loss)))


def gate() -> str:
    return r"(?i)(?<![a-z0-9])(?:" + "|".join(sorted(map(re.escape, LICENCE_WORDS), key=lambda x: (-len(x), x))) + r")(?![a-z0-9])"


def _tables(spark: SparkSession, model: Model) -> tuple[DataFrame, DataFrame]:
    """The weights (gram, family, weight) and the templates (family, pairs, phrase): constant, a few thousand rows."""
    rows = [(g, model.families[k], float(model.weights[i, k])) for g, i in model.grams.items() for k in range(len(model.families))]
    return spark.createDataFrame(rows, "gram string, family string, weight double"), spark.createDataFrame(templates(), "family string, pairs array<string>, phrase string")


def templates() -> list[tuple[str, list[str], str]]:
    """(family, word pairs, words) of each notice and of each beginning of an id."""
    texts = [(f, line_tokens(n)) for f, notices in NOTICES.items() for n in notices if SPDX not in n.lower()]
    texts += [(f, [SPDX, stem]) for f, stems in SPDX_STEMS.items() for stem in stems.split()]
    return [(f, sorted({" ".join(p) for p in zip(t, t[1:])}), " ".join(t)) for f, t in texts]


def _pairs(tokens: list[str]) -> set[str]:
    return {" ".join(p) for p in zip(tokens, tokens[1:])} | id_grams(tokens) or set(tokens)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", model: Model | None = None) -> DataFrame:
    """One row for each line or paragraph with a licence word: row, key, line (from 0; -1, -2, ... for paragraphs), text, family, probability, overlap, confirmed."""
    return _found(_gated(docs, text, key), key, model)


def _gated(docs: DataFrame, text: str, key: str) -> DataFrame:
    """row, key and the lines that pass the gate, for all rows: texts are read once, and only these lines go on."""
    lines = F.transform(F.split(text, "\n"), lambda t, i: F.struct(i.alias("line"), t.alias("text")))
    blocks = F.split(F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), _MARKS, ""), "\n\n+")
    wrapped = F.filter(blocks, lambda t: F.trim(t, F.lit("\n")).contains("\n") & t.rlike(gate()))
    wrapped = F.transform(wrapped, lambda t, i: F.struct((-1 - i).alias("line"), F.trim(F.translate(t, "\n", " ")).alias("text")))
    some = F.when(F.col(text).rlike(gate()), F.concat(F.filter(lines, lambda t: t["text"].rlike(gate())), wrapped))
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key), F.coalesce(some, F.array().cast("array<struct<line:int,text:string>>")).alias("lines"))
    return materialize(slim)  # row numbers are fixed from here on


def _found(gated: DataFrame, key: str, model: Model | None) -> DataFrame:
    spark = gated.sparkSession
    lines = gated.where(F.size("lines") > 0).select("row", key, F.explode("lines").alias("l")).select("row", key, "l.line", "l.text")
    if model is None:
        sample = lines.orderBy(F.xxhash64("text"), "row", "line").where("line >= 0").select("text").limit(SAMPLE_LINES).collect()
        known = [set(line_tokens(n)) for notices in NOTICES.values() for n in notices]
        strange = [r[0] for r in sample if all(len(k & set(line_tokens(r[0]))) < 0.5 * len(k) for k in known)]
        model = train(strange)
    weights, templates_ = _tables(spark, model)
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(_TOKEN), F.lit(0))
    lines = lines.withColumn("tokens", tokens)
    n = F.size("tokens")
    marked = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at("tokens", i).isin(*LICENCE_WORDS))
    run = lambda i, back, size: F.when((i > back) & (i - back + size - 1 <= n), F.array_join(F.slice("tokens", i - back, F.lit(size)), " "))
    around = lambda i: F.array(*(run(i, back, size) for size in (1, 2, 3) for back in range(size)))
    at = F.array_position("tokens", SPDX)
    parts = F.split(F.get("tokens", at.cast("int")), "-")  # the token behind the mark
    begun = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(F.lit(f"{SPDX} "), F.array_join(F.slice(parts, 1, i), "-")))
    ids = F.when((at > 0) & (at < n), begun).otherwise(F.array().cast("array<string>"))
    near = F.array_compact(F.array_distinct(F.concat(F.flatten(F.transform(marked, around)), ids)))
    grams = lines.where(n > 0).select("row", "line", F.explode(near).alias("gram"))
    scores = grams.join(F.broadcast(weights), "gram").groupBy("row", "line", "family").agg(F.sum("weight").alias("z"))
    bias = F.create_map(*(F.lit(x) for f, b in zip(model.families, model.bias.tolist()) for x in (f, b)))
    scores = scores.withColumn("z", (F.col("z") + F.element_at(bias, F.col("family"))) / model.temperature)
    place = F.create_map(*(F.lit(x) for i, f in enumerate(model.families) for x in (f, -i)))
    best = F.max(F.struct("z", F.element_at(place, F.col("family")).alias("tie"), "family")).alias("best")
    top = scores.groupBy("row", "line").agg(best, F.max("z").alias("m"), F.collect_list("z").alias("zs"))  # one z a family
    share = 1 / F.aggregate("zs", F.lit(0.0), lambda a, z: a + F.exp(z - F.col("m")))
    top = top.select("row", "line", F.col("best.family").alias("family"), share.alias("probability"))
    twos = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice("tokens", i, F.lit(2)), " "))
    lines = lines.join(top, ["row", "line"], "left").withColumn("pairs", F.when(n > 1, F.array_distinct(F.concat(twos, ids))).otherwise(F.col("tokens")))
    forms = templates_.groupBy("family").agg(F.collect_list(F.struct("pairs", "phrase")).alias("forms"))
    lines = lines.join(F.broadcast(forms), "family", "left").withColumn("shared", F.transform("forms", lambda p: F.size(F.array_intersect("pairs", p["pairs"])) / F.size(p["pairs"])))
    words = F.concat(F.lit(" "), F.array_join("tokens", " "), F.lit(" "))
    whole = lambda p, share: (F.size("tokens") <= SHORT_PARAGRAPH) & (share >= NEARLY_WHOLE) | F.contains(words, F.concat(F.lit(" "), p["phrase"], F.lit(" ")))
    fits = lambda p, share: F.when((F.col("line") >= 0) | (F.size(p["pairs"]) >= LONG_TEMPLATE) | whole(p, share), share)
    overlap = F.coalesce(F.array_max(F.zip_with("forms", "shared", fits)), F.lit(0.0))
    family = F.coalesce("family", F.lit(UNKNOWN))
    confirmed = (family != UNKNOWN) & (F.coalesce("probability", F.lit(0.0)) >= MIN_PROBABILITY) & (overlap >= MIN_OVERLAP)
    return lines.select("row", key, "line", "text", family.alias("family"), "probability", overlap.alias("overlap"), confirmed.alias("confirmed"))


def by_document(docs: DataFrame, text: str = "text", key: str = "doc_id", model: Model | None = None) -> DataFrame:
    """One row for each row of docs: key, n_candidates, n_confirmed, families (confirmed, distinct, sorted), best_probability."""
    gated = _gated(docs, text, key)
    found = _found(gated, key, model).groupBy("row").agg(
        F.count("*").alias("n_candidates"),
        F.count_if("confirmed").alias("n_confirmed"),
        F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"),
        F.max(F.when(F.col("confirmed"), F.col("probability"))).alias("best_probability"),
    )
    out = gated.select("row", key).join(found, "row", "left")
    zero = F.lit(0).cast("long")
    none = F.array().cast("array<string>")
    return out.select(key, F.coalesce("n_candidates", zero).alias("n_candidates"), F.coalesce("n_confirmed", zero).alias("n_confirmed"), F.coalesce("families", none).alias("families"), "best_probability")
