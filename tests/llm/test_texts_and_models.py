import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter
from functools import reduce
from operator import add
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import awkward, empty
from pyspark.sql import functions as F

import corpus_pipeline
from pelagia.llm import chat_format, license_scan, piece_sampling, pii, quality_model, queries, search, toxicity

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def test_pseudonyms_are_valid_linked_and_reach_all(spark):
    card, day, mail = "4111 1111 1111 1111", "2021-03-04", "jo.do@example.org"
    got = [r.text for r in pii.pseudonymize(docs(spark, f"pay {card} on {day}, {mail}", f"again {card}", "order 1234 5678 9012 3456 stays", f"{mail} 192.168.0.1 2021-13-45", "GB82 WEST 1234 5698 7654 32"), "k").orderBy("doc_id").collect()]
    new = re.search(r"\d{4} \d{4} \d{4} \d{4}", got[0])[0]
    assert new != card and luhn(new.replace(" ", "")) and got[1] == f"again {new}"
    assert got[2] == "order 1234 5678 9012 3456 stays"  # fails its check digit
    assert mail not in got[0] and got[0].split()[-1] == got[3].split()[0] and "192.168.0.1" not in got[3] and got[3].endswith("2021-13-45")
    iban = got[4].replace(" ", "")
    assert got[4] != "GB82 WEST 1234 5698 7654 32" and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert re.search(r"on (\d{4}-\d\d-\d\d),", got[0])[1] != day


def test_long_and_capital_credentials_go_whole(spark):
    """Secrets of any length, with keywords in any case; lengths stay, and nothing of them is left."""
    secret = lambda n: hashlib.sha512(str(n).encode()).hexdigest() * 8
    finds = [(f"{word}{secret(n)[:n]}", n) for word in ("token=", "PASSWORD=", "API_KEY: ", "Token: ") for n in (12, 128, 129, 200, 1000)]
    finds += [(f"sk-{secret(n)[:n]}", n) for n in (64, 65, 200, 1000)] + [("sk-proj-" + "aB3_x-9" * 12, 84)]
    got = [r.text for r in pii.pseudonymize(docs(spark, *(f"so {x} end" for x, _ in finds)), "k").orderBy("doc_id").collect()]
    for (x, n), text in zip(finds, got):
        assert len(text) == len(x) + 7 and text.startswith("so " + x[:3]) and text.endswith(" end")
        assert not any(x[-n:][i : i + 12] in text for i in range(n - 11))


def test_feistel_is_a_permutation(spark):
    pairs = spark.range(35).select(F.floor(F.col("id") / 5).alias("l"), (F.col("id") % 5).alias("r"))
    out = pairs.select(pii.feistel("t", F.col("l"), F.col("r"), F.lit(7), F.lit(5), "k").alias("m")).collect()
    assert {(r.m.l, r.m.r) for r in out} == {(a, b) for a in range(7) for b in range(5)}


def test_pseudonyms_on_awkward_and_empty(spark):
    clash = awkward(spark).withColumn("pattern", F.lit(1))
    got = pii.pseudonymize(clash, "k")
    assert got.columns == clash.columns + ["pii"] and got.exceptAll(got.withColumn("text", F.col("text"))).count() == 0
    assert sorted(map(str, (r.text for r in got.collect()))) == sorted(map(str, (r.text for r in clash.collect())))
    assert pii.pseudonymize(empty(spark), "k").count() == 0


def held_out(spark, query, label):
    labels = spark.read.parquet(f"{SF2}/labels.parquet").groupBy("doc_id").agg(F.max(label).alias("y"))
    got = query(spark, SF2).where("held_out").join(labels, "doc_id").select("y", "score", "predicted").toPandas().dropna()
    pos, neg = got[got["y"] == 1]["score"].to_numpy(), got[got["y"] == 0]["score"].to_numpy()
    auc = ((pos[:, None] > neg[None, :]).mean() + (pos[:, None] == neg[None, :]).mean() / 2)
    return auc, (got["y"] == got["predicted"]).mean()


def test_toxicity_on_labels_not_learned_from(spark):
    auc, right = held_out(spark, queries.op2_toxicity, "toxic")
    assert auc > 0.95 and right > 0.95


def test_quality_on_labels_not_learned_from(spark):
    auc, right = held_out(spark, queries.op8_quality_model, "quality")
    assert auc > 0.9 and right > 0.8


def test_models_on_awkward_and_empty(spark):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (7, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for d, n in ((awkward(spark), 10), (empty(spark), 0)):
        for known in (labels, labels.limit(0)):
            scores = [r.score for r in toxicity.score(d, toxicity.fit(d, known)).collect()]
            scores += [r.score for r in quality_model.score(d, *quality_model.fit(d.select("doc_id", "text"), known)).collect()]
            assert len(scores) == 2 * n and all(0 <= s <= 1 for s in scores)


def brute_search(texts, k=10):
    toks = {i: Counter(re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))) for i, t in texts.items()}
    df, n = Counter(w for c in toks.values() for w in c), len(texts)
    size = {i: sum(c.values()) for i, c in toks.items()}
    mean = max(1.0, sum(size.values()) / n)
    out = {}
    for q in (i for i in texts if i % 20 == 0):
        scores = {}
        for d, c in toks.items():
            s = sum(
                tf * math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * size[d] / mean))
                for w, tf in toks[q].items() if w in c and df[w] > 1
            )
            if s > 0 and d != q:
                scores[d] = s
        out[q] = sorted(scores.values(), reverse=True)[:k]
    return out


def test_search_against_brute_force(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where(F.col("text").isNotNull())
    texts = {r.doc_id: r.text for r in d.collect()}
    got = search.search(search.build_index(d, shards=3), d.where("doc_id % 20 = 0"), terms=1 << 30).orderBy("query", "rank").collect()
    want = brute_search(texts)
    for q, scores in want.items():
        assert [r.score for r in got if r.query == q] == pytest.approx(scores)


def test_search_as_the_query_runs_it_against_brute_force(spark):
    """At the query's own settings: texts of more than a hundred terms are searched with all of them."""
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where(F.col("text").isNotNull())
    texts = {r.doc_id: r.text for r in d.collect()}
    got = queries.op4_block_max_search(spark, SF).orderBy("query", "rank").collect()
    for q, scores in brute_search(texts).items():
        assert [r.score for r in got if r.query == q] == pytest.approx(scores)


def test_search_holds_one_segment_and_one_block_of_queries(spark, monkeypatch):
    """However often a term comes, a row of the index has a segment's postings, and queries go in blocks with the same results."""
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("sea "), F.repeat(F.concat(F.lit("w"), F.col("id") % 50, F.lit(" ")), 1500)).alias("text"))
    index = search.build_index(d, shards=1)
    assert index.agg(F.max(F.octet_length("docs") / 4)).first()[0] < 3000 and index.count() > 2
    asked = d.where("doc_id % 100 = 0")
    want = search.search(index, asked).orderBy("query", "rank").collect()
    monkeypatch.setattr(search, "QUERY_BLOCK", 7)
    assert want and search.search(index, asked).orderBy("query", "rank").collect() == want


def test_search_walks_a_segment_for_many_queries_at_once(spark, monkeypatch):
    """A segment is walked for a hundred queries in one pass; however they are cut, and however few documents are told apart, the best stay the same."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where(F.col("text").isNotNull())
    texts = {r.doc_id: r.text for r in rows.collect()}
    packed = search._segments(iter(pa.Table.from_pylist([{"doc_id": i, "text": t} for i, t in sorted(texts.items())], pa.schema([("doc_id", pa.int64()), ("text", pa.string())])).to_batches()))
    index = pa.Table.from_batches(list(packed))
    asked = pa.table({"doc_id": pa.array(sorted(texts)), "text": pa.array([texts[i] for i in sorted(texts)], pa.string())})
    terms = pa.Table.from_batches(list(search._query_terms(iter(asked.to_batches()))))
    query, term, tf = (terms.column(c).to_numpy() for c in ("query", "term", "tf"))
    _, code, df = np.unique(term, return_inverse=True, return_counts=True)
    n, mean = len(texts), sum(index.column("total").to_pylist()) / len(texts)
    weight = tf * np.log1p((n - df[code] + 0.5) / (df[code] + 0.5))
    sent = SimpleNamespace(value=search._Queries(query, term, weight, df[code] > search.COMMON * n))
    walks, walk = [], search._walk
    monkeypatch.setattr(search, "_walk", lambda *a: walks.append(a[3] - a[2]) or walk(*a))

    def run():
        walks.clear()
        out = pa.Table.from_batches(list(search._search_task(iter(index.select(list(search._PACKED)).to_batches()), sent, mean, 10, True)))
        return sorted(zip(*(out.column(c).to_pylist() for c in out.column_names)))

    got = run()
    assert max(walks) > 100
    best = {}
    for q, d, s in got:
        best.setdefault(q, {})[d] = s
    for q, scores in brute_search(texts).items():
        assert sorted(best.get(q, {}).values(), reverse=True) == pytest.approx(scores)
    for name, value in (("_TOGETHER", 1), ("_CELLS", 1), ("_MANY", 0), ("_MANY", 1 << 30)):
        with monkeypatch.context() as m:
            m.setattr(search, name, value)
            assert run() == got


def two_languages(n):
    draw = random.Random(7)
    words = [[f"{c}{i}" for i in range(400)] for c in "ab"]
    texts = {i: " ".join(draw.choices(words[i % 2], range(400, 0, -1), k=60)) + " 7" for i in range(n)}
    return texts | {n - 1: texts[0], n - 2: texts[0]}


def test_search_leaves_segments_of_other_languages(monkeypatch):
    """Texts of a task are dealt to segments by kind, and a query whose k-th score is known scores nothing where another language is."""
    texts = two_languages(1200)
    index = pa.Table.from_batches(list(search._segments(iter(pa.table({"doc_id": sorted(texts), "text": [texts[i] for i in sorted(texts)]}).to_batches()))))
    tongue = {i: t[0] for i, t in texts.items()}
    held = [{tongue[i] for i in np.frombuffer(x.as_py(), "<i8").tolist()} for x in index.column("ids")]
    assert sorted(held, key=min) == [{"a"}, {"b"}]
    asked = pa.table({"doc_id": [i for i in texts if i % 20 == 0 or i % 20 == 5], "text": [t for i, t in texts.items() if i % 20 == 0 or i % 20 == 5]})
    query, term, tf = (pa.Table.from_batches(list(search._query_terms(iter(asked.to_batches())))).column(c).to_numpy() for c in ("query", "term", "tf"))
    df = Counter()
    for names, counts in zip(index.column("terms"), index.column("counts")):
        df.update(dict(zip(np.frombuffer(names.as_py(), "<i8").tolist(), np.frombuffer(counts.as_py(), "<i4").tolist())))
    df = np.array([df[t] for t in term.tolist()])
    weight, mean = tf * np.log1p((1200 - df + 0.5) / (df + 0.5)), sum(index.column("total").to_pylist()) / 1200
    sent = SimpleNamespace(value=search._Queries(query, term, weight, df > search.COMMON * 1200))
    scored, score = [], search._scored
    monkeypatch.setattr(search, "_scored", lambda *a: scored.append((len(a[1]), tongue[int(a[0].ids[0])])) or score(*a))

    def run(begin):
        scored.clear()
        out = pa.Table.from_batches(list(search._search_task(iter(index.select(list(search._PACKED)).to_batches()), sent, mean, 10, True, begin))).to_pylist()
        return {q: sorted((r["score"] for r in out if r["query"] == q), reverse=True) for q in {r["query"] for r in out}}, sum(n for n, _ in scored)

    plain, all_of = run(None)
    got, few = run(np.array([plain[q][-1] for q in sent.value.ids.tolist()]))
    assert got == plain and few == len(asked) < all_of
    for q, scores in brute_search(texts).items():
        assert got[q] == pytest.approx(scores)


def test_search_segments_of_short_texts_have_bounded_rows():
    ids, batches = [], pa.table({"doc_id": range(50_000), "text": [f"w{i % 9}" if i % 7 else "" for i in range(50_000)]}).to_batches(max_chunksize=10_000)
    for segment in search._segments(iter(batches)):
        assert segment.column("n")[0].as_py() <= 4096
        ids += np.frombuffer(segment.column("ids")[0].as_py(), "<i8").tolist()
    assert sorted(ids) == list(range(50_000))


def test_search_begins_with_a_few_segments(spark, monkeypatch):
    """What a few segments give bounds the rest; results stay the same, and equal texts go by id wherever they lie."""
    texts = two_languages(1200)
    d = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    index = search.build_index(d.repartition(40, "doc_id"))
    assert index.count() >= 2 * search._LEAD
    reached, called = search._reached, []
    monkeypatch.setattr(search, "_reached", lambda *a: called.append(1) or reached(*a))
    run = lambda: search.search(index, d.where("doc_id % 20 = 0")).orderBy("query", "rank").collect()
    got = run()
    assert called
    monkeypatch.setattr(search, "_LEAD", 1000)
    assert run() == got and len(called) == 1
    for q, scores in brute_search(texts).items():
        assert [r.score for r in got if r.query == q] == pytest.approx(scores)
    assert [r.doc_id for r in got if r.query == 0][:2] == [1198, 1199]


def test_search_reads_a_file_of_segments_one_by_one(spark, monkeypatch):
    """A task's segments lie in one file, but neither Parquet's reader nor Python gets several large ones at once."""
    d = spark.range(0, 2400, 1, 1).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(1500)), lambda i: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", i), F.lit(60_000)))), " ").alias("text"))
    index = search.build_index(d)
    metas = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in index.inputFiles()]
    groups = [m.row_group(i) for m in metas for i in range(m.num_row_groups)]
    largest = index.agg(F.max(reduce(add, (F.octet_length(c) for c in search._PACKED)))).first()[0]
    assert index.count() >= 3 and max(g.total_byte_size for g in groups) < 1.5 * largest

    name, set_to, true = "spark.sql.execution.arrow.maxRecordsPerBatch", [], search.materialize
    before = spark.conf.get(name)
    monkeypatch.setattr(search, "materialize", lambda df, *a, **b: set_to.append((spark.conf.get(name), df.columns)) or true(df, *a, **b))
    assert search.search(index, d.where("doc_id % 800 = 0")).count() == 30
    assert spark.conf.get(name) == before and {n for n, c in set_to if "score" in c} == {"1"} and {n for n, c in set_to if "score" not in c} == {before}


def test_search_sums_bounded_postings_at_once(monkeypatch):
    """Long queries side by side are summed in pieces: memory follows one query, not all of them, and sums stay the same."""
    draw, terms, blocks = np.random.default_rng(3), 1500, 16
    docs = np.tile(np.arange(0, 64 * blocks, 64), terms)
    seg = SimpleNamespace(ids=np.arange(64 * blocks), n_blocks=blocks, first=np.arange(terms + 1) * blocks, block=docs // 64, most=draw.random(terms * blocks), counts=np.full(terms, blocks), postings=np.arange(terms) * blocks, docs=docs, part=draw.random(terms * blocks))
    n = 250
    who, term, weight = np.repeat(np.arange(n), terms), np.tile(np.arange(terms), n), draw.random(n * terms)

    def run():
        return search._rare_bounds(seg, who, term, weight, n), search._sums(seg, who, term, weight, n, None)

    tracemalloc.start()
    got, _ = run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    assert got == pytest.approx(weight.reshape(n, terms) @ seg.most.reshape(terms, blocks))
    few = run()
    monkeypatch.setattr(search, "_POSTINGS", 1)
    assert all((a == b).all() for a, b in zip(few, run()))


def test_search_on_awkward_and_empty(spark):
    d = awkward(spark)
    got = search.search(search.build_index(d), d).collect()
    assert {(r.query, r.doc_id) for r in got} == {(7, 8), (8, 7)}
    assert search.search(search.build_index(empty(spark)), d).count() == 0


def test_pieces_decode_to_their_texts(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(awkward(spark).where("doc_id <> 7").select((F.col("doc_id") + 10**6).alias("doc_id"), "text"))
    enc = piece_sampling.encode(d, queries.PIECE_MODEL, k=3)
    texts = {r.doc_id: r.text or "" for r in d.collect()}
    assert all(r.text == texts[r.doc_id] for r in piece_sampling.decode(enc, queries.PIECE_MODEL).collect())
    rows = enc.collect()
    assert len({(r.doc_id, tuple(r.ids)) for r in rows}) == len(rows) and {r.doc_id for r in rows} == set(texts)
    assert all(r.log_inclusion <= 0 for r in rows)
    again = piece_sampling.encode(d.repartition(3), queries.PIECE_MODEL, k=3).collect()
    assert sorted((r.doc_id, r.sample, r.ids) for r in rows) == sorted((r.doc_id, r.sample, r.ids) for r in again)
    assert piece_sampling.encode(empty(spark), queries.PIECE_MODEL).count() == 0


def test_draws_follow_the_lattice(spark):
    """First draws of many rows with one text come as often as their probabilities say."""
    d = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("sea").alias("text"))
    rows = piece_sampling.encode(d, queries.PIECE_MODEL, k=1).collect()
    seen, prob = Counter(tuple(r.ids) for r in rows), {tuple(r.ids): math.exp(r.log_prob) for r in rows}
    assert all(abs(n / 4000 - prob[p]) < 0.03 for p, n in seen.items())


def test_chat_digests_against_brute_force(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    said = "</s>[INST] ok [/INST]"
    convs = {-7: [(0, "user", said), (1, "assistant", said)]}
    for r in turns:
        convs.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    got = {r.conv_id: r for r in queries.op9_chat_format(spark, SF).collect()}
    assert got.keys() == convs.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, ts in convs.items():
        ts = sorted(ts)
        loss = "".join(t for _, r, t in ts if r == "assistant")
        want = (len(ts), sha("".join(f"{r}\n{t}\n" for _, r, t in ts)), len(loss), sha(loss))
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == want


def test_chat_escapes_awkward_turns(spark):
    texts = ["<s>", "<\\s>", "<\\\\s>[INST]", "[/INST]", "<<SYS>>x<</SYS>>", None, "", "long " * 3000]
    turns = [(None, i % 3, None if i == 3 else "assistant", t) for i, t in enumerate(texts)] + [(1, None, "system", "s"), (1, None, "system", "s")]
    w = chat_format.windows(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"))
    got = {r.conv_id: r for r in chat_format.digests(w).collect()}
    loss = sum(len(t or "") for _, _, r, t in turns if r == "assistant")
    assert got[None].n_turns == 8 and got[None].loss_chars == loss and got[1].n_turns == 2
    assert chat_format.windows(w.sparkSession.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0


def test_licences(spark):
    got = license_scan.by_document(docs(spark, "Intro line\nReleased under the MIT License.", "The harbour was quiet at night.", "Students of MIT built a bridge.", "SPDX-License-Identifier: Apache-2.0\nLicensed under CC BY-SA 4.0.")).orderBy("doc_id").collect()
    assert [r.families for r in got] == [["MIT"], [], [], ["Apache-2.0", "CC-BY-SA"]]
    assert license_scan.by_document(awkward(spark)).count() == 10 and license_scan.by_document(empty(spark)).count() == 0


def test_wrapped_licences_and_spdx_ids(spark):
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software."
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    gpl = "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version."
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."
    block = lambda t: "/*\n * " + t.replace("\n", "\n * ") + "\n */\nint x;"
    texts, want = [], []
    for t, family in ((grant, "MIT"), (bsd, "BSD"), (gpl, "GPL"), (isc, "ISC")):
        texts += [f"Some title\n\n{t}\n\nmore", "# " + t.replace("\n", "\n# "), block(t)]
        want += [[family]] * 3
    for name, family in (("GPL-2.0-only", "GPL"), ("BSD-2-Clause", "BSD"), ("LGPL-3.0-only", "LGPL"), ("AGPL-3.0-only", "AGPL-3.0"), ("CC-BY-SA-3.0", "CC-BY-SA"), ("MIT", "MIT")):
        texts.append(f"// SPDX-License-Identifier: {name}\nint x;")
        want.append([family])
    texts.append("Released under the\nMIT License.")
    want.append(["MIT"])
    texts.append("The harbour master was licensed under the old rules.\nStudents of MIT walked by\nand the day was long.")
    want.append([])
    got = license_scan.by_document(docs(spark, *texts)).orderBy("doc_id").collect()
    assert [r.families for r in got] == want


def test_quality_rules_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(queries.oracle_sql()["op3_quality_rules"]).df()
    got = queries.op3_quality_rules(spark, SF).toPandas()[list(want.columns)]
    assert np.array_equal(got.sort_values("doc_id").to_numpy(), want.sort_values("doc_id").to_numpy())


def test_pipeline_runs_and_takes_empty_tables(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.where("ids is null").count() == 0
    d = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        d = stage(spark, d, SF)
        assert d.count() == 0
