import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOCS, awkward, empty
from pyspark.sql import functions as F

import corpus_pipeline
from pelagia.llm import near_dedup
from pelagia.llm.arrays import shingles, text_blocks
from pelagia.llm.components import connected_components


def brute(docs, percent=85):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed, n=220):
    """Texts with exact copies, light and heavy edits, chains of edits, and a shared passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = [word() for _ in range(60)]
    docs, texts = [], []
    for i in range(n):
        kind = rng.random()
        if not texts or kind < 0.35:
            t = [word() for _ in range(rng.choice([3, 8, 20, 80, 200]))]
            if rng.random() < 0.3:
                t += passage
        else:
            t = list(rng.choice(texts[-30:]))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
                t[rng.randrange(len(t))] = word()
            if rng.random() < 0.2:
                t = [x.upper() for x in t]
        texts.append(t)
        docs.append((i, " ".join(t)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    docs = corpus(seed)
    got = near_dedup.assign(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_short_texts_with_one_edit_link(spark):
    """Many pairs of 13 to 60 shingles, each a text and a copy with an edit near the threshold, inside and at the end."""
    rng = random.Random(11)
    docs = []
    for i in range(1500):
        t = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(17, 64))]
        copy = list(t)
        copy[rng.choice([-1, -1, 0, -2, rng.randrange(len(t))])] = "edited"
        docs += [(2 * i, " ".join(t)), (2 * i + 1, " ".join(copy))]
    got = {r.doc_id: r.component_id for r in near_dedup.assign(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = {}
    for i in range(1500):
        want |= {k: c for k, (_, c) in brute(docs[2 * i : 2 * i + 2]).items()}
    assert sum(want[2 * i + 1] == 2 * i for i in range(1500)) > 700
    assert got == want


def test_pipeline_stage_at_80_against_brute_force(spark):
    """Short and long copies with edits around 0.8: the stage's threshold, not the query's."""
    rng = random.Random(4)
    docs = []
    for i in range(60):
        t = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([24, 60, 150, 300, 600]))]
        copy = list(t)
        for k in range(max(1, round(len(t) * rng.choice([0.018, 0.02, 0.022, 0.024])))):
            copy[rng.randrange(len(t))] = f"edit{k}"
        docs += [(2 * i, " ".join(t)), (2 * i + 1, " ".join(copy))]
    want = {k for i in range(60) for k, (_, c) in brute(docs[2 * i : 2 * i + 2], 80).items() if k == c}
    at_85 = {k for i in range(60) for k, (_, c) in brute(docs[2 * i : 2 * i + 2], 85).items() if k == c}
    got = corpus_pipeline.dedup(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert want != at_85 and {r.doc_id for r in got.collect()} == want


def test_large_group_of_near_copies(spark):
    """No member is near enough to the smallest one, yet neighbours link: rounds across components must find them."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    docs = []
    for i in range(120):
        if i % 6 == 0:
            base = list(base)
            base[rng.randrange(150)] = f"n{i}"
        t = list(base)
        t[rng.randrange(150)] = f"m{i}"
        docs.append((i, " ".join(t)))
    got = near_dedup.assign(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(docs)


def test_tiles_split_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", 8)
    docs = corpus(3, 120)
    got = near_dedup.assign(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(docs)


def test_estimate_follows_jaccard():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2)
    for share in (0.3, 0.6, 0.9):
        est = []
        for _ in range(30):
            rng.shuffle(pool)
            k = int(1000 * 2 * share / (1 + share))
            a, b = np.sort(pool[:1000]), np.sort(np.concatenate([pool[:k], pool[1000 : 2000 - k]]))
            r = near_dedup.registers(np.concatenate([a, b]), np.array([0, 1000, 2000]))
            est.append(near_dedup.estimate(r[0], r[1], np.int64(1000), np.int64(1000)))
        assert np.mean(est) == pytest.approx(share, abs=0.03)


def test_chance_matches_are_as_many_as_expected():
    """Unrelated sets: registers agree as often as the table says, whatever their sizes."""
    rng = np.random.default_rng(3)
    for n, m in ((2000, 2000), (300, 4000)):
        same = []
        for _ in range(400):
            a, b = (np.sort(rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, k, dtype=np.uint64)) for k in (n, m))
            r = near_dedup.registers(np.concatenate([a, b]), np.array([0, n, n + m]))
            same.append(((r[0] == r[1]) & (r[0] > 0)).mean())
        i, j = (round(near_dedup._STEPS * np.log2(k)) for k in (n, m))
        assert np.mean(same) == pytest.approx(near_dedup._CHANCE[i, j], rel=0.5, abs=5e-5)


def test_shingles_ignore_blocks():
    texts = pa.array(["a b c d e f", None, "", "A b", "a\tb\x0bc d e", "x" * 50 + " é ñ a b c d"])
    whole = [shingles(d, o) for _, _, d, o in text_blocks(texts)]
    small = [shingles(d, o) for _, _, d, o in text_blocks(texts, 5)]
    assert np.array_equal(np.concatenate([h for h, _ in whole]), np.concatenate([h for h, _ in small]))
    assert np.diff(whole[0][1]).tolist() == [2, 0, 0, 1, 1, 3]  # the last has seven words


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_an_id_with_several_texts_links_by_each(spark):
    """Ids that come twice are one document with the links of both texts; blank rows of theirs link with nothing."""
    rng = random.Random(6)
    base = [[f"{c}{i}" for i in range(60)] for c in "pqrs"]
    near = lambda t: " ".join([*t[:59], f"e{rng.randrange(10**6)}"])
    docs = [(9, near(base[0])), (9, near(base[1])), (3, near(base[0])), (4, near(base[1])), (5, near(base[2])), (5, ""), (6, near(base[2])), (7, near(base[3])), (8, "alone"), (8, "alone")]
    docs += [(100 + i, near([f"z{i}_{j}" for j in range(60)])) for i in range(40)]
    got = sorted((r.doc_id, r.n_shingles > 0, r.component_id) for r in near_dedup.assign(spark.createDataFrame(docs, "doc_id long, text string")).collect() if r.doc_id < 100)
    assert got == sorted([(9, True, 3), (9, True, 3), (3, True, 3), (4, True, 3), (5, True, 5), (5, False, 5), (6, True, 5), (7, True, 7), (8, True, 8), (8, True, 8)])
    kept = near_dedup.keep(spark.createDataFrame(docs, "doc_id long, text string")).where("doc_id < 100")
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 5, 7, 8]


def test_awkward_and_empty(spark):
    got = near_dedup.assign(awkward(spark))
    assert got.count() == 10
    by = {r.doc_id: r for r in got.collect()}
    assert by[8].component_id == 7 and by[1].n_shingles == by[3].n_shingles == 0 and by[1].kept and by[4].n_shingles == 1
    kept = near_dedup.keep(awkward(spark).withColumn("n", F.lit(0)))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 7, 9]
    assert near_dedup.assign(empty(spark)).count() == 0 and near_dedup.keep(empty(spark)).columns == [c.split()[0] for c in DOCS.split(", ")]


def test_null_ids_come_last_and_are_told_apart(spark):
    same, other = "one text of seven words for all here", "another text that nothing else is like at all"
    docs = spark.createDataFrame([(None, same, 1), (None, same, 2), (None, other, 3), (None, None, 4), (1, same, 5), (2, same, 6), (None, other, 7)], "doc_id long, text string, n long")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.assign(docs).collect()), key=str)
    assert got == sorted([(None, 1, False), (None, 1, False), (None, None, True), (None, None, False), (None, None, True), (1, 1, True), (2, 1, False)], key=str)
    kept = sorted(r.n for r in near_dedup.keep(docs).collect())
    assert kept[0:1] + kept[-1:] in ([3, 5], [4, 7], [3, 7], [4, 5]) and len(kept) == 3 and 5 in kept and 4 in kept
