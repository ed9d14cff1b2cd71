"""Repeated passages against every pair of windows, in plain Python."""

import random

import numpy as np
import pytest
from helpers import AWKWARD, awkward, empty
from pyspark.sql import functions as F

from pelagia.llm import substring_dedup
from pelagia.llm.queries import op12_substring_dedup

SPACES = " \t\n\v\f\r"


def words(text):
    out, now = [], ""
    for ch in text or "":
        if ch in SPACES:
            if now:
                out.append(now)
            now = ""
        else:
            now += ch
    return out + [now] if now else out


def plain(docs, length):
    """doc_id, text -> (words, removed, kept text), by the earliest start of every window."""
    earliest = {}
    order = lambda i: (i is not None, i or 0)
    for i, text in docs:
        w = words(text)
        for s in range(len(w) - length + 1):
            key, at = tuple(w[s : s + length]), (order(i), s)
            earliest[key] = min(earliest.get(key, at), at)
    out = []
    for i, text in docs:
        w = words(text)
        gone = set()
        for s in range(len(w) - length + 1):
            if earliest[tuple(w[s : s + length])] < (order(i), s):
                gone |= set(range(s, s + length))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def random_docs(seed, length):
    """Texts of few words, so that repeats of every length, place and overlap happen by chance, and passages put in by hand."""
    r = random.Random(seed)
    passages = [[r.choice("abcdefgh") for _ in range(r.randrange(length, 4 * length))] for _ in range(4)]
    docs = []
    for i in range(60):
        w = []
        for _ in range(r.randrange(0, 6)):
            if r.random() < 0.5:
                w += r.choice(passages)[r.randrange(0, 3) :]
            else:
                w += [r.choice(["a", "b", "é日", "😀x", "c-%d" % r.randrange(40)]) for _ in range(r.randrange(1, 2 * length))]
        docs.append((None if i % 17 == 3 else i // 2 * 2 if i % 11 == 0 else i, r.choice([" ", "\n", " \t "]).join(w)))
    docs += [(100, "z " * 90), (101, "z " * 45 + "y"), (102, "x y " * 40), (103, docs[7][1]), (103, docs[7][1]), (3, None), (4, ""), (5, " \n ")]
    return docs


@pytest.mark.parametrize(("seed", "length", "width"), [(1, 20, 8), (2, 20, 8), (3, 6, 3), (4, 5, 5), (5, 9, 1)])
def test_equals_all_windows(spark, seed, length, width):
    docs = random_docs(seed, length)
    got = substring_dedup.remove(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), length, width)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=str)
    assert got == plain(docs, length)


def test_repeats_are_maximal_and_point_to_the_earliest(spark):
    body = [f"w{i}" for i in range(200)]
    docs = [(1, " ".join(body)), (2, " ".join(["new"] * 3 + body[10:90] + ["end"] * 2 + body[100:140])), (3, " ".join(body[:19]))]
    got = {r.doc_id: r.repeats for r in substring_dedup.remove(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [tuple(x) for x in got[2]] == [(3, 83, 1, 10), (85, 125, 1, 100)]
    assert got[1] == [] and got[3] == []


def test_maximal_merges_along_one_diagonal_only():
    start, end = np.array([0, 5, 30, 3]), np.array([20, 25, 50, 23])
    source, at = np.array([7, 7, 7, 8]), np.array([100, 105, 130, 3])
    assert substring_dedup.maximal(start, end, source, at).tolist() == [[0, 25, 7, 100], [30, 50, 7, 130], [3, 23, 8, 3]]
    assert len(substring_dedup.maximal(*(np.zeros(0, np.int64),) * 4)) == 0


def test_hot_passage_is_dealt_out_and_whole(spark):
    """One passage in a third of all documents, with other words around it: over the bar of a hot key."""
    line = " ".join(f"p{i}" for i in range(30))
    docs = [(i, f"a{i} b{i} {line} c{i} d{i}" if i % 3 == 0 else " ".join(f"u{i}_{k}" for k in range(34))) for i in range(4500)]
    got = {r.doc_id: r for r in substring_dedup.remove(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0].n_removed == 0
    assert all(got[i].kept_text == f"a{i} b{i} c{i} d{i}" for i in range(3, 4500, 3))
    assert sum(r.n_removed for r in got.values()) == 30 * 1499


def test_awkward_rows_and_clashing_columns(spark):
    docs = awkward(spark).withColumn("mark", F.lit("m")).withColumn("n_words", F.lit("own")).withColumn("row", F.lit(1)).withColumn("first", F.lit(2)).withColumn("__mark", F.lit(3))
    got = substring_dedup.remove(docs)
    assert got.columns == [*docs.columns, "n_removed", "kept_text", "repeats"]
    rows = got.collect()
    assert len(rows) == 10 and {r.n_words for r in rows} == {"own"}
    assert {r.doc_id: r.n_removed for r in rows}[6] == 2999
    assert {r.doc_id: r.kept_text for r in rows}[9] == AWKWARD[-1][1]
    assert substring_dedup.remove(empty(spark)).count() == 0


def test_query_over_a_whole_table(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = sorted(((i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in plain(docs, 20)), key=str)
    assert sorted((tuple(r) for r in op12_substring_dedup(spark, sf).collect()), key=str) == want
