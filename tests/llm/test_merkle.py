"""The manifest against a tree built in plain Python."""

import hashlib
import random
import zlib

import pytest
from helpers import awkward, empty
from pyspark.sql import functions as F

from pelagia.llm import merkle
from pelagia.llm.queries import op11_merkle_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    out = []
    for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]):
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h(*out)


def climb(nodes):
    """The root of a list of digests, and for each its steps: siblings before, siblings after."""
    steps, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            run = at // 16 * 16
            steps[i].append((nodes[run:at], nodes[at + 1 : run + 16]))
            where[i] = at // 16
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], steps


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s, members in groups.items():
        members.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[s] = climb([leaf_of(r) for r in members])
    root, top = climb([trees[s][0] for s in order])
    out = []
    for s, members in groups.items():
        for r, inner in zip(members, trees[s][1], strict=True):
            path = inner + top[order.index(s)]
            bad = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                bad["text"] = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])
            now = leaf_of(bad)
            for before, after in path:
                now = h(*before, now, *after)
            proof = h(*(x for before, after in path for x in (*before, *after)))
            out.append((r["doc_id"], leaf_of(r), trees[s][0], root, proof, now, now == root))
    return sorted(out, key=str)


KIND = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(sizes, seed=0):
    r, out = random.Random(seed), []
    for source, n in sizes.items():
        for i in range(n):
            text = None if r.random() < 0.05 else r.choice(["", "Abc é", "UPPER", "lower only", "日本 X"])
            out.append((len(out) * 7 if r.random() > 0.02 else None, text, r.choice(["en", None]), source, r.choice([3, None])))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {None: 1, "b": 16}, {"a": 17, "Z": 256, "é": 257, None: 15, "": 2}, {"hot": 4500, "b": 1, "c": 3}, {f"s{i}": 1 + i % 3 for i in range(300)},
])
def test_equals_a_plain_tree(spark, tmp_path, sizes):
    data = rows_of(sizes)
    spark.createDataFrame(data, KIND).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in op11_merkle_manifest(spark, str(tmp_path)).collect()), key=str)
    want = plain([dict(zip(["doc_id", "text", "lang", "source", "n_chars"], d, strict=True)) for d in data])
    assert got == want
    assert any(not r[-1] for r in want) or sum(sizes.values()) < 20


def test_repeated_null_awkward_and_empty_rows(spark):
    docs = awkward(spark).unionByName(awkward(spark)).withColumn("grp", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("hash", F.lit(3))
    got = merkle.manifest(docs).collect()
    assert len(got) == 20 and all(r.verified for r in got) and len({r.root for r in got}) == 1
    none = merkle.manifest(empty(spark))
    assert none.count() == 0 and none.columns == merkle.manifest(docs).columns
    lost = merkle.manifest(docs, F.when(F.col("doc_id") == 4, F.sha2(F.lit("other"), 256))).collect()
    assert {r.doc_id for r in lost if not r.verified} == {4}


def test_rows_alike_by_the_hundred_are_dealt_out(spark):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    got = merkle.manifest(docs).collect()
    assert len(got) == 3000 and all(r.verified for r in got)
    assert sorted(tuple(r) for r in got) != [tuple(got[0])] * 3000
