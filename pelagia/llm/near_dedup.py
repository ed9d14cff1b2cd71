"""Near-duplicate documents with HyperMinHash sketches, banding and exact confirmation.

A text's set is its distinct five-word shingles (A-Z lower-cased). Equal sets become one class first, so a hot
group of copies is one row afterwards. Each class has a HyperMinHash sketch: for every bucket of its hashes the
leading-zero count and ten mantissa bits of the smallest one. Sets of SHORT shingles and more are proposed by bands over the
registers (empty ones filled from the next full one); pairs with a smaller set are proposed exactly, by a prefix filter: of
any pair that reaches the threshold, the first floor((1 - threshold) * n) + 1 shingles of each in one order of all shingles
meet. The order puts shingles that are common in a bounded sample last; it decides the work, not the pairs. The collision-corrected Jaccard estimate drops the hopeless ones, and full sets
confirm the rest. Buckets of at most FEW classes emit their pairs. No larger bucket does: first each class meets the likeliest smallest class of its
buckets, and links make components. Buckets that still hold several components are cut into tiles of bounded size; a tile
compares its classes by their sketches, counts the shared shingles of likely pairs by one product of incidence matrices, and emits only
links that join components, so its rows never outnumber its classes. Chunks meet themselves first, and one another only
where a bucket holds several components even then.

Links: 100 * intersection >= percent * union. With 25 bands of 5 registers a pair of
long texts at 0.85 is missed with odds of 4e-7, at 0.8 with 32 bands of 4 with odds of 5e-8. Edge cases: null, empty and blank texts have the empty set, link with nothing and stay; a text with fewer
than five words is one shingle; repeated rows keep their rows, and if one id comes with different texts, it is one document that
links by each of them; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.arrays import mix, shingles, text_blocks
from pelagia.llm.common import BROADCAST_ROWS, materialize, release
from pelagia.llm.components import connected_components

BUCKETS = 128
MANTISSA = 10
#: Pairs whose estimate is this far below the threshold are not confirmed: four standard errors of 128 registers.
SLACK = 0.13
#: Sets with fewer shingles are proposed by their own shingles.
SHORT = 200
#: Classes a bucket may have and emit all its pairs.
FEW = 16
#: The sample that tells common shingles, and how many of them are told.
SAMPLE_SETS = 20_000
COMMON = 50_000
#: Classes, and shingles of them together, that a tile of a bucket has on each side.
TILE = 1024
TILE_SHINGLES = 1_000_000
_U = np.uint64


def band_width(percent: int) -> int:
    """The widest bands that miss a pair at the threshold with odds of at most one in a million."""
    return max([w for w in range(1, 9) if (1 - (percent / 100) ** w) ** (BUCKETS // w) <= 1e-6], default=1)


def slack(percent: int, buckets: int, least: float) -> float:
    """Four standard errors of so many registers at the threshold, but no less than least."""
    return max(least, 4 * (percent / 100 * (1 - percent / 100) / buckets) ** 0.5)


def registers(hashes: np.ndarray, bounds: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """HyperMinHash registers (uint16) of each row's ascending hashes: 0 is empty, else (zeros + 1) * 1024 + mantissa."""
    n = len(bounds) - 1
    bits = buckets.bit_length() - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    cell = row * buckets + (hashes >> _U(64 - bits)).astype(np.int64)
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    rest = hashes[first] << _U(bits)
    head = (rest >> _U(11)).astype(np.float64)
    zeros = np.where(head > 0, 53 - np.frexp(head)[1], 53).astype(np.uint64)
    mantissa = (rest << (zeros + _U(1))) >> _U(64 - MANTISSA)
    out = np.zeros(n * buckets, np.uint16)
    out[cell[first]] = ((zeros + _U(1)) * _U(1 << MANTISSA) + mantissa).astype(np.uint16)
    return out.reshape(n, buckets)


def bands(regs: np.ndarray, width: int = 5) -> np.ndarray:
    """One 64-bit key for each row and band; empty registers take the value of the next full one."""
    n = BUCKETS // width
    twice = np.concatenate([regs, regs], axis=1)
    place = np.where(twice > 0, np.arange(2 * BUCKETS), 4 * BUCKETS)
    nearest = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :BUCKETS]
    full = np.take_along_axis(twice, np.minimum(nearest, 2 * BUCKETS - 1), axis=1).astype(np.uint64)
    key = np.repeat(np.arange(1, n + 1, dtype=np.uint64)[None, :], len(regs), axis=0)
    for k in range(width):  # registers far apart, so that filled ones seldom meet in a band
        key = mix(key * _U(0x100000001B3) + full[:, k * n : (k + 1) * n])
    return key.view(np.int64)


#: Steps of an octave in the table of chance matches, and its octaves.
_STEPS, _OCTAVES = 4, 64


def _chance_table() -> np.ndarray:
    """The expected share of registers that two unrelated sets have equal, by the hashes each has a register (2 ** (i / _STEPS) / BUCKETS of a set of 2 ** (i / _STEPS)).

    A register's smallest hash falls into the octave of z zeros with odds exp(-a / 2 ** (z + 1)) - exp(-a / 2 ** z) for a hashes, and
    there into one of 1 << MANTISSA like parts; two registers agree if both fall into the same one.
    """
    a = 2.0 ** (np.arange(_STEPS * _OCTAVES) / _STEPS) / BUCKETS
    z = np.arange(_OCTAVES)
    odds = np.exp(-a[:, None] / 2.0 ** (z + 1)) - np.exp(-a[:, None] / 2.0**z)
    return odds @ odds.T / (1 << MANTISSA)


_CHANCE = _chance_table()


def estimate(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Jaccard estimates of register rows x and y, less the matches that unrelated sets of these sizes are expected to have."""
    used = ((x > 0) | (y > 0)).sum(axis=-1)
    same = ((x == y) & (x > 0)).sum(axis=-1)
    i, j = (np.round(_STEPS * np.log2(np.maximum(n, 1))).astype(int) for n in (nx, ny))
    chance = _CHANCE[i, j]
    share = same / np.maximum(used, 1)
    return np.clip((share - chance) / (1 - chance), 0, 1)


_SKETCH = "doc_id long, n long, f1 long, f2 long, regs binary"


def _marks(h: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    """Two sums over each row's set that tell different sets apart."""
    sums = [np.concatenate([[_U(0)], np.cumsum(mix(h ^ _U(salt)))]) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return [pa.array((m[at[1:]] - m[at[:-1]]).view(np.int64)) for m in sums]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for first, last, data, offsets in text_blocks(batch.column(1)):
            h, at = shingles(data, offsets)
            regs = registers(h, at)
            yield pa.record_batch(
                [ids.slice(first, last - first), pa.array(np.diff(at).astype(np.int64)), *_marks(h, at), pa.array([r.tobytes() for r in regs], pa.binary())],
                names=["doc_id", "n", "f1", "f2", "regs"],
            )


_SET = "doc_id long, n long, f1 long, f2 long, members binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole sets as packed hashes."""
    for batch in batches:
        for first, last, data, offsets in text_blocks(batch.column(1)):
            h, at = shingles(data, offsets)
            packed = pa.array([h[at[i] : at[i + 1]].tobytes() for i in range(last - first)], pa.binary())
            yield pa.record_batch([batch.column(0).slice(first, last - first), pa.array(np.diff(at).astype(np.int64)), *_marks(h, at), packed], names=["doc_id", "n", "f1", "f2", "members"])


def _band_rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16).reshape(-1, BUCKETS)
        for i in range(0, len(regs), 2000):
            keys = bands(regs[i : i + 2000], width)
            rep, n = (batch.column(c).to_numpy(zero_copy_only=False)[i : i + 2000] for c in ("rep", "n"))
            yield pa.record_batch([pa.array(keys.ravel()), pa.array(np.repeat(rep, BUCKETS // width)), pa.array(np.repeat(n, BUCKETS // width))], names=["band", "rep", "n"])


def _short_sets(h: np.ndarray, at: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with 1 to below - 1 shingles, and which shingles are theirs."""
    n = np.diff(at)
    rows = np.flatnonzero((n > 0) & (n < below))
    return rows, np.repeat((n > 0) & (n < below), n)


def _all_shingles(batches: Iterator[pa.RecordBatch], below: int) -> Iterator[pa.RecordBatch]:
    """Every shingle of the short sets."""
    for batch in batches:
        for _, _, data, offsets in text_blocks(batch.column(1)):
            h, at = shingles(data, offsets)
            yield pa.record_batch([pa.array(h[_short_sets(h, at, below)[1]].view(np.int64))], names=["shingle"])


_PREFIX = "doc_id long, n long, f1 long, f2 long, size long, band array<long>"


def _prefixes(batches: Iterator[pa.RecordBatch], percent: int, below: int, common: np.ndarray, rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The prefix of every short set: shingles not known as common by their hash, then the common ones, rarest first."""
    for batch in batches:
        for first, last, data, offsets in text_blocks(batch.column(1)):
            h, at = shingles(data, offsets)
            rows, theirs = _short_sets(h, at, below)
            n = np.diff(at)[rows]
            key, row = h[theirs], np.repeat(np.arange(len(rows)), n)
            place = np.minimum(np.searchsorted(common, key), max(0, len(common) - 1))
            known = np.where(common[place] == key, rank[place], 0) if len(common) else np.zeros(len(key), np.int64)
            key = key[np.lexsort((key, known, row))]
            size = n - (percent * n + 99) // 100 + 1
            start = np.cumsum(n) - n
            taken = key[np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(taken.view(np.int64)))
            marks = [m.take(pa.array(rows)) for m in _marks(h, at)]
            ids = batch.column(0).slice(first, last - first).take(pa.array(rows))
            sizes = pa.array(n.astype(np.int64))
            yield pa.record_batch([ids, sizes, *marks, sizes, lists], names=["doc_id", "n", "f1", "f2", "size", "band"])


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("ra", "rb"))
        a, b, na, nb = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "na", "nb"))
        yield pa.record_batch([pa.array(a), pa.array(b), pa.array(estimate(x, y, na, nb))], names=["a", "b", "est"])


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, links = [], [], []
        for i in range(batch.num_rows):
            x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("ma", "mb"))
            both = len(x) + len(y) - len(np.union1d(x, y))
            if 100 * both >= percent * (len(x) + len(y) - both):
                a.append(batch.column("a")[i].as_py())
                b.append(batch.column("b")[i].as_py())
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many hashes each pair of sets shares: the incidence matrix times itself, a slab of columns at a time."""
    m = len(sets)
    row = np.repeat(np.arange(m), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count[column] > 1
    column = (np.cumsum(count > 1) - 1)[column[often]]
    order = np.argsort(column, kind="stable")
    row, column = row[often][order], column[order]
    kind = np.float32 if len(row) < 1 << 24 else np.float64
    out, width = np.zeros((m, m), kind), max(64, 4_000_000 // m)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        at = slice(*np.searchsorted(column, [low, low + width]))
        slab = np.zeros((m, width), kind)
        slab[row[at], column[at] - low] = 1
        out += slab @ slab.T
    return out.astype(np.int64)


def _joining(a: np.ndarray, b: np.ndarray, home: np.ndarray) -> list[int]:
    """Which of the links a, b join components that those before left apart. home: each place's component, from 0."""
    root = list(range(int(home.max()) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for k, (x, y) in enumerate(zip(home[a].tolist(), home[b].tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append(k)
    return out


def _tile_links(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of a tile that join its components, as few as do."""
    between = pdf["lo"].iloc[0] != pdf["hi"].iloc[0]
    pdf = pdf.sort_values("rep", ignore_index=True)
    regs = np.frombuffer(b"".join(pdf["regs"]), np.uint16).reshape(-1, BUCKETS)
    full, least = (regs > 0).sum(axis=1), percent / 100 - slack(percent, BUCKETS, SLACK)
    n, rep, chunk, home = pdf["n"].to_numpy(), pdf["rep"].to_numpy(), pdf["chunk"].to_numpy(), pd.factorize(pdf["comp"])[0]
    pairs = []
    for i in range(len(pdf) - 1):
        fit = (home[i + 1 :] != home[i]) & (100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i]))
        if between:
            fit &= chunk[i + 1 :] != chunk[i]
        at = i + 1 + np.flatnonzero(fit)
        if len(at):
            same = ((regs[at] == regs[i]) & (regs[i] > 0)).sum(axis=1)
            at = at[same >= least * np.maximum(full[at], full[i])]  # no pair uses fewer registers
        if len(at):
            at = at[estimate(regs[i][None, :], regs[at], n[i], n[at]) >= least]
            pairs.append(np.stack([np.full(len(at), i), at]))
    a, b = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    if len(a):
        some = np.unique(np.concatenate([a, b]))
        both = _shared([np.frombuffer(x, np.uint64) for x in pdf["members"].iloc[some]])[np.searchsorted(some, a), np.searchsorted(some, b)]
        linked = 100 * both >= percent * (n[a] + n[b] - both)
        a, b = a[linked], b[linked]
        taken = _joining(a, b, home)
        a, b = a[taken], b[taken]
    return pd.DataFrame({"a": rep[a], "b": rep[b]})


class NearDuplicates:
    """Finds classes, links and components for one table of documents."""

    def __init__(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 85):
        self.percent = percent
        self.docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        self.slim = materialize(self.docs.mapInArrow(_sketches, _SKETCH))
        total = self.slim.agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
        self.repeated = total["rows"] > total["ids"]
        classes = self.slim.where(F.col("n") > 0).groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("doc"), F.first("regs").alias("regs"))
        # an id names one class, its own, unless ids are repeated; then classes go by their marks
        self.classes = materialize(classes.withColumn("rep", F.xxhash64("n", "f1", "f2") if self.repeated else F.col("doc")))

    def _estimated(self, pairs: DataFrame) -> DataFrame:
        """a, b, est of the pairs that may reach the threshold."""
        regs = self.classes.select("rep", "n", "regs")
        pairs = pairs.join(regs.toDF("a", "na", "ra"), "a").join(regs.toDF("b", "nb", "rb"), "b")
        scored = pairs.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_score, "a long, b long, est double")
        return scored.where(F.col("est") >= self.percent / 100 - slack(self.percent, BUCKETS, SLACK))

    def _texts(self, ids: DataFrame, run, schema: str) -> DataFrame:
        """What run makes of the texts of the classes asked for (materialized, column id), with their id; other columns than doc_id, n, f1, f2 are kept."""
        small = ids.count() <= BROADCAST_ROWS
        wanted = ids
        if self.repeated:
            wanted = ids.join(self.classes.select(F.col("rep").alias("id"), "doc", "n", "f1", "f2"), "id")
            wanted = wanted.select("id", F.col("doc").alias("__doc"), F.col("n").alias("__n"), F.col("f1").alias("__f1"), F.col("f2").alias("__f2"))
        asked = wanted.select(F.col("__doc" if self.repeated else "id").alias("__id")).distinct()
        rows = self.docs.join(F.broadcast(asked) if small else asked, F.col("doc_id") == F.col("__id"), "left_semi").mapInArrow(run, schema)
        if not self.repeated:
            return rows.drop("n", "f1", "f2").withColumnRenamed("doc_id", "id")
        same = (F.col("doc_id") == F.col("__doc")) & (F.col("n") == F.col("__n")) & (F.col("f1") == F.col("__f1")) & (F.col("f2") == F.col("__f2"))
        met = rows.join(F.broadcast(wanted) if small else wanted, same).drop("doc_id", "n", "f1", "f2", "__doc", "__n", "__f1", "__f2")
        return met.dropDuplicates(["id"])

    def _read(self, ids: DataFrame) -> DataFrame:
        """id and members (packed sets) for the materialized ids asked for, from their texts."""
        return self._texts(ids, _sets, _SET).select("id", "members")

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets reach the threshold. Only the texts of these pairs are read into sets again."""
        ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        sets = self._read(ids)
        with_b = pairs.select("a", "b").join(sets.toDF("b", "mb"), "b")
        both = with_b.join(sets.toDF("a", "ma"), "a").select("a", "b", "ma", "mb")
        percent = self.percent
        out = materialize(both.mapInArrow(lambda it: _confirm(it, percent), "a long, b long"))
        release(ids)
        return out

    def _prefix_rows(self) -> DataFrame:
        """band, rep, n of every set that a set of less than SHORT shingles may link with."""
        below = -(-SHORT * 100 // self.percent)
        short = materialize(self.classes.where(F.col("n") < below).select(F.col("rep").alias("id")))
        count = short.count()
        if not count:
            return self.classes.limit(0).select(F.col("n").alias("band"), "rep", "n")
        part = self.classes.where((F.col("n") < below) & (F.pmod(F.xxhash64("doc"), F.lit(-(-count // SAMPLE_SETS))) == 0)).select(F.col("doc").alias("doc_id"))
        seen = self.docs.join(F.broadcast(part), "doc_id", "left_semi").mapInArrow(partial(_all_shingles, below=below), "shingle long")
        often = seen.groupBy("shingle").count().where("count > 3").orderBy(F.desc("count"), "shingle").limit(COMMON).toArrow()  # a bounded list
        common = often.column("shingle").to_numpy().view(np.uint64)
        order = np.argsort(common)
        run = partial(_prefixes, percent=self.percent, below=below, common=common[order], rank=often.column("count").to_numpy()[order])
        return self._texts(short, run, _PREFIX).select(F.explode("band").alias("band"), F.col("id").alias("rep"), F.col("size").alias("n"))

    def _of_one_id(self) -> DataFrame:
        """Links between the classes that share an id."""
        mine = self.slim.join(self.classes, ["n", "f1", "f2"]).select("doc_id", "rep").distinct()
        first = mine.groupBy(F.col("doc_id").alias("__d")).agg(F.min("rep").alias("a"))
        return mine.join(first, F.col("doc_id") == F.col("__d")).where("rep <> a").select("a", F.col("rep").alias("b"))

    def components(self) -> DataFrame:
        """node, component for every class that links with another."""
        long = self.classes.where(F.col("n") >= SHORT).select("rep", "n", "regs")
        rows = materialize(long.mapInArrow(partial(_band_rows, width=band_width(self.percent)), "band long, rep long, n long").unionByName(self._prefix_rows()))
        crowded = rows.groupBy("band").agg(F.min(F.struct("rep", "n")).alias("hub"), F.count("*").alias("k")).where("k > 1")
        crowded = materialize(crowded.select("band", "k", F.col("hub.rep").alias("a"), F.col("hub.n").alias("na")))
        members = materialize(rows.join(crowded, "band"))
        release(rows, crowded)
        few = members.where(F.col("k") <= FEW).select("band", "rep", "n")
        pairs = few.toDF("band", "a", "na").join(few.toDF("band", "b", "nb"), "band").where("a < b")
        near = 100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb")
        met = materialize(pairs.where(near).select("a", "b").distinct())
        crowd = members.where(F.col("k") > FEW)
        fits = 100 * F.least("n", "na") >= self.percent * F.greatest("n", "na")
        star = crowd.where((F.col("rep") != F.col("a")) & fits).select("a", F.col("rep").alias("b")).distinct()
        star = self._estimated(star).groupBy("b").agg(F.max_by("a", F.struct("est", -F.col("a"))).alias("a"))
        likely = materialize(self._estimated(met).select("a", "b").unionByName(star.select("a", "b")).distinct())
        release(met)
        links = self._confirmed(likely)
        release(likely)
        if self.repeated:
            links = materialize(links.unionByName(self._of_one_id()))
        comp = connected_components(links)
        for between in (False, True):
            more = self._tiles(crowd.select("band", "rep", "n"), comp, between)
            if more is None:
                break
            before = links, more, comp
            links = materialize(links.union(more))
            comp = connected_components(links)
            release(*before)
        release(members, links)
        return comp

    def _tiles(self, crowd: DataFrame, comp: DataFrame, between: bool) -> DataFrame | None:
        """Links inside the chunks of the buckets that hold several components, or between their chunks; None if no bucket asks for it."""
        placed = materialize(crowd.join(comp, F.col("rep") == F.col("node"), "left").select("band", "rep", "n", F.coalesce("component", "rep").alias("comp")))
        sums = placed.groupBy("band").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("k"), F.sum("n").alias("size"))
        chunks = F.greatest(F.ceil(F.col("k") / F.lit(TILE)), F.ceil(F.col("size") / F.lit(TILE_SHINGLES))).cast("int").alias("chunks")
        mixed = materialize(sums.where("c0 < c1").select("band", chunks).where(F.col("chunks") > (1 if between else 0)))
        if mixed.isEmpty():
            release(placed, mixed)
            return None
        rows = placed.join(mixed, "band").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
        ids = materialize(rows.select(F.col("rep").alias("id")).distinct())
        sets = materialize(self._read(ids).join(self.classes.select(F.col("rep").alias("id"), "regs"), "id"))
        others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: c != F.col("chunk")) if between else F.array("chunk")
        rows = rows.withColumn("other", F.explode(others))
        rows = rows.select("band", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "rep", "n", "comp")
        rows = rows.join(sets.withColumnRenamed("id", "rep"), "rep")
        out = materialize(rows.groupBy("band", "lo", "hi").applyInPandas(partial(_tile_links, percent=self.percent), "a long, b long").distinct())
        release(placed, mixed, ids, sets)
        return out

    def assign(self) -> DataFrame:
        """doc_id, n_shingles, component_id, kept for every row."""
        comp = self.components()
        where = self.classes.join(comp, F.col("rep") == F.col("node"), "left").select("n", "f1", "f2", "doc", F.coalesce("component", "rep").alias("comp"))
        least = where.groupBy("comp").agg(F.min("doc").alias("component_id")) if self.repeated else None
        where = where.join(least, "comp") if self.repeated else where.withColumn("component_id", F.col("comp"))
        out = self.slim.join(where.select("n", "f1", "f2", "component_id"), ["n", "f1", "f2"], "left")
        out = materialize(out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
        release(self.slim, self.classes, comp)
        return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


#: Where the numbers begin that stand in for null ids, so that any id of a row's own goes before them.
_UNNAMED = 1 << 62


def _named(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows with an id for each: their own, or a number of their own from _UNNAMED on; written then, so that it stays."""
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    rows = docs.select(own, F.col(doc_id).cast("long").alias("__id"))
    if rows.where(F.col("__id").isNull()).isEmpty():
        return rows
    return materialize(rows.withColumn("__id", F.coalesce("__id", F.lit(_UNNAMED) + F.monotonically_increasing_id())))


def assign(docs: DataFrame, text: str = "text", percent: int = 85) -> DataFrame:
    """doc_id, n_shingles (long), component_id, kept for every row of docs.

    Rows with a null id come after all others: they are kept only where nothing with an id is near, one of a component, whose component_id is then null.
    """
    rows = _named(docs).select(F.col("__id").alias("doc_id"), F.col("__row")[text].alias("text"))
    out = NearDuplicates(rows, percent=percent).assign()
    own = lambda c: F.when(F.col(c) < _UNNAMED, F.col(c)).alias(c)
    return out.select(own("doc_id"), "n_shingles", own("component_id"), "kept")


def keep(docs: DataFrame, text: str = "text", percent: int = 85) -> DataFrame:
    """The rows of docs that stay: the smallest id of each component, once for each of its texts. Small sets of dropped ids are broadcast."""
    rows = _named(docs)
    found = NearDuplicates(rows.select(F.col("__id").alias("doc_id"), F.col("__row")[text].alias("text")), percent=percent)
    placed = found.assign()
    gone = materialize(placed.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct())
    small = gone.count() <= BROADCAST_ROWS
    out = rows.join(F.broadcast(gone) if small else gone, F.col("__id") == F.col("__gone"), "left_anti")
    if found.repeated:
        out = out.withColumn("__text", F.col("__row")[text]).dropDuplicates(["__id", "__text"])
    return out.select("__row.*")
