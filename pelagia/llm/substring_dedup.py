"""Removes passages of LENGTH words and more that also stand earlier in the corpus: seeds, extension, maximal repeats.

A window is `length` consecutive words of one text. Of its word 8-grams the one with the least hash is its anchor (winnowing), so equal
windows have the same anchor at the same place, and most windows share theirs with their neighbours: an anchor holds a run of
windows. Documents meet on anchors that occur at least twice (the seeds). A seed is extended both ways over all words that its windows
reach. Seeds alike in their whole reach are one class: all but the earliest are repeats from end to end, whatever their number, and
need no partner but the earliest. Where an anchor has several classes, copies begin or end within its reach; there the earliest of each class is
extended word by word, that is each of its windows is held against those of the other classes. What is found is merged along
each diagonal into maximal repeats.

No pairs of a group are made: every step is a least (document, start) by key and a join back with it, hot keys being dealt out apart
(common.spread_join). Text moves twice, at every size: to the seeds that need a closer look, and to its spans at the end.
Anchors and runs are told by hashes of 64 bits within an anchor's group, windows by 128 bits.

Order is by doc_id (null first), then by start. Texts that are null, empty or shorter than the length keep all they have. Rows with the same
doc_id and text have the same result; a row with the same doc_id and another text counts as the same document, so only a smaller start is earlier.
An empty table gives an empty result. Columns besides doc_id and text are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.llm.arrays import mix, span_hashes, text_blocks, word_bounds, word_hashes
from pelagia.llm.common import materialize, release, spread_join

#: Words of the shortest passage that is removed, and of an anchor.
LENGTH = 20
ANCHOR = 8
_U = np.uint64
_SALTS = (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x6A09E667F3BCC909)


def _text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and hash of every word, and the first word of each row."""
    starts, ends, rows = word_bounds(data, offsets)
    h = word_hashes(data, starts, ends, lower=False)
    return starts, ends, rows, h, np.searchsorted(rows, np.arange(len(offsets)))


def runs(h: np.ndarray, rows: np.ndarray, length: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each anchor's place and the first and last start of the windows it holds, over all rows' word hashes at once."""
    n = len(h) - length + 1
    empty = np.zeros(0, np.int64)
    if n < 1:
        return empty, empty, empty
    grams = mix(span_hashes(h, np.arange(len(h) - width + 1), np.arange(width, len(h) + 1), _SALTS[0]))
    inside = np.flatnonzero(rows[:n] == rows[length - 1 :])
    least = np.empty(len(inside), np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, length - width + 1)
    for i in range(0, len(inside), 65_536):  # so that the windows of a long text never stand side by side
        part = inside[i : i + 65_536]
        least[i : i + len(part)] = part + views[part].argmin(axis=1)
    if not len(least):
        return empty, empty, empty
    first = np.ones(len(least), bool)
    first[1:] = least[1:] != least[:-1]
    last = np.append(np.flatnonzero(first)[1:] - 1, len(least) - 1)
    return least[first], inside[first], inside[last]


_ANCHORS = "doc_id long, mark long, a long, c long, at long, size int"


def _anchors(length: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(2)):
                _, _, rows, h, base = _text_words(data, offsets)
                place, lo, hi = runs(h, rows, length, width)
                if not len(place):
                    continue
                reach = span_hashes(h, lo, hi + length, _SALTS[1])
                key = mix(reach + ((place - lo) * 64 + (hi - lo)).astype(np.uint64))
                a = span_hashes(h, place, place + width, _SALTS[2])
                row = rows[lo]
                at = pa.array(row + first)
                yield pa.record_batch(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(a.view(np.int64)), pa.array(key.view(np.int64)), pa.array(lo - base[row]), pa.array((hi - lo).astype(np.int32))],
                    names=["doc_id", "mark", "a", "c", "at", "size"],
                )

    return run


_WINDOWS = "doc_id long, mark long, h1 long, h2 long, at long"


def _windows(length: int):
    """Every window of the runs that a row lists in column 3."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(3)
            for first, last, data, offsets in text_blocks(batch.column(2)):
                _, _, _, h, base = _text_words(data, offsets)
                part = listed.slice(first, last - first)
                n = np.diff(part.offsets.to_numpy(zero_copy_only=False))
                flat = part.flatten()
                row = np.repeat(np.arange(last - first), n)
                at, size = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
                many = size + 1
                row, at = np.repeat(row, many), np.repeat(at, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                begin = base[row] + at
                keys = [pa.array(span_hashes(h, begin, begin + length, s).view(np.int64)) for s in _SALTS[2:]]
                ids = pa.array(row + first)
                yield pa.record_batch([batch.column(0).take(ids), batch.column(1).take(ids), *keys, pa.array(at)], names=["doc_id", "mark", "h1", "h2", "at"])

    return run


def _later() -> F.Column:
    """Whether a row stands after the earliest of its key; null ids come first."""
    return F.struct("doc_id", "at") > F.col("first")


def _same(left: DataFrame, right: DataFrame) -> list:
    return [left["doc_id"].eqNullSafe(right["__doc_id"]), left["mark"] == right["__mark"]]


def spans(docs: DataFrame, length: int = LENGTH, width: int = ANCHOR) -> DataFrame:
    """doc_id, mark (hash of the text), start, end, first (doc_id, at): runs of words whose windows all stand earlier, too."""
    if not 0 < width <= length <= width + 63:
        raise ValueError("an anchor has at most as many words as a window, and at most 63 fewer")
    texts = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").where(F.length("text") >= 2 * length - 1)
    anchors = texts.mapInArrow(_anchors(length, width), _ANCHORS)
    repeated = materialize(anchors.groupBy("a").agg(F.count("*").alias("n")).where("n > 1"))
    seeds = materialize(spread_join(anchors, repeated, ["a"], "n", ["doc_id", "at"]))
    release(repeated)
    classes = materialize(seeds.groupBy("a", "c").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n")))
    met = materialize(spread_join(seeds, classes, ["a", "c"], "n", ["doc_id", "at"]).withColumn("later", _later()))
    release(seeds)
    kinds = materialize(classes.groupBy("a").agg(F.count("*").alias("n")).where("n > 1"))
    border = materialize(spread_join(met.where("NOT later").select("doc_id", "mark", "a", "at", "size"), kinds, ["a"], "n", ["doc_id", "at"]).select("doc_id", "mark", "at", "size"))
    release(classes, kinds)
    wanted = border.groupBy(F.col("doc_id").alias("__doc_id"), F.col("mark").alias("__mark")).agg(F.collect_set(F.struct("at", "size")).alias("runs"))
    looked = texts.join(wanted.hint("merge"), _same(texts, wanted)).select("doc_id", "mark", "text", "runs")
    windows = materialize(looked.mapInArrow(_windows(length), _WINDOWS))
    release(border)
    firsts = materialize(windows.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n")).where("n > 1"))
    some = spread_join(windows, firsts, ["h1", "h2"], "n", ["doc_id", "at"]).where(_later())
    whole = met.where("later").select("doc_id", "mark", F.col("at").alias("start"), (F.col("at") + F.col("size") + length).alias("end"), "first")
    out = materialize(whole.unionByName(some.select("doc_id", "mark", F.col("at").alias("start"), (F.col("at") + length).alias("end"), "first")))
    release(met, windows, firsts)
    return out


def maximal(start: np.ndarray, end: np.ndarray, source: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The order and ends of maximal repeats: spans that touch or overlap on one diagonal of one source are one.

    source: any number for each source document; at: where the span begins there. Gives start, end, source and at as rows.
    """
    diagonal = at - start
    order = np.lexsort((start, diagonal, source))
    start, end, source, diagonal = start[order], end[order], source[order], diagonal[order]
    if not len(start):
        return np.zeros((0, 4), np.int64)
    group = np.ones(len(start), bool)
    group[1:] = (source[1:] != source[:-1]) | (diagonal[1:] != diagonal[:-1])
    lift = np.cumsum(group) * (int(end.max()) + 2)  # a group's ends lie below the next group's starts
    reach = np.maximum.accumulate(end + lift)
    cut = np.ones(len(start), bool)
    cut[1:] = start[1:] + lift[1:] > reach[:-1]
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(start)) - 1
    return np.stack([start[first], reach[last] - lift[last], source[first], diagonal[first] + start[first]], axis=1)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row (other columns), text, spans: both again, the kept words joined by one space, the counts and the maximal repeats."""
    for batch in batches:
        listed = batch.column(2)
        for first, last, data, offsets in text_blocks(batch.column(1)):
            starts, ends, rows, _, base = _text_words(data, offsets)
            part = listed.slice(first, last - first)
            n = np.diff(part.offsets.to_numpy(zero_copy_only=False))
            flat = part.flatten()
            row = np.repeat(np.arange(last - first), n)
            lo, hi = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            depth = np.zeros(len(starts) + 1, np.int64)
            np.add.at(depth, base[row] + lo, 1)
            np.subtract.at(depth, base[row] + hi, 1)
            keep = np.cumsum(depth)[:-1] == 0
            words = np.bincount(rows, minlength=last - first)
            kept = np.bincount(rows[keep], minlength=last - first)
            yield pa.record_batch(
                [batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first), _joined(data, starts[keep], ends[keep], kept), pa.array(words), pa.array(words - kept), _repeats(flat, n)],
                names=["row", "text", "kept_text", "n_words", "n_removed", "repeats"],
            )


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, each: np.ndarray) -> pa.Array:
    """The words of each row with one space between; each: words of a row."""
    size = ends - starts + 1
    size[(np.cumsum(each) - 1)[each > 0]] -= 1  # no space after a row's last word
    begin = np.cumsum(size) - size
    out = np.append(data, np.uint8(32))[np.arange(size.sum()) + np.repeat(starts - begin, size)]
    spaced = size > ends - starts
    out[(begin + size - 1)[spaced]] = 32
    bounds = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(each)])]
    return pa.LargeStringArray.from_buffers(len(each), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


_FOUND = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first_doc_id", pa.int64()), ("first_start", pa.int64())])


def _repeats(flat: pa.Array, n: np.ndarray) -> pa.Array:
    first = flat.field(2)
    ids = first.field(0).dictionary_encode()
    code = ids.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    lo, hi = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    at = first.field(1).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(n)])
    found = [maximal(lo[a:b], hi[a:b], code[a:b], at[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    found = [f[np.lexsort((f[:, 1], f[:, 0]))] for f in found]
    all_ = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    who = ids.dictionary.take(pa.array(all_[:, 2], mask=all_[:, 2] < 0))
    rows = pa.StructArray.from_arrays([pa.array(all_[:, 0]), pa.array(all_[:, 1]), who, pa.array(all_[:, 3])], fields=list(_FOUND))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)), rows)


def remove(docs: DataFrame, length: int = LENGTH, width: int = ANCHOR) -> DataFrame:
    """All rows and columns of docs, and n_words, n_removed, kept_text and repeats (start, end, first_doc_id, first_start).

    kept_text has the words outside of all repeats, joined by one space. Names of docs win over added ones of the same name: an added column
    that clashes is left out.
    """
    found = spans(docs, length, width)
    by_text = found.groupBy(F.col("doc_id").alias("__doc_id"), F.col("mark").alias("__mark")).agg(F.collect_list(F.struct("start", "end", "first")).alias("spans"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(F.struct(F.col("doc_id"), *others).alias("row"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").alias("text"))
    joined = rows.join(by_text, _same(rows, by_text), "left")
    none = F.array().cast(by_text.schema["spans"].dataType)
    joined = joined.select("row", "text", F.coalesce("spans", none).alias("spans"))
    repeats = "array<struct<start:bigint,end:bigint,first_doc_id:bigint,first_start:bigint>>"
    schema = T.StructType([rows.schema["row"], rows.schema["text"]] + T.StructType.fromDDL(f"kept_text string, n_words long, n_removed long, repeats {repeats}").fields)
    out = joined.mapInArrow(_cut, schema)
    added = [c for c in ("n_words", "n_removed", "kept_text", "repeats") if c not in docs.columns]
    own = [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(*own, *added)
