"""Sampled subword segmentations without replacement, and their decoding.

A vocabulary of pieces gives every text a lattice of segmentations. A piece's weight is a power of its rank in
the model, so the lattice is a distribution over segmentations. Gumbel top-k draws k different ones: the root's
perturbed log-probability is a Gumbel; the best segmentation of a set of paths takes the set's value, and the
rest of the set falls into subsets (same path up to an edge, another edge there) whose values are Gumbels
truncated at their parent's. An A-star search takes the best subset next; its bound is exact, so the k paths come in
order of their perturbed values, and the best subset left gives the threshold of their inclusion probabilities.

Pieces never reach past the start of a word, so lattices are built once for each distinct word of a block of
text and paths are drawn for all words of the block together. Uniforms come from a hash of the row's key, the
draw's number and the character's place: results do not depend on partitions, batches or blocks.

A space is the piece mark, one is put before the text, and characters outside the vocabulary become bytes, as
the model does; a literal piece mark also becomes bytes, so decoding returns every text exactly. Edge cases: null
and empty texts have no pieces, one sample, probability 1; a text with fewer than k segmentations gives all it has, each
with log inclusion 0; repeated rows give equal rows; a null id is drawn as -1 is and stays null; an empty table gives none; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.arrays import _BASE, _base_powers, mix, text_blocks

MARK = 0x2581
#: Bytes of text that share a lattice: its arrays then stay in the allocator's reach and the cache's.
_BLOCK_BYTES = 100_000
#: Stands for a literal piece mark of the text inside a block; no character has this number.
LITERAL = 0x110000
FALLBACK = 1 << 24
_U = np.uint64
_TABLE_BITS = 19


@dataclass(frozen=True)
class Pieces:
    """The vocabulary as tasks need it: text and rank of each ordinary piece, ids of the byte pieces."""

    texts: list[str]
    ids: list[int]
    ranks: list[int]
    byte_ids: list[int]
    size: int


def load_pieces(model_file: str) -> Pieces:
    """Read on the driver; half a megabyte travels to the executors, not the file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    special = set(byte_ids)
    plain = [i for i in range(sp.get_piece_size()) if i not in special and not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    order = sorted(plain, key=lambda i: (-sp.get_score(i), i))
    texts = [sp.id_to_piece(i) for i in order]
    inner = chr(MARK)
    keep = [k for k, t in enumerate(texts) if inner not in t.lstrip(inner)]
    return Pieces([texts[k] for k in keep], [order[k] for k in keep], [k + 1 for k in keep], byte_ids, sp.get_piece_size())


def _char_values(cp: np.ndarray) -> np.ndarray:
    return mix(cp.astype(np.uint64) + _U(0x632BE59BD9B4E019))


class Segmenter:
    """Lattices and draws over blocks of text; one a Python worker."""

    def __init__(self, pieces: Pieces, theta: float = 1.0):
        self.pieces = pieces
        self.fallback_score = -theta * float(np.log(len(pieces.ids) + 1))
        values: dict[int, int] = {}
        for text, piece, rank in zip(pieces.texts, pieces.ids, pieces.ranks):
            total, power = 0, 1
            for k, v in enumerate(_char_values(np.array([ord(c) for c in text]))):
                total = (total + int(v) * power) % 2**64
                power = power * _BASE % 2**64
                values.setdefault(total, -1)
            values[total] = piece
        self.scores = np.full(pieces.size, -np.inf)
        self.scores[pieces.ids] = -theta * np.log(np.array(pieces.ranks))
        hashes = mix(np.array(list(values), np.uint64))
        self.keys, self.vals = np.zeros(1 << _TABLE_BITS, np.uint64), np.full(1 << _TABLE_BITS, -1, np.int32)
        self.probes = 1
        for h, v in zip(hashes, values.values()):
            slot, n = int(h) >> (64 - _TABLE_BITS), 1
            while self.keys[slot]:
                slot, n = (slot + 1) % (1 << _TABLE_BITS), n + 1
            self.keys[slot], self.vals[slot] = h, v
            self.probes = max(self.probes, n)
        self.single = {ord(t) for t in pieces.texts if len(t) == 1}
        self.known = np.zeros(0x110001, bool)
        self.known[[ord(c) for t in pieces.texts for c in t]] = True

    def _look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is a prefix of a piece, and the piece it is (-1: none)."""
        slot = (h >> _U(64 - _TABLE_BITS)).astype(np.int64)
        at = self.keys[slot]
        found = at == h
        open_ = np.flatnonzero(~found & (at != 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) % (1 << _TABLE_BITS)
            at = self.keys[slot[open_]]
            hit = at == h[open_]
            found[open_[hit]] = True
            open_ = open_[~hit & (at != 0)]
        return found, np.where(found, self.vals[slot], -1)

    def lattice(self, cp: np.ndarray, ends: np.ndarray) -> dict:
        """Edges of the words laid end to end in cp; ends holds each character's word end.

        Edges are ordered by their distance to the word's end, then by place, so those of one place lie together.
        """
        n = len(cp)
        up, down = _base_powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_char_values(cp) * up[:n], out=sums[1:])
        starts, lengths, found_pieces, nth = [], [], [], []
        count = np.zeros(n, np.int64)

        def add(places: np.ndarray, length: int, pieces: np.ndarray) -> None:
            starts.append(places)
            lengths.append(np.full(len(places), length))
            found_pieces.append(pieces)
            nth.append(count[places])
            count[places] += 1

        alive, length = np.arange(n), 1
        while len(alive):
            h = mix((sums[alive + length] - sums[alive]) * down[alive])
            prefix, piece = self._look(h)
            is_piece = piece >= 0
            add(alive[is_piece], length, piece[is_piece])
            if length == 1:  # no one-character piece: the byte way
                lone = alive[~is_piece]
                add(lone, 1, FALLBACK + cp[lone].astype(np.int64))
            alive = alive[prefix]
            length += 1
            alive = alive[alive + length <= ends[alive]]
        # places by their distance to the word's end; the edges of one place lie together, shorter ones first
        distance = ends - np.arange(n)
        by_far = np.argsort(distance.astype(np.uint16) if n < 1 << 16 or distance.max(initial=0) < 1 << 16 else distance, kind="stable")
        width = count[by_far]
        heads = np.cumsum(width) - width
        where = np.empty(n, np.int64)
        where[by_far] = heads
        unsorted = np.concatenate(starts)
        at = where[unsorted] + np.concatenate(nth)
        start, end, piece = (np.empty(len(at), np.int64) for _ in range(3))
        start[at], end[at], piece[at] = unsorted, unsorted + np.concatenate(lengths), np.concatenate(found_pieces)
        score = np.where(piece >= FALLBACK, self.fallback_score, self.scores[np.minimum(piece, len(self.scores) - 1)])
        beta = np.zeros(n + 1)
        logp = np.empty(len(start))
        is_end = end == ends[start]
        cuts = np.concatenate([np.flatnonzero(np.diff(distance[by_far])) + 1, [len(heads)]]) if n else []
        a = 0
        for b in cuts:
            lo, hi = heads[a], heads[b] if b < len(heads) else len(start)
            value = score[lo:hi] + np.where(is_end[lo:hi], 0.0, beta[np.where(is_end[lo:hi], 0, end[lo:hi])])
            groups = heads[a:b] - lo
            top = np.maximum.reduceat(value, groups)
            total = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, width[a:b])), groups))
            beta[by_far[a:b]] = total
            logp[lo:hi] = value - np.repeat(total, width[a:b])
            a = b
        p = np.exp(logp)
        run = np.cumsum(p)
        cum = run - np.repeat(run[heads] - p[heads], width)
        cum[heads + width - 1] = 2.0
        only = heads[width == 1]  # the only edge there
        logp[only], p[only] = 0.0, 1.0
        return {"end": end, "start": start, "piece": piece, "logp": logp, "p": p, "cum": cum, "where": where, "count": count, "ends": ends}

    @staticmethod
    def _walk(lat: dict, place: np.ndarray, stop: np.ndarray, seed: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draws a path from place to stop for each word; edges in order of words, and their counts."""
        word = np.flatnonzero(place < stop)
        v = place[word]
        words_, edges_ = [], []
        steps = np.zeros(len(place), np.int64)
        while len(word):
            u = _uniform(seed[word], v + shift[word])
            e = lat["where"][v]
            late = np.flatnonzero(lat["cum"][e] < u)
            while len(late):
                e[late] += 1
                late = late[lat["cum"][e[late]] < u[late]]
            words_.append(word)
            edges_.append(e)
            steps[word] += 1
            v = lat["end"][e]
            go = v < stop[word]
            word, v = word[go], v[go]
        offset = np.concatenate([[0], np.cumsum(steps)])
        out = np.empty(offset[-1], np.int64)
        for k, (w, e) in enumerate(zip(words_, edges_)):
            out[offset[w] + k] = e
        return out, steps

    def sample(self, texts: pa.Array, keys: np.ndarray, k: int, seed: int) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
        """(row, sample number, piece ids, log-probability, perturbed value, log of the inclusion probability) for every row and draw."""
        for first, last, data, offsets in text_blocks(texts, _BLOCK_BYTES):
            sizes = np.diff(offsets)
            for r in np.flatnonzero(sizes == 0):
                yield first + int(r), 0, np.zeros(0, np.int32), 0.0, 0.0, 0.0
            rows = np.flatnonzero(sizes > 0)
            if not len(rows):
                continue
            raw = data.tobytes()
            cp = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            at = lead[offsets][rows]
            cp = np.where(cp == MARK, LITERAL, np.where(cp == 0x20, MARK, cp)).astype(np.uint32)
            cp = np.insert(cp, at, MARK)
            begin = at + np.arange(len(rows))
            for out in self._block(cp, begin, keys[first:last][rows], k, seed):
                yield (first + int(rows[out[0]]), *out[1:])

    def _block(self, cp: np.ndarray, begin: np.ndarray, keys: np.ndarray, k: int, seed: int) -> Iterator[tuple]:
        n, docs = len(cp), len(begin)
        new = (cp == MARK) | ~self.known[cp]
        start = new.copy()
        start[1:] &= ~((cp[1:] == MARK) & (cp[:-1] == MARK))
        start[1:] |= ~self.known[cp[:-1]]
        start[begin] = True
        s = np.flatnonzero(start)
        e = np.append(s[1:], n)
        up, down = _base_powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_char_values(cp) * up[:n], out=sums[1:])
        code, names = pd.factorize(mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)))
        head = np.empty(len(names), np.int64)
        head[code[::-1]] = np.arange(len(s))[::-1]
        length = (e - s)[head]
        base = np.concatenate([[0], np.cumsum(length)])
        spot = np.repeat(s[head] - base[:-1], length) + np.arange(base[-1])
        lat = self.lattice(cp[spot], np.repeat(base[1:], length))

        doc = np.searchsorted(begin, s, "right") - 1
        place, stop = base[code], base[code + 1]
        shift = s - begin[doc] - place
        word_bounds = np.searchsorted(doc, np.arange(docs + 1))
        row_seed = mix(keys.view(np.uint64) + _U(seed))
        # perturbed value of the whole set: a Gumbel at 0
        bound = -np.log(-np.log(_uniform(row_seed, np.full(docs, -1))))
        paths: list[tuple[np.ndarray, np.ndarray]] = []  # edges and document bounds of every draw
        pools: list[np.ndarray] = []  # values of the subsets that leave a draw at each of its edges
        taken: list[list[tuple[int, ...]]] = []  # edges that stay closed where a draw left its parent
        forks: list[np.ndarray] = []
        chains: list[np.ndarray] = []  # value of the subset left there
        bounds = [bound]
        live = np.ones(docs, bool)
        fork_parent = np.full(docs, -1)
        for draw in range(k):
            sd = mix(row_seed + _U(0x9E37 * (draw + 1)))
            if draw == 0:
                flat, steps = self._walk(lat, place, stop, sd[doc], shift)
                at = np.concatenate([[0], np.cumsum(steps)])[word_bounds]
                fork, closed = np.full(docs, -1), [()] * docs
            else:
                fork_parent, fork, closed, value = self._best(paths, pools, chains, forks, taken, docs)
                live = np.isfinite(value)
                if not live.any():
                    break
                bounds.append(value)
                chosen = np.zeros(docs, np.int64)
                p2 = np.full(len(s), 0, np.int64)
                st2 = np.full(len(s), 0, np.int64)
                heads = []
                for d in np.flatnonzero(live):
                    pe, pb = paths[fork_parent[d]]
                    j = pb[d] + fork[d]
                    v = lat["start"][pe[j]]
                    options = _open_edges(lat, v, closed[d])
                    w = np.cumsum(np.exp(lat["logp"][options]))
                    u = float(_uniform(sd[d : d + 1], np.array([-2]))[0]) * w[-1]
                    chosen[d] = options[min(int(np.searchsorted(w, u)), len(options) - 1)]
                    heads.append(np.append(pe[pb[d] : j], chosen[d]))
                    whole = int((lat["end"][heads[-1]] == lat["ends"][lat["start"][heads[-1]]]).sum())
                    t = word_bounds[d] + whole
                    p2[t : word_bounds[d + 1]] = place[t : word_bounds[d + 1]]
                    st2[t : word_bounds[d + 1]] = stop[t : word_bounds[d + 1]]
                    if lat["end"][chosen[d]] < lat["ends"][lat["start"][chosen[d]]]:
                        p2[t] = lat["end"][chosen[d]]
                tails, steps = self._walk(lat, p2, st2, sd[doc], shift)
                tail_at = np.concatenate([[0], np.cumsum(steps)])[word_bounds]
                parts, at, h = [], np.zeros(docs + 1, np.int64), iter(heads)
                for d in range(docs):
                    if live[d]:
                        parts += [next(h), tails[tail_at[d] : tail_at[d + 1]]]
                        at[d + 1] = at[d] + len(parts[-2]) + len(parts[-1])
                    else:
                        at[d + 1] = at[d]
                flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
                closed = [tuple(c) + (int(x),) for c, x in zip(closed, chosen)]
            paths.append((flat, at))
            lp = lat["logp"][flat]
            before = np.concatenate([[0.0], np.cumsum(lp)])
            owner = np.repeat(np.arange(docs), np.diff(at))
            with np.errstate(divide="ignore"):
                rest = np.log1p(-np.minimum(lat["p"][flat], 1.0))
            mass = before[:-1] - before[at[:-1]][owner] + rest
            inside = np.arange(len(flat)) - at[:-1][owner]
            value = _truncated(mass, bounds[-1][owner], _uniform(mix(sd + _U(77))[owner], inside))
            if draw:
                value[inside <= fork[owner]] = -np.inf
            pools.append(value)
            forks.append(fork)
            taken.append(closed)
            chain = np.full(docs, -np.inf)
            if draw:
                for d in np.flatnonzero(live):
                    j = at[d] + fork[d]
                    v = lat["start"][flat[j]]
                    options = _open_edges(lat, v, closed[d])
                    if len(options):
                        m = before[j] - before[at[d]] + np.log(np.exp(lat["logp"][options]).sum())
                        u = _uniform(sd[d : d + 1], np.array([-3]))
                        chain[d] = _truncated(np.array([m]), bounds[-1][d : d + 1], u)[0]
            chains.append(chain)
        _, _, _, threshold = self._best(paths, pools, chains, forks, taken, docs)
        for draw, (flat, at) in enumerate(paths):
            lp = np.concatenate([[0.0], np.cumsum(lat["logp"][flat])])
            ids, id_at = self._ids(lat["piece"][flat], at)
            for d in np.flatnonzero(np.diff(at) > 0):
                logp = float(lp[at[d + 1]] - lp[at[d]])
                over = logp - threshold[d]  # threshold -inf: every segmentation was drawn
                share = over if over < -30 else float(np.log(-np.expm1(-np.exp(min(over, 50.0)))))
                yield d, draw, ids[id_at[d] : id_at[d + 1]], logp, float(bounds[draw][d]), share

    @staticmethod
    def _best(paths, pools, chains, forks, taken, docs):
        """The best subset not yet opened for each document, which is then closed."""
        value, parent, fork = np.full(docs, -np.inf), np.full(docs, -1), np.full(docs, -1)
        chain_of = np.full(docs, -1)
        for r, ((_, at), pool) in enumerate(zip(paths, pools)):
            full = np.flatnonzero(np.diff(at) > 0)
            if len(full):
                top = np.maximum.reduceat(pool, at[full])
                better = top > value[full]
                for d, t in zip(full[better], top[better]):
                    value[d], parent[d], chain_of[d] = t, r, -1
            better = chains[r] > value
            value[better], parent[better], chain_of[better] = chains[r][better], r, r
        closed: list[tuple[int, ...]] = [()] * docs
        for d in np.flatnonzero(np.isfinite(value)):
            flat, at = paths[parent[d]]
            if chain_of[d] >= 0:
                fork[d], closed[d] = forks[parent[d]][d], taken[parent[d]][d]
                chains[parent[d]][d] = -np.inf
            else:
                j = at[d] + int(np.argmax(pools[parent[d]][at[d] : at[d + 1]]))
                fork[d], closed[d] = j - at[d], (int(flat[j]),)
                pools[parent[d]][j] = -np.inf
        return parent, fork, closed, value

    def _ids(self, piece: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with characters outside the vocabulary spelt in byte pieces, and the new document bounds."""
        odd = np.flatnonzero(piece >= FALLBACK)
        if not len(odd):
            return piece.astype(np.int32), at
        cp = piece[odd] - FALLBACK
        spelt = [(chr(MARK) if c == LITERAL else chr(c)).encode() for c in cp]
        size = np.ones(len(piece), np.int64)
        size[odd] = [len(b) for b in spelt]
        out = np.repeat(piece, size)
        begin = np.concatenate([[0], np.cumsum(size)])
        for j, b in zip(odd, spelt):
            out[begin[j] : begin[j] + len(b)] = [self.pieces.byte_ids[x] for x in b]
        return out.astype(np.int32), begin[at]


def _open_edges(lat: dict, place: int, closed: tuple[int, ...]) -> list[int]:
    first = int(lat["where"][place])
    return [e for e in range(first, first + int(lat["count"][place])) if e not in closed]


def _uniform(seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Uniforms inside (0, 1) from a seed and a counter."""
    x = mix(seed + place.astype(np.int64).view(np.uint64) * _U(0x9E3779B97F4A7C15))
    return (x >> _U(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def _truncated(mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbels at mass, given that they stay under bound."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = -np.logaddexp(-bound, np.log(-np.log(u)) - mass)
    return np.where(np.isfinite(mass), out, -np.inf)


_worker: dict[tuple, Segmenter] = {}

ENCODED = "doc_id long, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double"


def encode(docs: DataFrame, model_file: str, k: int = 2, seed: int = 11, theta: float = 1.0, text: str = "text", key: str = "doc_id", with_text: bool = False) -> DataFrame:
    """k different segmentations of every text, one row each, best perturbed value first.

    with_text adds the column text, decoded from the ids by the task that made them.
    """
    pieces = load_pieces(model_file)
    shared = docs.sparkSession.sparkContext.broadcast((pieces, piece_bytes(pieces) if with_text else None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, spelt = shared.value
        name = (vocabulary.size, vocabulary.texts[0], vocabulary.texts[-1], theta)
        if name not in _worker:
            _worker.clear()
            _worker[name] = Segmenter(vocabulary, theta)
        for batch in batches:
            ids = batch.column(0)
            keys = ids.fill_null(-1).to_numpy(zero_copy_only=False)
            rows: list[tuple] = []
            weight = 0
            for out in _worker[name].sample(batch.column(1), keys, k, seed):
                rows.append(out)
                weight += len(out[2]) + 50
                if weight > 250_000:
                    yield _encoded(ids, rows, spelt)
                    rows, weight = [], 0
            if rows:
                yield _encoded(ids, rows, spelt)

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, ENCODED + ", text string" * with_text)


def _encoded(keys: pa.Array, rows: list[tuple], spelt: tuple[np.ndarray, np.ndarray] | None) -> pa.RecordBatch:
    row, sample, ids, *numbers = zip(*rows)
    at, flat = np.concatenate([[0], np.cumsum([len(x) for x in ids])]), np.concatenate(ids)
    columns = [keys.take(pa.array(row)), pa.array(sample, pa.int32()), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat))]
    columns += [pa.array(x, pa.float64()) for x in numbers]
    names = ["doc_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion"]
    if spelt is not None:
        columns.append(_decoded(flat, at, *spelt))
        names.append("text")
    return pa.record_batch(columns, names=names)


def _decoded(flat: np.ndarray, at: np.ndarray, letters: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The texts of rows of ids (row i has flat[at[i] : at[i + 1]]), each without the space that was put before it."""
    size = (starts[1:] - starts[:-1])[flat]
    ends = np.concatenate([[0], np.cumsum(size)])
    out = letters[np.repeat(starts[flat] - ends[:-1], size) + np.arange(ends[-1])]
    bounds = ends[at]
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    keep = np.ones(len(out), bool)
    keep[bounds[full]] = False
    dropped = np.zeros(len(at), np.int64)
    dropped[1:] = np.cumsum(bounds[1:] > bounds[:-1])
    return pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer((bounds - dropped).astype(np.int32)), pa.py_buffer(out[keep])])


def piece_bytes(pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that all ids stand for, end to end, and where each id's begin."""
    out = [b""] * pieces.size
    for text, i in zip(pieces.texts, pieces.ids):
        out[i] = text.replace(chr(MARK), " ").encode()
    for b, i in enumerate(pieces.byte_ids):
        out[i] = bytes([b])
    return np.frombuffer(b"".join(out), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in out])])


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """The rows of encode() with the column text in place of ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(piece_bytes(load_pieces(model_file)))
    schema = ENCODED.replace("ids array<int>", "text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, columns = batch.column(2), list(batch.columns)
            at = ids.offsets.to_numpy().astype(np.int64)
            columns[2] = _decoded(ids.flatten().to_numpy(), at - at[0], *shared.value)
            yield pa.record_batch(columns, names=["doc_id", "sample", "text", "log_prob", "perturbed", "log_inclusion"])

    return encoded.mapInArrow(run, schema)
