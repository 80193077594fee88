"""SentencePiece encoding and decoding with Gumbel top-k sampling without replacement.

A text's lattice holds every way to write it with the pieces of a SentencePiece
vocabulary. A piece's weight falls with its rank in the vocabulary; a
segmentation's probability is the product of its pieces' weights over the sum of
all segmentations' products (a backward recursion).

The k segmentations of largest Gumbel-perturbed log-probability are a sample
without replacement. They are found by A-star search over sets of segmentations:
the root set is all of them, its bound one Gumbel draw. A set is popped at its
bound, which its best member attains; the member is drawn, and what is left of
the set is split, for each step of the member's path, into the paths that share
the steps before it and leave there. Each part's bound is a Gumbel draw of its own
mass, truncated at the bound popped. The next pop is the largest bound.

Draws are hashes of the row's key, the sample, the chunk and the step, so a row
gets the same samples wherever it is processed. Pieces never cross from a
letter to a space, so texts are cut into chunks there, and chunks that recur are
compiled once per worker, in tables of bounded size.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.llm.workers import releasing

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
GROUPED_BYTES = 64
#: Bytes of text whose chunks are compiled together, of chunks over GROUPED_BYTES among them, and of text that is sampled together.
LEARNED_AT_ONCE, LONG_AT_ONCE, SAMPLED_AT_ONCE = 8 << 20, 1 << 20, 1 << 20
_RADIX, _MIX, _SLOTS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), 1 << 18
_ODD = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD1B54A32D192ED03)]
_ODD_INTS, _ALL = [int(x) for x in _ODD], (1 << 64) - 1
#: So few chunks are walked one by one.
FEW = 16
_BELOW_ONE = float(np.nextafter(1, 0))


def _model_path(model: str) -> str:
    if "/" in model:
        return model
    import public_tokenizers

    return public_tokenizers.path(model)


@cache
def read_vocabulary(model: str = MODEL) -> tuple[dict[bytes, int], dict[int, int]]:
    """Ids of the pieces, by their bytes (a space for the space sign), and of the single bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=_model_path(model))
    pieces, single = {}, {}
    for i in range(sp.get_piece_size()):
        text = sp.id_to_piece(i)
        if sp.is_byte(i):
            single[int(text[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i)):
            pieces[text.replace(SPACE, " ").encode()] = i
    return pieces, single


def decode(ids: list[int], model: str = MODEL) -> str:
    """The text that ids stand for, less the space that encoding puts in front."""
    by_id = _bytes_by_id(model)
    return b"".join(by_id[i] for i in ids)[1:].decode("utf-8", "replace")


@cache
def _bytes_by_id(model: str) -> dict[int, bytes]:
    pieces, single = read_vocabulary(model)
    return {i: p for p, i in pieces.items()} | {i: bytes([b]) for b, i in single.items()}


def chunks_of(text: str | None) -> list[bytes]:
    """A text's chunks, each without the first of the spaces it starts with."""
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return []
    if b"  " not in data and data[0] != 32 and data[-1] != 32:
        return data.split(b" ")
    return [c[1:] for c in re.findall(rb" +[^ ]*", b" " + data)]


class CompiledChunks:
    """Lattices of chunks as edges in one array.

    A node's edges stand together; a node is named by its first edge. For each edge: the cumulated probability in its node, its log,
    the next node (-1: the chunk ends) and the id.
    """

    def __init__(self, model: str, most_edges: int = 12_000_000):
        self.pieces, self.single = read_vocabulary(model)
        n_ids = max([*self.pieces.values(), *self.single.values()]) + 1
        self.weights = np.full(n_ids + 1, -np.inf)
        for rank, i in enumerate(sorted(self.pieces.values())):
            self.weights[i] = -np.log(rank + 2)
        for i in self.single.values():
            self.weights[i] = -np.log(len(self.pieces) + 2)
        self.odds = np.exp(self.weights)
        self.none, self.longest = n_ids, max(map(len, self.pieces))
        self.byte_ids = np.array([self.single.get(b, n_ids) for b in range(256)])
        self.powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(GROUPED_BYTES + 1, _RADIX))), dtype=np.uint64)
        self.hashes, self.ids, self.steps = np.zeros(_SLOTS + 4096, np.uint64), np.full(_SLOTS + 4096, n_ids, np.int64), 1
        for p, i in self.pieces.items():
            h = np.uint64(self._hash_one(p))
            at = first = self._slot(int(h))
            while self.hashes[at]:
                at += 1
            self.hashes[at], self.ids[at], self.steps = h, i, max(self.steps, at - first + 1)
        # A bit for each start of a piece, by 22 bits of its hash; strays only cost a look-up.
        self.begins = np.zeros(1 << 22, bool)
        for start in {p[:n] for p in self.pieces for n in range(1, len(p) + 1)}:
            self.begins[(self._hash_one(start) * int(_MIX) % (1 << 64)) >> 42] = True
        self.most_edges = most_edges
        self.forget()

    @staticmethod
    def _hash_one(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_RADIX) + b + 1) % (1 << 64)
        return h

    @staticmethod
    def _slot(h: int) -> int:
        return (h * int(_MIX) % (1 << 64)) >> 46

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.n = 0
        self.cdf = self.log_q = self.next = self.piece = None  # freed before room is taken anew
        self.cdf, self.log_q = np.empty(self.most_edges), np.empty(self.most_edges, np.float32)
        self.next, self.piece = np.empty(self.most_edges, np.int32), np.empty(self.most_edges, np.uint16)

    def learn(self, chunks: list[bytes]) -> None:
        """Compile the chunks, each given once, that are not known yet."""
        new = [c for c in chunks if c not in self.known]
        if self.n + 4 * sum(map(len, new)) + 4 * len(new) > self.most_edges:
            self.forget()
            new = chunks
        by_length: dict[int, list[bytes]] = {}
        for c in new:
            by_length.setdefault(len(c) + 1, []).append(c)
        for length, group in by_length.items():
            if length <= GROUPED_BYTES:
                self._add(length, group, self._edges(length, group))
            else:
                for c in group:
                    self._add_long(c)

    def _find(self, h: np.ndarray) -> np.ndarray:
        slot = (h * _MIX >> np.uint64(46)).astype(np.int64)
        found = np.where(self.hashes[slot] == h, self.ids[slot], self.none)
        for step in range(1, self.steps):
            miss = np.flatnonzero((found == self.none) & (self.hashes[slot + step - 1] != 0))
            if not len(miss):
                break
            found[miss] = np.where(self.hashes[slot[miss] + step] == h[miss], self.ids[slot[miss] + step], self.none)
        return found

    def _edges(self, length: int, group: list[bytes]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, chunks, ids) of all edges of chunks of one length, a chunk once each."""
        rows = np.frombuffer(b"".join(b" " + c for c in group), np.uint8).reshape(-1, length)
        sums = np.zeros((length + 1, len(group)), np.uint64)
        for k in range(length):
            sums[k + 1] = sums[k] * _RADIX + rows[:, k].astype(np.uint64) + np.uint64(1)
        out, alone = [], {}
        for i in range(length):
            live, start = np.arange(len(group)), sums[i]
            for j in range(i + 1, min(length, i + self.longest) + 1):
                h = sums[j][live] - start * self.powers[j - i]
                begins = self.begins[(h * _MIX >> np.uint64(42)).astype(np.int64)]  # else no piece starts like this
                live, start, h = live[begins], start[begins], h[begins]
                if not len(live):
                    break
                found = self._find(h)
                is_piece = found != self.none
                hit = live[is_piece]
                if j - i <= 4:
                    alone[i, j - i] = np.zeros(len(group), bool)
                    alone[i, j - i][hit] = True
                if len(hit):
                    out.append((i, j, hit, found[is_piece]))
        # Bytes of characters that are no piece by themselves are edges of their own.
        none = np.zeros(len(group), bool)
        width = np.where(rows < 0x80, 1, np.where(rows < 0xC0, 0, np.where(rows < 0xE0, 2, np.where(rows < 0xF0, 3, 4))))
        for i in range(length):
            for w in (1, 2, 3, 4):
                if i + w <= length:
                    bare = np.flatnonzero((width[:, i] == w) & ~alone.get((i, w), none))
                    for k in range(w if len(bare) else 0):
                        out.append((i + k, i + k + 1, bare, self.byte_ids[rows[bare, i + k]]))
        return out

    def _add(self, length: int, group: list[bytes], edges: list[tuple[int, int, np.ndarray, np.ndarray]]) -> None:
        # Products of up to GROUPED_BYTES weights stay in the range of doubles.
        n = len(group)
        beta = np.zeros((length + 1, n))
        beta[length] = 1
        for i, j, chunk, piece in sorted(edges, key=lambda e: -e[0]):
            beta[i, chunk] += beta[j, chunk] * self.odds[piece]
        degree = np.zeros((n, length + 1), np.int64)
        for i, _, chunk, _ in edges:
            degree[chunk, i] += 1
        stops = np.cumsum(degree.ravel()).reshape(n, length + 1)
        begin = stops - degree + self.n
        total, place = int(stops[-1, -1]), begin.copy()
        self._reserve(total)
        begin[:, length] = -1
        share = np.empty(total)
        for i, j, chunk, piece in edges:
            at = place[chunk, i]
            place[chunk, i] += 1
            with np.errstate(invalid="ignore"):
                share[at - self.n] = self.odds[piece] * (beta[j, chunk] / beta[i, chunk])
            self.next[at] = begin[chunk, j]
            self.piece[at] = piece
        own = slice(self.n, self.n + total)
        share = np.minimum(np.nan_to_num(share, copy=False), 1)  # not a number: where no way leads to the end
        degrees = degree[:, :length].ravel()
        first, degrees = (begin[:, :length].ravel() - self.n)[degrees > 0], degrees[degrees > 0]
        share[first[degrees == 1]] = 1  # a node's only edge leaves nothing to others, however its share is rounded
        with np.errstate(divide="ignore"):
            self.log_q[own] = np.log(share)
        sums = np.cumsum(share)
        cdf = np.minimum(sums - np.repeat(sums[first] - share[first], degrees), _BELOW_ONE)
        cdf[first + degrees - 1] = 1
        self.cdf[own] = cdf
        self.known.update(zip(group, begin[:, 0].tolist()))
        self.n += total

    def _add_long(self, chunk: bytes) -> None:
        """Compile one chunk of over GROUPED_BYTES: the edges of all its places together, and sums scaled from place to place."""
        data = np.frombuffer(b" " + chunk, np.uint8)
        n = len(data)
        width = np.where(data < 0x80, 1, np.where(data < 0xC0, 0, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))).astype(np.uint8)
        edges, bare, live, h = [], width > 0, np.arange(n, dtype=np.int32), np.zeros(n, np.uint64)
        for d in range(1, self.longest + 1):
            live = live[: np.searchsorted(live, n - d, side="right")]
            h = h[: len(live)] * _RADIX + data[live + (d - 1)].astype(np.uint64) + np.uint64(1)
            begins = self.begins[(h * _MIX >> np.uint64(42)).astype(np.int64)]  # else no piece starts like this
            live, h = live[begins], h[begins]
            if not len(live):
                break
            found = self._find(h)
            is_piece = found != self.none
            hit = live[is_piece]
            bare[hit[width[hit] == d]] = False
            if len(hit):
                edges.append((d, hit, found[is_piece].astype(np.uint16)))
        # Bytes of characters that are no piece by themselves are edges of their own.
        alone = np.concatenate([np.flatnonzero(bare & (width == w)) + k for w in (1, 2, 3, 4) for k in range(w)])
        edges.append((1, alone, self.byte_ids[data[alone]].astype(np.uint16)))
        degree = np.zeros(n, np.int64)
        for _, at, _ in edges:
            degree[at] += 1
        stops = np.cumsum(degree)
        begin, total = np.append(stops - degree + self.n, -1), int(stops[-1])
        self._reserve(total)
        place, span = begin[:-1].copy(), np.empty(total, np.uint8)
        while edges:
            d, at, piece = edges.pop(0)
            edge = place[at]
            place[at] += 1
            self.next[edge], self.piece[edge], span[edge - self.n] = begin[at + d], piece, d
        ahead = [1.0] + [0.0] * (self.longest - 1)
        for stop in range(n, 0, -8192):
            start = max(0, stop - 8192)
            own = slice(int(begin[start]), self.n + int(stops[stop - 1]))
            share, cdf, ahead = self._shares(degree[start:stop].tolist(), self.odds[self.piece[own]].tolist(), span[own.start - self.n : own.stop - self.n].tolist(), ahead)
            with np.errstate(divide="ignore"):
                self.log_q[own] = np.log(share)
            self.cdf[own] = cdf
        self.known[chunk] = int(begin[0])
        self.n += total

    def _shares(self, degree: list[int], odds: list[float], span: list[int], ahead: list[float]) -> tuple[list[float], list[float], list[float]]:
        """Probabilities of edges in their nodes, the same cumulated, and the sums of the first places, from those of the places behind.

        Sums are multiples of the true ones: before they leave the range of doubles, all that are still of use are scaled alike.
        """
        sums, share, cdf, at = [0.0] * len(degree) + ahead, [1.0] * len(odds), [1.0] * len(odds), len(odds)
        for i in range(len(degree) - 1, -1, -1):
            stop, at = at, at - degree[i]
            total = 0.0
            for e in range(at, stop):
                share[e] = part = odds[e] * sums[i + span[e]]
                total += part
            sums[i] = total
            if stop - at == 1:
                share[at] = 1.0
            elif total:
                so_far = 0.0
                for e in range(at, stop):
                    share[e] /= total
                    so_far += share[e]
                    cdf[e] = min(so_far, _BELOW_ONE)
                cdf[stop - 1] = 1.0
            if 0 < total < 1e-60:
                for m in range(i, i + self.longest):
                    sums[m] /= total
        return share, cdf, sums[: self.longest]

    def _reserve(self, total: int) -> None:
        """Room for so many edges more: chunks can have more than the table foresees."""
        if self.n + total > len(self.cdf):
            more = max(self.n + total, len(self.cdf) * 5 // 4) - len(self.cdf)
            for name in ("cdf", "log_q", "next", "piece"):
                own = getattr(self, name)
                setattr(self, name, np.concatenate((own, np.empty(more, own.dtype))))


def mixed(key: np.ndarray, *counters: np.ndarray | int) -> np.ndarray:
    """64-bit hashes of the key and the counters."""
    h = np.atleast_1d(np.asarray(key, np.uint64))
    for c in counters:
        h = h + (np.atleast_1d(c).astype(np.uint64) + np.uint64(1)) * _ODD[2]
        h = (h ^ (h >> np.uint64(30))) * _ODD[0]
        h = (h ^ (h >> np.uint64(27))) * _ODD[1]
        h ^= h >> np.uint64(31)
    return h


def mixed_one(key: int, *counters: int) -> int:
    """:func:`mixed` of single numbers."""
    for c in counters:
        key = key + (c + 1) * _ODD_INTS[2] & _ALL
        key = (key ^ key >> 30) * _ODD_INTS[0] & _ALL
        key = (key ^ key >> 27) * _ODD_INTS[1] & _ALL
        key ^= key >> 31
    return key


def uniform(key: np.ndarray | int, *counters: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the key and the counters alone."""
    return ((mixed(key, *counters) >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


def uniform_one(key: int, *counters: int) -> float:
    return ((mixed_one(key, *counters) >> 12) + 0.5) / (1 << 52)


def _bounds(mass: np.ndarray, most: float, u: np.ndarray) -> np.ndarray:
    """Gumbel draws with these log masses, truncated at ``most``."""
    with np.errstate(divide="ignore"):
        return mass - np.log(np.exp(mass - most) - np.log(u))


class _Path:
    """A sampled segmentation: its edges and their nodes, and the bounds of the sets that leave it at each step.

    Sets that leave after steps so unlikely that none is expected to be popped
    are kept together as one, the last bound; it is taken apart if it is.
    """

    def __init__(self, nodes: np.ndarray, edges: np.ndarray, chunk: np.ndarray, log_q: np.ndarray, score: float, key: int, number: int, own_from: int, together_below: float):
        self.nodes, self.edges, self.chunk, self.score, self.key, self.number = nodes, edges, chunk, score, key, number
        n, looked = len(edges), 64
        self.before = np.zeros(n + 1)
        np.cumsum(log_q, out=self.before[1:])
        while looked < n and self.before[looked] > together_below:
            looked *= 4
        self.apart = max(own_from, int(np.searchsorted(-self.before[:n][: looked + 1], -together_below)))
        self.left_out: dict[int, list[int]] = {}
        mass = self.before[: self.apart + 1].copy()
        with np.errstate(divide="ignore"):
            mass[:-1] += np.log(-np.expm1(log_q[: self.apart]))
            mass[-1] += np.log(-np.expm1(self.before[-1] - self.before[self.apart])) if self.apart < n else -np.inf
        self.bound = _bounds(mass, score, uniform(mixed_one(key, number, 0, 2), np.arange(self.apart + 1)))
        self.bound[:own_from] = -np.inf

    def take_apart(self) -> int:
        """Split the last set, just popped; the part that attains its bound."""
        score, log_q = float(self.bound[-1]), np.diff(self.before[self.apart :])
        with np.errstate(divide="ignore"):
            mass = self.before[self.apart : -1] + np.log(-np.expm1(log_q))
        steps = np.arange(self.apart, len(self.edges))
        share = np.cumsum(np.exp(mass - mass.max()))
        first = min(int(np.searchsorted(share, uniform_one(self.key, self.number, 3, 6) * share[-1], side="right")), len(steps) - 1)
        parts = _bounds(mass, score, uniform(mixed_one(self.key, self.number, 0, 7), steps))
        parts[first] = score
        self.bound, self.apart = np.append(np.append(self.bound[:-1], parts), -np.inf), len(self.edges)
        return int(steps[first])


def _walk(table: CompiledChunks, key: np.uint64, step: int, node: int) -> tuple[np.ndarray, np.ndarray]:
    """One chunk's nodes and edges from a node to its end, step by step."""
    nodes, edges, draws = array("q"), array("q"), 32
    cdf, following = table.cdf.item, table.next.item
    while node >= 0:
        for u in uniform(key, np.arange(step, step + draws)).tolist():
            edge = node
            while u >= cdf(edge):
                edge += 1
            nodes.append(node)
            edges.append(edge)
            node = following(edge)
            if node < 0:
                break
        step, draws = step + draws, min(2 * draws, 4096)
    return np.array(nodes, np.int64), np.array(edges, np.int64)


Chunked = tuple[np.ndarray, np.ndarray, list[bytes]]


def chunked(texts: list[str | None]) -> Chunked:
    """How many chunks each text has, each chunk's place among the distinct ones, and those."""
    chunks = [chunks_of(t) for t in texts]
    coded = pa.array(chain.from_iterable(chunks), pa.binary()).dictionary_encode()
    return np.array([len(c) for c in chunks], np.int64), coded.indices.to_numpy(), coded.dictionary.to_pylist()


def sample_segmentations(
    table: CompiledChunks, texts: list[str | None], keys: np.ndarray, k: int, together_below: float = -40.0, cut: Chunked | None = None
) -> list[list[tuple[float, float, float, np.ndarray]]]:
    """For each text up to ``k`` (perturbed score, log probability, log inclusion score, ids), best first.

    ``cut``: the texts as :func:`chunked`, if the table knows the chunks already.
    """
    counts, codes, distinct = cut or chunked(texts)
    if cut is None:
        table.learn(distinct)
    begin = np.concatenate(([0], np.cumsum(counts)))
    start = np.fromiter(map(table.known.__getitem__, distinct), np.int64, len(distinct))[codes]
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(begin[-1]) - begin[doc]

    def draw(number: int, at: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Walk the chunks ``at`` from their states to their ends: chunk, node and edge of each step, by chunk."""
        seen, step, own = [], 0, mixed(mixed(keys, number, 1)[doc[at]], place[at])
        while len(at) > FEW:
            u = uniform(own, step)
            edge = state.copy()
            late = np.flatnonzero(u >= table.cdf[edge])
            while len(late):
                edge[late] += 1
                late = late[u[late] >= table.cdf[edge[late]]]
            seen.append((at, state, edge))
            state = table.next[edge].astype(np.int64)
            go = state >= 0
            at, state, own, step = at[go], state[go], own[go], step + 1
        for c, node, key in zip(at.tolist(), state.tolist(), own):
            nodes, edges = _walk(table, key, step, node)
            seen.append((np.full(len(nodes), c), nodes, edges))
        if not seen:
            return (np.zeros(0, np.int64),) * 3
        chunk, node, edge = (np.concatenate(x) for x in zip(*seen))
        order = np.argsort(chunk, kind="stable")
        return chunk[order], node[order], edge[order]

    chunk, node, edge = draw(0, np.arange(begin[-1]), start)
    cut = np.searchsorted(chunk, begin)
    first = -np.log(-np.log(uniform(keys, 0, 0, 3)))
    paths = [
        [_Path(node[a:b], edge[a:b], chunk[a:b], table.log_q[edge[a:b]].astype(np.float64), float(first[d]), int(keys[d]), 0, 0, together_below)]
        for d, (a, b) in enumerate(zip(cut, cut[1:]))
    ]
    for number in range(1, k):
        popped, at, state = {}, [], []
        for d, own in enumerate(paths):
            score, path, step = _best(own)
            if path is None:
                continue
            if step == path.apart:
                step = path.take_apart()
            new = _leave(table, path, step, int(keys[d]), number, score)
            popped[d] = (score, path, step, new)
            here = path.chunk[step]
            later = np.arange(here + 1, begin[d + 1])
            if table.next[new] >= 0:
                at.append([here])
                state.append([table.next[new]])
            at.append(later)
            state.append(start[later])
        if not popped:
            break
        chunk, node, edge = draw(number, np.concatenate(at).astype(np.int64), np.concatenate(state).astype(np.int64)) if at else draw(number, np.zeros(0, np.int64), np.zeros(0, np.int64))
        for d, (score, path, step, new) in popped.items():
            a, b = np.searchsorted(chunk, begin[d]), np.searchsorted(chunk, begin[d + 1])
            nodes = np.concatenate((path.nodes[: step + 1], node[a:b]))
            edges = np.concatenate((path.edges[:step], [new], edge[a:b]))
            where = np.concatenate((path.chunk[: step + 1], chunk[a:b]))
            paths[d].append(_Path(nodes, edges, where, table.log_q[edges].astype(np.float64), score, int(keys[d]), number, step + 1, together_below))
    out = []
    for own in paths:
        threshold = _best(own)[0]
        with np.errstate(over="ignore", divide="ignore"):
            rows = []
            for p in own:
                x = p.before[-1] - threshold
                rows.append((p.score, p.before[-1], float(x if x < -30 else np.log(-np.expm1(-np.exp(x)))), table.piece[p.edges]))
        out.append(rows)
    return out


def _best(paths: list[_Path]) -> tuple[float, _Path | None, int]:
    """The largest bound of a set not popped yet: the bound, the path it leaves and where."""
    score, path, step = -np.inf, None, 0
    for p in paths:
        t = int(p.bound.argmax())
        if p.bound[t] > score:
            score, path, step = float(p.bound[t]), p, t
    return score, path, step


def _leave(table: CompiledChunks, path: _Path, step: int, key: int, number: int, score: float) -> int:
    """Draw the edge by which the popped set's best member leaves the path, and bound what is left of the set."""
    node = int(path.nodes[step])
    edges = [node]
    while table.cdf[edges[-1]] < 1:
        edges.append(edges[-1] + 1)
    gone = path.left_out.setdefault(step, [int(path.edges[step])])
    open_ = [e for e in edges if e not in gone]
    q = np.exp(table.log_q[open_].astype(np.float64))
    u = uniform_one(key, number, step, 1, 4)
    new = open_[min(int(np.searchsorted(np.cumsum(q), u * q.sum(), side="right")), len(open_) - 1)]
    gone.append(new)
    rest = sum(x for e, x in zip(open_, q) if e != new)
    path.bound[step] = -np.inf
    if rest > 0:
        path.bound[step] = _bounds(path.before[step] + np.log(rest), score, uniform_one(key, number, step, 2, 5))
    return new


@cache
def _compiled(model: str) -> CompiledChunks:
    return CompiledChunks(model)


def sample_encodings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 2, model: str = MODEL, seed: int = 17, with_ids: bool = True
) -> DataFrame:
    """Up to ``k`` distinct segmentations of each row's text, sampled without replacement.

    Columns: ``doc_id, sample_no`` (from 1, best first), ``perturbed`` (the
    Gumbel-perturbed log-probability), ``log_prob`` (natural log), ``log_inclusion`` (log of
    the chance to be in a sample with this threshold; importance weights are
    exp(log_prob - log_inclusion)), ``n_ids``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit numbers) and, ``with_ids``, ``ids``. :func:`decode`
    gives the text back exactly.

    A null or empty text has one segmentation, without ids. A text with fewer than
    ``k`` segmentations gives them all. Draws depend on the seed and the id, so
    repeated rows get equal samples, as do all rows with a null id and equal text.
    Other columns are not read. An empty table gives no rows. A text is sampled whole, by one
    task, which needs about 120 bytes of memory for each of its bytes, 160 where there are no
    spaces, 300 in a run of one letter and 620 in a run of spaces.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("long"), F.lit(seed)).alias("key"))
    names = ["doc_id", "sample_no", "perturbed", "log_prob", "log_inclusion", "n_ids", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _compiled(model)
        for batch in batches:
            for large in parts_of(batch, LEARNED_AT_ONCE):
                parts = list(parts_of(large, SAMPLED_AT_ONCE))
                cuts = [chunked(p.column(1).to_pylist()) for p in parts]
                for together in groups_of(cuts):
                    table.learn(list(set().union(*(cuts[n][2] for n in together))))
                    for n in together:
                        keys = parts[n].column(2).to_numpy().astype(np.int64).view(np.uint64)
                        yield rows_of(parts[n].column(0).to_pylist(), sample_segmentations(table, [], keys, k, cut=cuts[n]))

    def groups_of(cuts: list[Chunked]) -> Iterator[list[int]]:
        """Numbers of parts that are learned together: all, unless they have many bytes of long chunks, which have most edges."""
        together, held = [], 0
        for n, (_, _, distinct) in enumerate(cuts):
            own = sum(len(c) for c in distinct if len(c) >= GROUPED_BYTES)
            if together and held + own > LONG_AT_ONCE:
                yield together
                together, held = [], 0
            together.append(n)
            held += own
        yield together

    def parts_of(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy() + 64)
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + size)) + 1
            yield batch.slice(first, last - first)
            first = last

    def rows_of(ids: list[int], sampled: list[list[tuple]]) -> pa.RecordBatch:
        out = []
        for doc_id, own in zip(ids, sampled):
            for n, (score, log_prob, inclusion, found) in enumerate(own):
                out.append((doc_id, n + 1, score, log_prob, inclusion, len(found), zlib.crc32(found.astype("<u4").tobytes())))
        columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
        if with_ids:
            stops = np.cumsum([0] + [len(row[3]) for own in sampled for row in own], dtype=np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate([row[3] for own in sampled for row in own]).astype(np.int32))))
        return pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, sample_no int, perturbed double, log_prob double, log_inclusion double, n_ids long, ids_crc32 long"
    return rows.mapInArrow(releasing(work), schema + ", ids array<int>" * with_ids)


def decode_encodings(encoded: DataFrame, ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """The rows with a column ``text`` added: what the ids of ``ids_col`` stand for, as :func:`decode` gives it.

    Null ids, and ids of which one is no piece, give a null text; no ids give an
    empty one. Other columns are kept. An empty table gives no rows.
    """
    if "text" in encoded.columns:
        raise ValueError("the rows have a column text already")
    at = encoded.columns.index(ids_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = _bytes_by_id(model)
        none = max(by_id) + 1
        pieces = pa.array([by_id.get(i) for i in range(none + 1)], pa.binary())
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                ids = part.column(at)
                flat = pc.fill_null(ids.flatten(), none).to_numpy(zero_copy_only=False)
                stops = np.cumsum(np.concatenate(([0], pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))))
                found = pieces.take(pa.array(np.where((flat >= 0) & (flat < none), flat, none)))
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(stops, pa.int32()), found), b"")
                texts = [b[1:].decode("utf-8", "replace") if valid and b is not None else None for b, valid in zip(joined.to_pylist(), ids.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "text"])

    return encoded.mapInArrow(releasing(work), T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())]))
