"""LM scoring by subword lattice likelihood.

The vocabulary is an existing one: the pieces of a public word-level BPE, some of
which end a word, and beside them the whole words met in training. A word's
probability is the sum over all segmentations of the products of their unigram
scores: the word as one unit, and every way to spell it from pieces of which the
last and only the last ends a word. The sums are found by a forward recursion in
log space; a document adds an end symbol.

Whole words have their training counts less an absolute discount; the mass that
the discount frees goes to the spellings. The pieces' scores start from the
vocabulary's own order (a piece's weight falls with its rank) and are
re-estimated by expectation maximisation over all distinct training words, each
once, as the spellings stand for words not met before.

Words are scored once each, in a table of distinct words. Texts then look up
their words: a bounded number of the most frequent ones in a copy on each worker,
the rest by a join on the word.
"""

from __future__ import annotations

import json
import math
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.scratch import stage
from tilewright.llm.word_tokens import byte_names
from tilewright.llm.workers import releasing

VOCABULARY = "word_bpe_49k.json"
_RADIX, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SLOTS = 1 << 18
#: Words longer than this are scored and learned from one by one; shorter ones, all of a length at once.
GROUPED_BYTES = 48
_SCALE = 1000.0
#: A word that meets odds below this in its group is done by itself, in logs: no step from here on can leave the range of doubles.
_LEAST = 1e-100


@cache
def read_pieces(vocabulary: str = VOCABULARY) -> tuple[tuple[bytes, bool], ...]:
    """(bytes, ends a word) of every piece but the special ones, in the vocabulary's order."""
    if "/" not in vocabulary:
        import public_tokenizers

        vocabulary = public_tokenizers.path(vocabulary)
    with open(vocabulary, encoding="utf-8") as f:
        model = json.load(f)
    special, names = {t["content"] for t in model["added_tokens"]}, byte_names()
    ranked = sorted((i, t) for t, i in model["model"]["vocab"].items() if t not in special)
    return tuple((bytes(names[c] for c in t.removesuffix("</w>")), t.endswith("</w>")) for _, t in ranked)


class Lattice:
    """Natural-log scores of the pieces, and forward and backward recursions over words.

    Words of up to ``GROUPED_BYTES`` go in groups of one length. Their recursions multiply odds instead of adding logs:
    each piece's odds are its probability times ``_SCALE`` for each of its bytes, so that most words' products stay in the range of doubles.
    Words whose products come near its end (:meth:`lost`) and longer words go one by one, in logs; that takes 8 bytes of memory a byte.
    """

    def __init__(self, pieces: tuple[tuple[bytes, bool], ...], scores: np.ndarray):
        self.scores = np.append(scores, -np.inf)  # the last is for what is no piece
        self.odds = np.exp(self.scores + np.append([len(p) for p, _ in pieces], 0) * math.log(_SCALE))
        self.values = self.scores.tolist()
        self.longest = max(len(p) for p, _ in pieces)
        self.plain = {p: i for i, (p, ends) in enumerate(pieces) if not ends}
        self.final = {p: i for i, (p, ends) in enumerate(pieces) if ends}
        self.powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(GROUPED_BYTES, _RADIX))), dtype=np.uint64)
        self.tables = [self._table(t) for t in (self.plain, self.final)]

    def _table(self, pieces: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
        """An open-addressed table: hashes and piece numbers by the top 18 bits of the hash, the most steps to the right slot, and
        which hashes (by 22 bits) some piece starts like; strays there only cost a look-up."""
        words = list(pieces)
        hashes, ids, most, begins = np.zeros(_SLOTS + 4096, np.uint64), np.full(_SLOTS + 4096, len(self.scores) - 1, np.int32), 1, np.zeros(1 << 22, bool)
        for length in {len(p) for p in words}:
            own = [p for p in words if len(p) == length]
            prefixes = self._prefixes(np.frombuffer(b"".join(own), np.uint8).reshape(-1, length))
            begins[(prefixes[:, 1:].ravel() * _MIX >> np.uint64(42)).astype(np.int64)] = True
            for p, h, first in zip(own, prefixes[:, -1], (prefixes[:, -1] * _MIX >> np.uint64(46)).tolist()):
                at = first
                while hashes[at]:
                    at += 1
                hashes[at], ids[at], most = h, pieces[p], max(most, at - first + 1)
        return hashes, ids, most, begins

    @staticmethod
    def _prefixes(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), rows.shape[1] + 1), np.uint64)
        for k in range(rows.shape[1]):
            out[:, k + 1] = out[:, k] * _RADIX + rows[:, k].astype(np.uint64) + np.uint64(1)
        return out

    def _find(self, h: np.ndarray, mixed: np.ndarray, table: int) -> np.ndarray:
        hashes, ids, most, _ = self.tables[table]
        none, slot = len(self.scores) - 1, (mixed >> np.uint64(46)).astype(np.int64)
        found = np.where(hashes[slot] == h, ids[slot], none)
        for step in range(1, most):
            miss = np.flatnonzero((found == none) & (hashes[slot + step - 1] != 0))
            if not len(miss):
                break
            there = slot[miss] + step
            found[miss] = np.where(hashes[there] == h[miss], ids[there], none)
        return found

    def edges(self, words: list[bytes]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, words, their pieces) of all edges of words of one length, by rising end."""
        length, none = len(words[0]), len(self.scores) - 1
        sums = np.ascontiguousarray(self._prefixes(np.frombuffer(b"".join(words), np.uint8).reshape(-1, length)).T)
        out, every = [], np.arange(len(words))
        for i in range(length):
            live, start = every, sums[i]
            for j in range(i + 1, min(length, i + self.longest) + 1):
                last = j == length
                if last and length - i > 1:  # pieces that end a word are others: what no plain piece starts like may be one
                    live, start = every, sums[i]
                h = sums[j][live] - start * self.powers[j - i]
                mixed = h * _MIX
                if last:
                    found = self._find(h, mixed, 1)
                    hit = np.flatnonzero(found != none)
                    if len(hit):
                        out.append((i, j, live[hit], found[hit]))
                    break
                begins = np.flatnonzero(self.tables[0][3][(mixed >> np.uint64(42)).astype(np.int64)])  # else no piece starts like this
                if len(begins) < len(live):
                    live, start, h, mixed = live[begins], start[begins], h[begins], mixed[begins]
                if len(live):
                    found = self._find(h, mixed, 0)
                    hit = np.flatnonzero(found != none)
                    if len(hit):
                        out.append((i, j, live[hit], found[hit]))
        return sorted(out, key=lambda e: e[1])

    def forward(self, n: int, length: int, edges: list[tuple[int, int, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Sums of the odds of all ways to each place."""
        alpha = np.zeros((length + 1, n))
        alpha[0] = 1
        for i, j, word, piece in edges:
            alpha[j, word] += alpha[i, word] * self.odds[piece]
        return alpha

    @staticmethod
    def lost(sums: np.ndarray) -> np.ndarray:
        """Which words (columns) have sums too small to go on with, or none at the end."""
        return ((sums > 0) & (sums < _LEAST)).any(axis=0) | (sums[-1] == 0)

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Natural logs of the words' probabilities."""
        out = np.empty(len(words))
        for length, at in _by_length(words).items():
            if length > GROUPED_BYTES:
                out[at] = [self._forward_one(words[k])[-1] for k in at]
                continue
            group = [words[k] for k in at]
            alpha = self.forward(len(group), length, self.edges(group))
            with np.errstate(divide="ignore"):
                out[at] = np.log(alpha[-1]) - length * math.log(_SCALE)
            for k in at[self.lost(alpha)]:
                out[k] = self._forward_one(words[k])[-1]
        return out

    def _forward_one(self, word: bytes) -> array:
        """Logs of the sums of all ways to each place."""
        n, alpha = len(word), array("d", [0.0])
        for j in range(1, n + 1):
            pieces = self.final if j == n else self.plain
            alpha.append(_log_sum([alpha[i] + self.values[p] for i in range(max(0, j - self.longest), j) if (p := pieces.get(word[i:j])) is not None]))
        return alpha

    def _expect_one(self, word: bytes, times: float, out: np.ndarray) -> None:
        """Adds one word's expected counts to ``out``."""
        n, alpha = len(word), self._forward_one(word)
        if alpha[-1] == -math.inf:
            return
        beta = array("d", bytes(8 * n)) + array("d", [0.0])
        for i in range(n - 1, -1, -1):
            ways = []
            for j in range(i + 1, min(n, i + self.longest) + 1):
                p = (self.final if j == n else self.plain).get(word[i:j])
                if p is not None and beta[j] > -math.inf:
                    ways.append(way := self.values[p] + beta[j])
                    out[p] += times * math.exp(alpha[i] + way - alpha[-1])
            beta[i] = _log_sum(ways)

    def expected_counts(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """How often each piece is expected when word k occurs ``times[k]`` times; a word that cannot be spelled adds nothing."""
        out = np.zeros(len(self.scores))
        for length, at in _by_length(words).items():
            if length > GROUPED_BYTES:
                for k in at:
                    self._expect_one(words[k], times[k], out)
                continue
            group = [words[k] for k in at]
            edges = self.edges(group)
            alpha = self.forward(len(group), length, edges)
            beta = np.zeros_like(alpha)
            beta[-1] = 1
            for i, j, word, piece in reversed(edges):
                beta[i, word] += beta[j, word] * self.odds[piece]
            alone = self.lost(alpha) | self.lost(beta[::-1])
            for k in at[alone]:
                self._expect_one(words[k], times[k], out)
            beta *= np.where(alone, 0, times[at] / np.where(alone, 1, alpha[-1]))
            if edges:
                used = np.concatenate([piece for *_, piece in edges])
                out += np.bincount(used, np.concatenate([alpha[i, word] * self.odds[piece] * beta[j, word] for i, j, word, piece in edges]), len(out))
        return out[:-1]


def _log_sum(logs: list[float]) -> float:
    top = max(logs, default=-math.inf)
    return top + math.log(sum(math.exp(x - top) for x in logs)) if top > -math.inf else top


def _by_length(words: list[bytes]) -> dict[int, np.ndarray]:
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(words) else []
    return {int(lengths[p[0]]): p for p in parts}


def large_batches(batches: Iterator[pa.RecordBatch], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about so many: words of one length are handled together, which pays in large groups."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").lower().split()


def count_words(rows: DataFrame) -> DataFrame:
    """``word, in_training, in_all`` over ``text, training``: every distinct word of every text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {True: Counter(), False: Counter()}

        def told() -> pa.RecordBatch:
            words = list(seen[True].keys() | seen[False].keys())
            training = np.array([seen[True][w] for w in words], np.int64)
            every = training + np.array([seen[False][w] for w in words], np.int64)
            seen[True].clear(), seen[False].clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(training), pa.array(every)], ["word", "in_training", "in_all"])

        for batch in batches:
            for text, training in zip(batch.column(0), batch.column(1).to_pylist()):
                seen[training].update(words_of(text.as_py()))
                if len(seen[True]) + len(seen[False]) > 400_000:
                    yield told()
        yield told()

    parts = rows.mapInArrow(releasing(count), "word binary, in_training long, in_all long")
    return parts.groupBy("word").agg(F.sum("in_training").alias("in_training"), F.sum("in_all").alias("in_all"))


def fit_scores(words: DataFrame, vocabulary: str = VOCABULARY, rounds: int = 3) -> np.ndarray:
    """Natural-log scores of the pieces from ``word, in_training``.

    Each round is one pass over all distinct training words; a sum per piece
    reaches the driver, bounded by the vocabulary. Every piece keeps a tenth of a
    count, so that any bytes can be spelled.
    """
    pieces = read_pieces(vocabulary)
    weights = 1 / (2.0 + np.arange(len(pieces)))
    scores = np.log(weights / weights.sum())
    for _ in range(rounds):
        lattice_scores = scores

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, total = Lattice(read_pieces(vocabulary), lattice_scores), np.zeros(len(lattice_scores))
            for batch in large_batches(batches):
                total += lattice.expected_counts(batch.column(0).to_pylist(), np.ones(batch.num_rows))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["piece", "times"])

        training = words.where("in_training > 0").select("word")
        times = np.full(len(pieces), 0.1)
        for row in training.mapInArrow(releasing(expect), "piece long, times double").groupBy("piece").agg(F.sum("times").alias("times")).collect():
            times[row["piece"]] += row["times"]
        scores = np.log(times / times.sum())
    return scores


def score_documents(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    rounds: int = 3,
    most_frequent: int = 150_000,
) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from rows that are not ``held_out`` (null: learned from).
    Tokens are a text's words and one end. ``base_score`` is an add-0.1 unigram
    model over whole tokens; ``score`` the lattice model's log10 probability of
    the text. A null or empty text is the end token alone. Without training rows
    the vocabulary's own weights are used, N and V are 0, and a token is the end
    with probability one half. Repeated rows are each
    scored and each learned from. ``most_frequent`` bounds the words that are
    copied to workers (64 bytes each at most); it changes no result. A word of any length is scored whole, in time
    and memory proportional to it. Other columns are not
    read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts = stage(count_words(rows.select("text", (~F.col("held_out")).alias("training"))), "word-counts")
    n_docs = rows.where(~F.col("held_out")).count()
    c = F.col("in_training")
    n_words, n_kinds, once, twice = counts.agg(F.coalesce(F.sum(c), F.lit(0)), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2)).first()
    n_train, n_distinct = n_words + n_docs, n_kinds + (n_docs > 0)
    scores = fit_scores(counts, vocabulary, rounds)
    whole = np.log10(n_train + 0.1 * (n_distinct + 1))
    discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))  # leave-one-out estimate
    spelled = discount * n_kinds / n_train if n_kinds else 0.5  # the share of tokens that are spelled
    end_model = float(np.log10(n_docs / n_train if n_kinds else 0.5))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(read_pieces(vocabulary), scores)
        for batch in large_batches(batches):
            times = batch.column(1).to_numpy()
            base = np.log10(times + 0.1) - whole
            as_unit = np.full(len(times), -np.inf)
            as_unit[times > 0] = np.log((times[times > 0] - discount) / n_train)
            spellings = lattice.log_probabilities(batch.column(0).to_pylist()) + np.log(spelled)
            model = np.logaddexp(as_unit, spellings) / np.log(10)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(base), pa.array(model)], ["word", "in_training", "in_all", "base", "model"])

    rated = stage(counts.mapInArrow(releasing(rate), "word binary, in_training long, in_all long, base double, model double"), "word-scores")
    short = rated.where(F.octet_length("word") <= 64)
    frequent = short.orderBy(F.desc("in_all"), "word").limit(most_frequent).select("word", "in_training", "base", "model").toArrow()
    place = spark.sparkContext.broadcast(  # at most most_frequent rows of 64 bytes and three numbers
        (frequent["word"].to_pylist(), *(frequent[c].to_numpy() for c in ("in_training", "base", "model")))
    )
    end_base, end_known = float(np.log10(n_docs + 0.1) - whole), int(n_docs > 0)
    names = ["row_no", "doc_id", "held_out", "n_tokens", "word", "times", "n_known", "base", "model"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, in_training, base, model = place.value
        known, at = in_training > 0, {w: i for i, w in enumerate(words)}
        row_no = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                out: list[tuple] = []
                part = batch.slice(first, 256)
                for doc_id, text, held in zip(part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist()):
                    own = words_of(text.as_py())
                    found = np.fromiter((at.get(w, -1) for w in own), np.int64, len(own))
                    hit = found[found >= 0]
                    # A row for the document itself; its "word" holds a space, as no word does, and is its own.
                    out.append((row_no, doc_id, held, len(own) + 1, b" %d" % row_no, 1, known[hit].sum() + end_known, base[hit].sum() + end_base, model[hit].sum() + end_model))
                    rare = Counter(own[i] for i in np.flatnonzero(found < 0))
                    out += [(row_no, None, None, None, w, n, None, None, None) for w, n in rare.items()]
                    row_no += 1
                types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    schema = "row_no long, doc_id long, held_out boolean, n_tokens long, word binary, times long, n_known long, base double, model double"
    looked = rows.select("doc_id", "text", "held_out").mapInArrow(releasing(look_up), schema)
    rest = rated.select("word", F.col("in_training").alias("c"), F.col("base").alias("word_base"), F.col("model").alias("word_model"))
    joined = looked.join(rest, "word", "left")
    return (
        joined.groupBy("row_no")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.max("n_tokens").alias("n_tokens"),
            F.sum(F.coalesce("n_known", F.when(F.col("c") > 0, F.col("times")).otherwise(0))).cast("long").alias("n_known"),
            F.lit(n_train).cast("long").alias("train_tokens"),
            F.sum(F.coalesce("base", F.col("word_base") * F.col("times"))).alias("base_score"),
            F.sum(F.coalesce("model", F.col("word_model") * F.col("times"))).alias("score"),
        )
        .drop("row_no")
    )
