"""Substring dedup by level-wise doubling.

Windows of words are compared level by level. Only windows that occur in more
than one document at one length are extended to twice that length (less the
overlap needed to end at the wanted length exactly), until that length is reached or no
candidate survives. At the wanted length the least id that holds each surviving
window is found, and every word that a later document's copy covers is removed.

A level is one exchange of fingerprints (:mod:`tilewright.llm.slots`). Words have 128-bit
hashes. The levels below the last only rule windows out, so 40 bits of a window's
fingerprint do there; the last level compares 128 bits, of two polynomials over the two
halves of the words' hashes: with n surviving windows, n * n / 2**129 false matches are
expected, under 10**-12 for all windows of 100 TB.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.llm.scratch import stage
from tilewright.llm.slots import RollingHash, exchange, ids_of, in_two_slots, numbers_told, slot_rows, texts_of, with_answers, write_slots
from tilewright.llm.workers import releasing

_COARSE = np.uint64((1 << 24) - 1)  # low bits that the coarse levels do without
_FIRST, _SECOND = RollingHash(0x9E3779B97F4A7C15), RollingHash(0xD1B54A32D192ED03)
_BLANK = re.compile(rb"[ \t-\r]")
#: Bytes of a text whose words are held at once.
_PIECE = 1 << 20


def level_lengths(window: int, start: int) -> list[int]:
    """Ascending lengths, each at most twice the one before, from about ``start`` to ``window``."""
    if not 1 <= start <= window:
        raise ValueError("1 <= start <= window is needed")
    lengths = [window]
    while lengths[0] > start:
        lengths.insert(0, max(start, -(-lengths[0] // 2)))
    return lengths


def words_by_piece(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a piece of it at a time."""
    first = 0
    while first < len(text):
        blank = _BLANK.search(text, first + _PIECE)
        last = blank.start() if blank else len(text)
        yield text[first:last].split() if first or last < len(text) else text.split()
        first = last


class SlotWords:
    """The hashes of the words of a slot's documents and which document each is in."""

    def __init__(self, table: pa.Table):
        self.texts, self.ids, digest = texts_of(table), ids_of(table), xxhash.xxh3_128_digest
        counts, digests = [], []
        for text in self.texts:
            n = 0
            for words in words_by_piece(text):
                digests.append(b"".join(map(digest, words)))
                n += len(words)
            counts.append(n)
        self.counts = np.array(counts, np.int64)
        self.firsts = np.concatenate(([0], np.cumsum(self.counts)))
        self.doc = np.repeat(np.arange(len(counts), dtype=np.int32), self.counts)
        hashes = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
        self.sums, self.more_sums = _FIRST.sums(hashes[:, 0]), _SECOND.sums(hashes[:, 1])

    def fits(self, length: int) -> np.ndarray:
        """Where windows of this length start."""
        at = np.arange(max(0, len(self.doc) - length + 1))
        return at[self.doc[: len(at)] == self.doc[length - 1 :]]

    def coarse(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For windows that start at ``at``: distinct fingerprints, each window's among them, and which this slot has under two ids."""
        keys, which = np.unique(_FIRST.runs(self.sums, at, length) & ~_COARSE, return_inverse=True)
        least, most = self._owners(at, which, len(keys))
        return keys, which, least != most

    def fine(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For windows that start at ``at``: distinct fingerprints in two halves, each window's among them, and the least ids."""
        one, two = _FIRST.runs(self.sums, at, length), _SECOND.runs(self.more_sums, at, length)
        order = np.lexsort((two, one))
        new = np.append(True, (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0))[: len(at)]
        which = np.empty(len(at), np.int64)
        which[order] = np.cumsum(new) - 1
        first = order[new]
        return one[first], two[first], which, self._owners(at, which, len(first))[0]

    def _owners(self, at: np.ndarray, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        owner, limits = self.ids[self.doc[at]], np.iinfo(np.int64)
        least, most = np.full(n, limits.max), np.full(n, limits.min)
        np.minimum.at(least, which, owner)
        np.maximum.at(most, which, owner)
        return least, most

    def survivors(self, lengths: list[int], answers: list) -> np.ndarray:
        """Where windows of the last length may start, after the levels that ``answers`` are of; ``lengths`` has one more."""
        at = self.fits(lengths[0])
        for length, longer, told in zip(lengths, lengths[1:], answers):
            keys, which, two = self.coarse(at, length)
            repeated = np.zeros(len(self.doc) + 1, bool)
            repeated[at] = (numbers_told(told, len(keys)) | two)[which]
            at = self.fits(longer)
            at = at[repeated[at] & repeated[at + longer - length]]
        return at


def held_by_smaller(slot: np.ndarray, one: np.ndarray, two: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which fingerprints another entry has under a smaller owner."""
    owner = owner.view(np.int64)
    order = np.lexsort((owner, two, one))
    new = np.append(True, (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0))[: len(one)]
    out = np.zeros(len(one), bool)
    out[order] = owner[order] > owner[order][new][np.cumsum(new) - 1]
    return out


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 13,
    start: int = 7,
    slot_bytes: int = 6 << 20,
    bucket_bytes: int = 10 << 20,
    run_bytes: int = 16 << 10,
    keep_columns: bool = False,
) -> DataFrame:
    """Remove the words of each document that a window held by a smaller id covers.

    Words are what is between ASCII white space, unchanged. A word goes if it is
    in a run of ``window`` consecutive words that also starts in a document with
    a smaller id; windows are judged on the input. Returns per row ``doc_id,
    n_words, n_removed, kept_sha256, kept_text``, kept words joined by a space. With
    ``keep_columns``, the row's own columns instead, the text replaced where
    words were removed, and the number of words removed last, named ``n_removed`` even
    if a column of that name is there.

    Documents are in slots of about ``slot_bytes``, fingerprints in buckets of about ``bucket_bytes`` of text; a slot cuts its
    fingerprints into runs of ``run_bytes`` of text at least.

    Null and empty texts have no words. A null id counts as larger than any
    other; rows with equal ids never remove from each other, nor do repeats inside
    one document. Other columns pass through unread. An empty table gives no rows. A task
    needs about 30 bytes of memory for each byte of a slot, or of a longer document.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)] if keep_columns else []
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"), *[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(others)])
    slots = write_slots(rows, slot_bytes)
    n_bytes = slots.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    n_buckets, most = 1 + n_bytes // bucket_bytes, max(1, slot_bytes // run_bytes)
    lengths, answers, columns = level_lengths(window, start), [], docs.columns

    for level, length in enumerate(lengths):
        last = length == window

        def emit(slot: int, table: pa.Table, about: list, told: list, level: int = level, length: int = length, last: bool = last) -> tuple[np.ndarray, list[np.ndarray]]:
            words = SlotWords(table)
            at = words.survivors(lengths[: level + 1], told)
            if not last:
                return words.coarse(at, length)[0], []
            one, two, _, least = words.fine(at, length)
            return one, [two, least]

        found = exchange(with_answers(slots, answers), level, emit, held_by_smaller if last else in_two_slots, n_buckets, most)
        answers.append(stage(found, f"level-{length}"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table, _, told in slot_rows(batches, len(lengths)):
            words = SlotWords(table)
            at = words.survivors(lengths, told[:-1])
            one, _, which, least = words.fine(at, window)
            gone = at[numbers_told(told[-1], len(one))[which] | (words.ids[words.doc[at]] > least[which])]
            edge = np.zeros(len(words.doc) + 1, np.int8)  # a place starts one window and ends one at most
            edge[gone] += 1
            edge[gone + window] -= 1
            covered = np.cumsum(edge[:-1], dtype=np.int32) > 0
            removed = np.array([covered[a:b].sum() for a, b in zip(words.firsts, words.firsts[1:])], np.int64)
            kept = [_kept(text, n, covered[a:b]) if n or not keep_columns else b"" for text, n, a, b in zip(words.texts, removed, words.firsts, words.firsts[1:])]
            if keep_columns:
                old = table.column(1).to_pylist()
                text = pa.array([o if not n else k.decode("utf-8", "replace") for o, k, n in zip(old, kept, removed)], pa.string())
                by_name = {id_col: table.column(0), text_col: text} | {c: table.column(2 + i) for i, c in enumerate(others)}
                out = pa.table([*(by_name[c] for c in columns), pa.array(removed)], [f"c{i}" for i in range(len(columns))] + ["n_removed"])
            else:
                digests = [hashlib.sha256(k).hexdigest() for k in kept]
                texts = pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())
                out = pa.table([table.column(0), pa.array(words.counts), pa.array(removed), pa.array(digests), texts], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
            yield from out.to_batches(max_chunksize=512)

    if keep_columns:
        types = [T.LongType() if c == id_col else T.StringType() if c == text_col else docs.schema[c].dataType for c in docs.columns]
        schema = T.StructType([T.StructField(f"c{i}", t) for i, t in enumerate(types)] + [T.StructField("n_removed", T.LongType())])
        return with_answers(slots, answers).mapInArrow(releasing(finish), schema).toDF(*docs.columns, "n_removed")
    return with_answers(slots, answers).mapInArrow(releasing(finish), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def _kept(text: bytes, n_removed: int, covered: np.ndarray) -> bytes:
    out, first = [], 0
    for words in words_by_piece(text):
        if n_removed:
            first, own = first + len(words), covered[first : first + len(words)].tolist()
            words = [w for w, gone in zip(words, own) if not gone]
        if words:
            out.append(b" ".join(words))
    return b" ".join(out)
