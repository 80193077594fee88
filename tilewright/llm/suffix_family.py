"""Suffix-array dedup with a logarithmic family of indexes.

Slots of documents arrive in batches. A batch's suffix array is sparse: it holds the
suffixes that start at *anchors*, the positions whose leading bytes have the least
hash in some run of positions, so that every string of the wanted length has
exactly one anchor, at the same place in all its copies. An entry is an anchor
with the bytes that those strings can hold on both sides of it.

The index is a family of levels, tables in the shared folder that hold sorted arrays
in buckets by the hash of the leading bytes. A new batch's array is sorted by
its bytes, merge-scanned with the arrays of all levels, and becomes a level; levels of
equal size merge, so each entry is rewritten about log2(batches) times. The scan
compares bytes: neighbours in suffix order give the common prefixes, neighbours
in the order of the reversed bytes before the anchors the common suffixes, and a string is one class
of the first at its depth with one class of the second. Whichever side has
the larger id is told; so batches may come in any order, and an entry all of
whose strings were found under a smaller id is not needed in the index.

Before that, an exchange of hashes rules out anchors whose leading bytes occur once in the corpus;
nothing is removed on the word of a hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.scratch import stage
from tilewright.llm.slots import (
    RUNS, by_slot, exchange, ids_of, in_two_slots, mix, numbers_told, pack, pack_steps, read_runs, runs_of, slot_rows, split_runs, texts_of, to_batch, unpack, unpack_steps, with_answers, write_slots
)
from tilewright.llm.workers import releasing

_ODD1, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SEGMENT = 1 << 15  # strings whose anchors are looked for at once: small enough to stay in the processor's cache
_PLACE = np.uint64((1 << 16) - 1)
_COARSE = np.uint64((1 << 24) - 1)  # low bits of hashes that ruling out does without
_PAD = 1 << 10
NO_LEAST = np.iinfo(np.int64).max


def grams(data: np.ndarray, at: np.ndarray | slice, size: int) -> np.ndarray:
    """Mixed 64-bit hashes of the ``size`` bytes from each place on; ``data`` is padded."""
    h = np.uint64(0)
    for k in range(0, size, 8):
        width = min(8, size - k)
        view = np.ndarray((len(data) - 8 - k,), "<u8", data, k, (1,))
        words = view[at]
        h = (h ^ (words << np.uint64(64 - 8 * width) if width < 8 else words)) * _ODD1
        h ^= h >> np.uint64(29)
    return h * _ODD2


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts end to end and padded, and where each begins, with the end of the last."""
    return np.frombuffer(b"".join([*texts, bytes(_PAD)]), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))


def find_anchors(data: np.ndarray, firsts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors and, for each, the first place from which a string has it; strings lie within a document."""
    n, run = int(firsts[-1]) - length + 1, length - gram + 1
    fits = np.ones(max(0, n), bool)
    for end in firsts[1:].tolist():
        fits[max(0, end - length + 1) : end] = False
    out, last = [], -1
    for at in range(0, n, _SEGMENT):
        stop = min(n, at + _SEGMENT)
        least = (grams(data, slice(at, stop + run - 1), gram) & ~_PLACE) | np.arange(stop - at + run - 1, dtype=np.uint64)
        width = 1
        while 2 * width <= run:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < run:
            least = np.minimum(least[: width - run], least[run - width :])
        start = np.flatnonzero(fits[at:stop])
        if len(start):
            anchor = (least[start] & _PLACE).astype(np.int64) + at
            new = np.append(anchor[0] != last, anchor[1:] != anchor[:-1])
            out.append((anchor[new], start[new] + at))
            last = anchor[-1]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct row occurs first, and which of them each row is. Hashes find equal rows, their bytes decide."""
    words = _words(rows)
    h = np.zeros(len(rows), np.uint64)
    for word in words.T:
        h = mix(h * _ODD1 ^ word)
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    if (words[first[which]] != words).any():
        _, first, which = np.unique(words, axis=0, return_index=True, return_inverse=True)
    return first, which.ravel()


def _words(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian words, which compare as the bytes do."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return wide.view(">u8").astype(np.uint64)


def byte_order(rows: np.ndarray) -> np.ndarray:
    """The order of rows by their bytes."""
    words = _words(rows)
    order = np.lexsort((words[:, min(1, words.shape[1] - 1)], words[:, 0]))
    if words.shape[1] > 2:  # rows that two words tell apart are in their places
        ahead = words[order, :2]
        group = np.cumsum(np.append(False, (ahead[1:] != ahead[:-1]).any(axis=1)))
        tied = np.flatnonzero(np.bincount(group)[group] > 1)
        some = order[tied]
        order[tied] = some[np.lexsort((*(words[some, k] for k in range(words.shape[1] - 1, 1, -1)), group[tied]))]
    return order


def common(rows: np.ndarray) -> np.ndarray:
    """How many leading bytes each row shares with the one before it (the first: none)."""
    out = np.zeros(len(rows), np.int64)
    for a in range(1, len(rows), 1 << 16):
        b = min(len(rows), a + (1 << 16))
        differs = rows[a:b] != rows[a - 1 : b - 1]
        out[a:b] = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return out


def all_strings(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A bit for each place before an anchor, from ``low`` to ``high``."""
    ones = np.uint64((1 << 64) - 1)
    return (ones >> (63 - high).astype(np.uint64)) & (ones << low.astype(np.uint64))


class Entries:
    """Suffix array entries: rows of bytes (from the anchor on, the bytes before it reversed, and how many bytes before the
    anchor the strings start, least and most), with owners, slots, numbers and the strings found under smaller owners."""

    def __init__(self, rows: np.ndarray, owner: np.ndarray, slot: np.ndarray, number: np.ndarray, found: np.ndarray, length: int, gram: int):
        self.rows, self.owner, self.slot, self.number, self.found, self.length, self.run = rows, owner, slot, number, found, length, length - gram + 1
        self.gram = gram
        edges = rows[:, length + self.run - 1 :].astype(np.int64)
        self.low, self.high = edges[:, 0] << 8 | edges[:, 1], edges[:, 2] << 8 | edges[:, 3]

    def every(self) -> np.ndarray:
        return all_strings(self.low, self.high)

    def scan(self) -> np.ndarray:
        """The strings of each entry that another entry holds under a smaller owner; entries are in byte order."""
        found, n = self.found.copy(), len(self.rows)
        if not n:
            return found
        # Entries of equal bytes: those over the least owner are found whole; the others are compared string by string.
        shared = common(self.rows)
        same = np.cumsum(shared < self.rows.shape[1])
        least = np.full(same[-1] + 1, NO_LEAST)
        np.minimum.at(least, same, self.owner)
        behind = self.owner > least[same]
        found[behind] = self.every()[behind]
        group = np.cumsum(shared < self.gram)
        at = np.flatnonzero(~behind)
        kinds = np.append(True, same[at][1:] != same[at][:-1])
        several = np.bincount(group[at][kinds], minlength=group[-1] + 1) > 1
        at = at[several[group[at]]]
        if not len(at):
            return found
        right = self.rows[at, : self.length]
        left = self.rows[at, self.length : self.length + self.run - 1]
        by_left = byte_order(left)
        prefix, suffix = common(right), common(left[by_left])
        low, high, owner = self.low[at], self.high[at], self.owner[at]
        more = np.zeros(len(at), np.uint64)
        before = np.empty(len(at), np.int64)
        for d in range(self.run):
            own = np.flatnonzero((low <= d) & (d <= high))
            before[by_left] = np.cumsum(suffix < d)
            string = np.cumsum(prefix < self.length - d)[own] * (len(at) + 1) + before[own]
            order = np.lexsort((owner[own], string))
            string, holder = string[order], owner[own][order]
            first = np.flatnonzero(np.append(True, string[1:] != string[:-1])) if len(own) else np.zeros(0, np.int64)
            beaten = holder > np.repeat(holder[first], np.diff(np.append(first, len(own))))
            more[own[order[beaten]]] |= np.uint64(1 << d)
        found[at] |= more
        return found


class SlotBytes:
    """A slot's texts, anchors, and which of the anchors' leading bytes are not ruled out."""

    def __init__(self, table: pa.Table, about: list[bytes], length: int, gram: int):
        self.texts, self.ids, self.length, self.gram, self.run = texts_of(table), ids_of(table), length, gram, length - gram + 1
        self.data, self.firsts = padded(self.texts)
        self.anchors, begins = (unpack_steps(a).astype(np.int64) for a in about)
        self.doc = np.searchsorted(self.firsts, self.anchors, side="right") - 1
        last = np.minimum(np.append(begins[1:], NO_LEAST) - 1, self.firsts[self.doc + 1] - length)
        self.high, self.low = self.anchors - begins, self.anchors - last
        self.hashes = mix(grams(self.data, self.anchors, gram))  # anchors have small hashes; mixed, they spread over the buckets

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of the leading bytes, each anchor's among them, and which this slot has under two ids."""
        keys, which = np.unique(self.hashes & ~_COARSE, return_inverse=True)
        owner = self.ids[self.doc]
        least, most = np.full(len(keys), NO_LEAST), np.full(len(keys), -NO_LEAST - 1)
        np.minimum.at(least, which, owner)
        np.maximum.at(most, which, owner)
        return keys, which, least != most

    def candidates(self, told: list[list[bytes]]) -> np.ndarray:
        keys, which, two = self.keys()
        return np.flatnonzero((numbers_told(told, len(keys)) | two)[which])

    def rows(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), self.length + self.run + 3), np.uint8)
        place, low, high = self.anchors[at], self.low[at], self.high[at]
        for k in range(self.length):
            out[:, k] = np.where(k < self.length - low, self.data[place + k], 0)
        for k in range(self.run - 1):
            out[:, self.length + k] = np.where(k < high, self.data[np.maximum(place - 1 - k, 0)], 0)
        for k, edge in enumerate((low >> 8, low & 255, high >> 8, high & 255)):
            out[:, self.length + self.run - 1 + k] = edge
        return out

    def entries(self, told: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Candidates, each one's entry, and by entry, in the order of hashes: the hash, the row and the least owner."""
        at = self.candidates(told)
        rows = self.rows(at)
        first, which = distinct_rows(rows)
        order = np.argsort(self.hashes[at[first]], kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        which, first = place[which], first[order]
        least = np.full(len(first), NO_LEAST)
        np.minimum.at(least, which, self.ids[self.doc[at]])
        return at, which, self.hashes[at[first]], rows[first], least

    def spans(self, at: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that the strings found cover, as disjoint runs; ``found`` has a bit for each place before the anchor."""
        starts, stops = [], []
        place, low, high = self.anchors[at], self.low[at], self.high[at]
        whole = found == all_strings(low, high)
        starts.append(place[whole] - high[whole]), stops.append(place[whole] - low[whole] + self.length)
        place, found = place[~whole & (found != 0)], found[~whole & (found != 0)]
        for d in range(self.run):
            own = place[(found >> np.uint64(d)) & np.uint64(1) != 0]
            starts.append(own - d), stops.append(own - d + self.length)
        starts, stops = np.concatenate(starts), np.concatenate(stops)
        order = np.argsort(starts, kind="stable")
        starts, stops = starts[order], np.maximum.accumulate(stops[order])
        if not len(starts):
            return starts, stops
        doc = np.searchsorted(self.firsts, starts, side="right")
        new = np.flatnonzero(np.append(True, (starts[1:] > stops[:-1]) | (doc[1:] != doc[:-1])))
        return starts[new], stops[np.append(new[1:], len(stops)) - 1]


def merge_batch(runs: DataFrame, levels: list[DataFrame], merged: int, length: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """One batch against the levels: what slots are told, and the level that the batch and the last ``merged`` levels become.

    ``runs`` and the levels are rows of ``RUNS``. Levels that do not merge stay as they are.
    """
    rows = runs.withColumn("level", F.lit(-1))
    for i, level in enumerate(levels):
        rows = rows.unionByName(level.withColumn("level", F.lit(i)))
    stay = len(levels) - merged

    def scan(key: tuple, table: pa.Table) -> pa.Table:
        bucket, parts = key[0].as_py(), []
        for level in sorted(set(table["level"].to_pylist())):
            own = table.filter(pa.compute.equal(table["level"], level))
            slot, number, values = read_runs(own["slot"].to_pylist(), own["data"].to_pylist())
            found = values[2] if len(values) > 2 else np.zeros(len(slot), np.uint64)
            parts.append((values[0], values[1].view(np.int64), slot, number, found, np.full(len(slot), level)))
        *fields, level = (np.concatenate(x) for x in zip(*parts))
        order = byte_order(fields[0])
        entries, level = Entries(*(f[order] for f in fields), length, gram), level[order]
        found = entries.scan()
        new = np.flatnonzero(found & ~entries.found)
        out = [(*row, True) for row in by_slot(bucket, entries.slot[new], entries.number[new], found[new])]
        kept = np.flatnonzero((found != entries.every()) & ((level < 0) | (level >= stay)))
        if len(kept):
            data = [pack_steps(entries.number[kept]), pack(entries.rows[kept]), pack(entries.owner[kept]), pack(found[kept]), pack_steps(entries.slot[kept])]
            out.append((bucket, -1, data, False))
        types = [pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.bool_()]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["bucket", "slot", "data", "told"])

    out = stage(rows.groupBy("bucket").applyInArrow(scan, RUNS + ", told boolean"), "level")
    return out.where("told").drop("told"), out.where("NOT told").drop("told")


def remove_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 50,
    gram: int = 16,
    n_batches: int = 4,
    slot_bytes: int = 12 << 20,
    bucket_bytes: int = 16 << 20,
    run_bytes: int = 32 << 10,
) -> DataFrame:
    """Remove the bytes of each document that a string held by a smaller id covers.

    A byte of the UTF-8 text goes if it is in a string of ``length`` bytes that also starts in
    a document with a smaller id; overlaps count, and strings are judged on the
    input. Returns per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    kept`` (the remaining bytes, which may cut characters).

    Slots of about ``slot_bytes`` arrive in ``n_batches``. Buckets hold the entries of about ``bucket_bytes`` of text; a slot cuts its entries into runs of
    ``run_bytes`` of text at least.

    Null and empty texts have no bytes. A null id counts as larger than any
    other; rows with equal ids never remove from each other, nor do repeats inside
    one document. Other columns are not read. An empty table gives no rows. A
    task needs about 20 bytes of memory for each byte of a slot, or of a longer document.
    """
    if not 1 <= gram < length < gram + 64 or length > _PAD - 8:
        raise ValueError("1 <= gram < length < gram + 64 and length <= 1016 are needed")

    def about(table: pa.Table) -> list[bytes]:
        return [pack_steps(a) for a in find_anchors(*padded(texts_of(table)), length, gram)]

    slots = write_slots(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), slot_bytes, about)
    n_bytes = slots.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    n_buckets, most = 1 + n_bytes // bucket_bytes, max(1, slot_bytes // run_bytes)

    def emit(slot: int, table: pa.Table, about: list[bytes], told: list) -> tuple[np.ndarray, list[np.ndarray]]:
        return SlotBytes(table, about, length, gram).keys()[0], []

    twice = stage(exchange(slots, 0, emit, in_two_slots, n_buckets, most), "repeated-heads")

    coarse = min(n_buckets, most)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, table, about, told in slot_rows(batches, 1):
            _, _, hashes, rows, least = SlotBytes(table, about, length, gram).entries(told[0])
            yield to_batch(list(runs_of(slot, hashes, coarse, [rows, least])))

    def hash_of(values: list[np.ndarray]) -> np.ndarray:
        return mix(grams(np.concatenate([values[0][:, :gram].ravel(), np.zeros(_PAD, np.uint8)]), np.arange(len(values[0])) * gram, gram))

    answers, levels, sizes = [], [], []
    batch_no = (F.shiftright("slot", 24) + F.col("slot").bitwiseAND(F.lit((1 << 24) - 1))) % n_batches
    for batch in range(n_batches):
        arriving = with_answers(slots.where(batch_no == batch), [twice.where(batch_no == batch)])
        runs = split_runs(arriving.mapInArrow(releasing(give), RUNS), -(-n_buckets // coarse), coarse, hash_of)
        merged, size = 0, 1
        while merged < len(levels) and sizes[-1 - merged] == size:
            merged, size = merged + 1, 2 * size
        told, level = merge_batch(runs, levels, merged, length, gram)
        answers.append(told)
        levels, sizes = [*levels[: len(levels) - merged], level], [*sizes[: len(sizes) - merged], size]
    found_by_slot = answers[0]
    for more in answers[1:]:
        found_by_slot = found_by_slot.union(more)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table, about, told in slot_rows(batches, 2):
            data = SlotBytes(table, about, length, gram)
            at, which, _, _, least = data.entries(told[0])
            found = np.zeros(len(least), np.uint64)
            for own in told[1]:
                found[unpack_steps(own[0]).astype(np.int64)] |= unpack(own[1])
            behind = data.ids[data.doc[at]] > least[which]
            starts, stops = data.spans(at, np.where(behind, all_strings(data.low[at], data.high[at]), found[which]))
            cuts = np.searchsorted(starts, data.firsts)
            out: list[tuple] = []
            for text, a, b, base in zip(data.texts, cuts.tolist(), cuts[1:].tolist(), data.firsts.tolist()):
                kept, n, end = [], 0, 0
                for x, y in zip((starts[a:b] - base).tolist(), (stops[a:b] - base).tolist()):
                    kept.append(text[end:x])
                    n, end = n + y - x, y
                kept = b"".join([*kept, text[end:]]) if n else text
                out.append((len(text), n, b - a, hashlib.sha256(kept).hexdigest(), kept))
            n_all, n_removed, n_spans, digests, kept = zip(*out)
            columns = [table.column(0), *(pa.array(c, pa.int64()) for c in (n_all, n_removed, n_spans)), pa.array(digests), pa.array(kept, pa.binary())]
            yield from pa.table(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]).to_batches(max_chunksize=512)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return with_answers(slots, [twice, found_by_slot]).mapInArrow(releasing(finish), schema)
