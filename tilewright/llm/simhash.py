"""SimHash near-dedup with covering locality-sensitive hashing.

Every text has a 64-bit fingerprint: the bitwise majority over the hashes of its
word shingles. Fingerprints that differ in at most ``radius`` bits are linked.

Candidates come from ``2**(radius+1) - 1`` tables. Bit i carries the vector
m(i) = i mod 2**(radius+1) over GF(2); table t keeps the bits whose vector has an
odd product with t. For any ``radius`` differing bits some t has an even product
with all of their vectors (fewer equations than unknowns), so every pair within
the radius agrees on all bits that table keeps: collisions are certain, not
likely. Copies share a fingerprint and enter the tables once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.components import components
from tilewright.llm.scratch import stage
from tilewright.llm.workers import releasing

BITS = 64
SEED = 42


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """The fingerprint as an unsigned number; 0 where there are no words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - shingle_words + 1)
    stops = ends[min(shingle_words, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return majority_bits(np.array([digest(whole[i:j], SEED) for i, j in zip(starts[:last].tolist(), stops.tolist())], np.uint64))


def majority_bits(hashes: np.ndarray) -> int:
    """A number with the bits that are set in over half the hashes."""
    ones = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 65_536):
        own = hashes[first : first + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(own, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def covering_masks(radius: int) -> list[int]:
    """The bits each table keeps."""
    size = 1 << (radius + 1)
    return [sum(1 << i for i in range(BITS) if (i % size & t).bit_count() % 2) for t in range(1, size)]


def links_within(prints: np.ndarray, radius: int, direct: int = 2048) -> list[tuple[int, int]]:
    """Links that connect exactly what pairs within the radius connect; never more links than fingerprints.

    Over ``direct`` distinct fingerprints, pairs are looked for among those that
    agree on one of ``radius + 1`` blocks of bits, as any such pair must.
    """
    prints = np.unique(prints)
    if len(prints) <= direct:
        return _spread(prints, radius)
    width, parent, links = -(-BITS // (radius + 1)), np.arange(len(prints)), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    place = {int(p): i for i, p in enumerate(prints)}
    for block in range(radius + 1):
        part = (prints >> np.uint64(block * width)) & np.uint64((1 << width) - 1)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        for group in np.split(prints[order], cuts):
            for x, y in _spread(group, radius) if len(group) > 1 else ():
                i, j = root(place[x]), root(place[y])
                if i != j:
                    parent[i] = j
                    links.append((x, y))
    return links


def _spread(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    left, links, front = prints, [], []
    while len(left):
        here = front.pop() if front else None
        if here is None:
            here, left = left[0], left[1:]
        near = np.bitwise_count(left ^ here) <= radius
        if near.any():
            links += [(int(here), int(x)) for x in left[near]]
            front += list(left[near])
            left = left[~near]
    return links


def simhash_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """``doc_id, print`` per row; ``print`` is the fingerprint as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                prints = np.array([fingerprint(t.as_py(), shingle_words) for t in part.column(1)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints)], ["doc_id", "print"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(releasing(work), "doc_id long, print long")


def print_links(prints: DataFrame, radius: int, hot_rows: int = 100_000) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``print``) that connect what the radius connects.

    A bucket of more than ``hot_rows`` is not linked as one: pairs within the radius agree on one of ``radius + 1`` blocks of bits, so it is cut
    into those that agree on a block, each linked by itself.
    """
    masks = [m - (1 << BITS) if m >> (BITS - 1) else m for m in covering_masks(radius)]
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("print").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)]))
    keyed = prints.select("print", tables.alias("at")).select("at.t", "at.key", "print")
    hot = stage(keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows).select("t", "key", F.lit(True).alias("hot")), "hot-buckets")
    width = -(-BITS // (radius + 1))
    of_block = lambda i: F.shiftrightunsigned("print", i * width).bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1))
    part = lambda block, bits: F.struct(F.lit(block).alias("block"), bits.alias("bits"))
    parts = F.when(F.col("hot"), F.array(*[part(i, of_block(i)) for i in range(radius + 1)])).otherwise(F.array(part(-1, F.lit(0).cast("long"))))
    bucket = ["t", "key", "block", "bits"]
    keyed = keyed.join(hot, ["t", "key"], "left").select("t", "key", "print", F.explode(parts).alias("part")).select("t", "key", "part.*", "print")
    keyed = keyed.repartition(*bucket).sortWithinPartitions(*bucket)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def link(rows: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
            found = []
            for group in np.split(rows[:, -1].copy().view(np.uint64), cuts) if len(cuts) < len(rows) - 1 else ():
                if len(group) > 1:
                    found += links_within(group, radius)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

        rest: list[np.ndarray] = []  # the last bucket so far; it may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5)])
            if rest and (rows[-1, :4] == rest[0][0, :4]).all():
                rest.append(rows)
                continue
            rows = np.concatenate([*rest, rows])
            cuts = np.flatnonzero((np.diff(rows[:, :4], axis=0) != 0).any(axis=1)) + 1
            if len(cuts):
                yield link(rows[: cuts[-1]], cuts[:-1])
                rest = [rows[cuts[-1] :]]
            else:
                rest = [rows]
        if rest:
            yield link(np.concatenate(rest), np.array([], np.int64))

    return keyed.mapInArrow(releasing(work), "a long, b long").distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, shingle_words: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row.

    Words are split at ASCII white space after A-Z are lower-cased; shingles have
    ``shingle_words`` words (a shorter text is one shingle). ``component_id`` is
    the least id that links lead to, the own one included. Null, empty and blank
    texts have fingerprint 0 and are linked like any other. Null ids are never
    the least; a component of null ids alone has a null one. Repeated rows each
    get their answer. Other columns are not read. An empty table gives no rows.
    """
    rows = stage(simhash_prints(docs, id_col, text_col, shingle_words), "prints")
    classes = stage(rows.groupBy("print").agg(F.min("doc_id").alias("least_id")), "print-classes")
    roots = stage(components(print_links(classes.select("print"), radius)), "print-roots")
    rooted = classes.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    rooted = stage(rooted, "rooted")
    least = stage(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "least-ids")
    named = stage(rooted.join(least, "root").select("print", "component_id"), "named")
    # Both sides are plain scans, so that the partition of a very common fingerprint can be split at run time.
    found = rows.join(named, "print")
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
