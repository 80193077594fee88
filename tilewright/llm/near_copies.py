"""SimHash near-dedup at a similarity of word shingles, decided exactly.

Two texts are linked where the Jaccard similarity of their sets of word shingles
is ``least`` or more. Candidates share a bucket, and each candidate pair's sets are compared. Buckets are those of
the covering tables of :mod:`tilewright.llm.simhash` over the fingerprints of the same shingles, which hold every pair within
the radius. Fingerprints alone cannot list the pairs at a threshold
like 0.8: those of such a pair differ in about ten of 64 bits, and
covering tables grow as 2**radius. So texts that agree on
a band of MinHashes share a bucket too (40 bands of 5: a pair at 0.8 shares
none with probability 10**-7).

What is returned are links that connect what all similar pairs connect, not all pairs: once texts are connected, pairs among them are not looked at.
First all texts of a bucket are compared to a few hubs: the text that is in the largest buckets, which others are copies of, and of
large buckets some by hash, the same in all buckets that hold them. That goes on as long as hubs connect much; so work stays linear in a large group of near copies.
Buckets whose texts are then still in several classes are open. Those of at most ``all_pairs`` texts are compared pair by pair. Larger ones that have texts in common are put together, so that a pair is met once, and the texts outside
the largest class are compared to all texts of other classes in blocks of bounded size: by MinHashes, and where enough of them agree
(a pair at the threshold fails with probability 10**-7) by their sets, unless a link before has connected their classes. A block gives
the links that it found, fewer than it has texts. So no bucket loses a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.components import components
from tilewright.llm.scratch import stage
from tilewright.llm.simhash import covering_masks, majority_bits
from tilewright.llm.workers import releasing

BANDS, BAND_ROWS, HUBS, BLOCK, SEED = 40, 5, 2, 1024, 42


def shingle_hashes(text: str | None, shingle_words: int = 5) -> np.ndarray:
    """Hashes of the shingles, repeats included; words as in ``simhash.fingerprint``. A shorter text is one shingle."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words] or [1]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - shingle_words + 1)
    digest = xxhash.xxh64_intdigest
    stops = ends[min(shingle_words, len(ends)) - 1 :].tolist()
    return np.array([digest(whole[i:j], SEED) for i, j in zip(starts[:last].tolist(), stops)], np.uint64)


def shingle_set(text: str | None, shingle_words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    return np.unique(shingle_hashes(text, shingle_words))


@cache
def _mixers() -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * BAND_ROWS), np.uint64)
    return drawn[0], drawn[1] | np.uint64(1)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    flip, odd = _mixers()
    least = np.full(BANDS * BAND_ROWS, np.uint64((1 << 64) - 1))
    for first in range(0, len(shingles), 256):
        part = shingles[first : first + 256, None] ^ flip
        part *= odd
        np.minimum(least, part.min(axis=0), out=least)
    return least


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One key for each band of the MinHashes; bands of different places have different keys."""
    least = min_hashes(shingles)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), SEED + i) for i, b in enumerate(least.reshape(BANDS, BAND_ROWS))], np.uint64).view(np.int64)


def _buckets(texts: DataFrame, shingle_words: int, radius: int) -> DataFrame:
    """``t, key, print, size``: a row for each bucket of each text that others share, with the size of the text's set. A key tells its table, so ``t`` is 0."""
    masks = np.array(covering_masks(radius), np.uint64)
    place = (np.arange(len(masks), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    n = BANDS + len(masks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                keys, sizes = [], []
                for text in part.column(1):
                    hashes = shingle_hashes(text.as_py(), shingle_words)
                    own = np.unique(hashes)
                    covered = (np.uint64(majority_bits(hashes)) & masks) * np.uint64(0xD6E8FEB86659FD93) + place
                    keys += [band_keys(own), covered.view(np.int64)]
                    sizes.append(len(own))
                prints = np.repeat(part.column(0).to_numpy(), n)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(prints), pa.array(np.repeat(sizes, n))], ["key", "print", "size"])

    rows = stage(texts.mapInArrow(releasing(work), "key long, print long, size long"), "bands")
    # Most keys are those of one text; only the others' rows go on.
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return stage(rows.join(shared, "key", "left_semi").distinct().select(F.lit(0).alias("t"), "key", "print", "size"), "buckets")


def _shingle_sets(texts: DataFrame, shingle_words: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                found = [shingle_set(t.as_py(), shingle_words).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], ["print", "shingles"])

    return stage(texts.mapInArrow(releasing(work), "print long, shingles binary"), "shingle-sets")


def _alike_sets(x: pa.BinaryScalar, y: pa.BinaryScalar, least: float) -> bool:
    x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both + 1e-9 >= least * (len(x) + len(y) - both)


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``a, b``: the pairs whose sets are similar."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [_alike_sets(x, y, least) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    sides = pairs.join(sets.select(F.col("print").alias("a"), F.col("shingles").alias("x")), "a")
    sides = sides.join(sets.select(F.col("print").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    return stage(sides.mapInArrow(releasing(compare), "a long, b long"), "similar")


def _agreeing(left: DataFrame, texts: DataFrame, least: float, shingle_words: int) -> DataFrame:
    """``a, b``: pairs of a bucket of ``t, key, print, size`` whose MinHashes agree as often as those of similar texts.

    With columns ``root`` and ``minor`` instead links between similar texts, that connect what all pairs of different roots of which one is minor connect.
    """
    exact = "root" in left.columns
    if not exact:
        left = left.withColumns({"root": F.col("print"), "minor": F.lit(True)})
    n_hashes, p = BANDS * BAND_ROWS, least + (1 - least) / 256
    enough = int(n_hashes * p - 5.3 * np.sqrt(n_hashes * p * (1 - p)))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                sets = [shingle_set(t.as_py(), shingle_words) for t in part.column(1)]
                found = [(min_hashes(own) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.uint8).tobytes() for own in sets]
                shown = [own.tobytes() if exact else None for own in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary()), pa.array(shown, pa.binary())], ["print", "sketch", "shingles"])

    own = texts.join(left.select("print").distinct(), "print", "left_semi").dropDuplicates(["print"])
    sketches = stage(own.mapInArrow(releasing(sketch), "print long, sketch binary, shingles binary"), "sketches")
    blocks = left.groupBy("t", "key").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / (BLOCK * 2048))).alias("blocks"))
    placed = left.join(blocks, ["t", "key"]).withColumn("own", F.pmod(F.xxhash64("print"), F.col("blocks")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(sketches, "print")
    # A row for each block that a text's block meets; a group holds two blocks, or one.
    group = ["t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]
    rows = placed.select(*group, "own", "print", "size", "sketch", "root", "minor", "shingles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = np.column_stack([batch.column(k).to_numpy() for k in range(4)])
            new = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            if held and batch.num_rows and (keys[0] != [held[-1].column(k)[-1].as_py() for k in range(4)]).any():
                new = np.append(0, new)
            for a, b in zip(np.append(-1, new), np.append(new, batch.num_rows)):
                if a >= 0 and held:
                    yield pairs(held)
                    held = []
                a = max(a, 0)
                if b > a:
                    held.append(batch.slice(int(a), int(b - a)))
        if held:
            yield pairs(held)

    def pairs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        prints, sizes, block, roots, minor = (rows[c].to_numpy() for c in ("print", "size", "own", "root", "minor"))
        sketches = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(-1, n_hashes)
        crossed, out = rows["i"][0].as_py() != rows["j"][0].as_py(), [np.zeros((0, 2), np.int64)]
        order = np.argsort(~minor, kind="stable")  # the minor first: each is compared to all that follow
        prints, sizes, block, roots, sketches = prints[order], sizes[order], block[order], roots[order], sketches[order]
        sets, joined = [rows["shingles"][int(i)] for i in order] if exact else [], {}

        def class_of(root: int) -> int:
            while root in joined:
                root = joined[root]
            return root

        for k in range(min(int(minor.sum()), len(prints) - 1)):
            first = k + 1
            may = (roots[first:] != roots[k]) & (np.minimum(sizes[first:], sizes[k]) >= least * np.maximum(sizes[first:], sizes[k]))
            if crossed:
                may &= block[first:] != block[k]
            at = first + np.flatnonzero(may)
            agree = (sketches[at] == sketches[k]).sum(axis=1)
            at, agree = at[agree >= enough], agree[agree >= enough]
            if exact:
                linked = []
                for j in at[np.argsort(-agree, kind="stable")].tolist():
                    one, other = class_of(int(roots[k])), class_of(int(roots[j]))
                    if one != other and _alike_sets(sets[k], sets[j], least):
                        joined[one] = other
                        linked.append(j)
                at = np.array(linked, np.int64)
            found = prints[at]
            out.append(np.column_stack([np.minimum(found, prints[k]), np.maximum(found, prints[k])]))
        both = np.concatenate(out)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])

    return rows.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j").mapInArrow(releasing(compare), "a long, b long").distinct()


_BUCKET = ["t", "key"]


def _open(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``t, key, print, size, root, n, minor``: the rows of buckets with texts of several classes; ``minor`` are those outside of the bucket's largest."""
    rows = rows.select(*_BUCKET, "print", "size")
    if roots is None:
        rows = rows.withColumn("root", F.col("print"))
    else:
        rows = rows.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    classes = rows.groupBy(*_BUCKET, "root").agg(F.count("*").alias("own"))
    state = classes.groupBy(*_BUCKET).agg(F.sum("own").alias("n"), F.count("*").alias("classes"), F.max(F.struct("own", "root"))["root"].alias("major")).where("classes > 1")
    rows = rows.join(state.drop("classes"), _BUCKET)
    return stage(rows.withColumn("minor", F.col("root") != F.col("major")).drop("major"), "open")


def _hub_pairs(rows: DataFrame, n_hubs: int, all_pairs: int, least: float) -> DataFrame:
    """``a, b``: pairs of each text and its bucket's hubs."""
    # What many others share most with is in the largest buckets: the text that a group was copied from, rather than any of its copies.
    weights = stage(rows.groupBy("print").agg(F.sum("n").alias("weight")), "weights")
    order = F.xxhash64("print", F.lit(n_hubs))  # not the table: near copies meet the same hubs in all of theirs
    ranked = rows.where("may_be_hub").join(weights, "print").withColumn("order", order)
    first = ranked.groupBy(*_BUCKET).agg(F.max(F.struct("weight", "order", "print"))["print"].alias("first"))
    by_hash = (F.col("n") > all_pairs) & (F.col("order").cast("double") / 2.0**64 + 0.5 < n_hubs / F.col("n"))
    hubs = first.select(*_BUCKET, F.col("first").alias("print")).union(ranked.where(by_hash).select(*_BUCKET, "print")).distinct()
    hubs = hubs.join(rows.select(*_BUCKET, "print", "size", "root"), [*_BUCKET, "print"]).withColumnsRenamed({"print": "hub", "size": "other", "root": "hub_root"})
    met = rows.select(*_BUCKET, "print", "size", "root").join(stage(hubs, "hubs"), _BUCKET).where("root != hub_root")
    return _alike(met.select(F.least("print", "hub").alias("a"), F.greatest("print", "hub").alias("b"), "size", "other"), least)


def _alike(pairs: DataFrame, least: float) -> DataFrame:
    """Sets of too different sizes cannot be similar."""
    return pairs.where(F.least("size", "other") >= least * F.greatest("size", "other")).select("a", "b")


def similar_links(texts: DataFrame, least: float, shingle_words: int, radius: int = 3, all_pairs: int = 32) -> DataFrame:
    """``a, b`` over ``print, text``: links between similar texts that connect what all of them connect."""
    whole = _buckets(texts, shingle_words, radius)
    texts = stage(texts.join(whole.select("print").distinct(), "print", "left_semi").dropDuplicates(["print"]), "shared-texts")
    sets = _shingle_sets(texts, shingle_words)
    links = compared = roots = None
    rows = _open(whole, None)

    def settle(pairs: DataFrame) -> None:
        """Compare pairs that were not compared before; then rows are those of the buckets that are still open."""
        nonlocal links, compared, roots, rows
        new = pairs.distinct()  # a pair of several buckets is compared once
        new = stage(new if compared is None else new.join(compared, ["a", "b"], "left_anti"), "candidates")
        compared = new if compared is None else compared.union(new)
        found = _similar(new, sets, least)
        links = found if links is None else links.union(found)
        # The classes so far are links enough of their own.
        roots = stage(components(found if roots is None else found.union(roots.select("node", "root"))), "classes")
        rows = _open(rows, roots)

    n_hubs, before = HUBS, None
    while True:
        own = rows.withColumn("may_be_hub", F.lit(True)) if before is None else rows.where(F.col("n") > all_pairs).withColumn("may_be_hub", F.col("minor"))
        settle(_hub_pairs(own, n_hubs, all_pairs, least))
        n_many, n_minor = rows.where(F.col("n") > all_pairs).agg(F.count("*"), F.count_if("minor")).first()
        if 4 * n_minor <= n_many or before is not None and n_minor > 0.75 * before:
            break
        n_hubs, before = 2 * n_hubs, n_minor
    few = rows.where(F.col("n") <= all_pairs)
    a, b = ([*_BUCKET, F.col("print").alias(p), F.col("size").alias(s), F.col("root").alias(r)] for p, s, r in (("a", "size", "root"), ("b", "other", "other_root")))
    pairs = _alike(few.select(*a).join(few.select(*b), _BUCKET).where("a < b AND root != other_root"), least)
    new = stage(pairs.distinct().join(compared, ["a", "b"], "left_anti"), "candidates")
    links = links.union(_similar(new, sets, least))
    if n_many:
        links = links.union(stage(_agreeing(_together(rows.where(F.col("n") > all_pairs), roots), texts, least, shingle_words), "agreeing"))
    return links.distinct()


def _together(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` of :func:`_open` with those buckets as one that have texts in common."""
    least = rows.groupBy(*_BUCKET).agg(F.min("print").alias("least"))
    groups = components(rows.join(least, _BUCKET).select(F.col("print").alias("a"), F.col("least").alias("b")))
    whole = groups.withColumnsRenamed({"node": "print", "root": "key"}).join(rows.select("print", "size").distinct(), "print")
    return _open(whole.withColumn("t", F.lit(0)), roots)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8, shingle_words: int = 5, radius: int = 3) -> DataFrame:
    """``doc_id, text_hash, component_id, kept_hash`` for each row.

    ``text_hash`` is Spark's xxhash64 of the text (null as empty). Components are
    those of the links; ``component_id`` is the least id, null ids last, and
    ``kept_hash`` the text that goes with it (of several, the least hash). Texts
    without words are alike. Repeated rows each get their answer. Other columns
    are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("print"))
    texts = docs.select(F.xxhash64(text).alias("print"), text.alias("text"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "print"))
    classes = stage(rows.groupBy("print").agg(first.alias("first")), "text-classes")
    roots = stage(components(similar_links(texts, least, shingle_words, radius)), "text-roots")
    rooted = classes.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    rooted = stage(rooted, "rooted")
    kept = stage(rooted.groupBy("root").agg(F.min("first").alias("first")), "least-ids")
    named = stage(rooted.select("print", "root").join(kept, "root").select("print", "first"), "named")
    found = stage(rows, "text-hashes").join(named, "print")
    return found.select("doc_id", F.col("print").alias("text_hash"), F.col("first.doc_id").alias("component_id"), F.col("first.print").alias("kept_hash"))
