"""Vector codes by Lloyd's rounds over parts of vectors, maintained by what changes.

Vectors are scaled to integers and written once, in packs, as a table bucketed by pack. A round
assigns every part to its nearest codebook entry and writes the assignments as a table with the
same buckets, so that the next round meets them without a shuffle. Beside them it writes, once a
task, what the parts whose assignment changed add to their new entries and take from their old ones. Only
these contributions are shuffled; they are added to a table of running integer sums, from which the next codebooks
follow exactly: integers leave no rounding behind, however the rows were dealt out.

The driver reads the codebooks' sums, whose size is given by the parameters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.scratch import stage, stage_by
from tilewright.llm.workers import releasing

#: Scaled components are held within these bounds, so that squared distances fit 64 bits.
MOST = 2**24
PACKS = "pack long, ids binary, labels binary, null_ids binary, x binary"
ASSIGNED = "pack long, codes binary, n_changed long, places array<int>, amounts array<long>"


@dataclass(frozen=True)
class Packs:
    """Scaled vectors: ``table`` has a row a pack, bucketed by it; ``first`` the rows that codebooks start from."""

    table: DataFrame
    n_rows: int
    n_buckets: int
    width: int
    first: np.ndarray


def scaled(flat: np.ndarray, sizes: np.ndarray, width: int, scale: int) -> np.ndarray:
    """Vectors of these sizes, end to end, as rows of integers: floor(scale * component), zeros after a shorter one's end."""
    out = np.zeros((len(sizes), width), np.int32)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.clip(np.floor(flat.astype(np.float64) * scale), -MOST, MOST)
    return out


def pack_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int, n_parts: int, n_entries: int, pack_rows: int) -> Packs:
    """The finite vectors of a table, scaled; all are filled up with zeros to the least multiple of ``n_parts`` that holds the longest."""
    spark, v = vectors.sparkSession, F.col("v")
    good = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    good = good.where(v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    n_rows, longest = good.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    width = -(-longest // n_parts) * n_parts

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, pack_rows):
                part = batch.slice(start, pack_rows)
                ids, labels, v = part.column(0), part.column(1), part.column(2)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, pa.schema([("label", pa.string())])) as writer:
                    writer.write_batch(pa.RecordBatch.from_arrays([labels], ["label"]))
                x = scaled(v.flatten().to_numpy(zero_copy_only=False), v.value_lengths().to_numpy(zero_copy_only=False), width, scale)
                row = [number, ids.fill_null(0).to_numpy().tobytes(), sink.getvalue().to_pybytes(), np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes(), x.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, (pa.int64(), *[pa.binary()] * 4))], ["pack", "ids", "labels", "null_ids", "x"])
                number += 1

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(1, min(-(-n_rows // pack_rows), max(parts, n_rows * width * 4 >> 27)))
    table = stage_by(good.mapInArrow(releasing(pack), PACKS).repartition(n_buckets, "pack"), "pack", n_buckets, "packs")
    rows = good.orderBy(F.asc_nulls_last("id"), "v").limit(n_entries).collect()
    sizes = np.array([len(r["v"]) for r in rows], np.int64)
    first = scaled(np.array([x for r in rows for x in r["v"]], np.float64), sizes, width, scale)
    return Packs(table, n_rows, n_buckets, width, first)


def nearest(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of each row, the first of equally near ones; exact."""
    bound = max(1, np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if 4 * x.shape[1] * int(bound) ** 2 < 2**53 else np.int64  # floats multiply faster, and are exact so far
    x, c = x.astype(kind), entries.astype(kind)
    out, square = np.empty(len(x), np.int64), (c * c).sum(axis=1)
    for at in range(0, len(x), 4096):
        out[at : at + 4096] = (square - 2 * (x[at : at + 4096] @ c.T)).argmin(axis=1)
    return out


def _parts(data: bytes, width: int, n_parts: int) -> np.ndarray:
    """Scaled vectors of a pack: (rows, parts, components of a part). ``width`` 0 leaves no bytes to tell rows by."""
    return np.frombuffer(data, np.int32).reshape(-1, n_parts, width // n_parts)


def contributions(x: np.ndarray, new: np.ndarray, old: np.ndarray | None, n_entries: int) -> np.ndarray:
    """(entries, components + 1): what rows whose entry changed add, their count last."""
    moved = np.arange(len(x)) if old is None else np.flatnonzero(new != old)
    rows = np.concatenate([x[moved].astype(np.int64), np.ones((len(moved), 1), np.int64)], axis=1)
    out = np.zeros((n_entries, rows.shape[1]), np.int64)
    for sign, entry in ((1, new[moved]), *([(-1, old[moved])] if old is not None else [])):
        order = np.argsort(entry, kind="stable")
        used, starts = np.unique(entry[order], return_index=True)
        if len(used):
            out[used] += sign * np.add.reduceat(rows[order], starts)
    return out


def assign_round(packs: Packs, before: DataFrame | None, books: np.ndarray) -> DataFrame:
    """Every part's nearest entry of ``books``, written by pack; a task's last row has the contributions of all parts that it saw change."""
    n_parts, n_entries, size = books.shape
    width = packs.width

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros((n_parts, n_entries, size + 1), np.int64), None

        def row(pack: int, codes: np.ndarray, changed: int, places: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array([pack], pa.int64()), pa.array([codes.astype("<u2").tobytes()], pa.binary()), pa.array([changed], pa.int64()), pa.array([places.astype(np.int32)], pa.list_(pa.int32())), pa.array([total.ravel()[places]], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["pack", "codes", "n_changed", "places", "amounts"])

        none = np.empty(0, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                x, old = _parts(batch.column("x")[i].as_py(), width, n_parts), None
                if batch.schema.get_field_index("codes") >= 0:
                    old = np.frombuffer(batch.column("codes")[i].as_py(), "<u2").reshape(-1, n_parts).astype(np.int64)
                new = np.stack([nearest(x[:, p], books[p]) for p in range(n_parts)], axis=1)
                for p in range(n_parts):
                    total[p] += contributions(x[:, p], new[:, p], None if old is None else old[:, p], n_entries)
                if held:
                    yield row(*held, none)
                held = batch.column("pack")[i].as_py(), new, new.size if old is None else int((new != old).sum())
        if held:
            yield row(*held, np.flatnonzero(total))

    rows = packs.table.select("pack", "x")
    if before is not None:
        rows = rows.join(before.select("pack", "codes").hint("shuffle_hash"), "pack")
    return stage_by(rows.mapInArrow(releasing(work), ASSIGNED), "pack", packs.n_buckets, "assigned")


def fit_codebooks(packs: Packs, n_parts: int, rounds: int) -> np.ndarray:
    """(parts, entries, components) after so many rounds, from the parts of ``packs.first``."""
    books = packs.first.astype(np.int64).reshape(len(packs.first), n_parts, -1).transpose(1, 0, 2)
    sums, before, running = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64), None, None
    for _ in range(rounds):
        before = assign_round(packs, before, books)
        changes = before.select(F.explode(F.arrays_zip("places", "amounts")).alias("c")).select(F.col("c.places").alias("place"), F.col("c.amounts").alias("amount"))
        rows = changes if running is None else changes.union(running)
        running = stage(rows.groupBy("place").agg(F.sum("amount").alias("amount")), "running-sums")
        for r in running.collect():  # a row at most for each number in the codebooks
            sums.ravel()[r["place"]] = r["amount"]
        used = sums[..., -1:] > 0
        books = np.where(used, sums[..., :-1] // np.maximum(sums[..., -1:], 1), books)
    return books


def encode_vectors(packs: Packs, books: np.ndarray) -> DataFrame:
    """``vec_id, code, error, label`` of every packed vector: its parts' nearest entries and their squared distances."""
    n_parts, _, size = books.shape
    width, digits = packs.width, max(2, len(f"{books.shape[1] - 1:x}"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                x = _parts(batch.column("x")[i].as_py(), width, n_parts) if width else np.zeros((len(ids), n_parts, 0), np.int32)
                codes = np.stack([nearest(x[:, p], books[p]) for p in range(n_parts)], axis=1)
                error = sum(((x[:, p] - books[p][codes[:, p]]) ** 2).sum(axis=1) for p in range(n_parts))
                absent = np.unpackbits(np.frombuffer(batch.column("null_ids")[i].as_py(), np.uint8), count=len(ids)).astype(bool)
                label = pa.ipc.open_stream(batch.column("labels")[i].as_py()).read_all()["label"].combine_chunks()
                code = pa.array(["".join(f"{c:0{digits}x}" for c in own) for own in codes.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=absent), code, pa.array(error, pa.int64()), label], ["vec_id", "code", "error", "label"])

    return packs.table.mapInArrow(releasing(work), "vec_id long, code string, error long, label string")


def lloyd_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 1024, n_parts: int = 4, n_entries: int = 256, rounds: int = 4, pack_rows: int = 4096
) -> DataFrame:
    """Codes of all vectors: ``vec_id, code, error, label_error, codebooks_sha256``.

    Component x counts as floor(scale * x). Vectors are cut into ``n_parts`` equal parts; each part's
    codebook starts as that part of the vectors with the ``n_entries`` smallest ids and is refined in
    ``rounds`` rounds; entries that no part uses stay. Equally near entries: the first. ``code`` has two
    hexadecimal digits a part (more, if entries need them), ``error`` the squared distances, ``label_error`` their sum
    over the rows of one label, null labels together, ``codebooks_sha256`` the hash of all entries.

    Null vectors and vectors with null or non-finite components are left out. Vectors of other lengths are filled up with
    zeros to the longest, and all to a multiple of ``n_parts``. Components beyond 2**24 once scaled count as 2**24, negative
    ones as -2**24. Null ids are kept; they rank after all others for the first codebooks, as repeated ids do by their vectors.
    A label's sum beyond 64 bits is null. Other columns are not read. An empty table gives no rows.
    """
    packs = pack_vectors(vectors, id_col, vector_col, label_col, scale, n_parts, n_entries, pack_rows)
    if not packs.n_rows:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    books = fit_codebooks(packs, n_parts, rounds) if packs.width else np.zeros((n_parts, len(packs.first), 0), np.int64)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = stage(encode_vectors(packs, books), "codes")
    # Written, so that both sides of the join are plain scans and a hot label's partition can be split at run time.
    labels = stage(coded.groupBy(F.col("label").alias("own")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    found = coded.join(labels, F.col("label").eqNullSafe(F.col("own")))
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
