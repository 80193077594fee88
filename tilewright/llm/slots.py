"""What the two repeated-passage operators share: slots of documents, and exchanges of sorted runs by bucket.

Documents are first written as *slots* of some MB of text each, in a table bucketed
by slot, so that joining what later steps find to the texts moves only the
findings. Each slot sends its distinct keys, sorted and packed, to *buckets*
(ranges of keys); a bucket answers with the numbers of the keys that it found, and a
slot gets the answers to its own keys. A passage that very many documents share
is one key per slot.

A slot cuts its keys into a bounded number of ranges, so rows grow with the number of slots. Where the
corpus needs finer buckets, a second shuffle cuts each range again, with the runs of
many slots put together first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.scratch import new_path
from tilewright.llm.workers import releasing

NO_ID = np.iinfo(np.int64).max  # stands for a null id: larger than any other
RUNS = "bucket long, slot long, data array<binary>"
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes of packed runs that a task of the second shuffle puts together before it cuts them again.
TOGETHER = 32 << 20


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


class RollingHash:
    """64-bit polynomial hashes of runs of a sequence of hashes, by differences of prefix sums."""

    def __init__(self, radix: int) -> None:
        self.radix = radix
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        n = len(values) + 1
        if len(self.up) < n:
            grow = lambda r: np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, np.uint64(r)))), dtype=np.uint64)
            self.up, self.down = grow(self.radix), grow(pow(self.radix, -1, 1 << 64))
        return np.concatenate(([np.uint64(0)], np.cumsum(values * self.up[: n - 1], dtype=np.uint64)))

    def runs(self, sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        return mix((sums[starts + length] - sums[starts]) * self.down[starts])


def pack(values: np.ndarray) -> bytes:
    """A matrix of bytes by rows, or 64-bit numbers by byte planes, compressed."""
    if values.ndim == 2:
        width, raw = values.shape[1], values.tobytes()
    else:
        width, raw = 0, np.ascontiguousarray(np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
    return width.to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes) -> np.ndarray:
    width, raw = int.from_bytes(data[:4], "little"), zstandard.ZstdDecompressor().decompress(data[4:])
    if width:
        return np.frombuffer(raw, np.uint8).reshape(-1, width)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def pack_steps(values: np.ndarray) -> bytes:
    """Numbers by their differences: small where they rise."""
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_steps(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def write_slots(docs: DataFrame, text_bytes: int, describe: Callable[[pa.Table], list[bytes]] = lambda table: []) -> DataFrame:
    """``slot, n_bytes, docs, about``: rows of ``docs`` (whose first columns are the id and the text) in packs of about ``text_bytes``.

    A longer document is a slot of its own. ``about`` is what ``describe`` says of the slot. The table is bucketed by slot. Its
    files are in the shared folder; its name is dropped at once, as only the returned DataFrame needs it.
    """
    spark = docs.sparkSession

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor, slot = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 24

        def row(parts: list[pa.RecordBatch], n: int) -> pa.RecordBatch:
            sink, table = pa.BufferOutputStream(), pa.Table.from_batches(parts)
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            data = compressor.compress(memoryview(sink.getvalue()))
            columns = [pa.array([slot], pa.int64()), pa.array([n], pa.int64()), pa.array([data], pa.binary()), pa.array([describe(table)], pa.list_(pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, ["slot", "n_bytes", "docs", "about"])

        parts: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            first = 0
            for i, size in enumerate(sizes):
                if held and held + size > text_bytes:
                    yield row([*parts, batch.slice(first, i - first)], held)
                    parts, held, slot, first = [], 0, slot + 1, i
                held += size
            parts.append(batch.slice(first))
        if parts and sum(p.num_rows for p in parts):
            yield row(parts, held)

    slots = docs.mapInArrow(releasing(work), "slot long, n_bytes long, docs binary, about array<binary>")
    n_buckets = min(100_000, max(8, 2 * docs.rdd.getNumPartitions()))
    name = f"slots_{uuid.uuid4().hex}"
    slots.write.bucketBy(n_buckets, "slot").option("path", new_path(spark, "slots")).option("compression", "none").format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def read_slot(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()


def texts_of(table: pa.Table) -> list[bytes]:
    """The texts in UTF-8; null is empty."""
    return [t or b"" for t in table.column(1).cast(pa.binary()).to_pylist()]


def ids_of(table: pa.Table) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in table.column(0).to_pylist()], np.int64)


def with_answers(slots: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """Slots with a column ``a0, a1, ...`` of each exchange's answers to the slot's own keys (null: none). The table of slots is not shuffled."""
    for i, answer in enumerate(answers):
        own = answer.groupBy("slot").agg(F.collect_list(F.struct("bucket", "data")).alias(f"a{i}"))
        slots = slots.join(own.hint("shuffle_hash"), "slot", "left")
    return slots


def slot_rows(batches: Iterator[pa.RecordBatch], n_answers: int) -> Iterator[tuple[int, pa.Table, list[bytes], list[list]]]:
    """Slot, documents, what is said of it and the data of each exchange's answers, by bucket."""
    for batch in batches:
        for i in range(batch.num_rows):
            told = [[a["data"] for a in sorted(batch.column(f"a{k}")[i].as_py() or [], key=lambda a: a["bucket"])] for k in range(n_answers)]
            yield batch.column("slot")[i].as_py(), read_slot(batch.column("docs")[i].as_py()), batch.column("about")[i].as_py(), told


def numbers_told(told: list[list[bytes]], n: int) -> np.ndarray:
    """Which of a slot's ``n`` keys the answers name."""
    out = np.zeros(n, bool)
    for data in told:
        out[unpack_steps(data[0]).astype(np.int64)] = True
    return out


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)


def runs_of(slot: int, keys: np.ndarray, n_buckets: int, values: list[np.ndarray]) -> Iterator[tuple]:
    """Rows of ``RUNS`` for sorted keys: in ``data`` their numbers, then the values."""
    cuts = np.flatnonzero(np.diff(bucket_of(keys, n_buckets))) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]) if len(keys) else ():
        yield int(bucket_of(keys[a : a + 1], n_buckets)[0]), slot, [pack_steps(np.arange(a, b)), *(v(a, b) if callable(v) else pack(v[a:b]) for v in values)]


def to_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.list_(pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["bucket", "slot", "data"])


def read_runs(slots: list[int], data: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Slot and number of each entry, and the values; runs of many slots (slot -1) carry the slots as their last value."""
    parts = []
    for slot, d in zip(slots, data):
        number, values = unpack_steps(d[0]), list(map(unpack, d[1:]))
        own = unpack_steps(d[-1]) if slot < 0 else np.full(len(number), slot, np.uint64)
        parts.append((own, number, *(values[:-1] if slot < 0 else values)))
    slot, number, *values = (np.concatenate(x) for x in zip(*parts))
    return slot.astype(np.int64), number.astype(np.int64), values


def split_runs(runs: DataFrame, per_bucket: int, n_buckets: int, key_of: Callable[[list[np.ndarray]], np.ndarray]) -> DataFrame:
    """Each of ``n_buckets`` cut into ``per_bucket``, by a second shuffle of runs that are put together first; as it is for one."""
    if per_bucket < 2:
        return runs

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, held, size = [], [], 0
        for batch in batches:
            for slot, data in zip(batch.column("slot").to_pylist(), batch.column("data").to_pylist()):
                slots.append(slot), held.append(data)
                size += sum(map(len, data))
                if size >= TOGETHER:
                    yield cut(slots, held)
                    slots, held, size = [], [], 0
        if held:
            yield cut(slots, held)

    def cut(slots: list[int], held: list[list[bytes]]) -> pa.RecordBatch:
        slot, number, values = read_runs(slots, held)
        fine = bucket_of(key_of(values), per_bucket * n_buckets)
        order = np.argsort(fine, kind="stable")
        parts = np.split(order, np.flatnonzero(np.diff(fine[order])) + 1)
        return to_batch([(int(fine[p[0]]), -1, [pack_steps(number[p]), *(pack(v[p]) for v in values), pack_steps(slot[p])]) for p in parts])

    return runs.repartition("bucket").mapInArrow(releasing(split), RUNS)


def by_slot(bucket: int, slot: np.ndarray, number: np.ndarray, *values: np.ndarray) -> list[tuple]:
    """Rows of ``RUNS`` that tell each slot the numbers found, with values."""
    order = np.lexsort((number, slot))
    cuts = np.flatnonzero(np.diff(slot[order])) + 1
    return [(bucket, int(slot[p[0]]), [pack_steps(number[p]), *(pack(v[p]) for v in values)]) for p in (np.split(order, cuts) if len(order) else ())]


def exchange(slots: DataFrame, n_answers: int, emit: Callable, find: Callable, n_buckets: int, most_buckets: int) -> DataFrame:
    """Rows of ``RUNS`` that tell each slot which of its keys are found.

    ``emit(slot, documents, about, answers)`` gives sorted distinct keys and a list of values; ``find(slots, keys, *values)`` says
    for all entries of a bucket which are found. A slot cuts its keys into ``most_buckets`` at most.
    """
    coarse = min(n_buckets, most_buckets)
    per = -(-n_buckets // coarse)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, table, about, told in slot_rows(batches, n_answers):
            keys, values = emit(slot, table, about, told)
            yield to_batch(list(runs_of(slot, keys, coarse, [keys, *values])))

    def take(key: tuple, table: pa.Table) -> pa.Table:
        slot, number, values = read_runs(table["slot"].to_pylist(), table["data"].to_pylist())
        found = np.flatnonzero(find(slot, *values))
        return pa.Table.from_batches([to_batch(by_slot(key[0].as_py(), slot[found], number[found]))])

    runs = split_runs(slots.mapInArrow(releasing(give), RUNS), per, coarse, lambda values: values[0])
    return runs.groupBy("bucket").applyInArrow(take, RUNS)


def in_two_slots(slot: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Keys are distinct in a slot, so one that occurs twice is in two."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order] = np.append(same, False) | np.append(False, same)
    return out
