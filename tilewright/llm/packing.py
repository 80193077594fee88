"""Packing in space-filling-curve order.

Every document's hashed vector (a fixed random vector per token id, averaged) is
projected to a few dimensions; its place on a Hilbert curve through them is the
sort key. Documents are range-sorted by that key and laid end to end; sequences
are cut from this one stream, so only the very last one has padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.prefix_sum import running_totals
from tilewright.llm.scratch import stage
from tilewright.llm.word_tokens import word_tokenizer
from tilewright.llm.workers import release, releasing

VOCABULARY = "word_bpe_49k.json"
END_ID = 2


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (rows) with ``bits`` bits a coordinate.

    The transposed index is found by undoing excess rotations from the highest
    bit down and Gray-decoding, then its bits are interleaved.
    """
    x = points.astype(np.uint64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = np.uint64(q - 1)
        for i in range(dims):
            swap = (x[0] ^ x[i]) & low
            set_ = (x[i] & np.uint64(q)) != 0
            x[0] ^= np.where(set_, low, swap)
            if i:
                x[i] ^= np.where(set_, np.uint64(0), swap)
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key.astype(np.int64)


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, dims: int = 4, bits: int = 12, seed: int = 7
) -> DataFrame:
    """``row_no, doc_id, n_tokens, curve_key, ids`` per row; ids are 16-bit and end with the end id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(vocabulary)
        random = np.random.default_rng(seed).standard_normal((65_536, dims)).astype(np.float32)
        end = np.array([END_ID], "<u2").tobytes()
        row_no = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                ids = [i + end for i in words.ids_of_all(part.column(1).to_pylist())]
                centres = np.array([random[np.frombuffer(i, "<u2")].mean(axis=0) for i in ids], np.float64).reshape(-1, dims)
                cells = np.clip((1 << bits) / (1 + np.exp(-8 * centres)), 0, (1 << bits) - 1).astype(np.int64)
                n = len(ids)
                columns = [
                    pa.array(np.arange(row_no, row_no + n)),
                    part.column(0),
                    pa.array([len(i) // 2 for i in ids], pa.int64()),
                    pa.array(hilbert_keys(cells, bits)),
                    pa.array(ids, pa.binary()),
                ]
                row_no += n
                yield pa.RecordBatch.from_arrays(columns, ["row_no", "doc_id", "n_tokens", "curve_key", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(releasing(encode), "row_no long, doc_id long, n_tokens long, curve_key long, ids binary"
    )


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, vocabulary: str = VOCABULARY, with_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``with_ids`` adds the piece's ids themselves (``ids array<int>``). Every row
    of the input gives at least one piece, because the end id follows even an
    empty or null text. Equal curve keys are ordered by id (nulls first), then by
    place in the input; repeated rows are packed each. Other columns are not
    read. An empty table gives no pieces.
    """
    encoded = stage(encode_documents(docs, id_col, text_col, vocabulary), "encoded")
    order = encoded.select("curve_key", "doc_id", "row_no", "n_tokens")
    placed = running_totals(order, ["curve_key", "doc_id", "row_no"], {"n_tokens": "first_token"}).select("row_no", "first_token")
    both = encoded.select("row_no", "doc_id", "ids").join(placed, "row_no").select("doc_id", "ids", "first_token")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_tokenizer.cache_clear()  # what encoding needed is not needed any more
        release()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids, first in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                tokens = np.frombuffer(ids.as_py(), "<u2").astype("<u4")
                at = 0
                while at < len(tokens):
                    place = first + at
                    piece = tokens[at : at + length - place % length]
                    row = (doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(tokens), place // length, place % length)
                    rows.append((*row, piece.astype(np.int32)) if with_ids else row)
                    at += len(piece)
            columns = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:7]] if rows else [pa.array([], pa.int64())] * 7
            if with_ids:
                columns.append(pa.array([r[7] for r in rows], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    return both.mapInArrow(releasing(cut), ", ".join(f"{n} long" for n in names[:7]) + ", ids array<int>" * with_ids)
