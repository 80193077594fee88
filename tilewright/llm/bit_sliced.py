"""Exact top-k inner products by a bit-sliced index.

Rows are dealt to blocks of bounded size by the hash of their id. In a block, an attribute (a position of the quantised
vectors) is kept as bit slices: one bitmap over the block's rows for each bit of the attribute's distance from its
least value. The index is a table of blocks in the shared folder.

A query is a weight for each attribute. A weight is written in signed binary digits; a positive
digit 2**a adds the attribute's slices, shifted by a, a negative one the complements of the slices
(the distance from the other end of the attribute's range), so that everything added is positive. Bitmaps of one
significance are added three at a time by a carry-save adder (a sum bitmap and a carry bitmap), until
one is left of each: the slices of all rows' scores. The best rows are then chosen from the most significant slice down:
a slice either splits the rows that are still undecided, or its rows are all taken. What is still
undecided after the last slice has equal scores, and the smallest ids among it fill the rest; exact
scores are read from the slices of the chosen rows.

Queries are searched in blocks against blocks of rows; each pair of blocks gives at most k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.scratch import stage


INDEX = "dim int, row_block int, n_rows int, ids binary, least array<long>, widths array<int>, slices binary"
FOUND = "query_id long, query_no int, vec_id long, score long"


def signed_digits(weight: int) -> list[tuple[int, int]]:
    """Signs and places of a number's binary digits, no two of them next to each other."""
    out, place = [], 0
    while weight:
        if weight & 1:
            digit = 2 - (weight & 3)
            out.append((digit, place))
            weight -= digit
        weight >>= 1
        place += 1
    return out


def slice_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least values and widths of the attributes (columns of ``x``), and their slices one below the other, least significant first, as 64-bit words."""
    least = x.min(axis=0) if len(x) else np.zeros(x.shape[1], np.int64)
    above = (x - least).astype(np.uint64)
    widths = np.array([int(m).bit_length() for m in (above.max(axis=0) if len(x) else [])], np.int64)
    words = -(-len(x) // 64)
    out = np.zeros((int(widths.sum()), words * 8), np.uint8)
    at = 0
    for j, width in enumerate(widths.tolist()):
        for b in range(width):
            bits = np.packbits((above[:, j] >> np.uint64(b)).astype(np.uint8) & 1, bitorder="little")
            out[at, : len(bits)] = bits
            at += 1
    return least, widths, out.view(np.uint64)


def add_slices(by_place: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of the sum of all bitmaps, each counting 2**place; least significant first, None where no row can have a bit."""
    out, place = [], 0
    while by_place and place <= max(by_place):
        parts = by_place.pop(place, [])
        own = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty((0, 0), np.uint64)
        while len(own) > 1:
            n = len(own) // 3
            if n:
                a, b, c = own[:n], own[n : 2 * n], own[2 * n : 3 * n]
                half = a ^ b
                total, carry, own = half ^ c, (half & c) | (a & b), own[3 * n :]
                own = np.concatenate([own, total]) if len(own) else total
            else:
                carry, own = own[:1] & own[1:], own[:1] ^ own[1:]
            by_place.setdefault(place + 1, []).append(carry)
        out.append(own[0] if len(own) else None)
        place += 1
    return out


def score_slices(weights: np.ndarray, least: np.ndarray, widths: np.ndarray, slices: np.ndarray, inverse: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices of the rows' inner products with ``weights``, less a constant, and the constant. ``inverse`` has the complements of the slices."""
    constant, starts, chosen = 0, np.cumsum(widths) - widths, {}
    for j, weight in enumerate(weights.tolist()):
        width, first = int(widths[j]), int(starts[j])
        for sign, place in signed_digits(weight):
            constant += sign * (int(least[j]) + (0 if sign > 0 else (1 << width) - 1)) << place
            for b in range(width):
                chosen.setdefault(place + b, ([], []))[sign < 0].append(first + b)
    by_place = {p: [m[rows] for m, rows in ((slices, plus), (inverse, minus)) if rows] for p, (plus, minus) in chosen.items()}
    return add_slices(by_place), constant


def top_rows(score: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` rows with the largest scores among the allowed ones, the first of equal ones; all, if they are fewer."""
    taken, open_ = np.zeros_like(allowed), allowed
    count = lambda bits: int(np.bitwise_count(bits).sum())
    have = 0
    for bits in reversed(score):
        if bits is None:
            continue
        ones = open_ & bits
        n = count(ones)
        if have + n > k:
            open_ = ones
        else:
            taken, have, open_ = taken | ones, have + n, open_ & ~bits
            if have == k:
                break
    return np.concatenate([_positions(taken), _positions(open_)[: k - have]])


def _positions(bits: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))


def read_scores(score: list[np.ndarray], rows: np.ndarray, constant: int) -> list[int]:
    word, shift = rows >> 6, (rows & 63).astype(np.uint64)
    total = [constant] * len(rows)
    for place, bits in enumerate(score):
        if bits is not None:
            total = [t + (int(b) << place) for t, b in zip(total, (bits[word] >> shift) & np.uint64(1))]
    return total


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, x, dim``: rows with an id and a finite vector, components as floor(scale * component), held within what scores of 64 bits allow."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    most = F.floor(F.sqrt(F.lit(2.0**62) / F.greatest(F.size(v), F.lit(1)))).cast("double")
    whole = F.transform(v, lambda x: F.greatest(-most, F.least(most, F.floor(F.greatest(-most, F.least(most, x * scale))))).cast("long"))
    return rows.select("vec_id", whole.alias("x"), F.size(v).alias("dim"))


def build_index(rows: DataFrame, block_rows: int) -> DataFrame:
    """A row for each block of about ``block_rows`` rows of one length of vectors: ids in rising order, least values, widths and slices."""
    counts = stage(rows.groupBy("dim").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("n_blocks")), "row-blocks")
    # Rows of one id go apart by their vectors; what repeats both is dealt out by a number of its own.
    dealt = rows.join(counts, "dim").withColumn("row_block", F.pmod(F.xxhash64("vec_id", "x", F.monotonically_increasing_id()), "n_blocks").cast("int"))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        dim, block = key[0].as_py(), key[1].as_py()
        table = table.sort_by("vec_id")
        ids, x = table["vec_id"].to_numpy(), _matrix(table["x"], dim)
        least, widths, slices = slice_rows(x)
        row = [dim, block, len(ids), ids.astype("<i8").tobytes(), least, widths.astype(np.int32), slices.tobytes()]
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
        return pa.table([pa.array([c], t) for c, t in zip(row, types)], ["dim", "row_block", "n_rows", "ids", "least", "widths", "slices"])

    return stage(dealt.select("dim", "row_block", "vec_id", "x").groupBy("dim", "row_block").applyInArrow(build, INDEX), "bit-slices")


def _matrix(x: pa.ChunkedArray, dim: int) -> np.ndarray:
    return x.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(x), dim)


def search_block(block: dict, ids: list[int], numbers: list[int], weights: np.ndarray, k: int) -> Iterator[tuple[int, int, int, int]]:
    """The ``k`` best rows of a block for each query (id, number, weights); rows with the query's own id are no candidates."""
    held = np.frombuffer(block["ids"], "<i8")
    least, widths = np.array(block["least"], np.int64), np.array(block["widths"], np.int64)
    words = -(-len(held) // 64)
    slices = np.frombuffer(block["slices"], np.uint64).reshape(-1, words)
    inverse, every = ~slices, np.zeros(words * 8, np.uint8)
    bits = np.packbits(np.ones(len(held), np.uint8), bitorder="little")
    every[: len(bits)] = bits
    for query, number, own in zip(ids, numbers, weights):
        allowed = np.unpackbits(every, bitorder="little")
        allowed[np.searchsorted(held, query) : np.searchsorted(held, query, "right")] = 0
        score, constant = score_slices(own, least, widths, slices, inverse)
        rows = top_rows(score, np.packbits(allowed, bitorder="little").view(np.uint64), k)
        for row, value in zip(rows.tolist(), read_scores(score, rows, constant)):
            yield query, number, int(held[row]), value


def top_products(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, scale: int = 64, block_rows: int = 16384, block_queries: int = 512
) -> DataFrame:
    """The ``k`` rows with the largest integer inner product for each row with ``is_query``: ``query_id, rank, vec_id, score``.

    Component x counts as floor(scale * x), for queries and rows alike. The result is exact; equal scores go to the smaller id,
    and a query with fewer candidates gets them all. Null ids, null vectors and vectors with null or non-finite components take
    no part; vectors of different lengths have no product and never meet; all products of empty vectors are 0. A row is never its own candidate, nor is another row with its id. A repeated
    candidate counts as often as it is there, and each row of a repeated query's id is ranked by itself (equal rows once). Components whose products could leave 64 bits
    count as the largest that cannot (2**28 for vectors of 64, once scaled). Other columns serve only in ``is_query``. An empty table gives no rows.
    """
    rows = stage(quantised(vectors, id_col, vector_col, scale), "quantised")
    index = build_index(rows, block_rows)
    asked = vectors.where(F.coalesce(is_query, F.lit(False))).select(id_col, vector_col)
    number = F.row_number().over(Window.partitionBy("vec_id").orderBy("x"))
    queries = stage(quantised(asked, id_col, vector_col, scale).distinct().withColumn("query_no", number), "asked")
    sizes = lambda df, name: df.groupBy("dim").agg(F.max(name).alias(name))
    n_rows = sizes(index.withColumn("n_row_blocks", F.col("row_block") + 1), "n_row_blocks")
    n_queries = queries.groupBy("dim").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("n_query_blocks"))
    plan = stage(n_rows.join(n_queries, "dim"), "block-pairs")  # a row for each length of vectors
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    blocks = index.join(plan.select("dim", "n_query_blocks"), "dim").withColumn("query_block", every("n_query_blocks")).drop("n_query_blocks")
    own = F.pmod(F.xxhash64("vec_id", "query_no"), "n_query_blocks").cast("int")
    asking = queries.join(plan, "dim").withColumn("query_block", own).withColumn("row_block", every("n_row_blocks")).select("dim", "row_block", "query_block", "vec_id", "query_no", "x")

    def search(key: tuple, asking: pa.Table, block: pa.Table) -> pa.Table:
        out = []
        for row in block.to_pylist() if asking.num_rows else ():  # one
            out += search_block(row, asking["vec_id"].to_pylist(), asking["query_no"].to_pylist(), _matrix(asking["x"], key[0].as_py()), k)
        columns = list(zip(*out)) if out else [(), (), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], ["query_id", "query_no", "vec_id", "score"])

    keys = ["dim", "row_block", "query_block"]
    found = asking.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
