"""Approximate nearest neighbours by a permutation index.

For each length of vectors, pivots are drawn from the distinct ones, their number growing with the root of the vectors' number. Each vector is represented by
the pivots nearest to it, in order, and posted in the inverted files of the first few of these. A query reads the files of its own nearest pivots, a fixed number,
so that the rows it meets grow with the root of the table as long as pivots do. What it finds there is
ranked by the footrule distance between the two lists of pivots, and the best share is reranked by the exact cosine.

Files and the queries that read them are cut into blocks of bounded size, so a
file that holds a third of all vectors is many tasks; no candidate is left out for being in a long file. As the best
share of each block is reranked, not a number, what is found does not depend on how many blocks there are.
Vectors are posted with their files, a fixed number of times: the pairs that are reranked would fetch each vector more often than the files hold it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.llm.scratch import stage

FOUND = "query_id long, vec_id long, score double"


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v, dim``: rows with an id and a vector that is finite and not zero. Floats stay floats, other numbers become doubles."""
    floats = isinstance(vectors.schema[vector_col].dataType, T.ArrayType) and isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    v = F.col(vector_col) if floats else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    bad: Column = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(~bad & F.exists("v", lambda x: x != 0))
    return rows.withColumn("dim", F.size("v"))


def draw_pivots(good: DataFrame, n_pivots: int | None, per_root: float, most: int) -> dict[int, np.ndarray]:
    """Distinct vectors of each length, of length 1, drawn by hash: ``n_pivots``, or ``per_root`` times the root of their number and ``most`` at most; about twice as many reach the driver."""
    kinds = good.groupBy("dim").agg(F.approx_count_distinct(F.xxhash64("v")).alias("n")).collect()
    if not kinds:
        return {}
    wanted = {r["dim"]: n_pivots or int(min(most, max(64, np.ceil(per_root * r["n"] ** 0.5)))) for r in kinds}
    share = F.create_map(*[F.lit(x) for r in kinds for x in (r["dim"], min(1.0, 2 * wanted[r["dim"]] / r["n"]) if r["n"] > wanted[r["dim"]] else 1.0)])
    place = F.xxhash64("v").cast("double") / 2.0**64 + 0.5
    drawn = good.where(place <= F.element_at(share, F.col("dim"))).select("dim", "v").distinct().withColumn("place", place).collect()
    out: dict[int, list] = {}
    for r in sorted(drawn, key=lambda r: (r["place"], r["v"])):
        own = out.setdefault(r["dim"], [])
        if len(own) < wanted[r["dim"]]:
            own.append(r["v"])
    return {dim: _unit(np.array(own, np.float64)) for dim, own in out.items()}


def nearest_pivots(unit: np.ndarray, pivots: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest pivots of each row, by falling cosine; equal ones in pivot order."""
    far = -(unit @ pivots.T)
    if far.shape[1] <= 2 * n:
        return np.argsort(far, axis=1, kind="stable")[:, :n]
    near = np.sort(np.argpartition(far, n - 1, axis=1)[:, :n], axis=1)
    return np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable"), axis=1)


def footrules(lists: np.ndarray, own: np.ndarray, n_pivots: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances of lists of pivots (rows) from a query's, and each list's places in it: a pivot that the query's list lacks stands behind its end."""
    n = len(own)
    place = n + np.arange(n_pivots, dtype=np.int32)
    place[own] = np.arange(n)
    seen = place[lists]
    return np.abs(np.minimum(seen, n) - np.arange(lists.shape[1])).sum(axis=1), seen


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)  # no square over- or underflows
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def permutation_search(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    n_pivots: int | None = None,
    post_in: int = 8,
    read_from: int = 96,
    rerank_share: float = 0.5,
    rerank_least: int = 64,
    block_rows: int = 8192,
    pivots_per_root: float = 6.0,
    most_pivots: int = 65536,
) -> DataFrame:
    """The ``k`` nearest vectors found for each row with ``is_query``: ``query_id, rank, vec_id, score``.

    The sample that the index is fitted on has ``pivots_per_root`` times the root of the number of vectors, ``most_pivots`` at most, for each length of vectors (or
    ``n_pivots``); every vector is posted. ``rerank_share`` of what a query finds in a block of a file, ``rerank_least`` at least, is
    scored. With ``read_from`` no less than the pivots and a share of 1 the search is exact. A query that finds fewer than ``k`` reads all files. Ties go to the
    smaller id. Null ids, null or zero vectors and vectors with null or non-finite
    components take no part; vectors of different lengths have no cosine and never meet. A row is never
    its own neighbour, nor is another row with its id; where an id is repeated, its
    best score counts. Other columns serve only in ``is_query``. An empty table
    gives no rows.
    """
    good = usable_vectors(vectors, id_col, vector_col)
    asked = vectors.where(F.coalesce(is_query, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id")).distinct()
    pivots = draw_pivots(good, n_pivots, pivots_per_root, most_pivots)
    sizes = {dim: len(p) for dim, p in pivots.items()}
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)  # bounded by most_pivots

    def post(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = pa.Table.from_batches([batch.slice(first, 1024)])
                for dim in set(part["dim"].to_pylist()):
                    own = part.filter(pa.compute.equal(part["dim"], dim))
                    order = nearest_pivots(_unit(_matrix(own["v"], dim)), shared.value[dim], read_from)
                    files = pa.array(list(order.astype(np.int32)), pa.list_(pa.int32()))
                    yield from own.append_column("files", files).combine_chunks().to_batches()

    index = stage(good.mapInArrow(post, T.StructType([*good.schema.fields, T.StructField("files", T.ArrayType(T.IntegerType()))])), "permutations")
    queries = stage(index.join(asked, "vec_id", "left_semi"), "queries")
    settings = (sizes, post_in, k, rerank_share, rerank_least, block_rows)
    found = stage(_read_files(index, queries, F.col("files"), *settings), "found")
    per_query = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n"))
    short = stage(queries.join(per_query.where(F.col("n") >= k), F.col("vec_id") == F.col("query_id"), "left_anti"), "short-queries")
    if not short.isEmpty():
        every = F.create_map(*[x for dim, n in sizes.items() for x in (F.lit(dim), F.lit(n))])
        found = found.union(_read_files(index, short, F.sequence(F.lit(0), F.element_at(every, F.col("dim")) - 1), *settings))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(v: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.array(v.combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def _lists(files: pa.ChunkedArray) -> np.ndarray:
    """Lists of pivots as rows; those of one length of vectors are equally long."""
    return files.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(files), -1)


def _read_files(
    index: DataFrame, queries: DataFrame, files: Column, sizes: dict[int, int], post_in: int, k: int, share: float, least: int, block_rows: int
) -> DataFrame:
    """The ``k`` best of each query in each block of each file it reads; a pair is judged in the first file of the query's that holds it."""
    posted = index.select("vec_id", "v", "dim", "files", F.explode(F.slice("files", 1, post_in)).alias("file"))
    asking = queries.select("vec_id", "v", "dim", "files", F.explode(files).alias("file"))
    # A row for each pivot at most.
    blocks = lambda rows, name: rows.groupBy("dim", "file").agg(F.ceil(F.count("*") / block_rows).cast("int").alias(name))
    parts = stage(blocks(posted, "n_rows").join(blocks(asking, "n_cols"), ["dim", "file"]), "blocks")
    own = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    posted = posted.join(parts, ["dim", "file"]).withColumns({"row_block": own("n_rows"), "query_block": each("n_cols")}).drop("n_rows", "n_cols")
    asking = asking.join(parts.toDF(*parts.columns), ["dim", "file"]).withColumns({"query_block": own("n_cols"), "row_block": each("n_rows")}).drop("n_rows", "n_cols")

    def search(key, asking: pa.Table, posted: pa.Table) -> pa.Table:
        dim, file, out = key[0].as_py(), key[1].as_py(), []
        if asking.num_rows and posted.num_rows:
            posted = posted.sort_by("vec_id")
            ids, unit, lists = posted["vec_id"].to_numpy(), _unit(_matrix(posted["v"], dim)), _lists(posted["files"])
            for query_id, u, own in zip(asking["vec_id"].to_pylist(), _unit(_matrix(asking["v"], dim)), _lists(asking["files"])):
                distance, seen = footrules(lists, own, sizes[dim])
                at = np.flatnonzero(own == file)
                mine = np.flatnonzero((seen[:, :post_in].min(axis=1) == (at[0] if len(at) else len(own) + file)) & (ids != query_id))
                n = max(least, int(np.ceil(share * len(mine))))
                if len(mine) > n:
                    mine = mine[np.argpartition(distance[mine].astype(np.int64) * len(ids) + mine, n - 1)[:n]]
                score = (unit[mine] * u).sum(axis=1)
                top = np.lexsort((ids[mine], -score))[:k]
                out += [(query_id, ids[mine[t]], score[t]) for t in top]
        columns = list(zip(*out)) if out else [(), (), ()]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], ["query_id", "vec_id", "score"])

    keys = ["dim", "file", "row_block", "query_block"]
    return asking.groupBy(*keys).cogroup(posted.groupBy(*keys)).applyInArrow(search, FOUND)
