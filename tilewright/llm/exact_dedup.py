"""Exact dedup by content-defined chunk recipes, in DataFrame operations only.

A text is cut into chunks at places that its content alone decides: after
``min_chars`` characters, at the next line feed or sentence mark followed by
white space, and after ``max_chars`` characters at the latest. A text's recipe is
the ordered list of its chunks' identifiers; texts are equal when recipes are.

Identifiers are verified. A chunk's is its 64-bit hash; the distinct chunks are
gathered once, content included, and where two different chunks share a hash
they get an ordinal beside it. The texts therefore move once, as distinct chunks
(combined before the shuffle, so that a chunk held by a third of all documents
is one row per task); everything after handles recipes of 8 bytes a chunk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.scratch import stage

CUT = r"(?:(?<=\n)|(?<=[.!?]\s))"


def chunk_pattern(min_chars: int, max_chars: int) -> str:
    """Matches one chunk; repeated matching covers the text without gaps."""
    if not 0 < min_chars <= max_chars:
        raise ValueError("0 < min_chars <= max_chars is needed")
    return rf"(?s).{{{min_chars}}}.{{0,{max_chars - min_chars}}}?{CUT}|.{{1,{max_chars}}}"


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 1024,
    max_chars: int = 8192,
    chunk_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """Group documents with identical text; the largest id of a group stays.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``. A null text counts as empty, and all empty texts are equal. A
    null id ranks below every other; a group of null ids alone has a null
    ``keep_id`` and all its rows are kept. Rows that repeat both id and text are
    one document: they count in ``group_size`` and are kept or dropped together.
    Other columns are not read, so their names cannot clash. An empty table gives
    an empty result.
    """
    chunks = F.regexp_extract_all("text", F.lit(chunk_pattern(min_chars, max_chars)), F.lit(0))
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    recipes = base.select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), F.transform(chunks, lambda c: chunk_hash(c)).alias("recipe"))
    recipes = stage(recipes, "recipes")

    store = base.select(F.explode(chunks).alias("chunk")).select(chunk_hash(F.col("chunk")).alias("h"), "chunk").distinct()
    shared = stage(store.groupBy("h").count().where("count > 1").select("h"), "shared-hashes")
    if not shared.isEmpty():
        recipes = stage(_with_ordinals(recipes, base, chunks, store, shared, chunk_hash), "verified-recipes")

    groups = recipes.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # Written, so that both sides of the join are plain scans and a hot recipe's partition can be split at run time.
    groups = stage(groups.where("group_size > 1"), "groups")
    found = recipes.join(groups, "recipe", "left")
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        size.alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _with_ordinals(
    recipes: DataFrame, base: DataFrame, chunks: Column, store: DataFrame, shared: DataFrame, chunk_hash: Callable[[Column], Column]
) -> DataFrame:
    """Recipes of (hash, ordinal): the ordinal tells different chunks of one hash apart."""
    ordinal = F.row_number().over(Window.partitionBy("h").orderBy("chunk")) - 1
    ordinals = stage(store.join(shared, "h", "left_semi").withColumn("ordinal", ordinal).where("ordinal > 0"), "ordinals")
    placed = base.select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), F.posexplode(chunks).alias("pos", "chunk"))
    placed = placed.withColumn("h", chunk_hash(F.col("chunk"))).join(ordinals, ["h", "chunk"])
    patch = placed.select(F.col("doc_id").alias("patch_id"), "sha", "pos", "ordinal").distinct()
    patch = patch.groupBy("patch_id", "sha").agg(F.map_from_entries(F.collect_list(F.struct("pos", "ordinal"))).alias("patch"))
    own = recipes.alias("r").join(patch.alias("p"), F.col("r.doc_id").eqNullSafe(F.col("patch_id")) & (F.col("r.sha") == F.col("p.sha")), "left")
    nth = lambda h, i: F.struct(h.alias("h"), F.coalesce(F.try_element_at("patch", i), F.lit(0)).alias("ordinal"))
    return own.select("r.doc_id", "r.sha", F.transform("recipe", nth).alias("recipe"))
