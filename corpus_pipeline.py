"""A corpus pipeline from raw documents to packed sequences: five stages, each of which calls one operator.

Every stage works on all rows that the stage before it kept. Between stages the
documents are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm.exact_dedup import exact_dedup
from tilewright.llm.language_id import UNDETERMINED, fit_language_model, identify_language
from tilewright.llm.near_copies import near_copies
from tilewright.llm.packing import pack_documents
from tilewright.llm.scratch import stage
from tilewright.llm.substring_dedup import remove_repeats

#: Under this share the best language is little better than a guess, and the document is rejected.
LEAST_LANGUAGE_SCORE = 0.4
#: Documents whose sets of 5-word shingles are this alike are near copies.
LEAST_SIMILARITY = 0.8


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters and a language; the rest goes."""
    model = fit_language_model(docs, F.lit(True))
    names = [f"own_{i}" for i in range(len(docs.columns))]
    found = identify_language(docs, model, keep_columns=True).toDF(*names, "lang_pred", "score", "ambiguous")
    kept = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.where(kept).select(*names).toDF(*docs.columns)


def keep_one_of_each(docs: DataFrame, stays: DataFrame, text_hash: Column) -> DataFrame:
    """One row of ``docs`` for each id and hash of a text in ``stays`` (``stays_id, stays_hash``, a row for each row of the table that may stay).

    Rows that are alike in both are reduced to any one of them; the others, nearly all, are not shuffled for that.
    """
    stays = stage(stays.groupBy("stays_id", "stays_hash").agg(F.count("*").alias("n")), "stays")

    def having(which: str) -> DataFrame:
        own = stays.where(which)
        return docs.join(own, docs["doc_id"].eqNullSafe(own["stays_id"]) & (text_hash == own["stays_hash"]), "left_semi")

    names = [f"own_{i}" for i in range(len(docs.columns))]
    again = having("n > 1").select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], text_hash.alias("own_hash"))
    return having("n = 1").union(again.dropDuplicates([names[docs.columns.index("doc_id")], "own_hash"]).drop("own_hash"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (null counts as empty) the one with the largest id; a null id only if there is no other. Of repeated rows one stays."""
    stays = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("stays_id"), F.col("text_sha256").alias("stays_hash"))
    return keep_one_of_each(docs, stays, F.sha2(F.coalesce(docs["text"], F.lit("")), 256))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that a 5-word Jaccard similarity of 0.8 or more links, the one with the smallest id; a null id only if there is no other. Of repeated rows one stays."""
    found = near_copies(docs, least=LEAST_SIMILARITY, shingle_words=5)
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("kept_hash")))
    stays = stays.select(F.col("doc_id").alias("stays_id"), F.col("kept_hash").alias("stays_hash"))
    return keep_one_of_each(docs, stays, F.xxhash64(F.coalesce(docs["text"], F.lit(""))))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that a smaller id holds in the same run of 13; those left without words go. ``n_chars``, where it is there, follows."""
    names = [f"own_{i}" for i in range(len(docs.columns))]
    own = {c: F.col(n) for c, n in zip(docs.columns, names)}
    cut = remove_repeats(docs, keep_columns=True).toDF(*names, "removed").where((F.col("removed") == 0) | (F.trim(own["text"]) != ""))
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("removed") > 0, F.char_length(own["text"])).otherwise(own["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return cut.select(*[own[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4,096 tokens."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack),
]

#: Language identification, fingerprints and tokenization cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
