"""Token counts by an exact length histogram.

Documents are aggregated by encoded length; running sums over the lengths then
answer totals, quantiles and truncated totals for every context limit without
another look at the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.prefix_sum import running_totals
from tilewright.llm.word_tokens import word_tokenizer
from tilewright.llm.workers import releasing

VOCABULARY = "word_bpe_49k.json"


def token_lengths(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One ``n_tokens`` per row; null and empty texts have 0 tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                ids = words.ids_of_all(batch.column(0).slice(first, 1024).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array([len(i) // 2 for i in ids], pa.int64())], ["n_tokens"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(releasing(count), "n_tokens long")


def length_histogram(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per distinct encoded length.

    Columns: ``n_tokens, n_docs, n_tokens_total`` of that length;
    ``docs_at_least, tokens_at_least`` (suffix sums, this length included);
    ``truncated_total``, the tokens left when every document is cut to this
    length; ``share_at_most``, the share of documents no longer than it.
    Null and empty texts have length 0. Other columns are not read. An empty
    table gives no rows. Repeated rows each count.
    """
    lengths = token_lengths(docs, text_col, vocabulary)
    counts = lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens_total"))
    sums = running_totals(counts, ["n_tokens"], {"n_docs": "docs_before", "n_tokens_total": "tokens_before"})
    sums = running_totals(sums.withColumn("from_top", -F.col("n_tokens")), ["from_top"], {"n_docs": "docs_above", "n_tokens_total": "tokens_above"})
    at_least = F.col("docs_above") + F.col("n_docs")
    return sums.select(
        "n_tokens",
        "n_docs",
        "n_tokens_total",
        at_least.alias("docs_at_least"),
        (F.col("tokens_above") + F.col("n_tokens_total")).alias("tokens_at_least"),
        (F.col("tokens_before") + F.col("n_tokens") * at_least).alias("truncated_total"),
        ((F.col("docs_before") + F.col("n_docs")) / (F.col("docs_before") + at_least)).alias("share_at_most"),
    )


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit, total`` for any limits: tokens left when every document is cut to the limit."""
    sums = [F.coalesce(F.sum(F.least("n_tokens", F.lit(x)) * F.col("n_docs")), F.lit(0)).cast("long") for x in limits]
    row = histogram.agg(F.array(*sums).alias("total"))
    both = F.arrays_zip(F.array(*[F.lit(x).cast("long") for x in limits]).alias("context_limit"), F.col("total"))
    return row.select(F.inline(both)).toDF("context_limit", "total")


def length_quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """``share, n_tokens``: the smallest length that at least this share of documents does not exceed; null without documents."""
    least = [F.min(F.when(F.col("share_at_most") >= s, F.col("n_tokens"))) for s in shares]
    row = histogram.agg(F.array(*least).alias("n_tokens"))
    both = F.arrays_zip(F.array(*map(F.lit, shares)).alias("share"), F.col("n_tokens"))
    return row.select(F.inline(both)).toDF("share", "n_tokens")
