"""Streaming form of the per-tile stage: arriving tiles are decoded once each and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tilewright.operators import metrics, outcome


def arriving_tiles(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """A stream over a folder of Parquet files of tiles as read."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def once_each(tiles: DataFrame, time: str = "fetched_at", delay: str = "1 day") -> DataFrame:
    """A tile counts once, however often it arrives within the delay; state older than that is dropped."""
    return tiles.withColumn("arrived", F.to_timestamp(time)).withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["request_id", "job_index", "source_id", "source_zoom", "x", "y"])


def append_summaries(tiles: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Decode arriving tiles and append their summary rows to a Parquet table."""

    def write(batch: DataFrame, number: int) -> None:
        rows = outcome.process_tiles(batch)
        rows.select(*outcome.RUN, "outcome", "reason", *outcome.TILE_SUMMARY).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = once_each(tiles).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_manifests(spark: SparkSession, jobs: DataFrame, path: str) -> DataFrame:
    """Manifests over all that has been appended so far."""
    return metrics.manifests(jobs, spark.read.parquet(path))


def merge_batch(batch: DataFrame, number: int, path: str, compact_every: int = 16, spark: SparkSession | None = None) -> None:
    """Take in one batch of tiles as read: their summary rows, and what they add to their jobs' manifests.

    Everything has the batch's number in its place and is made from the batch and from places of smaller numbers, so that a batch that is
    replayed changes nothing. Each ``compact_every`` batches the sums so far become one base, so that reading them costs a row per job and the
    sums of a few batches, however many tiles there were.

    Sums are made in the session ``spark`` (default: the batch's). A stream's own session plans without adaptive execution, and so gives few rows as many
    tasks and files as tiles.
    """
    spark = spark or batch.sparkSession
    rows = outcome.process_tiles(batch, one_pass=True).select(*outcome.RUN, "outcome", "reason", *outcome.TILE_SUMMARY)
    rows.write.mode("overwrite").parquet(f"{path}/summaries/batch={number}")
    metrics.partial_sums(spark.read.schema(rows.schema).parquet(f"{path}/summaries/batch={number}")).write.mode("overwrite").parquet(f"{path}/partials/batch={number}")
    if (number + 1) % compact_every == 0:
        whole = _sums_upto(spark, path, number, compact_every, number - compact_every)
        whole.write.mode("overwrite").parquet(f"{path}/bases/batch={number}")


def _sums_upto(spark: SparkSession, path: str, number: int, compact_every: int, base: int) -> DataFrame:
    """Sums of all batches up to a number: the base at ``base`` (negative: none), and the batches after it."""
    some = spark.read.parquet(f"{path}/partials").where(F.col("batch").between(base + 1, number)).drop("batch")
    if base >= 0:
        some = some.unionByName(spark.read.parquet(f"{path}/bases/batch={base}"))
    return metrics.merge_sums(some)


def keep_manifests(tiles: DataFrame, path: str, checkpoint: str, compact_every: int = 16, available_now: bool = True) -> StreamingQuery:
    """Decode arriving tiles once each, append their summaries and keep their jobs' sums (:func:`merge_batch`)."""
    spark = tiles.sparkSession
    writer = once_each(tiles).writeStream.foreachBatch(lambda batch, number: merge_batch(batch, number, path, compact_every, spark)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def kept_manifests(spark: SparkSession, jobs: DataFrame, path: str, compact_every: int = 16) -> DataFrame:
    """Manifests over all that has been kept so far, from the last base and the batches after it; no tile's row is read again."""
    last = spark.read.parquet(f"{path}/partials").agg(F.max("batch")).first()[0]
    last = -1 if last is None else last  # batches without tiles add nothing
    base = (last + 1) // compact_every * compact_every - 1
    return metrics.manifests_of_sums(jobs, _sums_upto(spark, path, last, compact_every, base))


def window_counts(events: DataFrame, time: str, keys: list[str], size: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Counts by window and keys, the same for a stream and a table."""
    return events.withWatermark(time, delay).groupBy(F.window(time, size), *keys).count()
