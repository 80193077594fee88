"""Aggregation of tiles into one manifest row per job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coverage_aggregates(covered: Column, total: Column, is_empty: Column) -> list[Column]:
    """Sums, the ratio of the sums (null without pixels) and counts of empty and non-empty tiles."""
    return [
        F.coalesce(F.sum(covered), F.lit(0)).alias("total_coverage_pixels"),
        F.coalesce(F.sum(total), F.lit(0)).alias("total_pixels"),
        F.try_divide(F.sum(covered), F.nullif(F.sum(total), F.lit(0))).alias("aggregate_coverage_ratio"),
        F.count_if(is_empty).alias("empty_tile_count"),
        F.count_if(~is_empty).alias("nonempty_tile_count"),
    ]


def run_counts() -> list[Column]:
    """Counts by outcome; both kinds of skip are in ``skipped_404_count``, and apart beside it."""
    got = F.col("outcome") == "fetched"
    only = lambda c: F.when(got, F.col(c))
    return [
        F.count_if(got).alias("tile_count"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped_404_count"),
        F.count_if(F.col("reason") == "http_404").alias("http_404_count"),
        F.count_if(F.col("reason") == "content_type_mismatch").alias("content_type_mismatch_count"),
        F.count_if(F.col("outcome") == "error").alias("error_count"),
        F.coalesce(F.sum(only("pano_count")), F.lit(0)).alias("pano_record_count"),
        F.coalesce(F.sum(only("feature_count")), F.lit(0)).alias("vector_feature_record_count"),
        F.count_if(got & (F.col("coverage_pixel_count") > 0)).alias("covered_tile_count"),
        *coverage_aggregates(only("coverage_pixel_count"), only("total_pixel_count"), only("is_empty")),
    ]


JOB = ["request_id", "job_index"]
_RATIO = "aggregate_coverage_ratio"


def partial_sums(tiles: DataFrame) -> DataFrame:
    """What tiles add to their jobs' manifests: a row per job that has any. Such rows can be put together by :func:`merge_sums`."""
    return tiles.groupBy(*JOB).agg(*run_counts()).drop(_RATIO)


def merge_sums(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*JOB).agg(*[F.sum(c).alias(c) for c in partials.columns if c not in JOB])


def manifests_of_sums(jobs: DataFrame, sums: DataFrame) -> DataFrame:
    """Manifests from sums that are whole: those of :func:`partial_sums` over all tiles, or merged."""
    ratio = F.try_divide(F.col("total_coverage_pixels"), F.nullif("total_pixels", F.lit(0)))
    at = sums.columns.index("total_pixels") + 1  # its place in manifests
    return _with_jobs(jobs, sums.select(*sums.columns[:at], ratio.alias(_RATIO), *sums.columns[at:]))


def manifests(jobs: DataFrame, tiles: DataFrame) -> DataFrame:
    """A row per job, jobs without tiles included; the jobs' own tile counts become ``planned_tile_count``. One shuffle of partial sums; the tiles' bytes are not read."""
    return _with_jobs(jobs, tiles.groupBy(*JOB).agg(*run_counts()))


def _with_jobs(jobs: DataFrame, sums: DataFrame) -> DataFrame:
    keys = JOB
    joined = jobs.withColumnRenamed("tile_count", "planned_tile_count").join(sums, keys, "left")
    counts = [c for c in sums.columns if c not in keys and c != _RATIO]
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def layer_counts(features: DataFrame, keys: list[str], layer: str = "layer_name") -> DataFrame:
    """``keys`` and ``counts``, a map of each tile's layers to their features; rows are counted, not gathered."""
    per_layer = features.groupBy(*keys, layer).agg(F.count("*").alias("n"))
    return per_layer.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(layer, "n"))).alias("counts"))


def job_indexes(manifest: DataFrame) -> DataFrame:
    """The job indexes that have results, each once, in order."""
    return manifest.select("job_index").distinct().orderBy("job_index")


def rollup(manifest: DataFrame) -> DataFrame:
    """Coverage by provider and label with subtotals."""
    return manifest.rollup("provider", "run_label").agg(
        F.sum("tile_count").alias("tile_count"), F.try_divide(F.sum("total_coverage_pixels"), F.nullif(F.sum("total_pixels"), F.lit(0))).alias("coverage_ratio")
    )
