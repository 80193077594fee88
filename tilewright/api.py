"""One call from requests to processed tiles and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilewright.operators import metrics, outcome
from tilewright.plans import planner
from tilewright.sources import transport


def plan(spark: SparkSession, requests: list[planner.AreaRequest]) -> DataFrame:
    """The jobs of a dry run."""
    return planner.build_jobs(planner.to_frame(spark, requests))


def process(jobs: DataFrame, stored: DataFrame | None = None, fetch: transport.Fetch | None = None, discovered: DataFrame | None = None, **fetching) -> DataFrame:
    """Decoded tiles of jobs, from a stored table or by a fetch function; ``discovered`` as :func:`transport.discover` gives it.

    ``fetching``: what :func:`transport.read_by` takes besides, as ``path`` (where fetched tiles are kept: without it each action fetches again), ``retries``, ``per_second`` and ``partitions``.
    """
    if (stored is None) == (fetch is None):
        raise ValueError("hand in either stored tiles or a fetch function")
    wanted = transport.tile_requests(planner.job_tiles(jobs.where("NOT dry_run")), keep_token=fetch is not None, discovered=discovered)
    read = transport.read_stored(wanted, stored) if stored is not None else transport.read_by(wanted, fetch, **fetching)
    return outcome.process_tiles(read)


def summarize(jobs: DataFrame, processed: DataFrame) -> DataFrame:
    return metrics.manifests(jobs, processed)
