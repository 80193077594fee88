"""Command line: ``python -m tilewright.cli COMMAND``. Prints JSON lines."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright import api
from tilewright.operators import compare, outcome
from tilewright.plans import planner
from tilewright.sources import catalog, tables, transport


def key_values(entries: list[str] | None, kind: type = str) -> dict:
    """``KEY=VALUE`` strings, split at the first ``=`` and trimmed."""
    out = {}
    for e in entries or []:
        if "=" not in e:
            raise ValueError(f"expected KEY=VALUE, got {e!r}")
        k, v = e.split("=", 1)
        out[k.strip()] = kind(v.strip())
    return out


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tilewright")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list-providers")
    commands.add_parser("provider-notes").add_argument("provider")
    down = commands.add_parser("direct-download")
    down.add_argument("name"), down.add_argument("--output-root", required=True)
    raw = commands.add_parser("fetch-raster-tiles")
    for name in ("source", "template", "output-root"):
        raw.add_argument(f"--{name}", required=True)
    for name in ("zoom", "x-min", "x-max", "y-min", "y-max"):
        raw.add_argument(f"--{name}", type=int, required=True)
    raw.add_argument("--header", action="append")
    for name in ("fetch-provider", "fetch-multi"):
        c = commands.add_parser(name)
        c.add_argument("--provider", required=name == "fetch-provider", action="append" if name == "fetch-multi" else "store")
        c.add_argument("--bbox", type=float, nargs=4), c.add_argument("--preset"), c.add_argument("--output-root", required=True)
        c.add_argument("--stored-tiles", help="Parquet of stored tiles; without it nothing is read unless --allow-network")
        c.add_argument("--allow-network", action="store_true"), c.add_argument("--dry-run", action="store_true"), c.add_argument("--auto-zoom", action="store_true")
        for option in ("display-zoom", "min-display-zoom", "max-display-zoom", "timeout-seconds"):
            c.add_argument(f"--{option}", type=int)
        c.add_argument("--max-source-tile-count", type=int, default=16), c.add_argument("--grid-rows", type=int, default=1), c.add_argument("--grid-cols", type=int, default=1)
        c.add_argument("--target-subbox", type=int, action="append"), c.add_argument("--run-label"), c.add_argument("--header", action="append")
        c.add_argument("--access-token", action="append"), c.add_argument("--provider-zoom", action="append"), c.add_argument("--keep-404", action="store_true"), c.add_argument("--continue-on-error", action="store_true")
    commands.add_parser("compare-manifests").add_argument("paths", nargs="+")
    return parser


def requests_of(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    tokens = a.access_token or []
    base = planner.AreaRequest(
        provider="", bbox=tuple(a.bbox) if a.bbox else None, preset=a.preset, display_zoom=a.display_zoom, auto_zoom=a.auto_zoom, min_display_zoom=a.min_display_zoom, max_display_zoom=a.max_display_zoom, max_source_tile_count=a.max_source_tile_count, grid_rows=a.grid_rows, grid_cols=a.grid_cols, target_subboxes=a.target_subbox, run_label=a.run_label, skip_404=not a.keep_404, stop_on_error=not a.continue_on_error, timeout_seconds=a.timeout_seconds, dry_run=a.dry_run, extra_headers=key_values(a.header)
    )
    if a.command == "fetch-provider":
        return planner.multi_source(spark, base, [a.provider], tokens={a.provider: tokens[0]} if tokens else {}, auto=[a.provider])
    return planner.multi_source(spark, base, a.provider, key_values(a.provider_zoom, int), key_values(tokens))


def main(argv: list[str] | None = None, spark: SparkSession | None = None, fetch: transport.Fetch = transport.http_fetch) -> int:
    a = build_parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("tilewright").getOrCreate()
    show = lambda df: [print(line) for line in df.toJSON().collect()]  # noqa: E731  catalogs, jobs and manifests are small
    if a.command == "list-providers":
        show(catalog.providers(spark).select("provider").orderBy("provider"))
    elif a.command == "provider-notes":
        show(catalog.require(spark.createDataFrame([(a.provider,)], "provider string"), "provider", catalog.notes(spark, "No notes."), "provider"))
    elif a.command == "direct-download":
        print(transport.download(a.name, a.output_root, spark, fetch))
    elif a.command == "fetch-raster-tiles":
        wanted = transport.raw_range(spark, a.source, a.template, a.zoom, (a.x_min, a.x_max), (a.y_min, a.y_max), key_values(a.header))
        transport.read_by(wanted, fetch).write.mode("overwrite").parquet(f"{a.output_root}/tiles_raw")
        show(transport.raw_manifest(spark.read.parquet(f"{a.output_root}/tiles_raw")))
    elif a.command in ("fetch-provider", "fetch-multi"):
        jobs = planner.build_jobs(requests_of(spark, a))
        if a.dry_run:
            show(jobs.drop("access_token"))
            return 0
        if not (a.stored_tiles or a.allow_network):
            sys.exit("hand in --stored-tiles, or --allow-network to fetch")
        done = api.process(jobs, stored=spark.read.parquet(a.stored_tiles)) if a.stored_tiles else api.process(jobs, fetch=fetch)
        done.drop("access_token").write.mode("overwrite").parquet(f"{a.output_root}/processed")
        tables.write_run(jobs.drop("access_token"), spark.read.parquet(f"{a.output_root}/processed"), a.output_root, written=True, raise_failed=False)
        show(compare.summarize(spark.read.parquet(f"{a.output_root}/manifests")).orderBy(F.col("job_index")))
        outcome.raise_first(spark.read.parquet(f"{a.output_root}/failed_runs"))
    else:
        show(compare.summarize_documents(tables.read_manifests(spark, a.paths)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
