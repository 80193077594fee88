"""Planning: boxes, grids of sub-boxes, zooms and sources, and the tiles to read.

Requests are rows, so a plan for one box and for a million boxes is the same
query. Tile counts come from arithmetic; tiles are listed only at the end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import grid
from tilewright.functions.text import run_label
from tilewright.sources import catalog


@dataclass(frozen=True)
class AreaRequest:
    """One request; ``to_frame`` makes rows of several."""

    provider: str
    bbox: tuple[float, float, float, float] | dict | None = None
    preset: str | None = None
    display_zoom: int | None = None
    auto_zoom: bool = False
    min_display_zoom: int | None = None
    max_display_zoom: int | None = None
    max_source_tile_count: int = 16
    grid_rows: int = 1
    grid_cols: int = 1
    target_subboxes: int | list[int] | None = None
    run_label: str | None = None
    skip_404: bool = True
    stop_on_error: bool = True
    timeout_seconds: int | None = None
    dry_run: bool = False
    access_token: str | None = None
    extra_headers: dict[str, str] = field(default_factory=dict)


REQUESTS = (
    f"request_id long, provider string, bbox {catalog.BBOX}, preset string, display_zoom int, auto_zoom boolean, min_display_zoom int, max_display_zoom int, "
    "max_source_tile_count int, grid_rows int, grid_cols int, target_subboxes array<int>, run_label string, skip_404 boolean, stop_on_error boolean, "
    "timeout_seconds int, dry_run boolean, access_token string, extra_headers map<string,string>"
)


def read_bbox(value: tuple | list | dict | None) -> tuple[float, ...] | None:
    """By name from a mapping, or four numbers in order."""
    if value is None:
        return None
    if isinstance(value, dict):
        value = [value[k] for k in ("min_lon", "min_lat", "max_lon", "max_lat")]
    if len(value) != 4:
        raise ValueError("a box has four numbers: min_lon, min_lat, max_lon, max_lat")
    return tuple(float(v) for v in value)


def to_frame(spark: SparkSession, requests: list[AreaRequest]) -> DataFrame:
    rows = []
    for i, r in enumerate(requests):
        if r.grid_rows < 1 or r.grid_cols < 1:
            raise ValueError("grid rows and columns start from 1")
        wanted = [r.target_subboxes] if isinstance(r.target_subboxes, int) else r.target_subboxes and list(r.target_subboxes)
        rows.append((i, r.provider, read_bbox(r.bbox), r.preset, r.display_zoom, r.auto_zoom, r.min_display_zoom, r.max_display_zoom, r.max_source_tile_count, r.grid_rows, r.grid_cols, wanted, r.run_label, r.skip_404, r.stop_on_error, r.timeout_seconds, r.dry_run, r.access_token, r.extra_headers))
    return spark.createDataFrame(rows, REQUESTS)


def multi_source(spark: SparkSession, template: AreaRequest, providers: list[str] | None = None, zooms: dict[str, int] | None = None, tokens: dict[str, str] | None = None, auto: list[str] = ("apple_lookaround",)) -> DataFrame:
    """Requests of one box for several providers, in order, with zooms and tokens of their own."""
    from dataclasses import replace

    zooms, tokens = zooms or {}, tokens or {}
    return to_frame(spark, [replace(template, provider=p, display_zoom=zooms.get(p, template.display_zoom), access_token=tokens.get(p), auto_zoom=template.auto_zoom and p in auto) for p in providers or catalog.MULTI_SOURCE])


def unset(value: Column, default: Column) -> Column:
    """0 and null alike mean that nothing was given."""
    return F.coalesce(F.nullif(value, F.lit(0)), default)


def resolve_boxes(requests: DataFrame) -> DataFrame:
    """A box of its own wins over the preset; neither raises."""
    known = catalog.presets(requests.sparkSession).withColumnRenamed("bbox", "preset_bbox")
    own = requests.join(F.broadcast(known), "preset", "left")
    bbox = F.coalesce("bbox", "preset_bbox", F.raise_error(F.lit("a box or a known preset is needed")).cast(catalog.BBOX))
    return own.withColumn("bbox", bbox).drop("preset_bbox")


def split_boxes(df: DataFrame) -> DataFrame:
    """A row per sub-box: row by row from the south; a single one keeps the box as it is."""
    rows, cols, b = F.col("grid_rows"), F.col("grid_cols"), F.col("bbox")
    df = df.withColumn("job_index", F.explode(F.sequence(F.lit(0), rows * cols - 1)))
    df = df.withColumns({"subbox_row": (F.col("job_index") / cols).cast("int"), "subbox_col": F.col("job_index") % cols})
    r, c = F.col("subbox_row"), F.col("subbox_col")
    width, height = (b["max_lon"] - b["min_lon"]) / cols, (b["max_lat"] - b["min_lat"]) / rows
    part = F.struct((b["min_lon"] + c * width).alias("min_lon"), (b["min_lat"] + r * height).alias("min_lat"), (b["min_lon"] + (c + 1) * width).alias("max_lon"), (b["min_lat"] + (r + 1) * height).alias("max_lat"))
    return df.withColumn("bbox", F.when((rows == 1) & (cols == 1), b).otherwise(part))


def select_boxes(df: DataFrame) -> DataFrame:
    """Null selects all; unknown and repeated numbers change nothing."""
    return df.where(F.col("target_subboxes").isNull() | F.array_contains("target_subboxes", F.col("job_index")))


def add_sources(df: DataFrame, zoom: str = "zoom") -> DataFrame:
    """The first source, in catalog order, whose zooms include the row's; none raises. The catalog has nine sources."""
    found = catalog.sources(df.sparkSession)
    per_provider = found.groupBy(F.col("provider").alias("source_provider")).agg(F.sort_array(F.collect_list(F.struct("source_ordinal", "source_id", "source_kind", "zoom_min", "zoom_max", "query_zoom"))).alias("options"))
    df = df.join(F.broadcast(per_provider), F.col("provider") == F.col("source_provider"), "left")
    fits = F.filter("options", lambda s: F.col(zoom).between(s["zoom_min"], s["zoom_max"]))
    missing = F.raise_error(F.concat(F.lit("no source for zoom "), F.col(zoom).cast("string"))).cast("string")
    df = df.withColumn("source", F.try_element_at(fits, F.lit(1))).drop("options", "source_provider")
    return df.withColumns({"source_id": F.coalesce(F.col("source.source_id"), missing), "source_kind": F.col("source.source_kind"), "source_zoom": unset(F.col("source.query_zoom"), F.col(zoom))}).drop("source")


def zoom_candidates(df: DataFrame) -> DataFrame:
    """A row per zoom that a job may use: from its bounds with automatic zoom, else the one asked for or the default."""
    bounds = catalog.zoom_bounds(df.sparkSession).toDF("bounds_provider", "provider_zoom_min", "provider_zoom_max")
    df = df.join(F.broadcast(bounds), F.col("provider") == F.col("bounds_provider"), "left").drop("bounds_provider")
    low, high = unset(F.col("min_display_zoom"), F.col("provider_zoom_min")), unset(F.col("max_display_zoom"), F.col("provider_zoom_max"))
    many = F.when(low <= high, F.sequence(low, high)).otherwise(F.raise_error(F.lit("the least zoom is over the largest")).cast("array<int>"))
    one = F.array(unset(F.col("display_zoom"), F.col("default_zoom")))
    df = df.withColumn("zoom", F.explode(F.when(F.col("auto_zoom"), many).otherwise(one))).drop("provider_zoom_min", "provider_zoom_max")
    df = add_sources(df).withColumn("tile_range", grid.tile_range(F.col("bbox"), F.col("source_zoom"), F.col("scheme")))
    return df.withColumn("tile_count", grid.tile_count(F.col("tile_range")))


def choose_zoom(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Per job the largest zoom whose tiles fit the budget, else the one with fewest tiles; ``zoom_candidates`` lists all."""
    picked = F.struct("zoom", "source_id", "source_kind", "source_zoom", "tile_range", "tile_count")
    fits = F.when(F.col("tile_count") <= F.col("max_source_tile_count"), F.col("zoom"))
    own = [c for c in candidates.columns if c not in keys and c not in ("zoom", "source_id", "source_kind", "source_zoom", "tile_range", "tile_count")]
    best = candidates.groupBy(*keys).agg(
        F.coalesce(F.max_by(picked, fits), F.min_by(picked, F.struct("tile_count", "zoom"))).alias("best"),
        F.sort_array(F.collect_list(picked)).alias("zoom_candidates"),
        *[F.first(c).alias(c) for c in own],
    )
    return best.select(*keys, *own, "zoom_candidates", "best.*").withColumnRenamed("zoom", "display_zoom_used")


def build_jobs(requests: DataFrame) -> DataFrame:
    """A row per request and sub-box, with its zoom, source, tile range and label. Nothing is read: this is the dry run."""
    spark = requests.sparkSession
    df = catalog.require(requests, "provider", catalog.providers(spark), "provider")
    candidates = zoom_candidates(select_boxes(split_boxes(resolve_boxes(df))))
    jobs = choose_zoom(candidates, ["request_id", "job_index"])
    label = run_label(F.coalesce(F.nullif("run_label", F.lit("")), "label_prefix"), F.col("job_index"))
    return jobs.withColumn("display_zoom", F.col("display_zoom_used")).drop("display_zoom_used").withColumn("run_label", label)


def job_tiles(jobs: DataFrame, x_range: tuple[int, int] | None = None) -> DataFrame:
    """A row per tile of each job. A range of x cuts the jobs' ranges first, so that tiles outside are never made."""
    if x_range:
        r = F.col("tile_range")
        cut = F.struct(F.greatest(r["x_min"], F.lit(x_range[0])).alias("x_min"), F.least(r["x_max"], F.lit(x_range[1])).alias("x_max"), r["y_min"].alias("y_min"), r["y_max"].alias("y_max"))
        jobs = jobs.withColumn("tile_range", cut)
    return grid.explode_tiles(jobs)
