"""Reading tiles: from a table of stored ones, or, only if asked for, over a network.

Nothing here opens a connection unless a caller hands in a way to fetch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions import grid, text
from tilewright.sources import catalog
from tilewright.sources.tile_format import Fetch, Pace, read_tile

# Fixed value: the style document of the panorama layers.
PANORAMA_STYLE = "https://map.pstatic.net/nrb/styles/basic.json?fmt=png&callback=__naver_maps_callback__0"
#: Columns of requests that may hold secrets; nothing that is written has them.
SECRETS = ("access_token", "headers", "extra_headers")
STORED = "source_id string, source_zoom int, x long, y long, http_status int, content_type string, content binary, transport_error string"


def tile_requests(tiles: DataFrame, template_override: Column | None = None, values: dict[str, str] | None = None, keep_token: bool = False, discovered: DataFrame | None = None) -> DataFrame:
    """Tiles with what reading them takes: source columns, merged headers, ``tile_url``.

    ``discovered`` has versions and templates that take the place of the catalog's (:func:`discover`). The token's value is replaced in ``tile_url``. For fetching, ``keep_token`` adds ``fetch_url`` with it, which :func:`read_by` drops.
    """
    found = catalog.sources(tiles.sparkSession).drop("source_kind", "source_ordinal", "zoom_min", "zoom_max", "query_zoom")
    if discovered is not None:  # a row for each source
        own = discovered.select("source_id", F.col("version").alias("live_version"), F.col("template").alias("live_template"))
        found = found.join(F.broadcast(own), "source_id", "left").withColumns({"template": F.coalesce("live_template", "template"), "options": F.when(F.col("live_version").isNull(), F.col("options")).otherwise(F.map_concat(F.map_filter("options", lambda k, _: k != "version_fallback"), F.create_map(F.lit("version_fallback"), F.col("live_version"))))}).drop("live_version", "live_template")
    df = tiles.join(F.broadcast(found), ["provider", "source_id"])
    values = {k: F.lit(v) for k, v in (values or {}).items()}
    option = lambda k: F.try_element_at("options", F.lit(k))
    values = {"layer": F.coalesce(option("layer"), F.lit("")), "version": F.coalesce(option("version_fallback"), F.lit(""))} | values
    template = F.coalesce(template_override, "template") if template_override is not None else F.col("template")
    url = text.fill_template(template, **values, z=F.col("source_zoom"), x=F.col("x"), y=F.col("y"))
    url = text.with_token(url, F.col("token_parameter"), F.col("access_token"))
    kept = {"fetch_url": url} if keep_token else {}
    return df.withColumns(kept | {"tile_url": text.redact_token(url, F.col("token_parameter")), "headers": text.merge_headers(F.col("headers"), F.col("extra_headers")), "fetched_at": text.iso_utc(F.current_timestamp())})


def read_stored(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Requests joined with stored tiles; a tile that is not stored reads as 404."""
    kept = stored.select(*[c.split()[0] for c in STORED.split(", ")])
    df = requests.join(kept, ["source_id", "source_zoom", "x", "y"], "left")
    absent = F.col("http_status").isNull() & F.col("transport_error").isNull() & F.col("content").isNull()
    return df.withColumn("http_status", F.when(absent, F.lit(404)).otherwise(F.col("http_status"))).drop(*SECRETS)


def read_by(
    requests: DataFrame, fetch: Fetch, partitions: int | None = None, timeout_seconds: int = 60, retries: int = 0, backoff: float = 1.0, per_second: float = 0.0, path: str | None = None
) -> DataFrame:
    """Requests read by ``fetch`` on the executors; a failure is text in ``transport_error``.

    ``fetch_url`` is read where it is there, else ``tile_url``. It and the columns ``headers``, ``extra_headers`` and ``access_token``, which hold secrets,
    are dropped, and their values are replaced in the texts of failures. Failures that may pass are tried again ``retries`` times. ``per_second`` bounds the requests
    to a host by all ``partitions`` (which it needs) together. With ``path``, what was read is written there and read back: each tile is then fetched once, however
    many tables are made from it; without, every action fetches again.
    """
    if per_second and not partitions:
        raise ValueError("a rate needs a number of partitions to be shared among")

    def get(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        pace = Pace(per_second / (partitions or 1))
        for urls, headers, timeouts in batches:
            rows = [read_tile(fetch, url, dict(own or {}), int(t) if pd.notna(t) and t else timeout_seconds, retries, backoff, pace) for url, own, t in zip(urls, headers, timeouts)]
            yield pd.DataFrame(rows, columns=["content", "content_type", "http_status", "transport_error", "attempts"])

    get.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    url = "fetch_url" if "fetch_url" in requests.columns else "tile_url"
    df = requests.repartition(partitions, url) if partitions else requests
    read = F.pandas_udf(get, "content binary, content_type string, http_status int, transport_error string, attempts int").asNondeterministic()
    out = df.withColumn("read", read(url, "headers", "timeout_seconds")).select("*", "read.*").drop("read", "fetch_url", *SECRETS)
    if path is None:
        return out
    out.write.parquet(path)
    return out.sparkSession.read.schema(out.schema).parquet(path)


def http_fetch(url: str, headers: dict[str, str], timeout: int) -> tuple[bytes, str, int]:
    """Plain GET. Passing this to :func:`read_by` is what opts in to the network."""
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers=headers), timeout=timeout) as response:
        return response.read(), response.headers.get("Content-Type") or "", response.status


def raw_range(spark, source_id: str, template: str, zoom: int, x: tuple[int, int], y: tuple[int, int], headers: dict[str, str] | None = None) -> DataFrame:
    """Requests for an explicit range of tiles of one template, without planning."""
    whole = spark.range(1).where(F.lit(x[0] <= x[1] and y[0] <= y[1]))
    whole = whole.select(F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(("x_min", "x_max", "y_min", "y_max"), (*x, *y))]).alias("tile_range"))
    df = grid.explode_tiles(whole)
    headers = {"User-Agent": catalog._AGENT[1]} | (headers or {})
    pairs = F.create_map(*[F.lit(v) for kv in headers.items() for v in kv])
    url = text.fill_template(template, z=F.lit(zoom), x=F.col("x"), y=F.col("y"))
    return df.select(F.lit(source_id).alias("source_id"), F.lit(zoom).alias("source_zoom"), "x", "y", url.alias("tile_url"), pairs.alias("headers"), F.lit(None).cast("int").alias("timeout_seconds"))


def raw_files(read: DataFrame) -> DataFrame:
    """A row per tile of a raw range, with what a file beside it would say: ``stored_file, tile_url, z, x, y, content_type, sha256, byte_length``."""
    stem = F.regexp_replace(text.tile_path(F.col("source_zoom"), F.col("x"), F.col("y")), r"\.bin$", "")
    body = F.coalesce("content", F.lit("").cast("binary"))
    found = text.content_suffix(F.coalesce("content_type", F.lit("")), F.col("tile_url"))
    return read.select(
        "source_id", F.concat(stem, found).alias("stored_file"), "tile_url", F.col("source_zoom").alias("z"), "x", "y", "content_type", F.sha2(body, 256).alias("sha256"), F.octet_length(body).alias("byte_length")
    )


def raw_manifest(read: DataFrame) -> DataFrame:
    """Ranges, count and bytes of a raw range; the list of files is a row per tile: see :func:`raw_files`."""
    ends = [f(c).alias(f"{c}_{n}") for c in ("x", "y") for f, n in ((F.min, "min"), (F.max, "max"))]
    return read.groupBy("source_id", "source_zoom").agg(*ends, F.count("*").alias("tile_count"), F.sum(F.octet_length("content")).alias("byte_length"))


def download(name: str, folder: str, spark, fetch: Fetch = http_fetch) -> dict:
    """One catalog download into a folder, with its hash and length; on the driver, as it is one file."""
    import hashlib
    import os

    row = catalog.downloads(spark).where(F.col("name") == name).first()
    if row is None:
        raise KeyError(name)
    body, kind, _ = fetch(row["url"], dict([catalog._AGENT]), 600)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, row["filename"])
    with open(path, "wb") as f:
        f.write(body)
    return {"provider": name, "url": row["url"], "path": path, "content_type": kind, "sha256": hashlib.sha256(body).hexdigest(), "byte_length": len(body), "notes": row["notes"]}


def discover(spark, fetch: Fetch, provider: str, extra_headers: dict[str, str] | None = None, timeout_seconds: int = 60) -> DataFrame:
    """``source_id, config_source, config_error, version, template, query_layers`` of each source of a provider, one GET for each frontend page.

    Sources with a frontend page get their version and template from it; if that fails, their fallback version, with the error told. Others
    have neither. Hand the result to :func:`tile_requests`. The catalog has few sources, so this runs on the driver.
    """
    rows = []
    for s in catalog.sources(spark).where(F.col("provider") == provider).orderBy("source_ordinal").collect():
        own = s["options"] or {}
        version, template, layers, error, came_from = own.get("version_fallback"), None, "", None, "catalog"
        if own.get("config_kind") == "yandex_stv_renderer":
            came_from = "fallback"
            try:
                body, _, _ = fetch(own["frontend_page_url"], dict(s["headers"] or {}) | (extra_headers or {}), timeout_seconds)
                state = text.page_state(F.lit(body.decode()))
                found = spark.range(1).select(state["version"].alias("version"), text.normalise_tile_template(state["tiles_template"], F.lit(own.get("layer", "stv"))).alias("template"), state["query_layers"].alias("layers")).first()
                if found["version"] is None:
                    raise KeyError("version")
                version, template, layers, came_from = found["version"], found["template"] or None, found["layers"], "live_page"
            except Exception as e:  # the fallback is what the catalog says
                error = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
        rows.append((s["source_id"], came_from, error, version, template, layers))
    return spark.createDataFrame(rows, "source_id string, config_source string, config_error string, version string, template string, query_layers string")


def discover_style(spark, fetch: Fetch, url: str = PANORAMA_STYLE, timeout_seconds: int = 30) -> DataFrame:
    """Version and templates of the panorama style document: one row of ``text.style_config``."""
    body, _, _ = fetch(url, dict([catalog._AGENT]), timeout_seconds)
    return spark.range(1).select(text.style_config(F.lit(body.decode())).alias("c")).select("c.*")


def discover_roadview(spark, fetch: Fetch, url: str, timeout_seconds: int = 30) -> DataFrame:
    """Templates, resources and versions of a loader script: one row of ``text.roadview_config``."""
    body, _, _ = fetch(url, dict([catalog._AGENT]), timeout_seconds)
    return spark.range(1).select(text.roadview_config(F.lit(body.decode())).alias("c")).select("c.*")


