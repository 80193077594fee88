"""Classifying what reading a tile gave, and the tables that follow from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions import text
from tilewright.operators import decode

# The columns of the three record tables, in order.
TILE_SUMMARY = ["provider", "source_id", "source_kind", "display_zoom", "source_zoom", "x", "y", "tile_url", "http_status", "content_type", "is_empty", "wire_byte_length", "stored_byte_length", "wire_sha256", "stored_sha256", "was_gzip_compressed", "width", "height", "coverage_pixel_count", "total_pixel_count", "coverage_ratio", "record_count", "pano_count", "feature_count", "layer_counts_json", "last_modified", "output_path", "metadata_path", "fetched_at"]
PANO_RECORDS = ["provider", "source_id", "display_zoom", "source_zoom", "tile_x", "tile_y", "tile_url", "panoid", "lat", "lon", "timestamp", "buildId", "coverageType", "lastModified", "fetched_at"]
FEATURE_RECORDS = ["provider", "source_id", "display_zoom", "source_zoom", "tile_x", "tile_y", "tile_url", "layer_name", "feature_index", "mvt_id", "geometry_type", "properties_json", "geometry_wkt", "fetched_at"]
ERRORS = ["provider", "source_id", "source_kind", "display_zoom", "source_zoom", "tile_url", "x", "y", "fetched_at", "http_status", "reason"]
RUN = ["request_id", "job_index", "run_label"]


def fetch_outcome(status: Column, error: Column, kind: Column, content_type: Column, prefix: Column, size: Column, special: Column, skip_404: Column) -> Column:
    """``struct<outcome, reason>`` before decoding; outcome is fetched, skipped or error.

    A 404 is skipped if that is asked for, else an error, as is any other failure.
    An empty body of a special raster source is fetched whatever its type; other
    rasters of the wrong content type are skipped. Vector and JSON tiles are not
    held to a content type.
    """
    to = lambda outcome, reason: F.struct(F.lit(outcome).alias("outcome"), reason.alias("reason"))
    none = F.lit(None).cast("string")
    known = kind.isin("raster", "vector_mvt", "coverage_json")
    empty = (kind == "raster") & F.coalesce(special, F.lit(False)) & ((status == 204) | (F.coalesce(size, F.lit(0)) == 0))
    wrong = (kind == "raster") & (F.coalesce(prefix, F.lit("")) != "") & ~F.startswith(F.coalesce(content_type, F.lit("")), prefix)
    return (
        F.when((status == 404) & skip_404, to("skipped", F.lit("http_404")))
        .when((status >= 400), to("error", F.concat(F.lit("HTTP "), status.cast("string"))))
        .when(error.isNotNull(), to("error", error))
        .when(empty, to("fetched", none))
        .when(wrong, to("skipped", F.lit("content_type_mismatch")))
        .when(~known, to("error", F.concat(F.lit("unsupported source kind "), kind)))
        .otherwise(to("fetched", none))
    )


def process_tiles(tiles: DataFrame, one_pass: bool = False) -> DataFrame:
    """Tiles as read, decoded: a row each with ``outcome``, ``reason`` and the columns of the tile summary.

    Input: run, job and source columns, ``x, y, tile_url, http_status,
    content_type, content, transport_error, fetched_at``. A tile that does not
    decode is an error and leaves nothing in any record table. With ``one_pass``
    vector tiles are inflated by their decoder, and so tiles go to Python once:
    where tasks have few tiles, a pass costs more than what it does.
    """
    special = F.coalesce(F.try_element_at("options", F.lit("config_kind")) == "yandex_stv_renderer", F.lit(False))
    size = F.coalesce(F.octet_length("content"), F.lit(0)).cast("long")
    first = fetch_outcome(F.col("http_status"), F.col("transport_error"), F.col("source_kind"), F.col("content_type"), F.col("content_type_prefix"), size, special, F.col("skip_404"))
    df = tiles.withColumns({"special": special, "wire_byte_length": size, "first": first}).withColumn("ok", F.col("first.outcome") == "fetched")
    kind = lambda k: F.col("ok") & (F.col("source_kind") == k) & (F.col("wire_byte_length") > 0)
    content, zipped = F.col("content"), decode.is_gzip(F.col("content"))
    raster, vector = F.col("ok") & (F.col("source_kind") == "raster"), kind("vector_mvt")
    was_gzip = F.coalesce(zipped, F.lit(False)) & (F.col("source_kind") != "raster")
    other = F.col("ok") & (F.col("source_kind") != "raster")
    if one_pass:
        df = df.withColumns({"png": decode.summarize_png(F.when(kind("raster"), content)), "vector": decode.decode_mvt_tiles(F.when(vector, content), inflate=True), "inflated": decode.gunzip(F.when(other & ~vector, content))})
        plain = F.when(raster | (vector & ~zipped), content).when(vector, F.col("vector.plain")).otherwise(F.col("inflated"))
        df = df.withColumns({"was_gzip_compressed": was_gzip, "plain": plain, "mvt": F.struct("vector.layers", "vector.error")}).drop("vector", "inflated")
    else:
        df = df.withColumns({"was_gzip_compressed": was_gzip, "plain": F.when(raster, content).otherwise(decode.gunzip(F.when(other, content)))})
        df = df.withColumns({"png": decode.summarize_png(F.when(kind("raster"), F.col("plain"))), "mvt": decode.decode_mvt_tiles(F.when(vector, F.col("plain")))})
    sha256 = lambda c: F.sha2(F.coalesce(c, F.lit("").cast("binary")), 256)
    df = df.withColumns({"document": F.from_json(F.decode(F.when(kind("coverage_json"), F.col("plain")), "UTF-8"), decode.COVERAGE_JSON), "wire_sha256": sha256(content)})
    broken_json = kind("coverage_json") & F.try_parse_json(F.decode(F.col("plain"), "UTF-8")).isNull()
    broken_gzip = F.col("ok") & F.col("was_gzip_compressed") & F.col("plain").isNull()
    late = F.coalesce(F.when(broken_gzip, F.lit("broken gzip")), F.col("png.error"), F.col("mvt.error"), F.when(broken_json, F.lit("broken JSON")))
    df = df.withColumns({"outcome": F.when(late.isNotNull(), F.lit("error")).otherwise(F.col("first.outcome")), "reason": F.coalesce(late, F.col("first.reason"))})
    good = F.col("outcome") == "fetched"
    nothing = (F.col("http_status") == 204) | (F.col("wire_byte_length") == 0) | (F.col("png.coverage_pixel_count") == 0)
    is_empty = F.when(good & (F.col("source_kind") == "raster"), F.when(F.col("special"), F.coalesce(nothing, F.lit(False))).otherwise(F.lit(False)))
    stored = F.when(F.coalesce(is_empty, F.lit(False)), F.lit(None)).otherwise(F.col("plain"))
    features = F.aggregate(F.col("mvt.layers"), F.lit(0).cast("long"), lambda n, x: n + F.size(x["features"]))
    suffix = F.when(F.col("source_kind") == "raster", text.content_suffix(F.coalesce("content_type", F.lit("")), F.col("tile_url"), ".png")).when(F.col("source_kind") == "vector_mvt", F.lit(".mvt")).otherwise(F.lit(".json"))
    place = F.concat_ws("/", F.coalesce(F.nullif("storage_subdir", F.lit("")), "source_kind"), F.col("source_zoom").cast("string"), F.col("x").cast("string"), F.col("y").cast("string"))
    panos = F.when(F.col("source_kind") == "coverage_json", F.coalesce(F.size(F.col("document.panos")), F.lit(0))).cast("long")
    return df.withColumns(
        {
            "is_empty": is_empty,
            "stored_byte_length": F.coalesce(F.octet_length("plain"), F.lit(0)).cast("long"),
            "stored_sha256": F.when(F.col("plain").eqNullSafe(content), F.col("wire_sha256")).otherwise(sha256(F.col("plain"))),  # equal bytes are hashed once
            **{c: F.col(f"png.{c}") for c in ("width", "height", "coverage_pixel_count", "total_pixel_count", "coverage_ratio")},
            "pano_count": panos,
            "feature_count": F.when(F.col("source_kind") == "vector_mvt", F.coalesce(features, F.lit(0))),
            "record_count": F.when(F.col("source_kind") == "coverage_json", panos).when(F.col("source_kind") == "vector_mvt", F.coalesce(features, F.lit(0))),
            "layer_counts_json": text.sorted_json(decode.layer_counts(F.col("mvt.layers"))),
            "last_modified": F.col("document.lastModified"),
            "stored_content": stored,
            "output_path": F.when(stored.isNotNull(), F.concat(place, suffix)),
            "metadata_path": F.concat(place, F.when(stored.isNotNull(), suffix).otherwise(F.lit(".png")), F.lit(".metadata.json")),
        }
    ).drop("first", "ok", "special")


def fetched(df: DataFrame) -> DataFrame:
    return df.where(F.col("outcome") == "fetched")


def tile_summary(df: DataFrame) -> DataFrame:
    return fetched(df).select(*RUN, *TILE_SUMMARY)


def _run_keys() -> list[Column | str]:
    return [*RUN, "provider", "source_id", "display_zoom", "source_zoom", "x", "y", "tile_url", "fetched_at"]


def pano_records(df: DataFrame) -> DataFrame:
    rows = decode.pano_rows(fetched(df), _run_keys())
    return rows.withColumnsRenamed({"x": "tile_x", "y": "tile_y"}).select(*RUN, *PANO_RECORDS)


def feature_records(df: DataFrame) -> DataFrame:
    tiles = fetched(df).withColumn("layers", F.col("mvt.layers"))
    rows = decode.feature_rows(tiles.select(*_run_keys(), "layers", "decoder", "layer_names"), [*_run_keys(), "decoder", "layer_names"], "layer_names")
    return rows.withColumnsRenamed({"x": "tile_x", "y": "tile_y"}).select(*RUN, *FEATURE_RECORDS)


def error_tiles(df: DataFrame) -> DataFrame:
    return df.where(F.col("outcome") == "error").select(*RUN, *ERRORS)


def skipped_tiles(df: DataFrame) -> DataFrame:
    return df.where(F.col("outcome") == "skipped").select(*RUN, *ERRORS)


def failed_tiles(df: DataFrame) -> DataFrame:
    """Rows of both tables with their ``outcome``, in one pass."""
    return df.where(F.col("outcome").isin("error", "skipped")).select(*RUN, *ERRORS, "outcome")


def first_errors(df: DataFrame) -> DataFrame:
    """Per run that stops on errors and has one: the first error by place, x before y."""
    bad = df.where((F.col("outcome") == "error") & F.col("stop_on_error"))
    return bad.groupBy(*RUN).agg(F.min_by(F.struct("x", "y", "tile_url", "reason"), F.struct("x", "y")).alias("error"))


def raise_first(failed: DataFrame) -> None:
    """Raise the error of the first of :func:`first_errors`, if there is one."""
    first = failed.orderBy(*RUN).limit(1).collect()  # its URL has no token's value
    if first:
        raise RuntimeError(f"{first[0]['run_label']}: {first[0]['error']['tile_url']}: {first[0]['error']['reason']}")


def raise_on_errors(df: DataFrame) -> None:
    """Raise the first error of a run that is to stop."""
    raise_first(first_errors(df))
