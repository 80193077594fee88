"""The static catalog as DataFrames: providers, their sources in order of preference, area presets, downloads, notes, colours.

These tables are fixed and tiny, so joins with them may broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_AGENT = ("User-Agent", "tilewright/0.1")
_VECTOR = ("Accept", "application/vnd.mapbox-vector-tile, application/octet-stream;q=0.9, */*;q=0.1")
_LOOKMAP = {"Referer": "https://lookmap.eu.pythonanywhere.com/", _AGENT[0]: _AGENT[1]}

# Key, namespace, label prefix, default zoom, grid, automatic zoom.
PROVIDERS = [
    ("apple_lookaround", "apple_lookaround_bluelines_layered", "apple_lookaround_layered", 18, "web_mercator", True),
    ("svmap_google", "svmap_google_mts_raster", "svmap_google_mts", 13, "web_mercator", False),
    ("kartaview", "kartaview_coverage_raster", "kartaview_coverage", 13, "web_mercator", False),
    ("panoramax", "panoramax_mvt_coverage", "panoramax_coverage", 13, "web_mercator", False),
    ("mapillary", "mapillary_mvt_coverage", "mapillary_coverage", 13, "web_mercator", False),
    ("baidu", "baidu_mapsv_raster", "baidu_mapsv", 13, "baidu", False),
    ("yandex", "yandex_stv_raster", "yandex_stv_raster", 13, "yandex_wgs84_mercator", False),
]
# Provider, source, place in order, kind, template, headers, least and most zoom, fixed query zoom, layers, subfolder, decoder, content-type prefix, token parameter, options.
SOURCES = [
    ("apple_lookaround", "apple_lookaround_bluelines_raster_2x", 0, "raster", "https://lookmap.eu.pythonanywhere.com/bluelines_raster_2x/{z}/{x}/{y}.png", _LOOKMAP, 3, 7, None, [], "raster", None, "image/", None, {}),
    ("apple_lookaround", "apple_lookaround_cached_bluelines", 1, "vector_mvt", "https://lookmap.eu.pythonanywhere.com/bluelines2/{z}/{x}/{y}/", _LOOKMAP, 8, 15, None, ["panos"], "vector_mvt", "ogr2ogr", None, None, {}),
    ("apple_lookaround", "apple_lookaround_coverage_tiles", 2, "coverage_json", "https://lookmap.eu.pythonanywhere.com/tiles/coverage/{x}/{y}/", _LOOKMAP, 16, 20, 17, [], "coverage_json", None, "application/json", None, {}),
    ("svmap_google", "svmap_google_mts", 0, "raster", "https://mts.googleapis.com/vt?pb=!1m4!1m3!1i{z}!2i{x}!3i{y}!2m8!1e2!2ssvv!4m2!1scc!2s*211m3*211e2*212b1*213e2*212b1*214b1!4m2!1ssvl!2s*212b1!3m11!2sen!3sUS!12m4!1e68!2m2!1sset!2sRoadmap!12m3!1e37!2m1!1ssmartmaps!5m1!5f1.5", {_AGENT[0]: _AGENT[1], "Referer": "https://sv-map.netlify.app/"}, 0, 22, None, [], "tiles", None, "image/", None, {}),
    ("kartaview", "kartaview_sequence_tiles", 0, "raster", "https://api.openstreetcam.org/2.0/sequence/tiles/{x}/{y}/{z}.png", {_AGENT[0]: _AGENT[1], "Referer": "https://kartaview.org/"}, 0, 22, None, [], "tiles", None, "image/", None, {}),
    ("panoramax", "panoramax_xyz_mvt", 0, "vector_mvt", "https://api.panoramax.xyz/api/map/{z}/{x}/{y}.mvt", {_AGENT[0]: _AGENT[1], _VECTOR[0]: _VECTOR[1], "Referer": "https://api.panoramax.xyz/en/index?focus=map"}, 0, 22, None, ["sequences"], "vector_mvt", "custom_mvt", None, None, {}),
    ("mapillary", "mapillary_mly1_public_vtp", 0, "vector_mvt", "https://tiles.mapillary.com/maps/vtp/mly1_public/2/{z}/{x}/{y}", {_AGENT[0]: _AGENT[1], _VECTOR[0]: _VECTOR[1], "Referer": "https://www.mapillary.com/"}, 0, 22, None, ["sequence"], "vector_mvt", "custom_mvt", None, "access_token", {}),
    ("baidu", "baidu_mapsv_tile", 0, "raster", "https://mapsv0.bdimg.com/tile/?udt=20200825&qt=tile&styles=pl&x={x}&y={y}&z={z}", {_AGENT[0]: _AGENT[1], "Referer": "https://map.baidu.com/"}, 0, 22, None, [], "tiles", None, "image/", None, {}),
    ("yandex", "yandex_stv_tiles_png", 0, "raster", "https://core-stv-renderer.maps.yandex.net/2.x/tiles?l={layer}&x={x}&y={y}&z={z}&scale=1&v={version}&lang=en_US&format=png", {_AGENT[0]: _AGENT[1], "Accept": "image/png, image/*;q=0.9, */*;q=0.1", "Referer": "https://yandex.com/maps/"}, 0, 22, None, [], "tiles", None, "image/", None, {"config_kind": "yandex_stv_renderer", "frontend_page_url": "https://yandex.com/maps/213/moscow/?l=stv&ll=37.565000%2C55.745000&z=13", "layer": "stv", "version_fallback": "2026.05.19.17.14-1_26.05.18-0-29389"}),
]
# Area presets.
PRESETS = [
    ("amsterdam_city_bbox_approx", (4.728, 52.278, 5.079, 52.431)),
    ("hong_kong_urban_bbox_approx", (113.87, 22.19, 114.33, 22.45)),
    ("moscow_center_stv_bbox", (37.53, 55.73, 37.60, 55.76)),
    ("abakan_bbox", (91.54, 53.66, 91.72, 53.79)),
]
# Direct downloads (the notes are our own).
DOWNLOADS = [
    ("panoramax", "https://api.panoramax.xyz/data/geoparquet/panoramax.parquet", "panoramax.parquet", "The catalog as GeoParquet, renewed every week: the download to start from."),
    ("panoramax_pg_dump", "https://api.panoramax.xyz/data/pg_dump/panoramax.dump", "panoramax.dump", "The whole database, much larger: only for fields that the GeoParquet lacks."),
    ("svmap_google_index", "https://d3q761cy2sygif.cloudfront.net/index.json", "index.json", "An index of archives by date: tells where the package of a date is."),
]
NOTES = [
    ("apple_lookaround", "The public host asks not to be automated at scale: use a self-hosted or throttled setup."),
    ("mapillary", "Public vector tiles need an access token, which callers pass explicitly."),
]
# Colours by provider, providers of multi-source runs, colour of unknown ones.
COLOURS = [("apple_lookaround", "#1f78b4"), ("svmap_google", "#e66101"), ("kartaview", "#5e3c99"), ("panoramax", "#4daf4a"), ("mapillary", "#d01c8b"), ("baidu", "#b15928"), ("yandex", "#1f9d8a")]
MULTI_SOURCE = ["apple_lookaround", "svmap_google", "kartaview", "panoramax", "mapillary", "yandex"]
OTHER_COLOUR = "#333333"

BBOX = "struct<min_lon: double, min_lat: double, max_lon: double, max_lat: double>"


def providers(spark: SparkSession) -> DataFrame:
    rows = [(*p, i) for i, p in enumerate(PROVIDERS)]
    return spark.createDataFrame(rows, "provider string, namespace string, label_prefix string, default_zoom int, scheme string, supports_auto_zoom boolean, provider_ordinal int")


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SOURCES,
        "provider string, source_id string, source_ordinal int, source_kind string, template string, headers map<string,string>, zoom_min int, zoom_max int, "
        "query_zoom int, layer_names array<string>, storage_subdir string, decoder string, content_type_prefix string, token_parameter string, options map<string,string>",
    )


def presets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRESETS, f"preset string, bbox {BBOX}")


def downloads(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DOWNLOADS, "name string, url string, filename string, notes string")


def notes(spark: SparkSession, default: str = "") -> DataFrame:
    """Every provider, in order of name, with its note or the default."""
    found = spark.createDataFrame(NOTES, "provider string, note string")
    return providers(spark).join(F.broadcast(found), "provider", "left").select("provider", F.coalesce("note", F.lit(default)).alias("note")).orderBy("provider")


def labels(spark: SparkSession) -> DataFrame:
    """``name, label, colour`` for provider keys and namespaces alike."""
    own = spark.createDataFrame(COLOURS, "label string, colour string").join(F.broadcast(providers(spark).select(F.col("provider").alias("label"), "namespace")), "label")
    return own.select(F.col("namespace").alias("name"), "label", "colour").union(own.select("label", "label", "colour")).dropDuplicates(["name"])


def zoom_bounds(spark: SparkSession) -> DataFrame:
    return sources(spark).groupBy("provider").agg(F.min("zoom_min").alias("zoom_min"), F.max("zoom_max").alias("zoom_max"))


def require(found: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Join with a catalog table; keys it doesn't have raise."""
    known = F.broadcast(known.withColumnRenamed(known_key, "__key").withColumn("__known", F.lit(True)))
    joined = found.join(known, found[key] == known["__key"], "left")
    check = F.when(F.col("__known"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit(f"unknown {key}: "), F.coalesce(F.col(key), F.lit("null")))).cast("string"))
    return joined.withColumn(key, check).drop("__key", "__known")
