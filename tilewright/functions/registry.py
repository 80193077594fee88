"""The library's functions for SQL texts: :func:`register_functions` makes them known to a session.

Column functions become SQL functions, which Spark puts in place of their calls, so that a query over them is planned like one written with columns.
Decoders become vectorised functions, and what gives rows becomes table functions.
"""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import grid, text
from tilewright.operators import decode, vector_tiles

BBOX = "STRUCT<min_lon: DOUBLE, min_lat: DOUBLE, max_lon: DOUBLE, max_lat: DOUBLE>"
RANGE = "STRUCT<x_min: BIGINT, x_max: BIGINT, y_min: BIGINT, y_max: BIGINT>"
POINT = "STRUCT<lon: DOUBLE, lat: DOUBLE>"


def sql_text(column: Column) -> str:
    """A column as SQL that can be read again: operators as functions in quotes, fractions as doubles."""
    piece = re.compile(r"('(?:[^'\\]|\\.)*'|`[^`]*`)|(?<![\w`])([^\w\s(),.'\"`\[\]]+)\(|(?<![\w.])(\d+\.\d+(?:[eE][+-]?\d+)?)(?![\w.])")

    def again(m: re.Match) -> str:
        return m[1] or (f"`{m[2]}`(" if m[2] else f"{m[3]}D")

    return piece.sub(again, column._jc.node().sql())


def _point(lonlat: tuple[Column, Column]) -> Column:
    return F.struct(lonlat[0].cast("double").alias("lon"), lonlat[1].cast("double").alias("lat"))


def _tile_at(lon: Column, lat: Column, zoom: Column, scheme: Column) -> Column:
    """The tile of a point, in the grid that the catalog's ``scheme`` names."""
    pack = lambda xy: F.struct(xy[0].alias("x"), xy[1].alias("y"))
    at = (lon, lat, zoom)
    return F.when(scheme == grid.BAIDU, pack(grid.baidu_lonlat_to_tile(*at))).when(scheme == grid.ELLIPTIC, pack(grid.elliptic_lonlat_to_tile(*at))).otherwise(pack(grid.lonlat_to_tile(*at)))


def _steps(r: Column, axis: str) -> Column:
    """The numbers of a range along one axis; none of an inverted one."""
    low, high = r[f"{axis}_min"], r[f"{axis}_max"]
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.slice(F.array(low), 1, 0))


def _subboxes(bbox: Column, n_rows: Column, n_cols: Column) -> Column:
    """The boxes of a grid, row by row from the south."""
    wide, high = (bbox["max_lon"] - bbox["min_lon"]) / n_cols, (bbox["max_lat"] - bbox["min_lat"]) / n_rows

    def box(i: Column) -> Column:
        c, r = i % n_cols, F.floor(i / n_cols)
        ends = (bbox["min_lon"] + c * wide, bbox["min_lat"] + r * high, bbox["min_lon"] + (c + 1) * wide, bbox["min_lat"] + (r + 1) * high)
        return F.struct(i.alias("job_index"), F.struct(*[v.alias(n) for v, n in zip(ends, ("min_lon", "min_lat", "max_lon", "max_lat"))]).alias("bbox"))

    return F.transform(F.sequence(F.lit(0), n_rows * n_cols - 1), box)


#: name: (arguments, what it returns, the column made of columns of the arguments).
SCALARS = {
    "tile_at": ("lon DOUBLE, lat DOUBLE, zoom INT, scheme STRING", "STRUCT<x: BIGINT, y: BIGINT>", _tile_at),
    "tile_range": (f"bbox {BBOX}, zoom INT, scheme STRING", RANGE, grid.tile_range),
    "tile_count": (f"r {RANGE}", "BIGINT", grid.tile_count),
    "tile_columns": (f"r {RANGE}", "ARRAY<BIGINT>", lambda r: _steps(r, "x")),
    "tile_rows": (f"r {RANGE}", "ARRAY<BIGINT>", lambda r: _steps(r, "y")),
    "subboxes_of": (f"bbox {BBOX}, n_rows INT, n_cols INT", f"ARRAY<STRUCT<job_index: INT, bbox: {BBOX}>>", _subboxes),
    "tile_bounds": ("x BIGINT, y BIGINT, zoom INT, scheme STRING", BBOX, grid.tile_bounds),
    "tile_centre": (f"bounds {BBOX}", POINT, grid.tile_centre),
    "zigzag_decode": ("v BIGINT", "BIGINT", grid.zigzag_decode),
    "wgs84_to_gcj02": ("lon DOUBLE, lat DOUBLE", POINT, lambda lon, lat: _point(grid.wgs84_to_gcj02(lon, lat))),
    "gcj02_to_bd09": ("lon DOUBLE, lat DOUBLE", POINT, lambda lon, lat: _point(grid.gcj02_to_bd09(lon, lat))),
    "fill_tile_url": ("template STRING, zoom INT, x BIGINT, y BIGINT", "STRING", lambda template, zoom, x, y: text.fill_template(template, z=zoom, x=x, y=y)),
    "content_suffix": ("content_type STRING, url STRING", "STRING", text.content_suffix),
    "wkt_type": ("wkt STRING", "STRING", text.wkt_type),
}

def _record_count(kind: pd.Series, content: pd.Series) -> pd.Series:
    """Features of a vector tile, panoramas of a JSON tile, covered pixels of a raster; null of what is none of these or broken."""
    out = pd.Series([None] * len(kind), index=kind.index, dtype="Int64")
    plain = decode._inflate(content)
    rasters = kind.eq("raster") & plain.notna()
    if rasters.any():
        out[rasters] = decode._summarize_png(plain[rasters])["coverage_pixel_count"].to_numpy()
    vectors = kind.eq("vector_mvt") & plain.notna()
    if vectors.any():
        read = vector_tiles.read_tiles(pa.array([bytes(b) for b in plain[vectors]], pa.binary()))
        out[vectors] = [None if layers is None else sum(len(x["features"]) for x in layers) for layers in read.field("layers").to_pylist()]
    documents = kind.eq("coverage_json") & plain.notna()
    if documents.any():
        out[documents] = plain[documents].map(decode.pano_count).astype("Int64")
    return out


class TilesIn:
    """Table function: a row for each tile of a range, x first. ``tile_columns`` and ``tile_rows`` do the same without Python."""

    def eval(self, r):
        if r is not None:
            for x in range(r["x_min"], r["x_max"] + 1):
                for y in range(r["y_min"], r["y_max"] + 1):
                    yield x, y


class MvtFeatures:
    """Table function: a row for each feature of a vector tile; none of null or of a broken tile."""

    def eval(self, content: bytes):
        if content is not None:
            for layers in vector_tiles.read_tiles(pa.array([content], pa.binary())).field("layers").to_pylist():
                for layer in layers or []:
                    for i, f in enumerate(layer["features"]):
                        yield layer["name"], i, f["mvt_id"], f["geometry_type"], f["properties_json"]


FEATURES = "layer_name string, feature_index int, mvt_id string, geometry_type string, properties_json string"


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Register all functions as temporary ones of the session, and return their names.

    Scalar: ``tile_at``, ``tile_range``, ``tile_count``, ``tile_bounds``, ``tile_centre``, ``zigzag_decode``, ``wgs84_to_gcj02``, ``gcj02_to_bd09``, ``fill_tile_url``,
    ``content_suffix``, ``wkt_type``; where they take a ``scheme``, it is the catalog's column that chooses the grid. To explode, once they are columns of a subquery: ``tile_columns`` and ``tile_rows`` of a range,
    ``subboxes_of(bbox, n_rows, n_cols)``. Decoders: ``png_summary``, ``mvt_layers``, ``gunzip_tile``, and ``tile_record_count``, which goes by the
    catalog's ``source_kind``. Tables: ``tiles_in(range)`` and ``mvt_features(content)``.
    """
    for name, (arguments, returns, make) in SCALARS.items():
        names = [a.split()[0] for a in re.sub(r"<[^>]*>", "", arguments).split(", ")]
        body = sql_text(make(*[F.col(n) for n in names]))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS {returns} RETURN {body}")
    decoders = {
        "png_summary": F.pandas_udf(decode._summarize_png, decode.PNG_SUMMARY),
        "mvt_layers": F.arrow_udf(decode._decode_mvt_tiles, decode.MVT),
        "gunzip_tile": F.pandas_udf(decode._inflate, "binary"),
        "tile_record_count": F.pandas_udf(_record_count, "long"),
    }
    for name, f in decoders.items():
        spark.udf.register(f"{prefix}{name}", f)
    tables = {"tiles_in": F.udtf(TilesIn, returnType="x long, y long"), "mvt_features": F.udtf(MvtFeatures, returnType=FEATURES)}
    for name, t in tables.items():
        spark.udtf.register(f"{prefix}{name}", t)
    return [f"{prefix}{n}" for n in (*SCALARS, *decoders, *tables)]
