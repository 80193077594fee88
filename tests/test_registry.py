"""Functions in SQL texts against the columns that they stand for."""

import gzip

import pytest
from pyspark.sql import functions as F

from tilewright import samples
from tilewright.functions import grid, registry
from tilewright.operators import decode

BOXES = "VALUES (1, named_struct('min_lon', 4.728D, 'min_lat', 52.278D, 'max_lon', 5.079D, 'max_lat', 52.431D)), (2, named_struct('min_lon', 116.3D, 'min_lat', 39.8D, 'max_lon', 116.5D, 'max_lat', 39.95D)) AS t(k, bbox)"


@pytest.fixture(scope="module")
def names(spark):
    return registry.register_functions(spark, "tw_")


def test_scalars_are_the_columns(spark, names):
    spark.sql(f"SELECT k, bbox, scheme FROM {BOXES}, (VALUES ('web_mercator'), ('yandex_wgs84_mercator'), ('baidu'), ('other')) AS s(scheme)").createOrReplaceTempView("boxes_of_test")
    df = spark.table("boxes_of_test")
    got = spark.sql("SELECT k, scheme, tw_tile_range(bbox, 11, scheme) AS r, tw_tile_at(bbox.min_lon, bbox.max_lat, 11, scheme) AS t, tw_tile_bounds(1000L, 700L, 11, scheme) AS b, tw_wgs84_to_gcj02(bbox.min_lon, bbox.min_lat) AS g FROM boxes_of_test")
    b, scheme, z = F.col("bbox"), F.col("scheme"), F.lit(11)
    shifted = grid.wgs84_to_gcj02(b["min_lon"], b["min_lat"])
    expected = df.select("k", "scheme", grid.tile_range(b, z, scheme).alias("r"), registry._tile_at(b["min_lon"], b["max_lat"], z, scheme).alias("t"), grid.tile_bounds(F.lit(1000), F.lit(700), z, scheme).alias("b"), F.struct(shifted[0].alias("lon"), shifted[1].alias("lat")).alias("g"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    row = spark.sql("SELECT tw_tile_count(named_struct('x_min', 1L, 'x_max', 3L, 'y_min', 5L, 'y_max', 6L)) AS n, tw_zigzag_decode(3L) AS z, tw_fill_tile_url('u/{z}/{x}/{y}?a=1.5', 3, 4L, 5L) AS u, tw_content_suffix('image/webp; q=1.0', 'u') AS s, tw_wkt_type('MULTIPOINT (1 2)') AS w").first()
    assert tuple(row) == (6, -2, "u/3/4/5?a=1.5", ".webp", "MultiPoint")


def test_tables(spark, names):
    tiles = spark.sql("SELECT k, x, y FROM (VALUES (1, named_struct('x_min', 1L, 'x_max', 2L, 'y_min', 5L, 'y_max', 7L)), (2, named_struct('x_min', 2L, 'x_max', 1L, 'y_min', 5L, 'y_max', 7L))) AS t(k, r), LATERAL tw_tiles_in(r)").collect()
    assert sorted(map(tuple, tiles)) == [(1, x, y) for x in (1, 2) for y in (5, 6, 7)]
    native = spark.sql("SELECT k, x, y FROM (SELECT k, tw_tile_columns(r) AS xs, tw_tile_rows(r) AS ys FROM (VALUES (1, named_struct('x_min', 1L, 'x_max', 2L, 'y_min', 5L, 'y_max', 7L)), (2, named_struct('x_min', 2L, 'x_max', 1L, 'y_min', 5L, 'y_max', 7L))) AS t(k, r)) LATERAL VIEW explode(xs) AS x LATERAL VIEW explode(ys) AS y")
    assert sorted(native.collect()) == sorted(tiles)
    parts = spark.sql(f"SELECT k, s.job_index, s.bbox.min_lon AS w FROM (SELECT k, tw_subboxes_of(bbox, 2, 3) AS parts FROM {BOXES} WHERE k = 1) LATERAL VIEW explode(parts) AS s").collect()
    assert sorted((r["job_index"], round(r["w"], 6)) for r in parts) == [(i, round(4.728 + i % 3 * 0.117, 6)) for i in range(6)]


def test_decoders(spark, names):
    rows = [(k, kind, gzip.compress(body) if k % 2 and kind != "raster" else body) for k in range(6) for kind, body in (("raster", samples.png_body(k)), ("vector_mvt", samples.vector_body(k)), ("coverage_json", samples.json_body(k)), ("other", b"x"))]
    rows += [(9, "raster", b"broken"), (9, "vector_mvt", b"\x1a"), (9, "coverage_json", b"{"), (9, "raster", None)]
    spark.createDataFrame(rows, "k int, kind string, content binary").createOrReplaceTempView("tiles_of_test")
    got = {(r["k"], r["kind"]): r["n"] for r in spark.sql("SELECT k, kind, tw_tile_record_count(kind, content) AS n FROM tiles_of_test WHERE content IS NOT NULL").collect()}
    for k in range(6):
        covered = sum((7 * i + k) % 3 != 0 for i in range((1 + k % 9) * (1 + k % 7)))
        assert (got[k, "raster"], got[k, "vector_mvt"], got[k, "coverage_json"], got[k, "other"]) == (covered, k % 4 + 1, k % 3, None)
    assert [got[9, kind] for kind in ("raster", "vector_mvt", "coverage_json")] == [None] * 3
    features = spark.sql("SELECT k, f.* FROM tiles_of_test, LATERAL tw_mvt_features(tw_gunzip_tile(content)) AS f WHERE kind = 'vector_mvt' AND k < 9")
    assert features.columns == ["k", "layer_name", "feature_index", "mvt_id", "geometry_type", "properties_json"] and features.count() == sum(k % 4 + 1 for k in range(6))
    assert spark.sql("SELECT tw_png_summary(content).width AS w, size(tw_mvt_layers(content).layers) AS n FROM tiles_of_test WHERE k = 3 AND kind = 'raster'").first()["w"] == 4
    assert decode.pano_count(b"[]") is None


def test_texts_of_columns():
    assert registry.sql_text(F.col("a") * 2.5 + F.lit("it's 1.5 *(")) == r"`+`(`*`(a, 2.5D), 'it\'s 1.5 *(')"
