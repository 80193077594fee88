import math

import pytest
from pyspark.sql import functions as F

from tilewright.functions import grid

BOXES = {
    "A": (4.728, 52.278, 5.079, 52.431),
    "H": (113.87, 22.19, 114.33, 22.45),
    "M": (37.53, 55.73, 37.60, 55.76),
    "B": (91.54, 53.66, 91.72, 53.79),
}
RANGES = [
    ("A", "web_mercator", 8, (131, 131, 84, 84), 1),
    ("A", "web_mercator", 13, (4203, 4211, 2689, 2695), 63),
    ("A", "web_mercator", 18, (134514, 134770, 86077, 86260), 47288),
    ("M", "yandex_wgs84_mercator", 13, (4950, 4951, 2567, 2569), 6),
    ("M", "web_mercator", 13, (4950, 4951, 2560, 2561), 4),
    ("B", "yandex_wgs84_mercator", 13, (6179, 6183, 2645, 2650), 30),
    ("H", "baidu", 13, (1547, 1553, 307, 311), 35),
    ("H", "web_mercator", 13, (6687, 6697, 3571, 3577), 77),
    ("H", "anything else", 13, (6687, 6697, 3571, 3577), 77),
]


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_ranges(spark):
    rows = [(BOXES[b], s, z) for b, s, z, _, _ in RANGES]
    df = spark.createDataFrame(rows, "bbox struct<min_lon: double, min_lat: double, max_lon: double, max_lat: double>, scheme string, z int")
    df = df.withColumn("r", grid.tile_range(F.col("bbox"), F.col("z"), F.col("scheme"))).select("r.*", grid.tile_count(F.col("r")))
    assert [tuple(r) for r in df.collect()] == [(*r, n) for *_, r, n in RANGES]


def test_scalars(spark):
    lit = F.lit
    assert one(spark, *grid.lonlat_to_tile(lit(4.9), lit(52.35), lit(13))) == (4207, 2692)
    assert one(spark, *grid.lonlat_to_tile(lit(0.0), lit(-90.0), lit(13))) == (4096, 53672)
    assert one(spark, *grid.tile_to_bounds(lit(4207), lit(2692), lit(13))) == pytest.approx((4.8779296875, 52.34876318198808, 4.921875, 52.3755991766591))
    assert one(spark, *grid.elliptic_lonlat_to_tile(lit(37.565), lit(55.745), lit(13))) == (4950, 2568)
    assert one(spark, grid.elliptic_lat_to_y(lit(55.75))) == pytest.approx((0.3135132296222706,))
    gcj = grid.wgs84_to_gcj02(lit(114.1), lit(22.3))
    assert one(spark, *gcj) == pytest.approx((114.10510646275051, 22.29734102536066), rel=1e-12)
    assert one(spark, *grid.gcj02_to_bd09(*gcj)) == pytest.approx((114.111540703271, 22.30358086849755), rel=1e-12)
    assert one(spark, *grid.bd09_to_mercator(lit(114.111540703271), lit(22.30358086849755))) == pytest.approx((12702976.823628098, 2531651.0401611426))
    assert one(spark, *grid.wgs84_to_gcj02(lit(4.9), lit(52.35))) == (4.9, 52.35)
    assert one(spark, *[grid.zigzag_decode(lit(v)) for v in range(5)]) == (0, -1, 1, -2, 2)
    assert one(spark, *[grid.wrap(lit(v), -180.0, 180.0) for v in (180.0, 181.0, -180.0, -541.0, 900.0)]) == (180.0, -179.0, -180.0, 179.0, 180.0)
    assert one(spark, *grid.tile_point_to_lonlat(lit(0), lit(0), lit(0), lit(0), lit(2048.0), lit(2048.0))) == pytest.approx((0.0, 0.0))


def test_southern_latitudes_take_the_band_at_the_equator(spark):
    x, y = one(spark, *grid.bd09_to_mercator(F.lit(10.0), F.lit(-60.0)))
    c = grid.BAND_COEFFICIENTS[-1]
    t = 60.0 / c[9]
    assert y == pytest.approx(-(c[2] + sum(c[3 + k] * t ** (k + 1) for k in range(6))))
    assert one(spark, *grid.bd09_to_mercator(F.lit(float("nan")), F.lit(float("nan")))) == (None, None)


def test_centres_of_tiles_are_in_their_tiles(spark):
    df = spark.range(2000).select((F.col("id") * 37 % 8192).alias("x"), (F.col("id") * 91 % 8192).alias("y"))
    for scheme, back in (("web_mercator", grid.lonlat_to_tile), ("yandex_wgs84_mercator", grid.elliptic_lonlat_to_tile)):
        c = grid.tile_centre(grid.tile_bounds(F.col("x"), F.col("y"), F.lit(13), F.lit(scheme)))
        tile = back(c["lon"], c["lat"], F.lit(13))
        assert df.where((tile[0] != F.col("x")) | (tile[1] != F.col("y"))).count() == 0
    assert one(spark, grid.tile_bounds(F.lit(1), F.lit(1), F.lit(3), F.lit("baidu"))) == (None,)


def test_enumeration(spark):
    df = spark.createDataFrame([(1, (0, 1, 0, 1)), (2, (3, 2, 0, 0))], "k int, tile_range struct<x_min: long, x_max: long, y_min: long, y_max: long>")
    assert [(r["k"], r["x"], r["y"]) for r in grid.explode_tiles(df).collect()] == [(1, 0, 0), (1, 0, 1), (1, 1, 0), (1, 1, 1)]
    assert math.isclose(one(spark, grid.mercator_y_to_lat(F.lit(0.5)))[0], 0.0, abs_tol=1e-12)
