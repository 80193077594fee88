"""Tile-grid and geodesy functions, all ``Column`` to ``Column``, without Python on the executors.

Three grids: ``web_mercator`` (spherical), ``yandex_wgs84_mercator``
(elliptic) and ``baidu`` (an offset datum with a polynomial projection).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WEB_MERCATOR, ELLIPTIC, BAIDU = "web_mercator", "yandex_wgs84_mercator", "baidu"

# Eccentricity and latitude limit of the elliptic grid.
ELLIPTIC_ECCENTRICITY = 0.0818191908426
ELLIPTIC_LAT_LIMIT = 85.08405905

# Ellipsoid of the offset datum and the box in which it applies.
GCJ_SEMI_MAJOR, GCJ_ECCENTRICITY_2 = 6378245.0, 0.00669342162296594323
GCJ_BOX = (72.004, 137.8347, 0.8293, 55.8271)

# Latitude bands of the polynomial projection and the coefficients of each.
BANDS = (75, 60, 45, 30, 15, 0)
BAND_COEFFICIENTS = (
    (-0.0015702102444, 111320.7020616939, 1704480524535203, -10338987376042340, 26112667856603880, -35149669176653700, 26595700718403920, -10725012454188240, 1800819912950474, 82.5),
    (0.0008277824516172526, 111320.7020463578, 647795574.6671607, -4082003173.641316, 10774905663.51142, -15171875531.51559, 12053065338.62167, -5124939663.577472, 913311935.9512032, 67.5),
    (0.00337398766765, 111320.7020202162, 4481351.045890365, -23393751.19931662, 79682215.47186455, -115964993.2797253, 97236711.15602145, -43661946.33752821, 8477230.501135234, 52.5),
    (0.00220636496208, 111320.7020209128, 51751.86112841131, 3796837.749470245, 992013.7397791013, -1221952.21711287, 1340652.697009075, -620943.6990984312, 144416.9293806241, 37.5),
    (-0.0003441963504368392, 111320.7020576856, 278.2353980772752, 2485758.690035394, 6070.750963243378, 54821.18345352118, 9540.606633304236, -2710.55326746645, 1405.483844121726, 22.5),
    (-0.0003218135878613132, 111320.7020701615, 0.00369383431289, 823725.6402795718, 0.46104986909093, 2351.343141331292, 1.58060784298199, 8.77738589078284, 0.37238884252424, 7.45),
)

_PI = math.pi


def _n(zoom: Column) -> Column:
    return F.pow(F.lit(2.0), zoom)


def _asinh_tan(lat: Column) -> Column:
    """asinh(tan(lat)), symmetric in sign so that it stays finite near the south pole."""
    t = F.tan(F.radians(lat))
    return F.signum(t) * F.log(F.abs(t) + F.sqrt(t * t + 1))


# Spherical Mercator


def lonlat_to_tile(lon: Column, lat: Column, zoom: Column) -> tuple[Column, Column]:
    """Tile x and y; truncated toward zero, not clamped to the grid."""
    n = _n(zoom)
    return ((lon + 180) / 360 * n).cast("long"), ((1 - _asinh_tan(lat) / _PI) / 2 * n).cast("long")


def mercator_y_to_lat(fraction: Column) -> Column:
    return F.degrees(F.atan(F.sinh((1 - 2 * fraction) * _PI)))


def tile_to_bounds(x: Column, y: Column, zoom: Column) -> list[Column]:
    """min_lon, min_lat, max_lon, max_lat of a tile."""
    n = _n(zoom)
    return [x / n * 360 - 180, mercator_y_to_lat((y + 1) / n), (x + 1) / n * 360 - 180, mercator_y_to_lat(y / n)]


# Elliptic Mercator


def clamp(value: Column, least: float, most: float) -> Column:
    return F.greatest(F.least(value, F.lit(most)), F.lit(least))


def elliptic_clamp_lat(lat: Column) -> Column:
    return clamp(lat, -ELLIPTIC_LAT_LIMIT, ELLIPTIC_LAT_LIMIT)


def elliptic_lat_to_y(lat: Column) -> Column:
    phi, e = F.radians(elliptic_clamp_lat(lat)), ELLIPTIC_ECCENTRICITY
    s = F.sin(phi) * e
    return (1 - F.log(F.tan(phi / 2 + _PI / 4) * F.pow((1 - s) / (1 + s), F.lit(e / 2))) / _PI) / 2


def elliptic_y_to_lat(fraction: Column, iterations: int = 12) -> Column:
    """Fixed-point inverse from the spherical latitude."""
    e, growth = ELLIPTIC_ECCENTRICITY, F.exp((1 - 2 * fraction) * _PI)

    def step(phi: Column, _: Column) -> Column:
        s = F.sin(phi) * e
        return F.atan(growth * F.pow((1 + s) / (1 - s), F.lit(e / 2))) * 2 - _PI / 2

    return F.degrees(F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), F.atan(growth) * 2 - _PI / 2, step))


def elliptic_lonlat_to_tile(lon: Column, lat: Column, zoom: Column) -> tuple[Column, Column]:
    """Tile x and y; floored."""
    n = _n(zoom)
    return F.floor((lon + 180) / 360 * n), F.floor(elliptic_lat_to_y(lat) * n)


def elliptic_tile_to_bounds(x: Column, y: Column, zoom: Column) -> list[Column]:
    n = _n(zoom)
    return [x / n * 360 - 180, elliptic_y_to_lat((y + 1) / n), (x + 1) / n * 360 - 180, elliptic_y_to_lat(y / n)]


# Offset datum


def out_of_offset_box(lon: Column, lat: Column) -> Column:
    west, east, south, north = GCJ_BOX
    return ~(lon.between(west, east) & lat.between(south, north))


def _waves(terms: list[tuple[float, Column]]) -> Column:
    return reduce(lambda a, b: a + b, [F.sin(angle * _PI) * size for size, angle in terms]) * 2 / 3


# Fixed values, in the two functions below: the terms of the offset's series.


def offset_lat(lon: Column, lat: Column) -> Column:
    """Perturbation of the latitude at coordinates relative to (105, 35)."""
    plane = 2 * lon + 3 * lat + 0.2 * lat * lat + 0.1 * lon * lat + 0.2 * F.sqrt(F.abs(lon)) - 100
    return plane + _waves([(20.0, 6 * lon), (20.0, 2 * lon)]) + _waves([(20.0, lat), (40.0, lat / 3)]) + _waves([(160.0, lat / 12), (320.0, lat / 30)])


def offset_lon(lon: Column, lat: Column) -> Column:
    """Perturbation of the longitude at coordinates relative to (105, 35)."""
    plane = lon + 2 * lat + 0.1 * lon * lon + 0.1 * lon * lat + 0.1 * F.sqrt(F.abs(lon)) + 300
    return plane + _waves([(20.0, 6 * lon), (20.0, 2 * lon)]) + _waves([(20.0, lon), (40.0, lon / 3)]) + _waves([(150.0, lon / 12), (300.0, lon / 30)])


def wgs84_to_gcj02(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Unchanged outside the box."""
    a, e2, phi = GCJ_SEMI_MAJOR, GCJ_ECCENTRICITY_2, F.radians(lat)
    w = 1 - e2 * F.sin(phi) * F.sin(phi)
    north = offset_lat(lon - 105, lat - 35) * 180 / (a * (1 - e2) / (w * F.sqrt(w)) * _PI)
    east = offset_lon(lon - 105, lat - 35) * 180 / (a / F.sqrt(w) * F.cos(phi) * _PI)
    outside = out_of_offset_box(lon, lat)
    return F.when(outside, lon).otherwise(lon + east), F.when(outside, lat).otherwise(lat + north)


def gcj02_to_bd09(lon: Column, lat: Column) -> tuple[Column, Column]:
    turn = _PI * 3000 / 180
    radius = F.sqrt(lon * lon + lat * lat) + 0.00002 * F.sin(lat * turn)
    angle = F.atan2(lat, lon) + 0.000003 * F.cos(lon * turn)
    return radius * F.cos(angle) + 0.0065, radius * F.sin(angle) + 0.006


def wrap(value: Column, least: float, most: float) -> Column:
    """Moved by whole spans into [least, most], both ends allowed."""
    span = most - least
    over, under = F.ceil((value - most) / span), F.ceil((least - value) / span)
    return F.when(value > most, value - over * span).when(value < least, value + under * span).otherwise(value)


def project_polynomial(x: Column, y: Column, coefficients: list[Column]) -> tuple[Column, Column]:
    """Odd in x and y: linear in x, of degree 6 in y."""
    c, t = coefficients, F.abs(y) / coefficients[9]
    height = c[8]
    for k in range(7, 1, -1):
        height = height * t + c[k]
    sign = lambda v: F.when(v < 0, -1.0).otherwise(1.0)
    return (c[0] + c[1] * F.abs(x)) * sign(x), height * sign(y)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, where repeating its expression would outgrow generated code."""
    return F.transform(F.array(value), body)[0]


def _point(lonlat: tuple[Column, Column]) -> Column:
    return F.struct(lonlat[0].alias("lon"), lonlat[1].alias("lat"))


def bd09_to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """The band is chosen by latitude; every negative latitude takes the band at the equator; not-a-number has none."""
    rows = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in BAND_COEFFICIENTS])

    def project(p: Column) -> Column:
        band = F.lit(len(BANDS) - 1)
        for k, least in reversed(list(enumerate(BANDS[:-1]))):
            band = F.when(p["lat"] >= least, F.lit(k)).otherwise(band)
        x_y = lambda q: project_polynomial(q["lon"], q["lat"], [q["row"][k] for k in range(10)])
        return _let(F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"), rows[band].alias("row")), lambda q: _point(x_y(q)))

    inside = _let(_point((lon, lat)), lambda p: F.when(~F.isnan(p["lat"]), _point((wrap(p["lon"], -180.0, 180.0), clamp(p["lat"], -74.0, 74.0)))))
    found = _let(inside, project)
    return found["lon"], found["lat"]


def baidu_lonlat_to_tile(lon: Column, lat: Column, zoom: Column) -> tuple[Column, Column]:
    shifted = _let(_point((lon, lat)), lambda p: _point(wgs84_to_gcj02(p["lon"], p["lat"])))
    moved = _let(shifted, lambda p: _point(gcj02_to_bd09(p["lon"], p["lat"])))
    flat = _let(moved, lambda p: _point(bd09_to_mercator(p["lon"], p["lat"])))
    span = F.pow(F.lit(2.0), 18 - zoom) * 256
    return F.floor(flat["lon"] / span), F.floor(flat["lat"] / span)


# By scheme


def tile_range(bbox: Column, zoom: Column, scheme: Column) -> Column:
    """``struct<x_min, x_max, y_min, y_max>``, inclusive; unknown schemes are spherical.

    In the two Mercator grids columns follow from longitudes and rows from latitudes alone, so two corners are enough, in plain expressions.
    The offset grid takes all four.
    """
    w, s, e, n = (bbox[c] for c in ("min_lon", "min_lat", "max_lon", "max_lat"))
    corners = F.array(*[F.struct(a.alias("lon"), b.alias("lat")) for a in (w, e) for b in (s, n)])

    def between(ends: list[tuple[Column, Column]]) -> Column:
        return F.struct(*[f(ends[0][i], ends[1][i]).alias(f"{c}_{name}") for i, c in enumerate("xy") for f, name in ((F.least, "min"), (F.greatest, "max"))])

    def spread(tiles: Column) -> Column:
        return F.struct(*[f(tiles[c]).alias(f"{c}_{name}") for c in ("x", "y") for f, name in ((F.array_min, "min"), (F.array_max, "max"))])

    def offset_tile(p: Column) -> Column:
        x, y = baidu_lonlat_to_tile(p["lon"], p["lat"], zoom)
        return F.struct(x.alias("x"), y.alias("y"))

    plain = [between([tile(w, n, zoom), tile(e, s, zoom)]) for tile in (elliptic_lonlat_to_tile, lonlat_to_tile)]
    return F.when(scheme == BAIDU, _let(F.transform(corners, offset_tile), spread)).when(scheme == ELLIPTIC, plain[0]).otherwise(plain[1])


def tile_count(rng: Column) -> Column:
    """Tiles in a range, without listing them."""
    return (rng["x_max"] - rng["x_min"] + 1) * (rng["y_max"] - rng["y_min"] + 1)


def tile_bounds(x: Column, y: Column, zoom: Column, scheme: Column, baidu_as_spherical: bool = False) -> Column:
    """``struct<min_lon, min_lat, max_lon, max_lat>``. The offset grid has no inverse: null, unless asked to be read as spherical."""
    names = ("min_lon", "min_lat", "max_lon", "max_lat")
    pack = lambda parts: F.struct(*[p.alias(n) for p, n in zip(parts, names)])
    plain = F.when(scheme == ELLIPTIC, pack(elliptic_tile_to_bounds(x, y, zoom))).otherwise(pack(tile_to_bounds(x, y, zoom)))
    return plain if baidu_as_spherical else F.when(scheme == BAIDU, F.lit(None)).otherwise(plain)


def tile_centre(bounds: Column) -> Column:
    return F.struct(((bounds["min_lon"] + bounds["max_lon"]) / 2).alias("lon"), ((bounds["min_lat"] + bounds["max_lat"]) / 2).alias("lat"))


def tile_point_to_lonlat(x: Column, y: Column, zoom: Column, extent: Column, px: Column, py: Column) -> tuple[Column, Column]:
    """A point in a tile's own units; an extent of 0 or null is 4096."""
    size, n = F.coalesce(F.nullif(extent.cast("double"), F.lit(0.0)), F.lit(4096.0)), _n(zoom)
    return (x + px / size) / n * 360 - 180, mercator_y_to_lat((y + py / size) / n)


def zigzag_decode(value: Column) -> Column:
    return F.shiftrightunsigned(value, 1).bitwiseXOR(-value.bitwiseAND(F.lit(1)))


def explode_tiles(df, rng: str = "tile_range"):
    """One row per tile of each row's range, x first; empty and inverted ranges give none."""
    r = F.col(rng)
    ok = df.where((r["x_min"] <= r["x_max"]) & (r["y_min"] <= r["y_max"]))
    return ok.withColumn("x", F.explode(F.sequence(r["x_min"], r["x_max"]))).withColumn("y", F.explode(F.sequence(r["y_min"], r["y_max"])))
