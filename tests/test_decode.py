import gzip
import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tilewright.operators import decode


def png(width, height, bits, colour, rows, extra=b"", interlace=0):
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    head = struct.pack(">IIBBBBB", width, height, bits, colour, 0, 0, interlace)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + extra + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")


def clear(data):
    return struct.pack(">I", len(data)) + b"tRNS" + data + b"\0\0\0\0"


RGBA = png(2, 2, 8, 6, [b"\0" + bytes([1, 2, 3, 0, 1, 2, 3, 255]), b"\0" + bytes([1, 2, 3, 128, 1, 2, 3, 0])])
CASES = [
    (RGBA, (2, 2, 2, 4, 0.5)),
    (png(2, 1, 8, 4, [b"\0" + bytes([9, 0, 9, 1])]), (2, 1, 1, 2, 0.5)),
    (png(3, 1, 8, 3, [b"\0" + bytes([0, 1, 2])], clear(bytes([0, 7]))), (3, 1, 2, 3, 2 / 3)),
    (png(2, 1, 8, 2, [b"\0" + bytes([1, 2, 3, 4, 5, 6])], clear(struct.pack(">3H", 1, 2, 3))), (2, 1, 1, 2, 0.5)),
    (png(2, 1, 8, 2, [b"\0" + bytes(6)]), (2, 1, 2, 2, 1.0)),
    (png(5, 1, 1, 0, [b"\0" + bytes([0b10101000])], clear(struct.pack(">H", 0))), (5, 1, 3, 5, 0.6)),
    (png(1, 1, 16, 6, [b"\0" + struct.pack(">4H", 1, 2, 3, 1)]), (1, 1, 1, 1, 1.0)),
    (png(2, 3, 8, 4, [b"\1" + bytes([5, 1, 0, 255]), b"\2" + bytes([0, 0, 0, 1]), b"\4" + bytes([0, 255, 0, 0])]), (2, 3, 3, 6, 0.5)),
]


def test_png(spark):
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(CASES)] + [(99, b"no png"), (100, RGBA[:-30])], "i int, content binary")
    rows = {r["i"]: r["s"] for r in df.select("i", decode.summarize_png(F.col("content")).alias("s")).collect()}
    for i, (_, expected) in enumerate(CASES):
        assert tuple(rows[i])[:5] == pytest.approx(expected) and rows[i]["error"] is None, i
    assert rows[99]["error"] and rows[100]["error"] and rows[99]["width"] is None


def test_mask(spark):
    colour = F.struct(*[F.lit(v).alias(c) for c, v in zip("rgba", (31, 120, 180, 190))])
    df = spark.createDataFrame([(0, RGBA), (1, b"x")], "i int, content binary").select("i", decode.recolour_mask(F.col("content"), colour).alias("m")).orderBy("i")
    good, bad = [r["m"] for r in df.collect()]
    on, off = bytes([31, 120, 180, 190]), bytes(4)
    assert (good["width"], good["height"], bytes(good["rgba"])) == (2, 2, off + on + on + off) and bad["error"]


def test_png_interlaced():
    plain = [[(x + y) % 3 == 0 for x in range(9)] for y in range(7)]
    rows = []
    for x0, y0, dx, dy in [(0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2)]:
        for y in range(y0, 7, dy):
            own = bytes(v for x in range(x0, 9, dx) for v in (7, 255 * plain[y][x]))
            if own:
                rows.append(b"\0" + own)
    assert decode.png_alpha(png(9, 7, 8, 4, rows, interlace=1)).tolist() == plain


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    return varint(number << 3) + varint(value) if isinstance(value, int) else varint(number << 3 | 2) + varint(len(value)) + value


def feature(kind, commands, tags=(), mvt_id=None):
    parts = [field(1, mvt_id)] if mvt_id else []
    return b"".join([*parts, field(2, b"".join(map(varint, tags))), field(3, kind), field(4, b"".join(map(varint, commands)))])


def layer(name, features, keys=(), values=(), extent=None):
    parts = [field(1, name.encode()), *[field(2, f) for f in features], *[field(3, k.encode()) for k in keys], *[field(4, v) for v in values]]
    return field(3, b"".join(parts + ([field(5, extent)] if extent else []) + [field(15, 2)]))


GEOMETRIES = [
    (1, [9, 50, 34], "Point", [[(25, 17)]]),
    (1, [17, 10, 14, 3, 9], "MultiPoint", [[(5, 7), (3, 2)]]),
    (2, [9, 4, 4, 18, 0, 16, 16, 0], "LineString", [[(2, 2), (2, 10), (10, 10)]]),
    (2, [9, 4, 4, 18, 0, 16, 16, 0, 9, 17, 17, 10, 4, 8], "MultiLineString", [[(2, 2), (2, 10), (10, 10)], [(1, 1), (3, 5)]]),
    (3, [9, 6, 12, 18, 10, 12, 24, 44, 15], "Polygon", [[(3, 6), (8, 12), (20, 34), (3, 6)]]),
    (1, [], "MultiPoint", [[]]),
]


@pytest.mark.parametrize(("kind", "commands", "name", "parts"), GEOMETRIES)
def test_geometry(kind, commands, name, parts):
    assert decode.read_geometry(commands, kind) == (name, parts)


def test_unknown_command():
    with pytest.raises(ValueError):
        decode.read_geometry([12], 2)


VALUES = [(7, 1, True), (3, None, 2.5), (2, None, 0.5), (4, (1 << 64) - 3, -3), (6, 5, -3), (1, b"s", "s"), (5, 9, 9)]


def encoded_value(number, raw, value):
    if number == 3:
        return varint(3 << 3 | 1) + struct.pack("<d", value)
    if number == 2:
        return varint(2 << 3 | 5) + struct.pack("<f", value)
    return field(number, raw)


def tile():
    keys, values = [f"k{n}" for n, *_ in VALUES], [encoded_value(*v) for v in VALUES]
    tags = [i for k in range(len(VALUES)) for i in (k, k)]
    return layer("a", [feature(1, [9, 50, 34], tags, 77)], keys, values, 4096) + layer("b", [feature(1, [9, 0, 0])]) + layer("b", [feature(2, [9, 4, 4, 18, 0, 16, 16, 0])] * 2)


def test_mvt(spark):
    df = spark.createDataFrame([(0, 0, 0, tile(), "custom_mvt", ["zzz"]), (1, 0, 1, gzip.compress(tile()), "ogr2ogr", ["b"]), (2, 0, 1, tile()[:-3], "custom_mvt", None)], "source_zoom int, x long, y long, content binary, decoder string, layer_names array<string>")
    df = df.withColumn("mvt", decode.decode_mvt_tiles(decode.gunzip(F.col("content")))).select("*", "mvt.*").cache()
    assert df.where("error IS NOT NULL").select("source_zoom").collect()[0][0] == 2
    rows = decode.feature_rows(df.where("error IS NULL"), ["source_zoom", "x", "y", "decoder", "layer_names"], "layer_names").orderBy("source_zoom", "layer_name", "feature_index").collect()
    assert [(r["source_zoom"], r["layer_name"], r["feature_index"]) for r in rows] == [(0, "a", 0), (0, "b", 0), (0, "b", 1), (1, "b", 0), (1, "b", 1)]
    assert json.loads(rows[0]["properties_json"]) == {f"k{n}": v for n, _, v in VALUES} and rows[0]["mvt_id"] == "77" and rows[1]["mvt_id"] == "0"
    assert rows[0]["properties_json"] == json.dumps(json.loads(rows[0]["properties_json"]), sort_keys=True)
    counts = df.where("source_zoom = 0").select(decode.layer_counts(F.col("layers")).alias("c")).first()["c"]
    assert counts == {"a": 1, "b": 2}
    assert {tuple(r) for r in decode.layer_listing(df.where("source_zoom = 0")).collect()} == {("a", "Point"), ("b", "LineString")}


def test_wkt(spark):
    shape = "parts array<array<struct<x: double, y: double>>>"
    rows = [("Point", [[(1.000000005, 0.001953125)]]), ("MultiLineString", [[(0.0, 1.0), (2.0, 3.0)], [(4.0, 5.0), (6.0, 7.0)]]), ("Polygon", [[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]]), ("Other", [])]
    df = spark.createDataFrame(rows, f"kind string, {shape}").withColumn("wkt", decode.write_wkt(F.col("kind"), F.col("parts"))).withColumn("back", decode.parse_wkt(F.col("wkt")))
    got = df.collect()
    assert got[0]["wkt"] == "POINT (1.00000000 0.00195312)"
    assert got[1]["wkt"] == "MULTILINESTRING ((0.00000000 1.00000000, 2.00000000 3.00000000), (4.00000000 5.00000000, 6.00000000 7.00000000))"
    assert got[3]["wkt"] == "" and got[3]["back"] == [] and all(r["back"] == r["parts"] for r in got[1:3])
    empty = spark.range(1).select(decode.parse_wkt(F.lit("POINT EMPTY")), decode.parse_wkt(F.lit("MULTIPOLYGON (((0 0, 1 1)), ((2 2, 3 3)))"))).first()
    assert empty[0] == [] and len(empty[1]) == 2


def test_coverage_json(spark):
    body = json.dumps({"lastModified": "m", "panos": [{"panoid": "p", "lat": 1.5, "lon": 2.5}, {"panoid": "q"}]}).encode()
    df = spark.createDataFrame([(1, body), (2, gzip.compress(body)), (3, b"{}")], "k int, content binary").withColumn("document", decode.read_coverage_json(F.col("content")))
    rows = decode.pano_rows(df, ["k"]).orderBy("k", "panoid").collect()
    assert [(r["k"], r["panoid"], r["lat"], r["lastModified"]) for r in rows] == [(1, "p", 1.5, "m"), (1, "q", None, "m"), (2, "p", 1.5, "m"), (2, "q", None, "m")]


def test_texts_of_a_batch(spark):
    """WKT of all kinds beside each other, with nulls and empty parts."""
    rows = [("Point", [[(1.0, -0.0)]]), ("MultiPoint", [[(1.5, 2.5), (0.000000005, 1e9)]]), ("LineString", [[(0.1, 0.2), (3.0, 4.0)], [(9.0, 9.0)]]), ("Point", []), ("Point", [[]]), ("Unknown", [[(1.0, 1.0)]]), (None, [[(1.0, 1.0)]]), ("Polygon", None)]
    rows += [("Polygon", [[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)], [], [(2.0, 2.0)]]), ("MultiLineString", [[(5.0, 5.0), (6.0, 6.0)], None, [(7.0, 7.0)]])] + [("Point", [[(float(i), 0.5)]]) for i in range(5000)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, kind string, parts array<array<struct<x: double, y: double>>>")

    def ring(part):
        return "(" + ", ".join(f"{x:.8f} {y:.8f}" for x, y in part or []) + ")"

    def text(kind, parts):
        own = parts or []
        if kind in ("Point", "MultiPoint", "LineString"):
            return f"{kind.upper()} {ring(own[0] if own else [])}"
        return f"{kind.upper()} ({', '.join(map(ring, own))})" if kind in ("MultiLineString", "Polygon") else ""

    got = {r["i"]: r["t"] for r in df.select("i", decode.write_wkt(F.col("kind"), F.col("parts")).alias("t")).collect()}
    assert got == {i: text(*r) for i, r in enumerate(rows)}
