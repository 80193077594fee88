"""Tiles to records. Bytes are decoded in Arrow batches; everything after is columns.

No decoder throws: each gives its result and an error text, of which one is null. Decoders are marked as not deterministic, which they
are, so that a filter on what they give (such as an explosion brings along) is not pushed below them with a second decoding.
"""

from __future__ import annotations

import gzip
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions import grid
from tilewright.operators import rasters, vector_tiles

# PNG


def _samples(raw: bytes, width: int, height: int, bits: int, channels: int) -> tuple[np.ndarray, int]:
    """Unfiltered samples (height, width, channels) of one pass, and the bytes it took."""
    step, row_bytes = max(1, bits * channels // 8), (width * bits * channels + 7) // 8
    lines = np.frombuffer(raw[: height * (row_bytes + 1)], np.uint8).reshape(height, row_bytes + 1)
    if lines[:, 0].max() > 4:
        raise ValueError(f"filter {lines[:, 0].max()}")
    if (lines[:, 0] > 2).any():
        return _values(_unfilter_by_diagonals(lines, step), width, height, bits, channels), height * (row_bytes + 1)
    out = np.zeros((height + 1, row_bytes + step), np.int32)
    for y in range(height):
        kind, line = lines[y, 0], lines[y, 1:].astype(np.int32)
        above, row = out[y], out[y + 1]
        if kind == 0:
            row[step:] = line
        elif kind == 1:
            for k in range(step):
                row[step + k :: step] = np.cumsum(line[k::step]) & 255
        else:
            row[step:] = (line + above[step:]) & 255
    return _values(out[1:, step:].astype(np.uint8), width, height, bits, channels), height * (row_bytes + 1)


def _unfilter_by_diagonals(lines: np.ndarray, step: int) -> np.ndarray:
    """Bytes of filtered rows of any kind: what a pixel depends on lies on the two diagonals before its own."""
    height, width = len(lines), (lines.shape[1] - 1) // step
    kind, pixels = lines[:, 0], lines[:, 1:].reshape(height, width, step).astype(np.int32)
    out = np.zeros((height + 1, width + 1, step), np.int32)
    for d in range(height + width - 1):
        y = np.arange(max(0, d - width + 1), min(height, d + 1))
        x, own = d - y, kind[y, None]
        a, b, c = out[y + 1, x], out[y, x + 1], out[y, x]
        p = a + b - c
        by_a, by_b, by_c = np.abs(p - a), np.abs(p - b), np.abs(p - c)
        paeth = np.where((by_a <= by_b) & (by_a <= by_c), a, np.where(by_b <= by_c, b, c))
        out[y + 1, x + 1] = (pixels[y, x] + np.choose(own, [0, a, b, (a + b) // 2, paeth])) & 255
    return out[1:, 1:].reshape(height, -1).astype(np.uint8)


def _values(data: np.ndarray, width: int, height: int, bits: int, channels: int) -> np.ndarray:
    if bits == 16:
        values = data.reshape(height, -1, 2)
        values = values[..., 0].astype(np.uint16) << 8 | values[..., 1]
    elif bits == 8:
        values = data.astype(np.uint16)
    else:
        spread = np.unpackbits(data, axis=1).reshape(height, -1, bits)
        values = (spread * (1 << np.arange(bits - 1, -1, -1))).sum(axis=2).astype(np.uint16)
    return values[:, : width * channels].reshape(height, width, channels)


def png_alpha(data: bytes) -> np.ndarray:
    """Which pixels are not fully transparent."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, chunks = 8, {}
    while at + 8 <= len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        chunks[name] = chunks.get(name, b"") + data[at + 8 : at + 8 + size]
        at += 12 + size
    width, height, bits, colour, _, _, interlaced = struct.unpack(">IIBBBBB", chunks[b"IHDR"])
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    raw, image = zlib.decompress(chunks[b"IDAT"]), np.zeros((height, width, channels), np.uint16)
    passes = [(0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2)] if interlaced else [(0, 0, 1, 1)]
    for x0, y0, dx, dy in passes:
        w, h = -(-(width - x0) // dx), -(-(height - y0) // dy)
        if w > 0 and h > 0:
            part, used = _samples(raw, w, h, bits, channels)
            image[y0::dy, x0::dx], raw = part, raw[used:]
    clear = chunks.get(b"tRNS")
    if colour in (4, 6):
        return image[..., -1] > 0
    if colour == 3 and clear is not None:
        table = np.full(1 << bits, 255)
        table[: len(clear)] = list(clear)
        return table[image[..., 0]] > 0
    if clear is not None:
        return (image != np.array(struct.unpack(f">{channels}H", clear))).any(axis=2)
    return np.ones((height, width), bool)


PNG_SUMMARY = "width int, height int, coverage_pixel_count long, total_pixel_count long, coverage_ratio double, error string"


def summarize_png(content: Column) -> Column:
    """Size, pixels that are not fully transparent, all pixels and their ratio (0 without pixels); of null, nulls."""
    return F.arrow_udf(_summaries, PNG_SUMMARY).asNondeterministic()(content)  # of one kind with the vector tiles' decoder, so that Spark calls both in one pass


def _summary_rows(content: list[bytes | None]) -> list[tuple]:
    rows = []
    for on in rasters.masks(content):
        if isinstance(on, np.ndarray):
            covered, total = int(on.sum()), on.size
            rows.append((on.shape[1], on.shape[0], covered, total, covered / total if total else 0.0, None))
        else:
            rows.append((None, None, None, None, None, None if on is None else f"{type(on).__name__}: {on}"))
    return rows


def _summaries(content: pa.Array) -> pa.Array:
    columns = list(zip(*_summary_rows(content.to_pylist()))) or [()] * 6
    kinds = {"width": pa.int32(), "height": pa.int32(), "coverage_pixel_count": pa.int64(), "total_pixel_count": pa.int64(), "coverage_ratio": pa.float64(), "error": pa.string()}
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))


_summaries.__annotations__ = {"content": pa.Array, "return": pa.Array}


def _summarize_png(content: pd.Series) -> pd.DataFrame:
    rows = _summary_rows([None if data is None else bytes(data) for data in content])
    out = pd.DataFrame(rows, columns=["width", "height", "coverage_pixel_count", "total_pixel_count", "coverage_ratio", "error"])
    return out.astype({c: "Int64" for c in out.columns[:4]} | {"coverage_ratio": "float64"})


MASK = "width int, height int, rgba binary, error string"


def recolour_mask(content: Column, colour: Column) -> Column:
    """The raster as an overlay: pixels that are not fully transparent in the colour (a struct of r, g, b, a), the rest clear; of null, nulls."""
    return F.pandas_udf(_recolour_mask, MASK)(content, colour)


def _recolour_mask(content: pd.Series, colour: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for on, own in zip(rasters.masks([None if data is None else bytes(data) for data in content]), colour[["r", "g", "b", "a"]].to_numpy()):
        if isinstance(on, np.ndarray):
            rows.append((on.shape[1], on.shape[0], (on[..., None] * own.astype(np.uint8)).tobytes(), None))
        else:
            rows.append((None, None, None, None if on is None else f"{type(on).__name__}: {on}"))
    return pd.DataFrame(rows, columns=["width", "height", "rgba", "error"]).astype({"width": "Int64", "height": "Int64"})


# gzip


def is_gzip(content: Column) -> Column:
    return F.substring(content, 1, 2) == F.unhex(F.lit("1f8b"))


def _inflated(data: bytes | None) -> bytes | None:
    try:
        return gzip.decompress(bytes(data)) if data is not None and bytes(data[:2]) == b"\x1f\x8b" else data
    except (OSError, EOFError, zlib.error):
        return None


def _inflate(content: pd.Series) -> pd.Series:
    return content.map(_inflated)


def _inflate_zipped(content: pa.Array) -> pa.Array:
    return pa.array([_inflated(data) for data in content.to_pylist()], pa.binary())


_inflate_zipped.__annotations__ = {"content": pa.Array, "return": pa.Array}


def gunzip(content: Column) -> Column:
    """Inflated where it starts like gzip (null if broken), else unchanged."""
    zipped = is_gzip(content)  # what is not is not handed to Python
    return F.when(zipped, F.arrow_udf(_inflate_zipped, "binary").asNondeterministic()(F.when(zipped, content))).otherwise(content)  # of one kind with the decoders


# vector tiles


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and raw value of each field of a message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size = 8 if key & 7 == 1 else 4 if key & 7 == 5 else None
            if size is None:
                if key & 7 != 2:
                    raise ValueError(f"wire type {key & 7}")
                size, at = _varint(data, at)
            if at + size > len(data):
                raise ValueError("truncated")
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def _packed(value: int | bytes) -> list[int]:
    if isinstance(value, int):
        return [value]
    out, at = [], 0
    while at < len(value):
        v, at = _varint(value, at)
        out.append(v)
    return out


def _property(data: bytes):
    """The first that is set of bool, double, float, int, sint, string and uint."""
    found = dict(_fields(data))
    reads = {
        7: bool,
        3: lambda v: struct.unpack("<d", v)[0],
        2: lambda v: struct.unpack("<f", v)[0],
        4: lambda v: v - (1 << 64) if v >> 63 else v,
        6: lambda v: (v >> 1) ^ -(v & 1),
        1: lambda v: v.decode(),
        5: int,
    }
    return next((read(found[n]) for n, read in reads.items() if n in found), None)


def read_geometry(commands: list[int], kind: int) -> tuple[str, list[list[tuple[int, int]]]]:
    """Type and parts of a command stream; rings are closed, points share one part."""
    parts: list[list[tuple[int, int]]] = []
    x = y = at = 0
    while at < len(commands):
        command, count = commands[at] & 7, commands[at] >> 3
        at += 1
        if command in (1, 2):
            for _ in range(count):
                x += (commands[at] >> 1) ^ -(commands[at] & 1)
                y += (commands[at + 1] >> 1) ^ -(commands[at + 1] & 1)
                at += 2
                if not parts or command == 1 and kind != 1:
                    parts.append([])
                parts[-1].append((x, y))
        elif command == 7:
            if parts and parts[-1] and parts[-1][0] != parts[-1][-1]:
                parts[-1].append(parts[-1][0])
        else:
            raise ValueError(f"geometry command {command}")
    if kind == 1:
        points = parts[0] if parts else []
        return ("Point" if len(points) == 1 else "MultiPoint"), [points]
    if kind == 2:
        return ("LineString" if len(parts) == 1 else "MultiLineString"), parts
    return ("Polygon" if kind == 3 else "Unknown"), parts


def decode_mvt(data: bytes) -> list[dict]:
    """Layers with extent, version and features; of layers with one name the last counts."""
    layers: dict[str, dict] = {}
    for number, value in _fields(data):
        if number != 3:
            continue
        layer, keys, values, features = {"name": "", "extent": 4096, "version": 1}, [], [], []
        for n, v in _fields(value):
            if n in (1, 3):
                (layer.__setitem__("name", v.decode()) if n == 1 else keys.append(v.decode()))
            elif n == 2:
                features.append(v)
            elif n == 4:
                values.append(_property(v))
            elif n in (5, 15):
                layer["extent" if n == 5 else "version"] = v
        layer["features"] = []
        for raw in features:
            mvt_id, kind, tags, commands = 0, 0, [], []
            for n, v in _fields(raw):
                if n == 1:
                    mvt_id = v
                elif n == 2:
                    tags += _packed(v)
                elif n == 3:
                    kind = v
                elif n == 4:
                    commands += _packed(v)
            geometry, parts = read_geometry(commands, kind)
            own = {keys[k]: values[v] for k, v in zip(tags[::2], tags[1::2])}
            layer["features"].append({"mvt_id": mvt_id, "geometry_type": geometry, "parts": parts, "properties_json": json.dumps(own, sort_keys=True)})
        layers[layer["name"]] = layer
    return list(layers.values())


MVT = (
    "layers array<struct<name: string, extent: int, version: int, features: array<struct<mvt_id: string, geometry_type: string, properties_json: string, "
    "parts: array<array<struct<x: double, y: double>>>>>>>, error string"
)


def decode_mvt_tiles(content: Column, inflate: bool = False) -> Column:
    """Layers of vector tiles, or the error; of null, neither. Tiles of a batch are read together (:mod:`tilewright.operators.vector_tiles`).

    With ``inflate``, content that starts like gzip is inflated first, in the same pass: ``plain`` has it then (null if broken), else it is null.
    """
    return F.arrow_udf(*((_decode_zipped_mvt_tiles, f"{MVT}, plain binary") if inflate else (_decode_mvt_tiles, MVT))).asNondeterministic()(content)


def _decode_mvt_tiles(content: pa.Array) -> pa.Array:
    return vector_tiles.read_tiles(content)


_decode_mvt_tiles.__annotations__ = {"content": pa.Array, "return": pa.Array}


def _decode_zipped_mvt_tiles(content: pa.Array) -> pa.Array:
    tiles = content.to_pylist()
    plain = [_inflated(data) for data in tiles]
    read = vector_tiles.read_tiles(pa.array(plain, pa.binary()))
    inflated = pa.array([None if own is data else own for own, data in zip(plain, tiles)], pa.binary())
    return pa.StructArray.from_arrays([*read.flatten(), inflated], [*vector_tiles.RESULT.names, "plain"])


_decode_zipped_mvt_tiles.__annotations__ = {"content": pa.Array, "return": pa.Array}


def decode_rows(tiles: list[bytes]) -> list[dict]:
    """``layers`` or ``error`` of each tile, read one after the other."""
    rows = []
    for data in tiles:
        try:
            layers = decode_mvt(data)
            for layer in layers:
                for f in layer["features"]:
                    f["mvt_id"], f["parts"] = str(f["mvt_id"]), [[{"x": float(x), "y": float(y)} for x, y in p] for p in f["parts"]]
            rows.append({"layers": layers, "error": None})
        except Exception as e:
            rows.append({"layers": None, "error": f"{type(e).__name__}: {e}"})
    return rows


GEOMETRY = "geometry_type string, parts array<array<struct<x: double, y: double>>>, error string"


def decode_geometry(commands: Column, kind: Column) -> Column:
    """Type and parts of command streams (arrays of numbers) of a kind: 1 points, 2 lines, 3 polygons."""
    return F.arrow_udf(_decode_geometry, GEOMETRY).asNondeterministic()(commands.cast("array<long>"), kind.cast("long"))


def _decode_geometry(commands: pa.Array, kind: pa.Array) -> pa.Array:
    return vector_tiles.read_streams(commands, kind)


_decode_geometry.__annotations__ = {"commands": pa.Array, "kind": pa.Array, "return": pa.Array}


def geometry_rows(commands: list, kinds: list) -> list[dict]:
    """``geometry_type, parts`` or ``error`` of each stream, read one after the other."""
    rows = []
    for own, k in zip(commands, kinds):
        try:
            name, parts = read_geometry([int(c) for c in own], int(k))
            rows.append({"geometry_type": name, "parts": [[{"x": float(x), "y": float(y)} for x, y in p] for p in parts], "error": None})
        except Exception as e:
            rows.append({"geometry_type": None, "parts": None, "error": f"{type(e).__name__}: {e}"})
    return rows


def project_parts(parts: Column, x: Column, y: Column, zoom: Column, extent: Column) -> Column:
    """Parts in tile units to parts in longitude and latitude."""

    def point(p: Column) -> Column:
        lon, lat = grid.tile_point_to_lonlat(x, y, zoom, extent, p["x"], p["y"])
        return F.struct(lon.alias("x"), lat.alias("y"))

    return F.transform(parts, lambda part: F.transform(part, point))


def write_wkt(geometry_type: Column, parts: Column) -> Column:
    """WKT with eight exact decimals; an unknown type is empty. Built-in formatting rounds halves differently."""
    return F.arrow_udf(_write_wkt, "string")(geometry_type, parts.cast("array<array<struct<x: double, y: double>>>"))


def _write_wkt(geometry_type: pa.Array, parts: pa.Array) -> pa.Array:
    """All coordinates of a batch are written by a few calls of one pattern, and joined by rings and rows."""
    rings = parts.flatten()
    points = rings.flatten()
    numbers = np.column_stack([points.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)]).ravel()
    pairs: list[str] = []
    for at in range(0, len(numbers), 8192):
        some = numbers[at : at + 8192].tolist()
        pairs += ("%.8f %.8f\n" * (len(some) // 2) % tuple(some)).split("\n")[:-1]
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(rings.value_lengths(), 0).to_numpy(zero_copy_only=False))]).tolist()
    written = ["(" + ", ".join(pairs[a:b]) + ")" for a, b in zip(ends, ends[1:])]
    rows = np.concatenate([[0], np.cumsum(pc.fill_null(parts.value_lengths(), 0).to_numpy(zero_copy_only=False))]).tolist()

    def one(kind: str | None, own: list[str]) -> str:
        if kind in ("Point", "MultiPoint", "LineString"):
            return f"{kind.upper()} {own[0] if own else '()'}"
        if kind in ("MultiLineString", "Polygon"):
            return f"{kind.upper()} ({', '.join(own)})"
        return ""

    return pa.array([one(kind, written[a:b]) for kind, a, b in zip(geometry_type.to_pylist(), rows, rows[1:])], pa.string())


_write_wkt.__annotations__ = {"geometry_type": pa.Array, "parts": pa.Array, "return": pa.Array}


def parse_wkt(wkt: Column) -> Column:
    """``array<array<struct<x, y>>>`` of any of the six types; EMPTY and unknown texts have no parts."""
    groups = F.regexp_extract_all(wkt, F.lit(r"\(([^()]*)\)"), F.lit(1))
    point = lambda t: F.struct(F.try_element_at(t, F.lit(1)).cast("double").alias("x"), F.try_element_at(t, F.lit(2)).cast("double").alias("y"))
    coordinates = lambda g: F.transform(F.split(F.trim(g), r"\s*,\s*"), lambda c: point(F.split(F.trim(c), r"\s+")))
    known = F.regexp_like(wkt, F.lit(r"(?i)^\s*(MULTI)?(POINT|LINESTRING|POLYGON)\s*\("))
    return F.when(known, F.transform(F.filter(groups, lambda g: F.trim(g) != ""), coordinates)).otherwise(F.array().cast("array<array<struct<x:double,y:double>>>"))


def feature_rows(tiles: DataFrame, keep: list[str], layer_names: str | None = None) -> DataFrame:
    """A row per layer and feature of ``tiles`` (``layers, x, y, source_zoom``). ``layer_names`` (a column) restricts layers where the decoder column says ``ogr2ogr``."""
    flat = tiles.select(*keep, F.explode("layers").alias("layer"))
    if layer_names:
        flat = flat.where((F.coalesce("decoder", F.lit("")) != "ogr2ogr") | F.array_contains(layer_names, F.col("layer.name")))
    flat = flat.select(*keep, F.col("layer.name").alias("layer_name"), F.col("layer.extent").alias("extent"), F.posexplode("layer.features").alias("feature_index", "feature"))
    parts = project_parts(F.col("feature.parts"), F.col("x"), F.col("y"), F.col("source_zoom"), F.col("extent"))
    return flat.select(*keep, "layer_name", "feature_index", "feature.mvt_id", "feature.geometry_type", "feature.properties_json", write_wkt(F.col("feature.geometry_type"), parts).alias("geometry_wkt"))


def layer_listing(tiles: DataFrame) -> DataFrame:
    """Names and geometry types of the layers that occur."""
    flat = tiles.select(F.explode("layers").alias("layer")).select(F.col("layer.name").alias("layer_name"), F.explode_outer("layer.features.geometry_type").alias("geometry_type"))
    return flat.distinct()


def layer_counts(layers: Column) -> Column:
    """Features by layer, layers without any included."""
    return F.map_from_entries(F.transform(layers, lambda x: F.struct(x["name"], F.size(x["features"]).cast("long"))))


COVERAGE_JSON = "struct<lastModified: string, panos: array<struct<panoid: string, lat: double, lon: double, timestamp: string, buildId: string, coverageType: string>>>"


def read_coverage_json(content: Column) -> Column:
    return F.from_json(F.decode(gunzip(content), "UTF-8"), COVERAGE_JSON)


def pano_count(data: bytes) -> int | None:
    """Panoramas of a plain JSON tile; null if it isn't JSON."""
    try:
        return len(json.loads(bytes(data)).get("panos") or [])
    except (ValueError, AttributeError, TypeError):
        return None


def pano_rows(tiles: DataFrame, keep: list[str], document: str = "document") -> DataFrame:
    """A row per panorama; ``lastModified`` is the tile's."""
    return tiles.select(*keep, F.explode(f"{document}.panos").alias("pano"), F.col(f"{document}.lastModified").alias("lastModified")).select(*keep, "pano.*", "lastModified")
