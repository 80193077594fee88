"""Tile bodies made from integer keys, for the registered queries: what they hold follows from the key by arithmetic.

PNG: ``1 + k % 9`` by ``1 + k % 7`` pixels in one of four colour types, each row with one of the five filters; pixel i is
covered where ``(7 * i + k) % 3 != 0``. Vector tiles: a layer ``a`` of ``k % 4`` points and a layer ``b`` of one line. JSON: ``k % 3`` panoramas.
"""

from __future__ import annotations

import gzip
import json
import struct
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def png_body(k: int) -> bytes:
    """Bodies recur with all that they are made from: after the common multiple of 9, 7, 5, 4, 3 and 256."""
    return _png_body(k % 80_640)


@lru_cache(maxsize=80_640)
def _png_body(k: int) -> bytes:
    colour, extra = ((6, b""), (4, b""), (3, b"\0\xff"), (2, struct.pack(">3H", 9, 9, 9)))[k % 4]
    pixel = {6: lambda c: (k % 256, 2, 3, 200 * c), 4: lambda c: (k % 256, 255 * c), 3: lambda c: (c,), 2: lambda c: (k % 8, 1, 2) if c else (9, 9, 9)}[colour]
    return _png(k, colour, 8, 0, extra, pixel)


#: Colour type and bits of the other forms, and how covered and clear pixels look in them.
_FORMS = [
    (3, 1, b"\0\xff", lambda k, c: (c,)),
    (3, 2, b"\xff\0\1", lambda k, c: (2 * (k % 2) if c else 1,)),
    (3, 4, b"\x07" * 5 + b"\0", lambda k, c: (k % 5 if c else 5,)),
    (0, 16, struct.pack(">H", 300), lambda k, c: (k % 300 if c else 300,)),
    (2, 16, struct.pack(">3H", 1, 2, 700), lambda k, c: (1, 2, 699 if c else 700)),
    (4, 16, b"", lambda k, c: (k % 65536, c)),
    (6, 16, b"", lambda k, c: (1, 2, k % 65536, 256 * c)),
]


def png_form_body(k: int) -> bytes:
    """As :func:`png_body`, in a form by ``k % 7``: palettes of 1, 2 and 4 bits and all others of 16; interlaced where ``k % 2`` is 1."""
    colour, bits, extra, pixel = _FORMS[k % 7]
    return _png(k, colour, bits, k % 2, extra, lambda c: pixel(k, c))


def _png(k: int, colour: int, bits: int, interlaced: int, extra: bytes, pixel) -> bytes:
    width, height, out, step = 1 + k % 9, 1 + k % 7, b"", max(1, bits * len(pixel(True)) // 8)
    passes = [(0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2)] if interlaced else [(0, 0, 1, 1)]
    for x0, y0, dx, dy in passes:
        before = None
        for n, y in enumerate(range(y0, height, dy) if x0 < width else ()):
            values = [v for x in range(x0, width, dx) for v in pixel((7 * (y * width + x) + k) % 3 != 0)]
            line = b"".join(v.to_bytes(2, "big") for v in values) if bits == 16 else bytes(values) if bits == 8 else _bits(values, bits)
            above, kind = bytes(len(line)) if before is None else before, (n + k) % 5
            left, corner = (bytes(step) + line)[: len(line)], (bytes(step) + above)[: len(line)]
            out += bytes([kind]) + bytes((v - _guess(kind, a, b, c)) % 256 for v, a, b, c in zip(line, left, above, corner))
            before = line
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, bits, colour, 0, 0, interlaced)) + (chunk(b"tRNS", extra) if extra else b"")
    return b"\x89PNG\r\n\x1a\n" + head + chunk(b"IDAT", zlib.compress(out)) + chunk(b"IEND", b"")


def _bits(values: list[int], bits: int) -> bytes:
    digits = "".join(f"{v:0{bits}b}" for v in values)
    digits += "0" * (-len(digits) % 8)
    return int(digits, 2).to_bytes(len(digits) // 8, "big")


def _guess(kind: int, a: int, b: int, c: int) -> int:
    if kind < 4:
        return (0, a, b, (a + b) // 2)[kind]
    p = a + b - c
    return min((a, b, c), key=lambda v: abs(p - v))  # the first of equals


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, value: int | bytes) -> bytes:
    return _varint(number << 3) + _varint(value) if isinstance(value, int) else _varint(number << 3 | 2) + _varint(len(value)) + value


_LINE = _field(3, 2) + _field(4, b"".join(_varint((v << 1) ^ (v >> 63)) if i not in (0, 3) else bytes([v]) for i, v in enumerate((9, 1024, 2048, 10, -512, 256))))
_NAMES, _TAIL = _field(3, b"k") + _field(3, b"odd"), _field(5, 4096) + _field(15, 2)


def vector_body(k: int) -> bytes:
    own, coded = _field(5, k), _varint(k % 4096 * 2)
    values = _NAMES + _field(4, own) + (b"\x22\x02\x38\x01" if k % 2 else b"\x22\x02\x38\x00") + _TAIL
    feature = lambda n, rest: b"\x08" + _varint(10 * k + n) + b"\x12\x04\0\0\1\1" + rest
    points = b""
    for n in range(k % 4):
        commands = b"\x09" + coded + _varint(1024 * n)
        points += _field(2, feature(n, b"\x18\x01\x22" + bytes([len(commands)]) + commands))
    return _field(3, b"\x0a\x01a" + points + values) + _field(3, b"\x0a\x01b" + _field(2, feature(0, _LINE)) + values)


def values_body(k: int) -> bytes:
    """A point with a property of each kind of value."""
    coded = {"s": _field(1, b"s%d" % k), "f": _varint(2 << 3 | 5) + struct.pack("<f", k / 4), "d": _varint(3 << 3 | 1) + struct.pack("<d", k / 8), "i": _field(4, (1 << 64) - 1 - k)}
    coded |= {"u": _field(5, k), "n": _field(6, 2 * k + 1), "b": _field(7, k % 2)}
    tags = b"".join(bytes([i, i]) for i in range(len(coded)))
    feature = _field(2, _field(1, k) + _field(2, tags) + _field(3, 1) + _field(4, b"\x09\x02\x04"))
    return _field(3, _field(1, b"v") + feature + b"".join(_field(3, n.encode()) for n in coded) + b"".join(_field(4, v) for v in coded.values()) + _field(15, 2))


def json_body(k: int) -> bytes:
    panos = [{"panoid": f"{k}-{n}", "lat": n + 0.5, "lon": k % 180 * 1.0, "timestamp": str(k), "buildId": "b", "coverageType": "c"} for n in range(k % 3)]
    return json.dumps({"lastModified": f"m{k}", "panos": panos}).encode()


def maker(body: str):
    """A vectorised function of keys, and whether to compress, to the bodies (``png``, ``png_form``, ``vector``, ``values``, ``json``)."""
    make = {"png": png_body, "png_form": png_form_body, "vector": vector_body, "values": values_body, "json": json_body}[body]

    def bodies(keys: pd.Series, zipped: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(k) else gzip.compress(make(int(k)), mtime=0) if z else make(int(k)) for k, z in zip(keys, zipped)], dtype=object)

    bodies.__annotations__ = {"keys": pd.Series, "zipped": pd.Series, "return": pd.Series}
    # Not deterministic as Spark sees it: else each of several uses of a body makes it anew.
    return F.pandas_udf(bodies, "binary").asNondeterministic()


def made(body: str, key: Column, zipped: Column | None = None) -> Column:
    """The body of each key, compressed where ``zipped``; null of a null key."""
    return maker(body)(key, F.lit(False) if zipped is None else zipped)


def compressed(content: Column) -> Column:
    def each(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else gzip.compress(bytes(v), mtime=0))

    each.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(each, "binary")(content)


def clear_png() -> bytes:
    """One pixel, fully transparent."""
    return _png(0, 4, 8, 0, b"", lambda c: (7, 0))
