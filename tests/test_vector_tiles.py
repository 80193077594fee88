"""The batch reader of vector tiles against the one that reads field by field."""

import random
import struct
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tilewright import samples
from tilewright.operators import decode, vector_tiles
from tilewright.samples import _field, _varint


def zigzag(v):
    return (v << 1) ^ (v >> 63)


def ring(rng, n, kind):
    """Commands of one part."""
    numbers = [zigzag(rng.randint(-3000, 3000)) for _ in range(2 * n)]
    if kind == 1:
        return [n << 3 | 1, *numbers]
    return [9, *numbers[:2], (n - 1) << 3 | 2, *numbers[2:], *([15] * (kind == 3))]


def value(rng):
    kind = rng.randint(1, 7)
    text = rng.choice(["a", "é", '"q"', "x" * 200, ""]).encode()
    if kind == 2:
        return _varint(2 << 3 | 5) + struct.pack("<f", rng.random())
    if kind == 3:
        return _varint(3 << 3 | 1) + struct.pack("<d", rng.random())
    return _field(kind, text if kind == 1 else rng.choice([0, 1, 5, 2**35, 2**63 - 1]) if kind != 7 else rng.randint(0, 1))


def feature(rng, n_keys, n_values):
    kind = rng.choice([1, 2, 3, 3, 0])
    commands = [c for _ in range(rng.randint(0, 3)) for c in ring(rng, rng.randint(1 + (kind != 1), 6), kind or 2)]
    tags = [t for _ in range(rng.randint(0, 4)) for t in (rng.randrange(n_keys), rng.randrange(n_values))] if n_keys and n_values else []
    fields = [_field(1, rng.choice([0, 7, 2**63, 2**64 - 1])), _field(3, kind)]
    fields += [_field(2, b"".join(map(_varint, tags)))] if tags and rng.random() < 0.8 else [_field(2, t) for t in tags]
    half = len(commands) // 2 if rng.random() < 0.2 else len(commands)  # a geometry may come in two fields
    fields += [_field(4, b"".join(map(_varint, c))) for c in (commands[:half], commands[half:]) if c]
    if rng.random() < 0.2:
        fields.append(_field(9, b"unknown"))
    return b"".join(fields)


def tile(seed, n_layers=3, n_features=6):
    rng, out = random.Random(seed), b""
    for i in range(rng.randint(0, n_layers)):
        keys, values = [rng.choice(["k", "kk", "é", "a b", "z"]) for _ in range(rng.randint(0, 5))], [value(rng) for _ in range(rng.randint(0, 6))]
        parts = [_field(2, feature(rng, len(keys), len(values))) for _ in range(rng.randint(0, n_features))] + [_field(3, k.encode()) for k in keys] + [_field(4, v) for v in values]
        parts += [_field(1, rng.choice(["roads", f"water {i}", f"land {i}", f"sea {i}"]).encode())] + ([_field(5, 8192)] if i else []) + [_field(15, 2)]
        rng.shuffle(parts)
        # Keys and values keep their order among themselves.
        order = iter([_field(3, k.encode()) for k in keys]), iter([_field(4, v) for v in values])
        parts = [next(order[0]) if p[0] == 0x1A else next(order[1]) if p[0] == 0x22 else p for p in parts]
        out += _field(3, b"".join(parts))
    return out


def same(tiles):
    got = vector_tiles.read_tiles(pa.array(tiles, pa.binary())).to_pylist()
    known = iter(pa.array(decode.decode_rows([t for t in tiles if t is not None]), vector_tiles.RESULT).to_pylist())
    expected = [{"layers": None, "error": None} if t is None else next(known) for t in tiles]
    assert got == expected
    return got


@pytest.mark.parametrize("together", [1, 2000, 8 << 20])
def test_tiles_of_all_kinds(together, monkeypatch):
    monkeypatch.setattr(vector_tiles, "TOGETHER", together)
    tiles = [tile(seed) for seed in range(250)] + [None, b"", tile(3, 1, 1), None]
    got = same(tiles)
    assert {f["geometry_type"] for r in got for layer in r["layers"] or [] for f in layer["features"]} == set(vector_tiles._TYPES)
    assert same([]) == [] and same([None]) == [{"layers": None, "error": None}]


def test_broken_tiles_are_errors_of_their_own():
    rng, tiles = random.Random(5), []
    for seed in range(300):
        data = bytearray(tile(seed, 4))
        if data:
            for _ in range(rng.randint(1, 3)):
                data[rng.randrange(len(data))] = rng.randrange(256)
            if seed % 3 == 0:
                del data[rng.randrange(len(data)) :]
        tiles += [bytes(data), tile(seed)]
    got = same(tiles)
    assert sum(r["error"] is not None for r in got) > 50 and all(r["error"] is None for r in got[1::2])


@settings(deadline=None, max_examples=150)
@given(st.lists(st.tuples(st.lists(st.integers(0, 40) | st.sampled_from([9, 15, 17, 18, 26, 7, 2**41]), max_size=12), st.integers(0, 4)), max_size=6))
def test_any_command_stream(streams):
    commands, kinds = [c for c, _ in streams], [k for _, k in streams]
    got = vector_tiles.read_streams(pa.array(commands, pa.list_(pa.int64())), pa.array(kinds, pa.int64())).to_pylist()
    assert got == decode.geometry_rows(commands, kinds)


def test_streams_with_nulls_and_negative_numbers():
    commands, kinds = [None, [9, 2, 2], [9, None, 2], [9, 2, 2], [-1]], [1, None, 1, 1, 2]
    got = vector_tiles.read_streams(pa.array(commands, pa.list_(pa.int64())), pa.array(kinds, pa.int64())).to_pylist()
    assert got == decode.geometry_rows(commands, kinds) and [r["error"] is None for r in got] == [False, False, False, True, True]


def large_tile(n=2000):
    rng = np.random.default_rng(1)
    keys = b"".join(_field(3, k) for k in (b"id", b"kind", b"name"))
    values = b"".join(_field(4, _field(1, b"name %d" % i)) for i in range(300))
    features = []
    for i in range(n):
        numbers = [9, *(rng.integers(0, 200, 2).tolist()), 18 << 3 | 2, *(rng.integers(0, 60, 36).tolist())]
        features.append(_field(2, _field(1, i) + _field(2, bytes([0, i % 100, 1, i % 7, 2, i % 120])) + _field(3, 2) + _field(4, b"".join(map(_varint, numbers)))))
    return _field(3, _field(1, b"roads") + b"".join(features) + keys + values + _field(15, 2))


def test_ten_megabytes_a_second():
    data = large_tile()
    tiles = pa.array([data] * 40, pa.binary())
    assert vector_tiles.read_tiles(tiles[:1]).to_pylist() == pa.array(decode.decode_rows([data]), vector_tiles.RESULT).to_pylist()
    took = []
    for _ in range(3):
        began = time.process_time()
        vector_tiles.read_tiles(tiles)
        took.append(time.process_time() - began)
    assert 40 * len(data) / min(took) > 5e6, (len(data), took)  # 10 MB/s on a machine of its own


def test_made_tiles():
    same([samples.vector_body(k) for k in range(40)])


def test_values_of_one_field_are_read_where_they_are(monkeypatch):
    """Each kind of value without the reader of whole messages, as that one gives it."""
    kinds = [_field(1, "é\"\n".encode()), b"\x15" + struct.pack("<f", 0.1), b"\x19" + struct.pack("<d", -0.0), b"\x19" + struct.pack("<d", 1e300), _field(4, 7), _field(4, (1 << 64) - 5), _field(5, 0), _field(5, 1 << 40), _field(6, 9), _field(7, 0), _field(7, 2)]
    tiles = [pair(v) for v in kinds]
    expected = decode.decode_rows(tiles)
    assert all(r["error"] is None for r in expected)

    def never(data):
        raise AssertionError(data)

    monkeypatch.setattr(decode, "_property", never)
    got = vector_tiles.read_tiles(pa.array(tiles, pa.binary())).to_pylist()
    assert got == pa.array(expected, vector_tiles.RESULT).to_pylist()


def pair(value):
    """A tile whose only feature has one property."""
    return _field(3, _field(1, b"l") + _field(2, _field(1, 1) + _field(2, b"\0\0") + _field(3, 1) + _field(4, b"\x09\x02\x04")) + _field(3, b"k") + _field(4, value))


def test_odd_values():
    """Not finite, none, several fields, of another wire type, cut off or too long."""
    real = lambda v: b"\x19" + struct.pack("<d", v)
    odd = [b"", real(float("nan")), real(float("-inf")), b"\x15" + struct.pack("<f", float("inf")), _field(5, 1) + _field(5, 2), _field(5, 1) + _field(1, b"s"), _field(1, b"x" * 200), b"\x0a\x05ab", b"\x0a", b"\x28", b"\x28\x80"]
    odd += [b"\x10\x01", b"\x15\0\0\0", b"\x19" + bytes(9), b"\x20" + b"\xff" * 9 + b"\x7f", b"\x20" + b"\xff" * 12 + b"\x01", b"\x28" + b"\xff" * 9 + b"\x01", b"\x38" + b"\x80" * 9 + b"\0", b"\x0a\x01\xff", b"\x2a\x01a", b"\x48\x01"]
    tiles = [pair(v) for v in odd]
    got = same([None, *tiles, b"", *tiles, None])  # each comes again
    assert {r["error"] is None for r in got} == {True, False}


def test_keys_of_layers_of_a_batch():
    """Layers with the same, other and repeated keys: properties are sorted by key, the last of equal keys wins."""
    layer = lambda name, keys, tags: _field(3, _field(1, name) + _field(2, _field(2, bytes(tags))) + b"".join(_field(3, k) for k in keys) + _field(4, _field(5, 1)) + _field(4, _field(5, 2)))
    first, second = layer(b"a", [b"z", b"a", b"z"], [0, 0, 1, 1, 2, 1]), layer(b"b", ["é".encode(), b"a"], [0, 0, 1, 0])
    got = same([first + second, second, first, layer(b"c", [], [])])
    assert [f["properties_json"] for r in got for x in r["layers"] for f in x["features"]] == ['{"a": 2, "z": 2}', '{"a": 1, "\\u00e9": 1}', '{"a": 1, "\\u00e9": 1}', '{"a": 2, "z": 2}', "{}"]


def test_tiles_are_decoded_once(spark):
    """The filter that an explosion of layers brings along is not pushed below the decoder."""
    from tilewright import run_queries

    plan = run_queries.mvt_decode(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [_decode_mvt_tiles(") == 1
