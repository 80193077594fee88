"""Vector tiles of a whole batch at once, by array operations.

Only layers and the places of their features are walked through one by one. What features hold is read for all
features of the batch together: their fields in lockstep (a step for each field that a feature can have), the numbers of all tags and
geometries from one array of bytes, and command streams as running sums over all points that start anew with each feature. The
result is built as Arrow arrays from offsets.

Whatever is not as usual (a broken message, an odd wire type, numbers beyond 40 bits) sends its tile to
:func:`tilewright.operators.decode.decode_mvt`, which reads one field after the other; results and errors are the same for all tiles.
"""

from __future__ import annotations

import json
import math
import struct
from json.encoder import encode_basestring_ascii

import numpy as np
import pyarrow as pa

POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
FEATURE = pa.struct([("mvt_id", pa.string()), ("geometry_type", pa.string()), ("properties_json", pa.string()), ("parts", pa.list_(pa.list_(POINT)))])
LAYER = pa.struct([("name", pa.string()), ("extent", pa.int32()), ("version", pa.int32()), ("features", pa.list_(FEATURE))])
RESULT = pa.struct([("layers", pa.list_(LAYER)), ("error", pa.string())])
#: Bytes of tiles that are read together; memory is some ten times as much.
TOGETHER = 1 << 20
_TYPES = np.array(["Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "Unknown"])


class Unusual(Exception):
    """A tile for the other reader."""


def _number(data: bytes, at: int, end: int, most: int = 56) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= end or shift > most:
            raise Unusual
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _span(data: bytes, at: int, end: int) -> tuple[int, int]:
    """Start and end of what follows a length."""
    size = data[at] if at < end else 128
    if size < 128:
        at += 1
    else:
        size, at = _number(data, at, end)
    if at + size > end:
        raise Unusual
    return at, at + size


#: Value messages of one number, by the byte they begin with: int, uint, sint and bool; float and double.
_WHOLE = {0x20: lambda v: str(v - (1 << 64) if v >> 63 else v), 0x28: str, 0x30: lambda v: str((v >> 1) ^ -(v & 1)), 0x38: lambda v: "true" if v else "false"}
_REAL = {0x15: struct.Struct("<f"), 0x19: struct.Struct("<d")}


def _value_json(data: bytes, start: int, end: int) -> str:
    """The JSON of a value message; the usual ones, of one field, without a look at the rest."""
    if end - start > 1:
        key, at = data[start], start + 1
        if key == 0x0A:
            if data[at] < 128 and at + 1 + data[at] == end:
                return encode_basestring_ascii(data[at + 1 : end].decode())
        elif key in _WHOLE:
            number, at = _number(data, at, end, 63)
            if at == end:
                return _WHOLE[key](number)
        elif key in _REAL and end - at == _REAL[key].size:
            number = _REAL[key].unpack_from(data, at)[0]
            if math.isfinite(number):
                return repr(number)
    from tilewright.operators.decode import _property

    return json.dumps(_property(data[start:end]))


class _Layer:
    """A layer as read; ``spans`` has the start and the end of each feature, one after the other."""

    __slots__ = ("name", "extent", "version", "keys", "values", "spans")

    def __init__(self):
        self.name, self.extent, self.version, self.keys, self.values, self.spans = "", 4096, 1, [], [], []


def _read_layer(data: bytes, at: int, end: int) -> _Layer:
    layer = _Layer()
    spans, keys, values = layer.spans, layer.keys, layer.values
    while at < end:
        key, start = data[at], at + 1
        if key > 127:
            key, start = _number(data, at, end)
        kind = key & 7
        if kind == 2:
            size = data[start]
            if size < 128:
                start += 1
                at = start + size
                if at > end:
                    raise Unusual
            else:
                start, at = _span(data, start, end)
            if key == 0x12:
                spans += (start, at)
            elif key == 0x1A:
                keys.append(data[start:at].decode())
            elif key == 0x22:
                values.append(_value_json(data, start, at))
            elif key == 0x0A:
                layer.name = data[start:at].decode()
        elif kind == 0:
            value, at = _number(data, start, end)
            if key == 0x28:
                layer.extent = value
            elif key == 0x78:
                layer.version = value
        else:
            raise Unusual
    if max(layer.extent, layer.version) >= 1 << 31:
        raise Unusual
    return layer


def _read_tile(data: bytes) -> list[_Layer]:
    """Layers of a tile. Names that come twice are unusual."""
    layers, at, end = {}, 0, len(data)
    while at < end:
        key, at = _number(data, at, end)
        if key & 7 == 2:
            start, at = _span(data, at, end)
            if key == 0x1A:
                layer = _read_layer(data, start, at)
                if layer.name in layers:
                    raise Unusual
                layers[layer.name] = layer
        elif key & 7 == 0:
            _, at = _number(data, at, end)
        else:
            raise Unusual
    return list(layers.values())


def _numbers_at(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The variable-length numbers that start at each place, and their lengths (11: longer than any)."""
    byte = data[at]
    value, length = (byte & 127).astype(np.uint64), np.ones(len(at), np.int64)
    more = np.flatnonzero(byte > 127)
    for i in range(1, 11):
        if not len(more):
            break
        length[more] += 1
        if i == 10:
            break
        byte = data[at[more] + i]
        value[more] |= (byte & 127).astype(np.uint64) << np.uint64(7 * i)
        more = more[byte > 127]
    return value, length


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of runs of these sizes, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _packed(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All numbers of runs of bytes, how many each run has, and which runs are unusual (they end in the midst of a number, or hold one of over 8 bytes)."""
    raw = data[_spread(starts, sizes)]
    last = raw < 128
    ends = np.flatnonzero(last)
    first = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    lengths = ends + 1 - first
    value = np.zeros(len(ends), np.uint64)
    for i in range(min(8, int(lengths.max(initial=0)))):
        own = np.flatnonzero(lengths > i) if i else slice(None)
        value[own] |= (raw[first[own] + i] & 127).astype(np.uint64) << np.uint64(7 * i)
    upto = np.concatenate([[0], np.cumsum(last)])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    counts = upto[bounds[1:]] - upto[bounds[:-1]]
    odd = (sizes > 0) & ~np.concatenate([last, [True]])[np.maximum(bounds[1:] - 1, 0)]
    if lengths.max(initial=0) > 8:
        odd[np.searchsorted(bounds, first[lengths > 8], "right") - 1] = True
    return value, counts, odd


class _Features:
    """Fields of features, read in lockstep: ``ids, kinds``, runs of bytes of ``tags`` and ``commands``, and which are unusual."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        n = len(starts)
        self.ids, self.kinds, self.odd = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, bool)
        runs: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {2: [], 4: []}
        live, at = np.flatnonzero(starts < ends), starts.copy()
        while len(live):
            key, size = _numbers_at(data, at[live])
            place = at[live] + size
            wire, field = key & 7, key >> 3
            value, size = _numbers_at(data, place)
            inner = place + size  # where a sized field begins, and where a number ends
            sized = wire == 2
            bad = ~(sized | (wire == 0)) | (inner > ends[live]) | (sized & (value > np.uint64(1 << 40)))
            after = inner + np.where(sized & ~bad, value, 0).astype(np.int64)
            bad |= (after > ends[live]) | (sized & ((field == 1) | (field == 3)))
            self.odd[live[bad]] = True
            good = ~bad
            for number, into in ((1, self.ids), (3, self.kinds)):
                own = good & (field == number)
                into[live[own]] = value[own]
            for number, found in runs.items():
                own = good & (field == number)
                if own.any():
                    found.append((live[own], np.where(sized, inner, place)[own], np.where(sized, after - inner, size)[own]))
            at[live] = after
            live = live[good & (after < ends[live])]
        self.tags, self.commands = (self._numbers(data, n, runs[k]) for k in (2, 4))

    def _numbers(self, data: np.ndarray, n: int, runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all features, one after the other, and how many each has."""
        if not runs:
            return np.empty(0, np.uint64), np.zeros(n, np.int64)
        feature, start, size = (np.concatenate([r[i] for r in runs]) for i in range(3))
        order = np.argsort(feature, kind="stable")  # a field that comes again goes on where it was left
        feature, start, size = feature[order], start[order], size[order]
        values, counts, odd = _packed(data, start, size)
        self.odd[feature[odd]] = True
        return values, np.bincount(feature, counts, n).astype(np.int64)


def read_commands(values: np.ndarray, counts: np.ndarray, kinds: np.ndarray) -> tuple[pa.Array, pa.ListArray, np.ndarray]:
    """Types, parts and which are unusual, of command streams that follow each other in ``values``, ``counts`` numbers each."""
    n = len(counts)
    ends = np.cumsum(counts)
    starts, odd = ends - counts, np.zeros(n, bool)
    if len(values) and values.max() >= 1 << 40:
        odd[np.searchsorted(ends, np.flatnonzero(values >= 1 << 40), "right")] = True
    live, at, found = np.flatnonzero((counts > 0) & ~odd), starts.copy(), []
    while len(live):
        number = values[at[live]].astype(np.int64)
        command, repeat = number & 7, number >> 3
        moves = (command == 1) | (command == 2)
        after = at[live] + 1 + np.where(moves, 2 * repeat, 0)
        bad = ~(moves | (command == 7)) | (after > ends[live])
        odd[live[bad]] = True
        good = ~bad
        found.append((live[good], command[good], np.where(moves, repeat, 1)[good], at[live][good] + 1))
        at[live] = after
        live = live[good & (after < ends[live])]
    feature, command, repeat, place = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(4))
    order = np.argsort(feature, kind="stable")
    feature, command, repeat, place = feature[order], command[order], repeat[order], place[order]
    owner, what = np.repeat(feature, repeat), np.repeat(command, repeat)  # of each point that a command may add
    closing = what == 7
    fresh = ~closing & (np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else closing)
    # What comes first of a feature may be a closing: then the first point after it begins the first part.
    real = np.flatnonzero(~closing)
    first_real = np.ones(len(real), bool)
    first_real[1:] = owner[real][1:] != owner[real][:-1]
    fresh[real] = first_real | ((what[real] == 1) & (kinds[owner[real]] != 1))
    moves = command != 7
    coded = values[_spread(place[moves], 2 * repeat[moves])].view(np.int64)
    coded = (coded >> 1) ^ -(coded & 1)
    first_point = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else owner
    per_feature = np.diff(np.append(first_point, len(owner)))

    def places_of(steps: np.ndarray) -> np.ndarray:
        if len(steps) < len(owner):
            whole = np.zeros(len(owner), np.int64)
            whole[~closing] = steps
            steps = whole
        total = np.cumsum(steps)
        return total - np.repeat(total[first_point] - steps[first_point], per_feature)

    x, y = places_of(coded[::2]), places_of(coded[1::2])
    part = np.cumsum(fresh) - 1
    opened = np.flatnonzero(fresh)
    if closing.any():
        c = np.flatnonzero(closing)
        has = (c > 0) & (part[c] >= 0)
        has[has] &= (owner[opened[part[c[has]]]] == owner[c[has]]) & ~closing[c[has] - 1]
        head = opened[part[c[has]]]
        differs = (x[head] != x[c[has] - 1]) | (y[head] != y[c[has] - 1])
        keep = ~closing
        x[c[has]], y[c[has]] = x[head], y[head]
        keep[c[has][differs]] = True
        x, y, owner, part, fresh = x[keep], y[keep], owner[keep], part[keep], fresh[keep]
    n_parts = np.bincount(owner[fresh], minlength=n)
    sizes = np.bincount(part, minlength=int(fresh.sum())) if len(part) else np.empty(0, np.int64)
    bare = (kinds == 1) & (n_parts == 0)  # points without any have one part without any
    if bare.any():
        sizes = np.insert(sizes, (np.cumsum(n_parts) - n_parts)[bare], 0)
        n_parts = n_parts + bare
    size_first = np.zeros(n, np.int64)
    own = np.flatnonzero(n_parts)
    size_first[own] = sizes[(np.cumsum(n_parts) - n_parts)[own]]
    types = np.where(kinds == 1, np.where(size_first == 1, 0, 1), np.where(kinds == 2, np.where(n_parts == 1, 2, 3), np.where(kinds == 3, 4, 5)))
    xy = pa.StructArray.from_arrays([pa.array(v.astype(np.float64)) for v in (x, y)], fields=list(POINT))
    rings = pa.ListArray.from_arrays(_offsets(sizes), xy)
    return pa.array(_TYPES).take(pa.array(types)), pa.ListArray.from_arrays(_offsets(n_parts), rings), odd


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())


def _properties(layers: list[_Layer], of_feature: np.ndarray, values: np.ndarray, counts: np.ndarray, odd: np.ndarray) -> list[str]:
    """Each feature's properties as JSON with sorted keys; the last of equal keys wins, a tag without a value is none."""
    pairs = counts // 2
    starts = np.cumsum(counts) - counts
    key_at = _spread(starts, 2 * pairs)[::2]
    owner = np.repeat(np.arange(len(counts)), pairs)
    key, value = values[key_at].astype(np.int64), values[key_at + 1].astype(np.int64)
    n_keys, n_values = (np.array([len(getattr(layer, c)) for layer in layers] or [0], np.int64) for c in ("keys", "values"))
    home = of_feature[owner]
    bad = (key >= n_keys[home]) | (value >= n_values[home])
    odd[owner[bad]] = True
    owner, key, value, home = owner[~bad], key[~bad], value[~bad], home[~bad]
    # Keys by their order among all of the batch, equal ones alike.
    keys, texts = [k for layer in layers for k in layer.keys], [v for layer in layers for v in layer.values]
    known = sorted(set(keys))
    order, names = {k: i for i, k in enumerate(known)}, [encode_basestring_ascii(k) + ": " for k in known]
    key, value = key + (np.cumsum(n_keys) - n_keys)[home], value + (np.cumsum(n_values) - n_values)[home]
    rank = np.array([order[k] for k in keys] or [0], np.int64)[key]
    order = np.lexsort((np.arange(len(key)), rank, owner))
    owner, value, rank = owner[order], value[order], rank[order]
    last = np.ones(len(owner), bool)
    last[:-1] = (owner[1:] != owner[:-1]) | (rank[1:] != rank[:-1])
    owner, value, rank = owner[last], value[last], rank[last]
    said = [names[k] + texts[v] for k, v in zip(rank.tolist(), value.tolist())]
    bounds = np.searchsorted(owner, np.arange(len(counts) + 1)).tolist()
    return ["{" + ", ".join(said[a:b]) + "}" for a, b in zip(bounds, bounds[1:])]


def _read_batch(tiles: list[bytes]) -> tuple[list[int], pa.Array]:
    """Numbers of the tiles that were usual, and their layers."""
    numbers, layers, per_tile, spans, bases, base = [], [], [], [], [], 0
    for i, data in enumerate(tiles):
        try:
            own = _read_tile(data)
        except (Unusual, IndexError, TypeError, ValueError, struct.error):
            base += len(data)
            continue
        for layer in own:
            spans += layer.spans
            bases.append(base)
            layers.append(layer)
        numbers.append(i)
        per_tile.append(len(own))
        base += len(data)
    data = np.frombuffer(b"".join(tiles) + bytes(32), np.uint8)
    per_layer = np.array([len(layer.spans) // 2 for layer in layers], np.int64)
    home = np.repeat(np.arange(len(layers)), per_layer)
    span = np.array(spans, np.int64).reshape(-1, 2) + np.array(bases, np.int64)[home, None]
    read = _Features(data, span[:, 0], span[:, 1])
    types, parts, odd = read_commands(*read.commands, read.kinds.astype(np.int64))
    odd |= read.odd
    said = _properties(layers, home, *read.tags, odd)
    features = pa.StructArray.from_arrays([pa.array(read.ids).cast(pa.string()), types, pa.array(said, pa.string()), parts], fields=list(FEATURE))
    by_layer = pa.ListArray.from_arrays(_offsets(per_layer), features)
    columns = [pa.array([getattr(layer, c) for layer in layers], t) for c, t in (("name", pa.string()), ("extent", pa.int32()), ("version", pa.int32()))]
    whole = pa.ListArray.from_arrays(_offsets(np.array(per_tile, np.int64)), pa.StructArray.from_arrays([*columns, by_layer], fields=list(LAYER)))
    tile_of_layer = np.repeat(np.arange(len(numbers)), per_tile)
    unusual = np.zeros(len(numbers), bool)
    unusual[tile_of_layer[home[odd]]] = True
    usual = np.flatnonzero(~unusual)
    return [numbers[i] for i in usual], whole.take(pa.array(usual, pa.int64())) if unusual.any() else whole


def read_tiles(content: pa.Array) -> pa.Array:
    """``struct<layers, error>`` of each vector tile; of null, neither."""
    from tilewright.operators.decode import decode_rows

    done: list[tuple[np.ndarray, pa.Array]] = []
    tiles: list[bytes] = []
    at: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal tiles, at, held
        numbers, layers = _read_batch(tiles) if tiles else ([], None)
        if numbers:
            done.append((np.array(at)[numbers], pa.StructArray.from_arrays([layers, pa.nulls(len(numbers), pa.string())], fields=list(RESULT))))
        rest = sorted(set(range(len(tiles))) - set(numbers))
        if rest:
            done.append((np.array(at)[rest], pa.array(decode_rows([tiles[i] for i in rest]), RESULT)))
        tiles, at, held = [], [], 0

    nulls = []
    for i, data in enumerate(content.to_pylist()):
        if data is None:
            nulls.append(i)
            continue
        tiles.append(data)
        at.append(i)
        held += len(data)
        if held > TOGETHER:
            flush()
    flush()
    if nulls:
        done.append((np.array(nulls), pa.StructArray.from_arrays([pa.nulls(len(nulls), RESULT.field(i).type) for i in range(2)], fields=list(RESULT))))
    if not done:
        return pa.array([], RESULT)
    return _in_order(done)


def _in_order(parts: list[tuple[np.ndarray, pa.Array]]) -> pa.Array:
    places = np.concatenate([p for p, _ in parts])
    whole = parts[0][1] if len(parts) == 1 else pa.concat_arrays([a for _, a in parts])
    return whole if (np.diff(places) > 0).all() else whole.take(pa.array(np.argsort(places), pa.int64()))


def read_streams(commands: pa.Array, kinds: pa.Array) -> pa.Array:
    """``struct<geometry_type, parts, error>`` of arrays of command numbers."""
    from tilewright.operators.decode import geometry_rows

    shape = pa.struct([("geometry_type", pa.string()), ("parts", pa.list_(pa.list_(POINT))), ("error", pa.string())])
    n = len(commands)
    flat = commands.flatten()
    usual = flat.null_count == 0 and commands.null_count == 0 and kinds.null_count == 0
    numbers = flat.to_numpy(zero_copy_only=False) if usual else np.empty(0)
    if usual and (not len(numbers) or numbers.min() >= 0):
        counts = commands.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        types, parts, odd = read_commands(numbers.astype(np.uint64), counts, kinds.to_numpy(zero_copy_only=False).astype(np.int64))
    else:
        odd = np.ones(n, bool)
    done, rest, good = [], np.flatnonzero(odd), np.flatnonzero(~odd)
    if len(good) or not n:
        fast = pa.StructArray.from_arrays([types, parts, pa.nulls(n, pa.string())], fields=list(shape))
        done.append((good, fast.take(pa.array(good, pa.int64())) if len(rest) else fast))
    if len(rest):
        done.append((rest, pa.array(geometry_rows([commands[i].as_py() for i in rest], [kinds[i].as_py() for i in rest]), shape)))
    return _in_order(done)
