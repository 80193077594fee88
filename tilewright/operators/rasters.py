"""Coverage masks of many PNG tiles at once.

Tiles of a batch that have one format and about one size are stacked and their filters undone together. Of each pixel only the bytes that
say whether it is covered are touched, since a byte depends only on the same byte of its neighbours. Rows without
averages and Paeth predictions are undone one row after the other; else one diagonal after the other: all of a diagonal, in all tiles, depends only on the
two before it. The stack is held skewed, a diagonal beside the next, so that neighbours are slices.

A tile that is not as usual goes to :func:`tilewright.operators.decode.png_alpha`, which reads one tile; masks and errors are the same.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

#: Bytes of a stack that are undone together.
TOGETHER = 1 << 22
#: Pictures whose sides end in the same steps of so many pixels are stacked together, though their sizes differ.
_SIDE = 16
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
_WHOLE = [(0, 0, 1, 1)]
# The seven passes of an interlaced picture (first column and row, steps of both).
_PASSES = [(0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2)]


@dataclass
class Tile:
    """A picture's form, its filtered bytes, and what of its bytes says that a pixel is clear."""

    form: tuple[int, int, int, int, int]  # width, height, bits, colour type, interlaced
    raw: bytes
    clear: bytes | None


def read_head(data: bytes) -> Tile | None:
    """The tile, or None if it isn't usual."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    at, form, body, clear = 8, None, [], None
    while at + 8 <= len(data):
        size, name = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        at += 12 + size
        if name == b"IDAT":
            body.append(part)
        elif name == b"IHDR" and form is None and size == 13:
            form = struct.unpack(">IIBBBBB", part)
        elif name == b"tRNS" and clear is None:
            clear = part
        elif name in (b"IHDR", b"tRNS"):
            return None
    if form is None or form[3] not in _CHANNELS or form[2] not in (1, 2, 4, 8, 16) or not body:
        return None
    form = (*form[:4], form[6])
    if clear is not None and form[3] in (0, 2) and len(clear) != 2 * _CHANNELS[form[3]]:
        return None
    if clear is not None and form[3] == 3 and len(clear) > 1 << form[2]:
        return None
    try:
        raw = zlib.decompress(b"".join(body))
    except zlib.error:
        return None
    needed = sum(h * (1 + (w * form[2] * _CHANNELS[form[3]] + 7) // 8) for w, h in _sizes(form))
    return Tile(form, raw[:needed], clear) if len(raw) >= needed else None


def _sizes(form: tuple[int, int, int, int, int]) -> list[tuple[int, int]]:
    """Width and height of each pass that has pixels."""
    width, height = form[:2]
    each = [(-(-(width - x) // dx), -(-(height - y) // dy)) for x, y, dx, dy in (_PASSES if form[4] else _WHOLE)]
    return [(w, h) for w, h in each if w > 0 and h > 0]


def undo_filters(lines: np.ndarray, step: int, offsets: list[int]) -> np.ndarray:
    """(tiles, rows, pixels, offsets): the bytes at these offsets of every pixel of ``step`` bytes. ``lines``: (tiles, rows, 1 + bytes of a row), filters first."""
    kinds = lines[:, :, 0]
    pixels = lines[:, :, 1:].reshape(*lines.shape[:2], -1, step)[..., offsets]
    if kinds.max(initial=0) > 2:
        return _by_diagonals(kinds, pixels)
    out, above = np.empty_like(pixels), np.zeros_like(pixels[:, 0])
    for y in range(pixels.shape[1]):
        kind, line = kinds[:, y, None, None], pixels[:, y]
        if (kind == 1).any():
            line = np.where(kind == 1, np.cumsum(line, axis=1, dtype=np.uint8), line)
        above = np.where(kind == 2, line + above, line)
        out[:, y] = above
    return out


def _by_diagonals(kinds: np.ndarray, pixels: np.ndarray) -> np.ndarray:
    n, height, width, size = pixels.shape
    # Diagonal d holds, at place y + 1, the pixel of row y and column d - y; place 0 and two diagonals before the first are outside.
    skewed = np.zeros((width + height + 1, height + 1, n * size), np.int16)
    for y in range(height):
        skewed[y + 2 : y + 2 + width, y + 1] = pixels[:, y].transpose(1, 0, 2).reshape(width, -1)
    of = [np.repeat((kinds == k).T, size, axis=1) for k in range(5)]
    by_row = [[bool(of[k][y].any()) for y in range(height)] for k in (1, 2, 3, 4)]
    some = [np.concatenate([[0], np.cumsum(r)]) for r in by_row]
    for d in range(width + height - 1):
        low, high = max(0, d - width + 1), min(height, d + 1)
        left, up, corner = skewed[d + 1, low + 1 : high + 1], skewed[d + 1, low:high], skewed[d, low:high]
        guess = np.zeros_like(left)
        has = [s[high] > s[low] for s in some]
        if has[3]:
            by_left, by_up = np.abs(up - corner), np.abs(left - corner)
            by_corner = np.abs(left + up - 2 * corner)
            best = np.where((by_left <= by_up) & (by_left <= by_corner), left, np.where(by_up <= by_corner, up, corner))
            guess = np.where(of[4][low:high], best, guess)
        if has[2]:
            guess = np.where(of[3][low:high], (left + up) >> 1, guess)
        if has[1]:
            guess = np.where(of[2][low:high], up, guess)
        if has[0]:
            guess = np.where(of[1][low:high], left, guess)
        own = skewed[d + 2, low + 1 : high + 1]
        own += guess
        own &= 255
    out = np.empty(pixels.shape, np.uint8)
    for y in range(height):
        out[:, y] = skewed[y + 2 : y + 2 + width, y + 1].reshape(width, n, size).transpose(1, 0, 2)
    return out


def _stack(tiles: list[Tile]) -> Tile:
    """Pictures of whole bytes as one form: each is filled up with nothing to the right and below, where no pixel of its own looks."""
    bits, colour = tiles[0].form[2:4]
    pixel = bits * _CHANNELS[colour] // 8
    width, height = (max(t.form[i] for t in tiles) for i in (0, 1))
    lines = np.zeros((len(tiles), height, 1 + width * pixel), np.uint8)
    for line, t in zip(lines, tiles):
        w, h = t.form[:2]
        line[:h, : 1 + w * pixel] = np.frombuffer(t.raw, np.uint8).reshape(h, -1)
    return Tile((width, height, bits, colour, 0), lines.tobytes(), tiles[0].clear)


def _masks(tiles: list[Tile]) -> list[np.ndarray] | None:
    """(height, width) of each: which pixels are covered, of tiles with the same meaning of their bytes. None: a filter is unknown."""
    if any(t.form != tiles[0].form for t in tiles):
        whole = _masks_of_one_form(_stack(tiles), len(tiles))
        return None if whole is None else [mask[: t.form[1], : t.form[0]] for mask, t in zip(whole, tiles)]
    whole = _masks_of_one_form(Tile(tiles[0].form, b"".join(t.raw for t in tiles), tiles[0].clear), len(tiles))
    return None if whole is None else list(whole)


def _masks_of_one_form(together: Tile, n: int) -> np.ndarray | None:
    """(tiles, height, width) of ``n`` tiles of one form, whose bytes follow each other."""
    width, height, bits, colour, interlaced = together.form
    channels, clear = _CHANNELS[colour], together.clear
    step = max(1, bits * channels // 8)
    offsets = {4: [-1], 6: [-1]}.get(colour) if bits == 8 else {4: [-2, -1], 6: [-2, -1]}.get(colour) if bits == 16 else None
    whole = np.zeros((n, height, width), bool)
    raw, at = np.frombuffer(together.raw, np.uint8).reshape(n, -1), 0
    for x0, y0, dx, dy in _PASSES if interlaced else _WHOLE:
        w, h = -(-(width - x0) // dx), -(-(height - y0) // dy)
        if w <= 0 or h <= 0:
            continue
        row = 1 + (w * bits * channels + 7) // 8
        lines = raw[:, at : at + h * row].reshape(n, h, row)
        at += h * row
        if lines[:, :, 0].max() > 4:
            return None
        if offsets:
            mask = (undo_filters(lines, step, [step + o for o in offsets]) > 0).any(axis=3)
        elif clear is None:
            mask = True
        else:
            data = undo_filters(lines, step, list(range(step)))
            mask = _not_clear(data.reshape(n, h, -1), w, bits, channels, colour, clear)
        whole[:, y0::dy, x0::dx] = mask
    return whole


def _not_clear(data: np.ndarray, width: int, bits: int, channels: int, colour: int, clear: bytes) -> np.ndarray:
    if bits == 16:
        values = data.reshape(*data.shape[:2], -1, 2).astype(np.uint16)
        values = values[..., 0] << 8 | values[..., 1]
    elif bits == 8:
        values = data
    else:
        spread = np.unpackbits(data, axis=2).reshape(*data.shape[:2], -1, bits)
        values = (spread << np.arange(bits - 1, -1, -1, dtype=np.uint8)).sum(axis=3, dtype=np.uint8)
    values = values[:, :, : width * channels].reshape(*data.shape[:2], width, channels)
    if colour == 3:
        opaque = np.ones(1 << bits, bool)
        opaque[: len(clear)] = np.frombuffer(clear, np.uint8) > 0
        return opaque[values[..., 0]]
    return (values != np.array(struct.unpack(f">{channels}H", clear))).any(axis=3)


def masks(tiles: list[bytes | None]) -> list[np.ndarray | Exception | None]:
    """Of each PNG which pixels are not fully transparent (height, width), or what is wrong with it; of None, None."""
    from tilewright.operators.decode import png_alpha

    out: list[np.ndarray | Exception | None] = [None] * len(tiles)
    groups: dict[tuple, list[tuple[int, Tile]]] = {}
    alone = []

    def undo(members: list[tuple[int, Tile]]) -> None:
        found = _masks([t for _, t in members])
        if found is None and len(members) > 1:  # one tile's filter is no reason to read all of them alone
            undo(members[: len(members) // 2])
            undo(members[len(members) // 2 :])
        elif found is None:
            alone.extend(i for i, _ in members)
        else:
            for (i, _), mask in zip(members, found):
                out[i] = mask

    for i, data in enumerate(tiles):
        if data is None:
            continue
        tile = read_head(data)
        if tile is None or not tile.raw:
            alone.append(i)
            continue
        width, height, bits, colour, interlaced = tile.form
        room = len(tile.raw)  # of the tile in its stack
        if not interlaced and bits >= 8:
            width, height = -(-width // _SIDE) * _SIDE, -(-height // _SIDE) * _SIDE
            room = height * (1 + width * bits * _CHANNELS[colour] // 8)
        own = groups.setdefault((width, height, bits, colour, interlaced, tile.clear), [])
        own.append((i, tile))
        if len(own) * room > TOGETHER:
            undo(own)
            own.clear()
    for own in groups.values():
        if own:
            undo(own)
    for i in alone:
        try:
            out[i] = png_alpha(tiles[i])
        except Exception as e:  # a broken tile is a row of errors, not a failed job
            out[i] = e
    return out
