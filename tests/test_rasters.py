"""Stacks of PNG tiles against the reader of one tile."""

import random
import struct
import time
import zlib

import numpy as np
import pytest

from tilewright import samples
from tilewright.operators import decode, rasters

FORMS = [(c, b) for c, bits in ((0, (1, 2, 4, 8, 16)), (2, (8, 16)), (3, (1, 2, 4, 8)), (4, (8, 16)), (6, (8, 16))) for b in bits]


def chunk(name, data):
    return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))


def picture(rng, width, height, bits, colour, interlaced=0, filters=(0, 1, 2, 3, 4), clear=None, few=None):
    """Random filtered bytes: whatever they stand for, both readers must agree."""
    channels, raw = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour], b""
    for w, h in rasters._sizes((width, height, bits, colour, interlaced)):
        for _ in range(h):
            row = (w * bits * channels + 7) // 8
            raw += bytes([rng.choice(filters)]) + bytes(rng.choice(few) if few else rng.randrange(256) for _ in range(row))
    cut = rng.randrange(len(raw) + 1)
    data = zlib.compress(raw)
    parts = [chunk(b"IDAT", data[:cut]), chunk(b"IDAT", data[cut:])]
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, bits, colour, 0, 0, interlaced))
    return b"\x89PNG\r\n\x1a\n" + head + (chunk(b"tRNS", clear) if clear is not None else b"") + b"".join(parts) + chunk(b"IEND", b"")


def same(tiles):
    got = rasters.masks(tiles)
    for data, mask in zip(tiles, got):
        try:
            expected = None if data is None else decode.png_alpha(data)
        except Exception as e:
            assert type(mask) is type(e) and str(mask) == str(e)
            continue
        assert (mask is None and data is None) or (mask.shape == expected.shape and (mask == expected).all())
    return got


@pytest.mark.parametrize("interlaced", [0, 1])
@pytest.mark.parametrize(("colour", "bits"), FORMS)
def test_all_forms(colour, bits, interlaced, monkeypatch):
    monkeypatch.setattr(rasters, "TOGETHER", 900)
    rng, tiles = random.Random(colour * 100 + bits), []
    clear = {0: struct.pack(">H", 1), 2: struct.pack(">3H", 0, 0, 0), 3: b"\x00\xff\x00"[: 1 << bits]}.get(colour)
    for i in range(24):
        size = rng.choice([(1, 1), (3, 5), (9, 4), (17, 8)])
        tiles.append(picture(rng, *size, bits, colour, interlaced, rng.choice([(0, 1, 2, 3, 4), (0, 1, 2), (4,), (3,)]), clear if i % 3 else None, (0, 1) if i % 2 else None))
    rng.shuffle(tiles)
    got = same(tiles)
    assert any(not m.all() for m in got) or colour not in (4, 6)


def test_what_is_not_a_whole_picture():
    rng = random.Random(3)
    good = picture(rng, 4, 4, 8, 6)
    bad_filter = picture(rng, 4, 4, 8, 6, filters=(7,))
    tiles = [None, b"", b"no picture", good[:40], good[:-12], good, bad_filter, good.replace(b"IDAT", b"IDAX"), picture(rng, 4, 4, 8, 6, clear=b""), picture(rng, 9, 4, 1, 3, clear=b"abc"), b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 4, 8, 5, 0, 0, 0)), good]
    got = same(tiles)
    assert [isinstance(m, np.ndarray) for m in got] == [False, False, False, False, True, True, False, False, True, False, False, True] and str(got[2]) == "not a PNG"


def test_made_tiles():
    same([samples.png_body(k) for k in range(200)])


def test_a_paeth_tile_takes_few_milliseconds():
    rng = np.random.default_rng(1)
    rows = b"".join(b"\x04" + rng.integers(0, 256, 1024).astype(np.uint8).tobytes() for _ in range(256))
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", 256, 256, 8, 6, 0, 0, 0))
    data = b"\x89PNG\r\n\x1a\n" + head + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
    assert (rasters.masks([data])[0] == decode.png_alpha(data)).all()
    began = time.process_time()
    rasters.masks([data] * 32)
    assert (time.process_time() - began) / 32 < 0.02  # under 0.01 on a machine of its own


def test_small_pictures_of_many_sizes_are_one_stack(monkeypatch):
    rng, stacks = random.Random(5), []
    one_form = rasters._masks_of_one_form
    monkeypatch.setattr(rasters, "_masks_of_one_form", lambda together, n: stacks.append(n) or one_form(together, n))
    tiles = [picture(rng, 1 + k % 9, 1 + k % 7, 8, 6, few=(0, 1, 255)) for k in range(63)]
    same(tiles)
    assert stacks == [63]
    same([picture(rng, 1 + k % 40, 1 + k % 23, bits, colour, clear=clear, few=(0, 1, 2)) for k in range(300) for colour, bits, clear in ((4, 16, None), (2, 8, b"\0\1\0\1\0\1"), (3, 8, b"\0\xff"), (0, 16, b"\0\1"))])


def test_an_unknown_filter_leaves_its_stack_alone(monkeypatch):
    rng, read = random.Random(6), []
    alone = decode.png_alpha
    tiles = [picture(rng, 1 + k % 9, 1 + k % 7, 8, 6, filters=(9,) if k == 20 else (0, 1, 2, 3, 4)) for k in range(63)]
    monkeypatch.setattr(decode, "png_alpha", lambda data: read.append(data) or alone(data))
    got = rasters.masks(tiles)
    assert read == [tiles[20]] and [k for k, m in enumerate(got) if isinstance(m, Exception)] == [20]
