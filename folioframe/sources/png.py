"""8-bit RGB PNG files with numpy and zlib."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"


def encode(image: np.ndarray) -> bytes:
    """``image``: height x width x 3, uint8."""
    height, width, _ = image.shape
    rows = np.zeros((height, 1 + 3 * width), np.uint8)
    rows[:, 1:] = image.reshape(height, -1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def decode(data: bytes) -> np.ndarray:
    """Greyscale, RGB and RGBA images of 8 bits, not interlaced, as RGB."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG file")
    at, body, head = 8, b"", None
    while at < len(data):
        (size,) = struct.unpack(">I", data[at : at + 4])
        kind, part = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body += part
        at += 12 + size
    if head is None:
        raise ValueError("a PNG file without a header")
    width, height, depth, color, _, _, interlace = head
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(color)
    if depth != 8 or channels is None or interlace:
        raise ValueError("only 8-bit PNG files without a palette are read")
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width * channels), np.uint8)
    above = np.zeros(width * channels, np.int32)
    for y in range(height):
        mode, line = int(raw[y, 0]), raw[y, 1:].astype(np.int32)
        if mode == 2:
            line = line + above
        elif mode in (1, 3, 4):
            line = _unfilter(mode, line, above, channels)
        elif mode:
            raise ValueError("unknown PNG filter")
        above = line & 255
        out[y] = above
    image = out.reshape(height, width, channels)
    if color in (0, 4):
        return np.repeat(image[:, :, :1], 3, axis=2)
    return image[:, :, :3].copy()


def _unfilter(mode: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """Filters that depend on the pixel to the left."""
    out = line.copy()
    for x in range(len(out)):
        a = int(out[x - step]) if x >= step else 0
        b = int(above[x])
        if mode == 1:
            guess = a
        elif mode == 3:
            guess = (a + b) >> 1
        else:
            c = int(above[x - step]) if x >= step else 0
            da, db, dc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = a if da <= db and da <= dc else b if db <= dc else c
        out[x] = (int(line[x]) + guess) & 255
    return out
