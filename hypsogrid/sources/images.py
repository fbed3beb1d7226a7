"""Small readers and writers of raster replies: TIFF with 32-bit floats and a place, PNG with RGB or RGBA.

Only what map servers send is read: uncompressed or deflated strips or tiles of one band; PNG of 8 bits, not interlaced.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

#: Fixed values of TIFF: tags, and bytes and format of a field's type.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, STRIP_BYTES = 256, 257, 258, 259, 262, 273, 277, 278, 279
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT, PIXEL_SCALE, TIE_POINT, GEO_KEYS, NODATA = 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 12: "d"}
PROJECTED, GEOGRAPHIC = 3072, 2048
PNG = b"\x89PNG\r\n\x1a\n"


class ImageError(ValueError):
    """A reply that cannot be read, or is not what was asked for."""


@dataclass
class Raster:
    values: np.ndarray
    bands: int
    west: float
    north: float
    pixel_x: float
    pixel_y: float
    epsg: int | None
    nodata: float | None


def encode_tiff(values: np.ndarray, west: float, north: float, pixel: float, epsg: int, nodata: float, deflate: bool = False) -> bytes:
    """One strip of 32-bit floats."""
    height, width = values.shape
    data = np.where(np.isnan(values), nodata, values).astype("<f4").tobytes()
    data = zlib.compress(data) if deflate else data
    key = GEOGRAPHIC if epsg == 4326 else PROJECTED
    fields = [
        (WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [32]), (COMPRESSION, 3, [8 if deflate else 1]), (PHOTOMETRIC, 3, [1]), (STRIPS, 4, [8]), (SAMPLES, 3, [1]), (ROWS, 4, [height]),
        (STRIP_BYTES, 4, [len(data)]), (FORMAT, 3, [3]), (PIXEL_SCALE, 12, [pixel, pixel, 0.0]), (TIE_POINT, 12, [0.0, 0.0, 0.0, west, north, 0.0]), (GEO_KEYS, 3, [1, 1, 0, 1, key, 0, 1, epsg]), (NODATA, 2, f"{nodata:g}\0".encode()),
    ]
    at, entries, more = 8 + len(data), b"", b""
    beyond = at + 2 + 12 * len(fields) + 4
    for tag, kind, value in fields:
        packed = value if kind == 2 else struct.pack(f"<{len(value)}{TYPES[kind]}", *value)
        count = len(value)
        if len(packed) > 4:
            entries += struct.pack("<HHII", tag, kind, count, beyond + len(more))
            more += packed
        else:
            entries += struct.pack("<HHI", tag, kind, count) + packed.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", at) + data + struct.pack("<H", len(fields)) + entries + struct.pack("<I", 0) + more


def decode_tiff(content: bytes) -> Raster:
    try:
        return _tiff(content)
    except (struct.error, KeyError, IndexError, zlib.error, UnicodeDecodeError) as e:
        raise ImageError(f"not a readable TIFF: {e!r}") from e


def _tiff(content: bytes) -> Raster:
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(content[:4])
    if order is None:
        raise ImageError("not a TIFF")
    at = struct.unpack_from(order + "I", content, 4)[0]
    fields = {}
    for i in range(struct.unpack_from(order + "H", content, at)[0]):
        tag, kind, count = struct.unpack_from(order + "HHI", content, at + 2 + 12 * i)
        if kind not in TYPES:
            continue
        size, place = struct.calcsize(TYPES[kind]) * count, at + 10 + 12 * i
        if size > 4:
            place = struct.unpack_from(order + "I", content, place)[0]
        fields[tag] = content[place : place + size].rstrip(b"\0").decode() if kind == 2 else struct.unpack_from(f"{order}{count}{TYPES[kind]}", content, place)
    width, height, bands = fields[WIDTH][0], fields[HEIGHT][0], fields.get(SAMPLES, (1,))[0]
    if fields[BITS][0] != 32 or fields.get(FORMAT, (1,))[0] != 3 or bands != 1:
        if bands != 1:
            return Raster(np.zeros((height, width), np.float32), bands, np.nan, np.nan, np.nan, np.nan, None, None)
        raise ImageError("heights are not 32-bit floats")
    deflated = fields.get(COMPRESSION, (1,))[0]
    if deflated not in (1, 8, 32946):
        raise ImageError(f"compression {deflated} is not read")

    def part(offset: int, size: int) -> np.ndarray:
        raw = content[offset : offset + size]
        return np.frombuffer(raw if deflated == 1 else zlib.decompress(raw), order + "f4")

    values = np.full((height, width), np.nan, np.float32)
    if TILES in fields:
        tw, th = fields[TILE_WIDTH][0], fields[TILE_HEIGHT][0]
        across = -(-width // tw)
        for i, (o, n) in enumerate(zip(fields[TILES], fields[TILE_BYTES])):
            r, c = i // across * th, i % across * tw
            values[r : r + th, c : c + tw] = part(o, n)[: tw * th].reshape(th, tw)[: height - r, : width - c]
    else:
        whole = np.concatenate([part(o, n) for o, n in zip(fields[STRIPS], fields[STRIP_BYTES])])
        if len(whole) < width * height:
            raise ImageError("the TIFF ends before its pixels")
        values[:] = whole[: width * height].reshape(height, width)
    keys = fields.get(GEO_KEYS, ())
    known = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
    scale, tie = fields.get(PIXEL_SCALE, (np.nan, np.nan)), fields.get(TIE_POINT, (np.nan,) * 6)
    nodata = float(fields[NODATA]) if NODATA in fields else None
    if nodata is not None:
        values[values == np.float32(nodata)] = np.nan
    values[~np.isfinite(values)] = np.nan
    return Raster(values, bands, tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1], scale[0], scale[1], known.get(PROJECTED, known.get(GEOGRAPHIC)), nodata)


def encode_png(pixels: np.ndarray) -> bytes:
    """(height, width, 3 or 4) bytes."""
    height, width, bands = pixels.shape
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    lines = b"".join(b"\0" + row.tobytes() for row in pixels.astype(np.uint8))
    return PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2 if bands == 3 else 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def decode_png(content: bytes) -> np.ndarray:
    """(height, width, 4) bytes; without alpha all is opaque."""
    if content[:8] != PNG:
        raise ImageError("not a PNG")
    at, data, shape = 8, b"", None
    while at + 8 <= len(content):
        n, kind = struct.unpack_from(">I4s", content, at)
        body = content[at + 8 : at + 8 + n]
        if len(body) < n or content[at + 8 + n : at + 12 + n] != struct.pack(">I", zlib.crc32(kind + body)):
            raise ImageError("the PNG is damaged")
        if kind == b"IHDR":
            shape = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data += body
        at += 12 + n
    if shape is None or shape[2] != 8 or shape[3] not in (2, 6) or shape[6]:
        raise ImageError("not an RGB or RGBA PNG of 8 bits")
    width, height, bands = shape[0], shape[1], 3 if shape[3] == 2 else 4
    try:
        raw = np.frombuffer(zlib.decompress(data), np.uint8)
    except zlib.error as e:
        raise ImageError("the PNG is damaged") from e
    if len(raw) != height * (1 + width * bands):
        raise ImageError("the PNG ends before its pixels")
    lines = raw.reshape(height, 1 + width * bands)
    out = np.zeros((height, width, bands), np.int64)
    above = np.zeros((width, bands), np.int64)
    for r in range(height):
        line, how = lines[r, 1:].reshape(width, bands).astype(np.int64), lines[r, 0]
        if how == 2:
            line = (line + above) % 256
        elif how == 1:
            line = np.cumsum(line, 0) % 256
        elif how in (3, 4):
            left, up_left = np.zeros(bands, np.int64), np.zeros(bands, np.int64)
            for c in range(width):
                up = above[c]
                if how == 3:
                    guess = (left + up) // 2
                else:
                    a, b, d = abs(up - up_left), abs(left - up_left), abs(left + up - 2 * up_left)
                    guess = np.where((a <= b) & (a <= d), left, np.where(b <= d, up, up_left))
                line[c] = left = (line[c] + guess) % 256
                up_left = up
        out[r] = above = line
    alpha = np.full((height, width, 1), 255)
    return np.concatenate([out, alpha] if bands == 3 else [out], 2).astype(np.uint8)
