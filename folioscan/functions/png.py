"""PNG files as pixels, in the task that holds their bytes: those whose pixels no reader sees differently."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_SIGNATURE = b"\x89PNG\r\n\x1a\n"
# Depth, colour, compression, filter and interlace of the header: 8 bits of grey, RGB or RGBA, row by row.
_PLAIN = {"0800000000": 1, "0802000000": 3, "0806000000": 4}
# Chunks beside the pixels that do not change them, with their lengths. Others, text among them, are left to Spark's reader.
_NEUTRAL = {b"pHYs": 9, b"gAMA": 4, b"sRGB": 1, b"cHRM": 32, b"tIME": 7}
# Bytes of pixels that Spark takes as an image.
MOST_BYTES = 10**9


def _number(payload: Column, start: int) -> Column:
    return F.conv(F.hex(F.substring(payload, start, 4)), 16, 10).cast("bigint")


def png_size(payload: Column) -> Column:
    """``struct(width, height, channels)`` that the header of a plain PNG names; null for all other payloads."""
    named = F.startswith(payload, F.lit(_SIGNATURE + b"\0\0\0\x0dIHDR"))
    kind = F.hex(F.substring(payload, 25, 5))
    channels = F.coalesce(*[F.when(kind == code, F.lit(n)) for code, n in _PLAIN.items()])
    width, height = _number(payload, 17), _number(payload, 21)
    usable = named & channels.isNotNull() & (width > 0) & (height > 0) & (width * height < MOST_BYTES // 4)
    return F.when(usable, F.struct(width.cast("int").alias("width"), height.cast("int").alias("height"), channels.alias("channels")))


def _rows(data: bytes) -> bytes | None:
    """The deflated rows of a PNG whose chunks are whole and known; else null."""
    body, at, kinds = [], 8, []
    while at < len(data):
        if len(data) < at + 12:
            return None
        size, kind = struct.unpack_from(">I4s", data, at)
        chunk, end = memoryview(data)[at + 4 : at + 8 + size], at + 12 + size
        if end > len(data) or zlib.crc32(chunk) != struct.unpack_from(">I", data, end - 4)[0]:
            return None
        if kind == b"IDAT":
            body.append(chunk[4:])
        elif kind not in (b"IHDR", b"IEND") and _NEUTRAL.get(kind) != size:
            return None
        if not kinds or kind != b"IDAT" or kinds[-1] != kind:
            kinds.append(kind)
        at = end
    once = len(set(kinds)) == len(kinds)
    return b"".join(body) if once and kinds[0] == b"IHDR" and kinds[-2:] == [b"IDAT", b"IEND"] else None


def _diagonals(out: np.ndarray, lines: np.ndarray, kinds: np.ndarray) -> None:
    """Rows of any filter, pixel by pixel along diagonals: a pixel needs those to its left, above and between."""
    height, width = lines.shape[:2]
    for d in range(height + width - 1):
        y = np.arange(max(0, d - width + 1), min(height, d + 1))
        x = d - y
        a, b, c = (out[y + i, x + j].astype(np.int16) for i, j in ((1, 0), (0, 1), (0, 0)))
        to_a, to_b, to_c = abs(b - c), abs(a - c), abs(a + b - 2 * c)
        nearest = np.where((to_a <= to_b) & (to_a <= to_c), a, np.where(to_b <= to_c, b, c))
        guess = np.choose(kinds[y][:, None], [np.zeros_like(a), a, b, (a + b) // 2, nearest])
        out[y + 1, x + 1] = lines[y, x] + guess.astype(np.uint8)


def _add_up(lines: np.ndarray) -> None:
    """Running sums down the rows, in place: blocks of rows side by side, as each step costs a call whatever its width."""
    height, width = lines.shape
    step = max(1, int(height**0.5))
    whole = height // step * step
    blocks = lines[:whole].reshape(-1, step, width)
    for i in range(1, step):
        blocks[:, i] += blocks[:, i - 1]
    for above, block in zip(blocks, blocks[1:]):
        block += above[-1]
    for i in range(whole, height):
        lines[i] += lines[i - 1]


def png_samples(data: bytes, width: int, height: int, channels: int) -> np.ndarray | None:
    """Pixels of a plain PNG in its own order (grey, RGB or RGBA); null where the file is in any way odd."""
    body = _rows(data)
    stride = width * channels + 1
    if body is None:
        return None
    try:
        inflate = zlib.decompressobj()
        raw = inflate.decompress(body, height * stride + 1)
    except zlib.error:
        return None
    if len(raw) != height * stride or not inflate.eof or inflate.unused_data:
        return None
    rows = np.frombuffer(raw, np.uint8).reshape(height, stride)
    kinds = rows[:, 0]
    if kinds.max() > 4:
        return None
    if kinds.max() > 2:
        # One row and one pixel of zeros before the image, as filters see them.
        out = np.zeros((height + 1, width + 1, channels), np.uint8)
        _diagonals(out, rows[:, 1:].reshape(height, width, channels), kinds)
        return out[1:, 1:]
    lines = rows[:, 1:].copy()
    pixels = lines.reshape(height, width, channels)
    left = kinds == 1
    if left.any():
        pixels[left] = np.cumsum(pixels[left], axis=1, dtype=np.uint8)
    # A row that is told by the one above adds up from the last row that is not.
    starts = np.flatnonzero(np.append(kinds != 2, True))
    if kinds[0] == 2:
        starts = np.append(0, starts)
    for low, high in zip(starts, starts[1:]):
        if high - low > 1:
            _add_up(lines[low:high])
    return pixels


def png_pixels(data: bytes, width: int, height: int, channels: int) -> np.ndarray | None:
    """Pixels of a plain PNG as Spark's image source has them (grey, BGR or BGRA); null where the file is in any way odd."""
    pixels = png_samples(data, width, height, channels)
    if pixels is None or channels == 1:
        return pixels
    turned = pixels.copy()
    turned[:, :, 0], turned[:, :, 2] = pixels[:, :, 2], pixels[:, :, 0]
    return turned
