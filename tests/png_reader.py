"""A plain PNG reader, beside Spark's own image source."""

import struct
import zlib

import numpy as np

from folioscan.operators.assets import IMAGE_CHANNELS


def _unfiltered(rows: np.ndarray, width: int, step: int) -> np.ndarray:
    """Pixel bytes of PNG rows, each of which begins with the number of its filter."""
    out = np.zeros((len(rows) + 1, width + step), np.uint8)
    for y, row in enumerate(rows, 1):
        kind, line, up = row[0], row[1:], out[y - 1, step:]
        if kind in (0, 2):
            out[y, step:] = line if kind == 0 else line + up
        elif kind == 1:
            out[y, step:] = np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
        else:
            done, above = out[y], out[y - 1]
            for x in range(step, width + step):
                a, b, c = int(done[x - step]), int(above[x]), int(above[x - step])
                nearest = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
                done[x] = (int(line[x - step]) + ((a + b) // 2 if kind == 3 else nearest)) & 255
    return out[1:, step:]


def _decoded(data: bytes | None) -> dict | None:
    """A PNG with 8 bits a channel (grey, RGB or RGBA, not interlaced) as Spark's image; else null."""
    if not data or data[:8] != b"\x89PNG\r\n\x1a\n" or data[12:16] != b"IHDR" or len(data) < 33:
        return None
    width, height, depth, colour, *_, interlaced = struct.unpack(">IIBBBBB", data[16:29])
    step = {0: 1, 2: 3, 6: 4}.get(colour)
    body, at = [], 8
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IDAT":
            body.append(data[at + 8 : at + 8 + size])
        at += size + 12
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8)
    except zlib.error:
        return None
    if step is None or depth != 8 or interlaced or not width or raw.size != height * (width * step + 1):
        return None
    pixels = _unfiltered(raw.reshape(height, -1), width * step, step).reshape(height, width, step)
    pixels = pixels[:, :, [2, 1, 0, *range(3, step)]] if step > 1 else pixels
    mode = {channels: code for code, channels in IMAGE_CHANNELS.items()}[step]
    return {"origin": "", "height": height, "width": width, "nChannels": step, "mode": mode, "data": pixels.tobytes()}
