"""PNG pictures as pixel arrays, many at a time.

The chunk walk and the inflate run per picture; undoing the scanline filters
runs over all pictures of one shape at once, so its cost is per scanline and not
per picture.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Fixed values of the file format: the signature, and channels by colour type (grey, RGB).
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3}


def scanlines(data: bytes | None) -> tuple[int, int, int, bytes] | None:
    """(height, width, channels, filtered scanlines), or None where the picture does not decode in full.

    Taken are 8-bit grey and RGB pictures without interlacing. Not decoded are:
    null, other formats, other depths or colour types, a damaged header or data
    chunk (checksum), a cut or damaged data stream, too few or too many bytes.
    Ancillary chunks are passed over unread.
    """
    if data is None or data[:8] != SIGNATURE:
        return None
    at, header, parts = 8, None, []
    while at + 8 <= len(data):
        n, kind = int.from_bytes(data[at : at + 4], "big"), data[at + 4 : at + 8]
        end = at + 12 + n
        if kind in (b"IHDR", b"IDAT"):
            if end > len(data) or zlib.crc32(data[at + 4 : end - 4]) != int.from_bytes(data[end - 4 : end], "big"):
                return None
            if kind == b"IHDR":
                header = data[at + 8 : end - 4]
            else:
                parts.append(data[at + 8 : end - 4])
        elif kind == b"IEND":
            break
        at = end
    if header is None or len(header) != 13 or not parts:
        return None
    width, height = int.from_bytes(header[:4], "big"), int.from_bytes(header[4:8], "big")
    depth, colour, compression, filters, interlace = header[8:]
    if depth != 8 or colour not in CHANNELS or compression or filters or interlace or not width or not height:
        return None
    size = height * (1 + width * CHANNELS[colour])
    stream = zlib.decompressobj()
    try:
        raw = stream.decompress(b"".join(parts), size + 1)
        if not stream.eof:
            raw += stream.decompress(stream.unconsumed_tail, 1)
    except zlib.error:
        return None
    if not stream.eof or len(raw) != size:
        return None
    return height, width, CHANNELS[colour], raw


def unfilter(lines: np.ndarray, channels: int) -> tuple[np.ndarray, np.ndarray]:
    """Pixels of many pictures of one shape.

    lines: uint8 (pictures, height, 1 + width * channels), the filter type first.
    Returns uint8 (pictures, height, width, channels) and which pictures use only known filters.
    """
    n, height, stride = lines.shape[0], lines.shape[1], lines.shape[2] - 1
    width = stride // channels
    out = np.empty((n, height, stride), np.uint8)
    above = np.zeros((n, stride), np.uint8)
    fine = (lines[:, :, 0] <= 4).all(axis=1)
    for y in range(height):
        kind, x = lines[:, y, 0], lines[:, y, 1:]
        row = out[:, y]
        row[:] = x
        for f in np.unique(kind):
            at = np.flatnonzero(kind == f)
            if f == 1:  # left neighbour
                row[at] = np.cumsum(x[at].reshape(-1, width, channels), axis=1, dtype=np.uint8).reshape(-1, stride)
            elif f == 2:  # neighbour above
                row[at] = x[at] + above[at]
            elif f in (3, 4):
                r, up = x[at].astype(np.int16), above[at].astype(np.int16)
                left = np.zeros((len(at), channels), np.int16)
                corner = np.zeros((len(at), channels), np.int16)
                for s in range(0, stride, channels):
                    b = up[:, s : s + channels]
                    if f == 3:
                        guess = (left + b) >> 1
                    else:
                        pa, pb, pc = np.abs(b - corner), np.abs(left - corner), np.abs(left + b - 2 * corner)
                        guess = np.where((pa <= pb) & (pa <= pc), left, np.where(pb <= pc, b, corner))
                    left = (r[:, s : s + channels] + guess) & 255
                    corner = b
                    row[at, s : s + channels] = left
        above = row
    return out.reshape(n, height, width, channels), fine


def decode(pictures: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Decodes what decodes in full: (positions, uint8 pixels (n, height, width, channels)) per shape."""
    shapes: dict[tuple[int, int, int], tuple[list[int], list[bytes]]] = {}
    for i, data in enumerate(pictures):
        got = scanlines(data)
        if got is not None:
            positions, raws = shapes.setdefault(got[:3], ([], []))
            positions.append(i)
            raws.append(got[3])
    result = []
    for (height, width, channels), (positions, raws) in sorted(shapes.items()):
        step = max(1, 64_000_000 // (height * width * channels))  # keeps the working arrays small
        for s in range(0, len(raws), step):
            lines = np.frombuffer(b"".join(raws[s : s + step]), np.uint8).reshape(-1, height, 1 + width * channels)
            pixels, fine = unfilter(lines, channels)
            result.append((np.array(positions[s : s + step])[fine], pixels[fine]))
    return result


def encode(pixels: np.ndarray, filters: int = 0) -> bytes:
    """A PNG of uint8 pixels (height, width[, 3]); every scanline with the filter 0, 1 or 2. For sinks and tests."""
    p = pixels if pixels.ndim == 3 else pixels[:, :, None]
    height, width, channels = p.shape
    flat = p.reshape(height, width * channels)
    if filters == 1:
        flat = (p - np.concatenate([np.zeros((height, 1, channels), np.uint8), p[:, :-1]], axis=1)).reshape(height, -1)
    elif filters == 2:
        flat = flat - np.concatenate([np.zeros((1, flat.shape[1]), np.uint8), flat[:-1]])
    raw = np.concatenate([np.full((height, 1), filters, np.uint8), flat.astype(np.uint8)], axis=1).tobytes()

    def chunk(kind: bytes, body: bytes) -> bytes:
        return len(body).to_bytes(4, "big") + kind + body + zlib.crc32(kind + body).to_bytes(4, "big")

    colour = {1: 0, 3: 2}[channels]
    header = width.to_bytes(4, "big") + height.to_bytes(4, "big") + bytes([8, colour, 0, 0, 0])
    return SIGNATURE + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
