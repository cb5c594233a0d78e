"""Image fingerprints: brightness differences between cells of a coarse grid, 304 bits; PNG decoding without libraries."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
MOST_PIXELS = 16_000_000
GRIDS = ((9, 8), (17, 15))


def grey(rgb: np.ndarray) -> np.ndarray:
    """Brightness of an array (height, width, 3 or more) of bytes, in integers."""
    return (rgb[..., :3].astype(np.uint32) @ np.array([77, 150, 29], np.uint32) >> 8).astype(np.uint8)


def cells(g: np.ndarray, wide: int, high: int) -> np.ndarray:
    """Mean brightness, rounded down, of each cell of a grid; from a table of sums."""
    h, w = g.shape
    sums = np.zeros((h + 1, w + 1), np.int64)
    sums[1:, 1:] = g.astype(np.int64).cumsum(0).cumsum(1)
    y0, x0 = np.arange(high) * h // high, np.arange(wide) * w // wide
    y1, x1 = np.maximum(y0 + 1, np.arange(1, high + 1) * h // high), np.maximum(x0 + 1, np.arange(1, wide + 1) * w // wide)
    total = sums[np.ix_(y1, x1)] - sums[np.ix_(y0, x1)] - sums[np.ix_(y1, x0)] + sums[np.ix_(y0, x0)]
    return total // np.outer(y1 - y0, x1 - x0)


def fingerprint(g: np.ndarray) -> bytes:
    """8 bytes of the small grid and 30 of the large one: a bit is set where a cell is brighter than its right neighbour."""
    grids = [cells(g, w, h) for w, h in GRIDS]
    return b"".join(np.packbits((c[:, :-1] > c[:, 1:]).ravel()).tobytes() for c in grids)


def decode_png(data: bytes) -> np.ndarray | None:
    """Brightness of a PNG of 8 bits a channel, not interlaced; None for anything else, broken data included."""
    try:
        if data[:8] != b"\x89PNG\r\n\x1a\n":
            return None
        at, body, palette, head = 8, b"", None, None
        while at + 8 <= len(data):
            size, kind = struct.unpack(">I4s", data[at : at + 8])
            chunk = data[at + 8 : at + 8 + size]
            at += 12 + size
            if kind == b"IHDR":
                head = struct.unpack(">IIBBBBB", chunk)
            elif kind == b"PLTE":
                palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
            elif kind == b"IDAT":
                body += chunk
            elif kind == b"IEND":
                break
        w, h, depth, colour, _, _, interlaced = head
        if depth != 8 or interlaced or colour not in CHANNELS or not 0 < w * h <= MOST_PIXELS:
            return None
        n = CHANNELS[colour]
        need = h * (w * n + 1)
        raw = zlib.decompressobj().decompress(body, need)
        if len(raw) < need:
            return None
        px = _unfilter(np.frombuffer(raw, np.uint8).reshape(h, w * n + 1), n).reshape(h, w, n)
        if colour == 3:
            px = palette[px[..., 0]]
        elif n < 3:
            px = np.repeat(px[..., :1], 3, axis=2)
        return grey(px)
    except (TypeError, ValueError, IndexError, struct.error, zlib.error):
        return None


def _unfilter(rows: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((len(rows), rows.shape[1] - 1), np.uint8)
    above = np.zeros(rows.shape[1] - 1, np.uint8)
    for y, row in enumerate(rows):
        kind, line = row[0], row[1:].copy()
        if kind == 1:
            line = np.cumsum(line.reshape(-1, n), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            line = line + above
        elif kind in (3, 4):
            now, up = line.tolist(), above.tolist()
            for i in range(len(now)):
                left, upper = (now[i - n], up[i - n]) if i >= n else (0, 0)
                if kind == 3:
                    guess = (left + up[i]) >> 1
                else:
                    guess = min(((abs(up[i] - upper), 0, left), (abs(left - upper), 1, up[i]), (abs(left + up[i] - 2 * upper), 2, upper)))[2]
                now[i] = (now[i] + guess) & 255
            line = np.array(now, np.uint8)
        elif kind:
            raise ValueError("unknown filter")
        out[y] = above = line
    return out


def with_fingerprints(df: DataFrame, key: str, content: str) -> DataFrame:
    """(key, fingerprint) of images: 38 bytes, or none of them (empty) where one can't be decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [decode_png(x) if x is not None else None for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([b"" if g is None else fingerprint(g) for g in found], pa.binary())], [key, "fingerprint"])

    return df.select(key, content).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, fingerprint binary")
