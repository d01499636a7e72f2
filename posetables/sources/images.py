"""PNG payloads decoded to arrays, and labels derived from them without shuffling pixels."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

IMAGE = "path string, height int, width int, channels int, dtype string, data binary"
_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def decode_png(raw: bytes) -> np.ndarray:
    """Height x width x channels of an 8- or 16-bit, non-interlaced grey or colour PNG."""
    if raw[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, parts, width = 8, [], None
    while at < len(raw):
        size, kind = struct.unpack(">I4s", raw[at : at + 8])
        if kind == b"IHDR":
            width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", raw[at + 8 : at + 21])
        elif kind == b"IDAT":
            parts.append(raw[at + 8 : at + 8 + size])
        at += 12 + size
    if width is None:
        raise ValueError("no header")
    if interlaced or depth not in (8, 16) or colour not in _CHANNELS:
        raise ValueError("this kind of PNG is not read")
    n = _CHANNELS[colour] * depth // 8
    lines = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, 1 + width * n)
    out = unfilter(lines[:, 0], lines[:, 1:].reshape(height, width, n))
    if depth == 16:
        return out.reshape(height, width, -1, 2).view(">u2")[..., 0].astype(np.uint16)
    return out


def unfilter(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Pixels (height x width x bytes) of filtered rows."""
    if kinds.max(initial=0) > 4:
        raise ValueError("an unknown filter")
    if kinds.max(initial=0) > 2:
        return _unfilter_diagonally(kinds, rows)
    out, above = np.empty_like(rows), np.zeros(rows.shape[1:], np.uint8)
    for y, kind in enumerate(kinds.tolist()):
        out[y] = above = np.cumsum(rows[y], axis=0, dtype=np.uint8) if kind == 1 else rows[y] + above if kind == 2 else rows[y]
    return out


def _unfilter_diagonally(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A pixel needs those on its left, above, and above left, so all pixels of an anti-diagonal are undone at once.

    The picture has a border of zeros on top and on the left; in it, a step along a diagonal is a step of one width.
    """
    height, width, n = rows.shape
    out = np.zeros(((height + 1) * (width + 1), n), np.uint8)
    flat = rows.reshape(height * width, n)
    kinds = kinds[:, None]
    for d in range(height + width - 1):
        first, end = max(0, d - width + 1), min(height, d + 1)
        low, high = first * width + width + 2 + d, (end - 1) * width + width + 3 + d
        left, up, corner = (out[low - k : high - k : width].astype(np.int16) for k in (1, width + 1, width + 2))
        base = left + up - corner
        a, b, c = np.abs(base - left), np.abs(base - up), np.abs(base - corner)
        nearest = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        kind = kinds[first:end]
        guess = np.where(kind == 4, nearest, np.where(kind == 3, (left + up) >> 1, np.where(kind == 2, up, np.where(kind == 1, left, 0))))
        residual = flat[np.arange(first, end) * (width - 1) + d]
        out[low:high:width] = residual + guess.astype(np.uint8)
    return np.ascontiguousarray(out.reshape(height + 1, width + 1, n)[1:, 1:])


def image_table(spark: SparkSession, root: str, pattern: str = "*.png", permissive: bool = False) -> DataFrame:
    """path and payload of every image below root. With permissive, a file that can't be decoded is a row of nulls with the reason in `corrupt`.

    Spark lists no files of no bytes.
    """

    def decoded(path: str, content: bytes) -> dict:
        try:
            a = decode_png(content)
        except (ValueError, zlib.error, struct.error) as e:
            if not permissive:
                raise ValueError(f"{path}: {e}") from e
            return {"path": path, "corrupt": f"{type(e).__name__}: {e}"}
        return {"path": path, "height": a.shape[0], "width": a.shape[1], "channels": a.shape[2], "dtype": str(a.dtype), "data": a.tobytes()}

    def work(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):  # an image at a time
                yield pa.RecordBatch.from_pylist([decoded(path.as_py(), content.as_py())], schema=schema)

    fields = [("path", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("dtype", pa.string()), ("data", pa.binary())]
    schema = pa.schema(fields + [("corrupt", pa.string())] * permissive)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", "content").mapInArrow(work, IMAGE + ", corrupt string" * permissive)


def to_array(height: int, width: int, channels: int, dtype: str, data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype).reshape(height, width, channels)


def mask_labels(images: DataFrame) -> DataFrame:
    """path, x1, y1, x2, y2 (inclusive, zeros if empty), px of each mask payload; one row leaves for each image."""

    def work(frames):
        for f in frames:
            rows = []
            for path, *rest in zip(f["path"], f["height"], f["width"], f["channels"], f["dtype"], f["data"]):
                y, x = np.nonzero(to_array(*rest)[..., 0])
                rows.append((path, *((int(x.min()), int(y.min()), int(x.max()), int(y.max())) if len(x) else (0,) * 4), len(x)))
            yield pd.DataFrame(rows, columns=["path", "x1", "y1", "x2", "y2", "px"])

    return images.select("path", "height", "width", "channels", "dtype", "data").mapInPandas(work, "path string, x1 int, y1 int, x2 int, y2 int, px long")


def depth_metres(images: DataFrame, scales: DataFrame) -> DataFrame:
    """path, data as float32 metres: raw * depth_scale / 1000. scales: path, depth_scale."""

    def work(frames):
        for f in frames:
            yield pd.DataFrame({"path": f["path"], "data": [(np.frombuffer(d, t).astype(np.float64) * s / 1000).astype(np.float32).tobytes() for d, t, s in zip(f["data"], f["dtype"], f["depth_scale"])]})

    return images.join(scales, "path").select("path", "dtype", "data", "depth_scale").mapInPandas(work, "path string, data binary")
