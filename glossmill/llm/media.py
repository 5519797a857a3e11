"""Media columns: payloads stored as PNG images, read back and hashed.

A payload of bytes becomes an 8-bit grey image 64 samples wide. The stored form is a complete PNG file
(signature, IHDR, IDAT, IEND, each chunk with its CRC); each row takes the one of the five filters that leaves
the least sum of absolute differences. Reading tests the signature and every checksum, inflates the IDAT streams
and undoes the filters of all images of a batch at once with numpy: a sample needs those to its left and above, so
the samples of one anti-diagonal, in all images, are one step. The feature is a perceptual hash: the
image is averaged onto a 32 x 32 grid, a cosine transform is taken, and each of the 8 x 8 lowest
frequencies gives one bit, set where it lies above their median.

Defined cases: a null or empty text is 64 zero bytes; equal payloads give equal files and features; rows
repeat as often as the input's; extra columns are ignored; a damaged file raises ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from glossmill.llm.common import map_texts, stored, utf8

WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"
GRID, LOW = 32, 8
#: Effort of zlib, from 1 to 9.
LEVEL = 6


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def padded(payload: bytes, unit: int = WIDTH) -> bytes:
    """Zero bytes up to a positive multiple of `unit`."""
    return payload + b"\0" * (-len(payload) % unit or (0 if payload else unit))


def filtered(rows: np.ndarray) -> np.ndarray:
    """The rows under each of the five filters: 0 none, 1 sub, 2 up, 3 average, 4 Paeth."""
    near = np.zeros((rows.shape[0] + 1, rows.shape[1] + 1), np.uint8)
    near[1:, 1:] = rows
    left, up, corner = near[1:, :-1], near[:-1, 1:], near[:-1, :-1]
    mean = ((left.astype(np.uint16) + up) >> 1).astype(np.uint8)
    return np.stack([rows, rows - left, rows - up, rows - mean, rows - _paeth(left, up, corner)])


def encode_png(samples: bytes, width: int = WIDTH, row_filter: int | None = None) -> bytes:
    """A grey 8-bit PNG. Each row has the filter with the least sum of absolute (signed) values, or all have the given one."""
    rows = np.frombuffer(samples, np.uint8).reshape(-1, width)
    shown = filtered(rows)
    if row_filter is None:
        kinds = np.abs(shown.view(np.int8).astype(np.int16)).sum(axis=2, dtype=np.int64).argmin(axis=0)
    else:
        kinds = np.full(len(rows), row_filter)
    lined = np.empty((len(rows), width + 1), np.uint8)
    lined[:, 0] = kinds
    lined[:, 1:] = shown[kinds, np.arange(len(rows))]
    header = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lined.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def _paeth(left: np.ndarray, up: np.ndarray, corner: np.ndarray) -> np.ndarray:
    a, b, c = (x.astype(np.int16) for x in (left, up, corner))
    p = a + b - c
    pa_, pb, pc = abs(p - a), abs(p - b), abs(p - c)
    return np.where((pa_ <= pb) & (pa_ <= pc), a, np.where(pb <= pc, b, c)).astype(np.uint8)


def decode_png(data: bytes) -> np.ndarray:
    """The samples of a grey 8-bit PNG, as rows."""
    return unfilter([filtered_rows(data)])[0]


def filtered_rows(data: bytes) -> np.ndarray:
    """Rows of a grey 8-bit PNG, each with its filter in front; tests signature, chunk order, checksums and sizes."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG: wrong signature")
    at, idat, header, ended = 8, [], None, False
    while at < len(data) and not ended:
        if at + 12 > len(data):
            raise ValueError("PNG: cut inside a chunk")
        (n,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if len(body) != n or at + 12 + n > len(data) or struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(kind + body):
            raise ValueError(f"PNG: checksum of chunk {kind!r} is wrong")
        if header is None and kind != b"IHDR":
            raise ValueError("PNG: IHDR must come first")
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            idat.append(body)
        ended = kind == b"IEND"
        at += 12 + n
    if header is None or not ended:
        raise ValueError("PNG: a chunk is missing")
    width, height, depth, colour, _, _, interlace = header
    if (depth, colour, interlace) != (8, 0, 0):
        raise ValueError("PNG: only grey samples of 8 bits, not interlaced")
    raw = zlib.decompress(b"".join(idat))
    if len(raw) != height * (width + 1):
        raise ValueError("PNG: wrong number of samples")
    return np.frombuffer(raw, np.uint8).reshape(height, width + 1)


def unfilter(images: list[np.ndarray]) -> list[np.ndarray]:
    """Undoes the row filters of images (rows with their filter in front) of one width, all at once.

    The samples lie in one array with a column of zeros before each row and a row of zeros above each image. In
    step d every row y that has a sample d - y takes it: what it needs was done in the steps before.
    """
    if not images:
        return []
    heights = np.array([len(x) for x in images])
    width, ends = images[0].shape[1] - 1, np.cumsum(heights + 1)
    held = np.zeros((ends[-1], width + 1), np.uint8)
    mine = np.ones(ends[-1], bool)
    mine[ends - heights - 1] = False
    lined = np.concatenate(images)
    held[mine, 1:] = lined[:, 1:]
    if lined[:, 0].max(initial=0) > 4:
        raise ValueError("PNG: unknown row filter")
    y = np.arange(len(lined)) - np.repeat(np.cumsum(heights) - heights, heights)
    order = np.argsort(y, kind="stable")
    y, kinds, flat, stride = y[order], lined[order, 0], held.reshape(-1), width + 1
    # The place of a row's sample d - y, less d.
    base = np.flatnonzero(mine)[order] * stride + 1 - y
    last = int(y[-1]) + width if len(y) else 0
    lows, highs = np.searchsorted(y, np.arange(last) - width, "right"), np.searchsorted(y, np.arange(last), "right")
    for d, lo, hi in zip(range(last), lows.tolist(), highs.tolist(), strict=True):
        at, kind = base[lo:hi] + d, kinds[lo:hi]
        left, up, corner = flat[at - 1], flat[at - stride], flat[at - stride - 1]
        mean = ((left.astype(np.uint16) + up) >> 1).astype(np.uint8)
        guess = np.choose(kind, (np.uint8(0), left, up, mean, _paeth(left, up, corner)))
        flat[at] += guess
    return [held[end - n : end, 1:] for end, n in zip(ends.tolist(), heights.tolist(), strict=True)]


_ANGLE = (2 * np.arange(GRID)[None, :] + 1) * np.arange(LOW)[:, None] * np.pi / (2 * GRID)
COSINES = np.cos(_ANGLE)


def shrink(rows: np.ndarray, grid: int = GRID) -> np.ndarray:
    """Means over a grid x grid raster; short sides repeat their samples."""

    def along(x: np.ndarray, n: int) -> np.ndarray:
        at = np.arange(grid) * n // grid
        if n < grid:
            return x[at]
        sums = np.add.reduceat(x, at, axis=0)
        return sums / np.diff(np.r_[at, n])[:, None]

    down = along(rows.astype(np.float64), rows.shape[0])
    return along(down.T, rows.shape[1]).T


def cosine_hash(rows: np.ndarray) -> bytes:
    """Eight bytes: a bit for each low frequency, set where it is above the median."""
    low = np.round(COSINES @ shrink(rows) @ COSINES.T, 6).ravel()
    return np.packbits(low > np.median(low)).tobytes()


def store_media(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, media: the padded payload of each text as a PNG file."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        payloads = utf8(batch.column(1))
        media = [encode_png(padded(p)) for p in payloads]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(p) for p in payloads], pa.int64()), pa.array(media, pa.binary())], [key, "n_bytes", "media"])

    kind = dict(df.dtypes)[key]
    return map_texts(df.select(key, text), work, f"{key} {kind}, n_bytes long, media binary", text)


def read_media(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Decodes stored media and gives digests and the hash, in a binary and a text column.

    Files are decoded together in slices of bounded payload, as a small file may hold a large one.
    """
    fields = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "cosine_bits", "feature"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in fields]
        files = batch.column(2).to_pylist()
        for n, media, rows in zip(batch.column(1).to_pylist(), files, unfilter([filtered_rows(x) for x in files]), strict=True):
            payload, bits = rows.tobytes(), cosine_hash(rows)
            if any(payload[n:]):
                raise ValueError("media: padding is not zero")
            for column, value in zip(out, (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(media), hashlib.sha256(media).hexdigest(), bits, bits.hex()), strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], [key, *fields])

    kind = dict(df.dtypes)[key]
    return map_texts(df.select(key, "n_bytes", "media"), work, f"{key} {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, cosine_bits binary, feature string", "n_bytes")


def media_columns(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stores the media as a table in the shared folder, then reads its bytes back."""
    return read_media(stored(store_media(df, key, text), "media", compression="none"), key)
