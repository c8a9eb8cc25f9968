"""Media columns: Netpbm and BMP images as numpy arrays, area-resized by integral images, NPY tiles, difference hashes."""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents

#: Bytes of a row of the image that holds a payload; side of a tile; digits that a number in a text header or raster can have.
ROW, TILE, DIGITS = 64, 64, 9


def encode_pgm(pixels: np.ndarray) -> bytes:
    """8-bit grey pixels as binary Netpbm."""
    height, width = pixels.shape
    return b"P5\n%d %d\n255\n" % (width, height) + np.ascontiguousarray(pixels, np.uint8).tobytes()


def _netpbm(data: bytes) -> np.ndarray:
    kind, at, fields = data[:2], 2, []
    gap = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])*")
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        at = gap.match(data, at).end()
        number = re.compile(rb"\d+").match(data, at)
        if not number or len(number[0]) > DIGITS:
            raise ValueError("Netpbm header ends early or is out of range")
        fields.append(int(number[0]))
        at = number.end()
    width, height, depth = (*fields, 1)[:3]
    planes = 3 if kind in (b"P3", b"P6") else 1
    if not (width > 0 and height > 0 and 0 < depth < 65536):
        raise ValueError("Netpbm header out of range")
    n = width * height * planes
    if kind in (b"P1", b"P2", b"P3"):
        body = re.sub(rb"#[^\n\r]*", b"", data[at:])
        words = list(re.sub(rb"\s", b"", body)[:n]) if kind == b"P1" else body.split(maxsplit=n)[:n]
        if kind != b"P1" and not all(w.isdigit() and len(w) <= DIGITS for w in words):
            raise ValueError("Netpbm raster holds no number")
        values = np.array(words, np.int64) - 48 * (kind == b"P1")
    elif kind == b"P4":
        row = (width + 7) // 8
        raw = np.frombuffer(data, np.uint8, row * height, at + 1).reshape(height, row)
        values = np.unpackbits(raw, axis=1)[:, :width].reshape(-1)
    else:
        values = np.frombuffer(data, np.dtype(">u2" if depth > 255 else "u1"), n, at + 1)
    if len(values) != n:
        raise ValueError("Netpbm raster ends early")
    if n and (values.min() < 0 or values.max() > depth):
        raise ValueError("Netpbm value out of range")
    if kind in (b"P1", b"P4"):
        values = (1 - values) * 255  # 1 is black
    elif depth != 255:
        values = (values.astype(np.int64) * 255 + depth // 2) // depth
    shape = (height, width, 3) if planes == 3 else (height, width)
    return values.astype(np.uint8).reshape(shape)


def _bmp(data: bytes) -> np.ndarray:
    word = lambda at, n=4, signed=False: int.from_bytes(data[at : at + n], "little", signed=signed)
    start, header = word(10), word(14)
    if header < 40:
        raise ValueError("BMP header of an unknown kind")
    width, height, bits, packed, colours = word(18, 4, True), word(22, 4, True), word(28, 2), word(30), word(46)
    if width <= 0 or height == 0 or bits not in (1, 4, 8, 24, 32) or packed not in (0, *([3] * (bits == 32))):
        raise ValueError("BMP of an unknown kind")
    rows, row = abs(height), (width * bits + 31) // 32 * 4
    if start + rows * row > len(data):
        raise ValueError("BMP raster ends early")
    raw = np.frombuffer(data, np.uint8, row * rows, start).reshape(rows, row)
    raw = raw if height < 0 else raw[::-1]
    if bits >= 24:
        return np.ascontiguousarray(raw[:, : width * bits // 8].reshape(rows, width, bits // 8)[:, :, 2::-1])
    if bits == 8:
        index = raw[:, :width]
    else:
        index = np.unpackbits(raw, axis=1).reshape(rows, -1, bits)
        index = (index * (1 << np.arange(bits - 1, -1, -1))).sum(axis=2)[:, :width]
    palette = np.frombuffer(data, np.uint8, 4 * min(colours or 1 << bits, 1 << bits), 14 + header).reshape(-1, 4)[:, 2::-1]
    if index.max() >= len(palette):
        raise ValueError("BMP pixel outside its palette")
    out = palette[index]
    return out[:, :, 0] if (palette == palette[:, :1]).all() else out


def decode(data: bytes) -> np.ndarray:
    """Pixels of a Netpbm (P1 to P6) or BMP image: (height, width) or (height, width, 3) of 8 bits.  ValueError for
    anything else, cut short, or with values, indices or sizes out of range."""
    if data[:1] == b"P" and data[1:2] in b"123456":
        return _netpbm(data)
    if data[:2] == b"BM":
        return _bmp(data)
    raise ValueError("neither Netpbm nor BMP")


def resize_area(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the area under each target pixel, by an integral image that is interpolated between whole pixels."""
    grey = pixels.mean(axis=2) if pixels.ndim == 3 else pixels
    h, w = grey.shape
    sums = np.zeros((h + 1, w + 1))
    np.cumsum(grey, axis=0, dtype=np.float64, out=sums[1:, 1:])
    np.cumsum(sums[1:, 1:], axis=1, out=sums[1:, 1:])

    def cut(table: np.ndarray, parts: int) -> np.ndarray:
        at = np.arange(parts + 1) * (len(table) - 1) / parts
        low = np.minimum(at.astype(int), len(table) - 2)
        return table[low] + (at - low)[:, None] * (table[low + 1] - table[low])

    areas = np.diff(np.diff(cut(cut(sums, height).T, width).T, axis=0), axis=1)
    return areas * (height * width / (h * w))


def difference_hash(pixels: np.ndarray) -> str:
    """64 bits: is a cell of the 8 x 9 area mean brighter than the one to its right?"""
    small = np.round(resize_area(pixels, 8, 9), 6)
    return np.packbits(small[:, :-1] > small[:, 1:]).tobytes().hex()


def npy(pixels: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, pixels, allow_pickle=False)
    return out.getvalue()


def image_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, image bytes) -> tile and hash.  An image that can't be decoded gives nulls and an error."""
    for batch in batches:
        rows = []
        for key, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            try:
                pixels = decode(data.as_buffer().to_pybytes() if data.is_valid else b"")
                small = np.round(resize_area(pixels, TILE, TILE)).astype(np.uint8)
                rows.append((key, pixels.shape[0], pixels.shape[1], npy(small), difference_hash(pixels), None))
            except ValueError as e:
                rows.append((key, None, None, None, None, str(e)))
        names = ["key", "height", "width", "npy", "dhash", "error"]
        kinds = [batch.schema.field(0).type, pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string()]
        yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], names=names)


def media_columns(images: DataFrame, key_col: str, image_col: str) -> DataFrame:
    """Decoded size, NPY tile (TILE x TILE area means), difference hash and error of each image.

    A null, broken or foreign image gives nulls and an error; repeated rows come back as often; other columns are
    ignored; an empty table stays empty.
    """
    kind = images.schema[key_col].dataType.simpleString()
    return images.select(F.col(key_col), F.col(image_col).cast("binary")).mapInArrow(
        image_features, f"key {kind}, height int, width int, npy binary, dhash string, error string"
    )


def store_text(text: str | None) -> bytes:
    """A text's UTF-8 bytes, padded with 0 to a positive multiple of 64, as the pixels of a grey Netpbm image."""
    data = (text or "").encode()
    return encode_pgm(np.frombuffer(data.ljust(max(1, -(-len(data) // ROW)) * ROW, b"\0"), np.uint8).reshape(-1, ROW))


def _stored(batches: Iterator[pa.RecordBatch], tiles: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, held = [], []
        for text in batch.column(1):
            n = len(text.as_buffer()) if text.is_valid else 0
            media = store_text(text.as_py())
            pixels = decode(media)  # from here on, only what was read back
            payload = pixels.tobytes()
            tile = npy(np.round(resize_area(pixels, TILE, TILE)).astype(np.uint8))
            rows.append(
                (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ROW:]), len(media), hashlib.sha256(media).hexdigest(),
                 f"dhash:{difference_hash(pixels)} npy:{zlib.crc32(tile):08x}")
            )
            held += [tile] * tiles
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        cols = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)]
        names = [x.split()[0] for x in _STORED.split(", ")]
        yield pa.record_batch([batch.column(0), *cols, *[pa.array(held, pa.binary())] * tiles], names=[*names, *["npy"] * tiles])


_STORED = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def text_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tiles: bool = False) -> DataFrame:
    """Every text stored as an image, read back, hashed and described; with `tiles`, its NPY tile as a last column, npy.

    A null text is an empty one; a null id stays null; repeated rows come back as often; equal texts give equal values;
    other columns are ignored; an empty table stays empty.  A map without a shuffle.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(partial(_stored, tiles=tiles), _STORED + ", npy binary" * tiles)


def op9_media(spark, sf_dir: str) -> DataFrame:
    """Every document's text as an image."""
    return text_media(documents(spark, sf_dir))
