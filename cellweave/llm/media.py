"""Media columns in lossless WebP.

`store` writes each text's bytes as a grey image, 64 bytes to a row, into a Parquet table with a binary column; `pixels` decodes such a
column (any lossless WebP file) to width, height and an array of red, green, blue and alpha bytes; `payloads` reads texts back from what is stored.

Bytes 0 fill a text up to a positive multiple of 64, so null and empty texts are one row of zeros. Where a text needs more than 16384 rows, rows get
wider, in multiples of 64, and the last one is filled up too. Nothing is shuffled: each task encodes and decodes the rows it
reads. Equal texts give equal files; equal rows, rows without doc_id and rows that share one each have a row. An empty table gives an empty result. Other
columns, whatever their names, are not read. Texts are read whole, however long; one above 256 MiB doesn't fit an image and raises ValueError.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cellweave.llm.common import id_and_text, slices, table
from cellweave.llm.webp import MOST_SIDE, decode, encode_grey

UNIT = 64


def padded(text: bytes) -> bytes:
    return text + bytes(max(UNIT, -(-len(text) // UNIT) * UNIT) - len(text))


def image_of(payload: bytes) -> bytes:
    width = UNIT * max(1, -(-len(payload) // (UNIT * MOST_SIDE)))
    return encode_grey(payload + bytes(-len(payload) % width), width)


def encoded(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=2 << 20):
            held = batch.column("text").cast(pa.binary())
            yield table(schema, doc_id=batch.column("doc_id"), n_bytes=pc.binary_length(held).cast(pa.int64()), media=[image_of(padded(x)) for x in held.to_pylist()])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def store(docs: DataFrame, path: str) -> None:
    # the files are compressed already
    encoded(docs).write.option("compression", "none").parquet(path)


def pixels(media: DataFrame, column: str = "media", key: str = "doc_id") -> DataFrame:
    """key, width, height and pixels (4 bytes each, row by row) of a column of lossless WebP files; null: null."""
    schema = pa.schema([(key, pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("pixels", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, most=1 << 20):
            images = [None if x is None else decode(x) for x in batch.column(column).to_pylist()]
            yield table(schema, **{key: batch.column(key)}, width=[None if x is None else x.shape[1] for x in images], height=[None if x is None else x.shape[0] for x in images], pixels=[None if x is None else x.tobytes() for x in images])

    return media.select(key, column).mapInArrow(run, f"`{key}` long, width int, height int, pixels binary")


def describe(image: np.ndarray, payload: np.ndarray) -> str:
    counts = np.bincount(payload, minlength=256)
    return f"{image.shape[1]}x{image.shape[0]} values={int((counts > 0).sum())} mean={int(payload.sum(dtype=np.int64)) / len(payload):.4f} most={int(counts.argmax())}"


def payloads(media: DataFrame) -> DataFrame:
    """What the stored files hold: sizes, digests and a feature of each; the digests are of the pixels as decoded."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", most=1 << 20):
            sizes, held = batch.column("n_bytes").to_pylist(), batch.column("media").to_pylist()
            rows = []
            for n, data in zip(sizes, held, strict=True):
                image = decode(data)
                payload = np.ascontiguousarray(image[..., 1]).ravel()[: max(UNIT, -(-n // UNIT) * UNIT)]
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(), describe(image, payload)))
            columns = dict(zip(schema.names[2:], zip(*rows, strict=True), strict=True))
            yield table(schema, doc_id=batch.column("doc_id"), n_bytes=batch.column("n_bytes"), **columns)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
