"""Image file headers, read in Arrow batches."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEADER = "format string, width int, height int"

# File signatures, and the JPEG markers that carry the frame size.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
JPEG_SIGNATURE = b"\xff\xd8"
JPEG_FRAME_MARKERS = {*range(0xC0, 0xD0)} - {0xC4, 0xC8, 0xCC}


def header_of(content: bytes | None) -> tuple[str | None, int | None, int | None]:
    """(format, width, height) of PNG or JPEG bytes, Nones where unreadable."""
    unknown = (None, None, None)
    if content is None:
        return unknown
    if content.startswith(PNG_SIGNATURE) and len(content) >= 24:
        return ("png", *struct.unpack(">II", content[16:24]))
    if not content.startswith(JPEG_SIGNATURE):
        return unknown
    at = 2
    while at + 9 <= len(content) and content[at] == 0xFF:
        marker, size = content[at + 1], int.from_bytes(content[at + 2 : at + 4], "big")
        if marker in JPEG_FRAME_MARKERS:
            height, width = struct.unpack(">HH", content[at + 5 : at + 9])
            return ("jpeg", width, height)
        at += 2 + size
    return ("jpeg", None, None)


def image_headers(df: DataFrame, content: str = "content") -> DataFrame:
    """Replace the bytes of each image by its format, width and height.

    The projection runs where the files are read; bytes are never shuffled, and
    Spark bounds the bytes per Arrow batch.
    """

    @F.pandas_udf(HEADER)
    def headers(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [header_of(None if b is None else bytes(b)) for b in batch]
            yield pd.DataFrame(rows, columns=["format", "width", "height"]).astype(
                {"format": "object", "width": "Int32", "height": "Int32"}
            )

    rest = [c for c in df.columns if c != content]
    return df.select(*rest, headers(F.col(content)).alias("_h")).select(*rest, "_h.*")


def pillow_decoder(size: int = 224) -> Callable[[bytes], np.ndarray]:
    """Decoder to RGB pixels of ``size`` x ``size``; needs Pillow on the executors."""

    def decode(content: bytes) -> np.ndarray:
        import io

        from PIL import Image

        image = Image.open(io.BytesIO(content)).convert("RGB")
        return np.asarray(image.resize((size, size), Image.Resampling.LANCZOS))

    return decode


def image_vectors(
    df: DataFrame, decoder: Callable[[bytes], np.ndarray], content: str = "content", alias: str = "pixels"
) -> DataFrame:
    """Replace the bytes of each image by its pixels, channel by channel.

    ``decoder`` turns bytes into a height x width x channels array.  The result
    is what ``standardize`` takes.  A missing content stays missing; bytes that
    are no image fail, as silently dropping them would change the training set.
    """

    @F.pandas_udf("array<float>")
    def pixels(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [
                    None if b is None else np.moveaxis(decoder(bytes(b)), -1, 0).astype("float32").ravel()
                    for b in batch
                ],
                dtype="object",
            )

    rest = [c for c in df.columns if c != content]
    return df.select(*rest, pixels(F.col(content)).alias(alias))
