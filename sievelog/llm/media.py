"""Media columns: texts stored as lossless WebP images and read back as pixel arrays.

A payload's bytes are grey pixels, 64 in a row; beyond 16384 rows (1 MB) whole rows of 16384 pixels come first, in images
of up to 16384 rows. Images use the subtract-green transform, a palette of the bytes that occur (packed where there are
16 or fewer), prefix codes and back-references. Channels that are constant cost a code of one symbol.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried
from .webp import LIMIT, decode, encode

ROW = 64


def store_payload(data: bytes) -> tuple[bytes, bytes]:
    """The bytes with zeros up to a positive multiple of 64, and the images that hold them."""
    payload = data + bytes(-len(data) % ROW or (0 if data else ROW))
    samples = np.frombuffer(payload, np.uint8).astype(np.uint32)
    grey = samples * np.uint32(0x010101) | np.uint32(0xFF000000)
    images, at = [], 0
    while len(grey) - at > ROW * LIMIT:
        rows = min(LIMIT, (len(grey) - at) // LIMIT)
        images.append(grey[at : at + rows * LIMIT].reshape(rows, LIMIT))
        at += rows * LIMIT
    if at < len(grey):
        images.append(grey[at:].reshape(-1, ROW))
    return payload, b"".join(encode(x, palette=True, back=True, subtract_green=True) for x in images)


def read_payload(blob: bytes) -> bytes:
    return b"".join((x >> 8 & 255).astype(np.uint8).tobytes() for x in decode(blob))


def media_features(docs: DataFrame, key: str = "doc_id", text: str = "text", with_pixels: bool = False) -> DataFrame:
    """Per input row: key, n_bytes, payload_bytes, payload_sha256 and tail_crc32 (both of what is read back from the
    stored form), media_bytes, media_sha256, feature (mean and spread of the samples and number of different ones), and
    with ``with_pixels`` media binary and pixels array<array<int>> (rows of grey samples per image, concatenated).

    A null or empty text is 64 zero bytes. Equal texts give equal values; further columns are ignored; an empty table gives
    an empty table. A task holds one text and its image at a time.
    """
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("body"))
    source = source.select(*carried(source, ["k"]), "body")
    schema = f"k {source.schema['k'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + (", media binary, pixels array<array<int>>" if with_pixels else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["body"]:
                data = (text or "").encode("utf-8", "surrogatepass")
                _, blob = store_payload(data)
                images = [x >> 8 & 255 for x in decode(blob)]
                back = b"".join(x.astype(np.uint8).tobytes() for x in images)
                counts = np.bincount(np.frombuffer(back, np.uint8), minlength=256)
                values = np.arange(256)
                mean = (counts @ values) / len(back)
                spread = (counts @ (values - mean) ** 2) / len(back)
                row = [len(data), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-ROW:]), len(blob), hashlib.sha256(blob).hexdigest(), f"{mean:.6f},{spread:.6f},{np.count_nonzero(counts)}"]
                rows.append(row + ([blob, [r.astype(np.int32) for x in images for r in x]] if with_pixels else []))
            names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", *(["media", "pixels"] if with_pixels else [])]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "k", batch["k"].to_numpy())
            yield out

    out = source.mapInPandas(run, schema)
    return out.withColumn("k", F.col("k").cast(kind)).withColumnRenamed("k", key)
