"""Image files: embeddings drawn as small grey pictures, then read back by the image source."""

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.tables import Tables

SIDE = 8


def bitmap(values) -> bytes:
    """An uncompressed 24-bit bitmap, ``SIDE`` pixels wide; rows are stored from the bottom up."""
    rows = -(-len(values) // SIDE)
    pixels = bytearray()
    for row in range(rows - 1, -1, -1):
        line = values[row * SIDE : (row + 1) * SIDE]
        for value in line:
            pixels += bytes([max(0, min(255, int(128 + 127 * value)))] * 3)
        pixels += bytes(3 * (SIDE - len(line)))
    head = struct.pack("<2sIHHI", b"BM", 54 + len(pixels), 0, 0, 54)
    return head + struct.pack("<IiiHHIIiiII", 40, SIDE, rows, 1, 24, 0, len(pixels), 0, 0, 0, 0) + bytes(pixels)


def write_bitmaps(folder: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = workspace.file_store(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for key, values in zip(batch["vec_id"], batch["embedding"]):
                # The name follows from the key, so a task that runs again writes the same file.
                with store.open_output_stream(f"{base}/{key}.bmp") as out:
                    out.write(bitmap(values))
            yield batch[["vec_id"]]

    return write


@query("io_image_metadata", "SELECT vec_id, 8 AS height, 8 AS width, 3 AS channels, 192 AS n_bytes FROM embeddings")
def io_image_metadata(t: Tables) -> DataFrame:
    """Size and channels of each picture; tasks write the files into the shared folder."""
    folder = workspace.scratch(t.spark, "images")
    t.embeddings.select("vec_id", "embedding").mapInPandas(write_bitmaps(folder), "vec_id bigint").agg(F.count("*")).first()
    images = t.spark.read.format("image").option("dropInvalid", True).load(folder)
    return images.select(
        F.regexp_extract("image.origin", r"(\d+)\.bmp$", 1).cast("bigint").alias("vec_id"),
        "image.height",
        "image.width",
        F.col("image.nChannels").alias("channels"),
        F.length("image.data").alias("n_bytes"),
    )
