"""Image folders and image tables."""

import struct
import zlib

import numpy as np
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.schemas import IMAGE

# Any case of .png, .jpg and .jpeg.
IMAGE_FILE = "*.{[pP][nN][gG],[jJ][pP][gG],[jJ][pP][eE][gG]}"


def scan_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded ``.png/.jpg/.jpeg`` files of a folder; undecodable files are dropped.

    Files of other names are left out before anything is read.
    """
    return (
        spark.read.format("image")
        .option("dropInvalid", True)
        .option("pathGlobFilter", IMAGE_FILE)
        .load(path)
        .select("image.*")
        .select(*IMAGE.fieldNames())
    )


def variant_name(origin: Column, variant: Column) -> Column:
    """``{stem}_{variant}{suffix}``; the original keeps its file name."""
    name = F.element_at(F.split(origin, "/"), -1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    suffix = F.regexp_extract(name, r".(\.[^.]+)$", 1)
    return F.when(variant == "original", name).otherwise(
        F.concat(stem, F.lit("_"), variant, suffix)
    )


def sink_images(variants: DataFrame, path: str) -> None:
    """Store image structs with their output names."""
    variants.withColumn("out_name", variant_name(F.col("origin"), F.col("aug"))).write.mode(
        "errorifexists"
    ).parquet(path)


PNG_COLOUR = {1: 0, 3: 2, 4: 6}


def _png(height: int, width: int, channels: int, data: bytes) -> bytes:
    """Lossless file content of one image struct (blue-green-red byte order)."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels > 1:
        pixels = pixels[..., [2, 1, 0, 3][:channels]]
    rows = np.zeros((height, 1 + width * channels), dtype=np.uint8)
    rows[:, 1:] = pixels.reshape(height, -1)

    def section(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    header = struct.pack(">IIBBBBB", width, height, 8, PNG_COLOUR[channels], 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n"
        + section(b"IHDR", header)
        + section(b"IDAT", zlib.compress(rows.tobytes()))
        + section(b"IEND", b"")
    )


def export_png(images: DataFrame, path: str, name_col: str = "out_name") -> None:
    """One ``.png`` file per image struct, written by the tasks into a shared folder.

    A retried task writes the same files again. Names that stand for several images, which
    would overwrite each other, are refused before anything is written.
    """
    again = images.groupBy(F.col(name_col).alias("name")).count().where("count > 1").first()
    if again is not None:
        raise ValueError(f"{again['count']} images have the file name {again['name']}")
    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
    filesystem, root = arrow_fs.FileSystem.from_uri(uri)
    filesystem.create_dir(root)

    def run(batches):
        target, folder = arrow_fs.FileSystem.from_uri(uri)
        for batch in batches:
            for row in batch.itertuples(index=False):
                with target.open_output_stream(f"{folder}/{row[0]}") as out:
                    out.write(_png(row.height, row.width, row.nChannels, row.data))
            yield batch[["name"]]

    named = images.select(F.col(name_col).alias("name"), "height", "width", "nChannels", "data")
    named.mapInPandas(run, "name string").write.format("noop").mode("overwrite").save()
