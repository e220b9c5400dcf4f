"""Image folders as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The accepted extensions.
EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "tiff", "gif", "webp")


def is_image(name: Column) -> Column:
    """True for an accepted extension, whatever its case."""
    return name.rlike(r"(?i)\.(" + "|".join(EXTENSIONS) + r")\z")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def scan_images(spark: SparkSession, folder: str) -> DataFrame:
    """Images directly in a folder: image, path, length, content.

    Leave ``content`` out of later selections and no file is opened.
    """
    files = spark.read.format("binaryFile").load(folder)
    found = files.withColumn("image", file_name(F.col("path")))
    return found.where(is_image(F.col("image"))).select("image", "path", "length", "content")


def filter_image_names(manifest: DataFrame, name: str = "image") -> DataFrame:
    """Distinct accepted image names of a manifest."""
    return manifest.where(is_image(F.col(name))).select(name).distinct()
