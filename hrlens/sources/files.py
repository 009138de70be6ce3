"""File listings as tables (S10): image files of a folder tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import file_stem, has_extension, strip_digits

# Accepted image extensions.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png")


def list_images(spark: SparkSession, folder: str, with_content: bool = False) -> DataFrame:
    """(path, file_name, person, length[, content]) for every image under ``folder``.

    ``person`` is the file stem without digits (``kim12.jpg`` → ``kim``).
    Content bytes are only read when asked (column pruning skips them).
    """
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", r"([^/\\]+)$", 1)
    out = df.where(has_extension(name, IMAGE_EXTENSIONS)).select(
        "path", name.alias("file_name"), strip_digits(file_stem(name)).alias("person"), "length",
        *(["content"] if with_content else []))
    return out
