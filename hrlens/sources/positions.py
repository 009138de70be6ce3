"""The place of a row in its files.

``nlargest``, ``.values[0]`` and "the first five" take ties in file order.  Spark's rows have no order, but a scan knows
where it reads: the hidden metadata give a row's file and the block of the file it was read from, and rows of a block
come in file order.  ``with_position`` turns that into a number:

1. the scan is written once with file, block and the running number Spark gives rows of a task;
2. a block's rows are numbered from its first running number on;
3. blocks are counted, put in order of file and block, and their counts summed up (one row a block).

The number depends on the files alone: files in order of path, rows in order of the file, however the scan is cut into
blocks and tasks.  So it tells exact duplicates apart, and sorting by it is sorting by file order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.persist import materialize


def with_position(scan: DataFrame, name: str = "position") -> DataFrame:
    """``scan`` (a plain read of files, with or without a projection or filter) with each row's number, from 0, in file order.

    Rows that the scan leaves out are not counted.  Within a file, blocks are split at line ends as the reader does it.
    """
    if name in scan.columns:
        raise ValueError(f"the table has a column {name!r}")
    own = [F.col(f"`{c}`") for c in scan.columns]
    rows = materialize(scan.select(F.struct(*own).alias("r") if own else F.lit(None).alias("r"), F.col("_metadata.file_path").alias("file"),
                                   F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")), repartition=False)
    blocks = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    # files are told apart first, so that the running sum over files has one row a file and that over blocks one file's blocks
    files = blocks.groupBy("file").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select("file", before.alias("file_at"))
    inside = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("block_at")).join(files, "file")
    placed = rows.join(starts, ["file", "block"])
    return placed.select("r.*", (F.col("file_at") + F.col("block_at") + F.col("id") - F.col("first")).alias(name))
