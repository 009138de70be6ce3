"""Reliable materialisation of intermediate tables for multi-pass jobs.

Iterative and multi-pass computations (model fits, OLS/REML passes) read
their prepared input several times.  ``materialize`` writes it once with
``checkpoint()`` into the shared folder the cluster names in
``spark.checkpoint.dir``: later passes scan the written copy (no re-run of the
upstream joins), and a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

#: With 200 doubles a row (random features) a partition is some 80 MB.
ROWS_PER_PARTITION = 50_000


def materialize(df: DataFrame, n_rows: int | None = None, repartition: bool = True) -> DataFrame:
    """Checkpoint ``df``; with ``repartition`` size partitions by row count first."""
    ensure_checkpoint_dir(df.sparkSession)
    if repartition:
        if n_rows is None:
            n_rows = df.count()
        df = df.repartition(max(1, math.ceil(n_rows / ROWS_PER_PARTITION)))
    return df.checkpoint(eager=True)


class Rounds:
    """The table of an iterative job, written anew each round in the shared folder; the round before is removed.

    A written table cuts the lineage, so a lost executor costs a re-read of the last round.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.k = 0

    def write(self, df: DataFrame) -> DataFrame:
        """Writes ``df``, which may read the round before, and returns the written table."""
        self.k += 1
        df.write.parquet(f"{self.path}/{self.k}")
        self._remove(f"{self.path}/{self.k - 1}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{self.k}")

    def drop(self) -> None:
        """Removes the folder, once no DataFrame reads it any more."""
        self._remove(self.path)

    def _remove(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
